"""ALTO pages against the rule in plain Python, with files larger than a split."""

import random
import unicodedata
from xml.sax.saxutils import quoteattr

from quireon.sources.files import alto_text


def text_of(lines):
    out, before = [], None
    for top, high, words in lines:
        if before and before[0] > 0 and before[1] > 0 and top > before[0] + 0.75 * before[1]:
            if out and out[-1] == " ":
                out[-1] = "\n"
            else:
                out.append("\n")
            if top > before[0] + 3 * before[1]:
                out.append("\n")
        for w in words:
            out += [w, " "]
        before = (top, high)
    return unicodedata.normalize("NFC", "".join(out)).rstrip(" ")


def xml_of(lines):
    rows = [f'<TextLine HEIGHT="{h}" VPOS="{v}"' + (">" + "<SP/>".join(f"<String STYLE='x' CONTENT={quoteattr(w)}/>" for w in ws) + "</TextLine>" if ws else "/>") for v, h, ws in lines]
    half = len(rows) // 2
    return f"<?xml version='1.0'?><alto xmlns='http://x'><Layout><Page><PrintSpace><ComposedBlock><TextBlock>{''.join(rows[:half])}</TextBlock></ComposedBlock><!-- <TextLine VPOS='1' HEIGHT='1'/> --><TextBlock>\n{chr(10).join(rows[half:])}</TextBlock></PrintSpace></Page></Layout></alto>"


def test_alto_equals_the_rule(spark, tmp_path):
    rng = random.Random(2)
    pages = {}
    for k in range(6):
        top, lines = 0, []
        for _ in range((5, 60, 3000)[k % 3]):
            top += rng.choice([0, 5, 9, 14, 40])
            lines.append((top, rng.choice([0, 10, 12]), [rng.choice(["loi", "vin & eau", "<b>", "été", '"cit"', "Valais", "l'État"]) for _ in range(rng.randrange(0, 6))]))
        pages[f"p{k}.xml"] = lines
        (tmp_path / f"p{k}.xml").write_text(xml_of(lines), encoding="utf8")
    (tmp_path / "none.xml").write_text("<alto/>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {r.file: r.text for r in alto_text(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {f: text_of(lines) for f, lines in pages.items()} | {"none.xml": ""}
    assert max(f.stat().st_size for f in tmp_path.iterdir()) > 100_000
