"""Pre-tests never change what the correction rules give; accents, image headers, topics, files of pages."""

import os
import random
import re
import struct
import unicodedata

from pyspark.sql import functions as F

from quireon.functions import rules as R
from quireon.functions import spans as S
from quireon.functions import text as X
from quireon.operators import extract as M
from quireon.operators import topics as T
from quireon.sources import files


def test_correct_equals_all_rules_in_order(spark):
    rng = random.Random(4)
    bits = ["l", "I", "1", "0", "O", "o", "A", "B", "a", "b", "7", " ", " ", ".", "é", *R.WORD_RULES, "ler", "Ier", "1es", "lundi", "IL"]
    rows = [(k, "".join(rng.choices(bits, k=rng.randrange(0, 9)))) for k in range(3000)] + [(9000, None), (9001, "")]
    t = spark.createDataFrame(rows, "k int, t string")
    plain = F.col("t")
    for a, b in [*R.LETTER_RULES, *R.WORD_RULES.items()]:
        plain = F.regexp_replace(plain, rf"(?U)\b{a}\b", X.java(b))
    got = t.select("t", X.correct(F.col("t")).alias("a"), plain.alias("b")).collect()
    assert all(r.a == r.b for r in got) and sum(r.t != r.a for r in got) > 300


def test_accents_by_decomposition(spark):
    """Every accented Latin letter becomes its base, where that is ASCII; letters of other alphabets stay."""
    letters = "".join(c for c in map(chr, range(0xC0, 0x250)) if len(unicodedata.normalize("NFD", c)) > 1)
    want = "".join(d[0] if (d := unicodedata.normalize("NFD", c))[0].isascii() else c for c in letters)
    row = spark.createDataFrame([(letters, "œuvre «ß» l’été… 5° ǆ Жи")], "a string, b string").select(X.ascii_letters(F.col("a")), X.ascii_letters(F.col("b"))).first()
    assert row[0] == want and row[1] == "oeuvre <<ss>> l'ete... 5deg ǆ Жи"


def test_image_headers():
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 640, 480) + b"\x08\x02\0\0\0"
    for order, magic in (("<", b"II*\0"), (">", b"MM\0*")):
        tags = struct.pack(order + "HHIHxx", 256, 3, 1, 300) + struct.pack(order + "HHII", 257, 4, 1, 70000)
        tiff = magic + struct.pack(order + "I", 10) + b"xx" + struct.pack(order + "H", 2) + tags + b"\0" * 4
        assert files.header_size(tiff) == (300, 70000)
        assert files.header_size(tiff[:12]) is None and files.header_size(tiff[:30]) is None
    assert files.header_size(png) == (640, 480) and files.header_size(b"") is None and files.header_size(b"text of no image") is None


def test_chosen_topics(spark):
    """The likeliest first, the lower number on ties; topics named x are left out, also where they would be among the three."""
    names = ["a", "x", "b", "c", "x", "d"]
    rows = [(1, [0.1, 0.5, 0.1, 0.1, 0.1, 0.1]), (2, [0.0, 0.3, 0.2, 0.0, 0.3, 0.2]), (3, [1 / 6] * 6)]
    got = spark.createDataFrame(rows, "k int, p array<double>").select("k", T.chosen(F.col("p"), names, 3).alias("t"))
    assert {r.k: r.t for r in got.collect()} == {1: ["a", "b", "c"], 2: ["b", "d", "a"], 3: ["a", "b", "c"]}


def test_files_of_pages_and_manifests(spark, tmp_path):
    files.write_segments(spark.createDataFrame([(7, "{}"), (8, "[]")], "page_id long, segments string"), str(tmp_path / "seg"))
    files.write_manifests(spark.createDataFrame([("12bis", "{}")], "cote string, manifest string"), str(tmp_path / "man"))
    assert sorted(os.listdir(tmp_path / "seg")) == ["7.json", "8.json"] and os.listdir(tmp_path / "man") == ["CH-AEV_IV_12bis.json"]


def test_group_keeps_the_order_of_alternatives():
    """On texts of pieces of the alternatives, the same match as the plain alternation."""
    rng = random.Random(1)
    for words in (R.PLACES, [*R.PLACES, *R.PLACE_SPELLINGS], sorted(R.PRINTERS, key=len), R.PRINTERS, R.CATEGORIES, [*R.MONTHS, *R.REPUBLICAN_MONTHS, *R.MONTH_VARIANTS], R.CONNECTORS, ["ab", "a", "abc", "b", "bc", "b", "c", "d", "e", "f?"], [*"abcdefghij", "ab"]):
        dealt, plain = re.compile(S.group(words), re.I), re.compile("(?:" + "|".join(words) + ")", re.I)
        for _ in range(300):
            text = "".join(w[: rng.randrange(1, len(w) + 1)] + rng.choice(["", " ", "e"]) for w in rng.choices(words, k=rng.randrange(1, 5)))
            text = text.upper() if rng.random() < 0.2 else text
            assert [m.span() for m in dealt.finditer(text)] == [m.span() for m in plain.finditer(text)]
    assert S.group(["a", "b"]) == "(?:a|b)" and S.group(["x|y", *"abcdefghi"]).startswith("(?:x|y|a")


def test_patterns_are_tried_where_words_are_mentioned(spark):
    """Plain words are looked for before patterns; letters that patterns take for others don't hide a match."""
    assert S.literal("commissaire(?:s)? federal") == "commissaire" and S.literal("1er vice-president") == "1er vice-president" and S.literal("ab?c") == "a"
    texts = ["\nLe pre\u017fident du conseil\nJean Rey", "\nLE PRES\u0130DENT\nJean Rey", "\nLe vice\nJean Rey", "\nLa chancellerie\n", "Fait a \u017fion le 5 mai 1805", "le 5 mai 1805", "rien", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(1)
    got = df.select("i", M.signature(F.col("t"))[0].alias("s"), M.dates(F.col("t"))[0].alias("d"), S.mentions(F.col("t"), R.SIGNATORIES).alias("m")).orderBy("i").collect()
    assert [r.s for r in got] == ["grande_signature", "grande_signature", "no_match", "signature_institution", *["no_match"] * 4]
    assert [r.d for r in got] == [*["no_match"] * 4, "formule_petite+date_complete", "le+date_complete", "no_match", "no_match"]
    assert [r.m for r in got] == [True, True, *[False] * 5, None]
