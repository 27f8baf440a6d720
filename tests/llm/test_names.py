"""Names in pages only propose a part; columns of callers are never touched."""

from pyspark.sql import functions as F

from quireon.llm.common import sieve
from quireon.llm.html_text import blocks_of, extract, text_of

ODD = '<div class="article-header"><h1>Title</h1></div><p class="market-share">Shares</p><section class="related-work"><p>Others</p></section><div class="alert">Look</div>'


def test_names_alone_take_no_article_text():
    page = f'<article>{ODD}<p>The <span class="share">fifth</span> part</article>'
    assert text_of(page, [], [], []) == text_of(page, [], [], None) == "Title\nShares\nOthers\nLook\nThe fifth part"
    assert text_of('<article><p>Text<div class="ad">Buy</div></article>', [], [], None) == "Text"
    assert text_of('<article><div class="ad">Buy</div></article>', [], [], None) == "Buy"
    assert [b[2] for b in blocks_of('<div class="ad"><p id="menu">x</div><p>y')] == ["div ad", ""]


def test_other_pages_confirm_names(spark):
    """Adverts that differ on every page go by their place; names that only one article has stay, and so do headings and a lone block."""
    ad = lambda k: f'<div class="ad-box">Buy {k}<p>now {k}</div>'
    rows = [(k, f"http://h/a/{k}", f'<article><div class="header"><h1>Head {k}</h1><p>by {k}</p></div><p>Body {k}{ad(k)}{ODD if k == 3 else ""}</article>') for k in range(1, 7)]
    rows += [(10, "http://g/1", f"<article><p>One{ad(1)}</article>"), (11, "http://g/2", f"<article><p>Two{ad(2)}</article>"), (12, "http://one/1", f"<article><p>Alone{ad(3)}<div class='ad'>x</div></article>"), (13, "http://k/1", '<article><div class="notice">A 1</div></article>'), (14, "http://k/2", '<article><div class="notice">A 2</div></article>')]
    df = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("_marks", "_mark", "_beside", "_confirmed", "_key", "_b", "_map")})
    got = sorted((r.page_id, r.text) for r in extract(df).collect())
    odd = "\nTitle\nShares\nOthers\nLook"
    want = [(k, f"Head {k}\nBody {k}{odd if k == 3 else ''}") for k in (1, 1, 2, 3, 4, 5, 6)] + [(10, "One"), (11, "Two"), (12, "Alone\nBuy 3\nnow 3"), (13, "A 1"), (14, "A 2")]
    assert got == want


def test_sieve_leaves_columns_alone(spark):
    df = spark.createDataFrame([(k, f"t{k}", "m", "u", "v", "w", None) for k in range(50)] + [(None, "n", "m", "u", "v", "w", None)], "id long, _b string, _map string, _bucket string, _byte string, _AT string, `a.b` string")
    keys = spark.createDataFrame([(3,), (7,), (None,)], "id long")
    kept, rest = sieve(df, "id", keys, "bits"), sieve(df, "id", keys, "bits", keep=False)
    assert kept.columns == rest.columns == df.columns
    assert {r["_b"] for r in kept.collect()} >= {"t3", "t7"} and {r["_b"] for r in rest.collect()} >= {f"t{k}" for k in range(50) if k not in (3, 7)} - {r["_b"] for r in kept.collect()}
    assert {tuple(r)[2:] for r in kept.unionByName(rest).collect()} == {("m", "u", "v", "w", None)}
