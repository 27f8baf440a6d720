"""Fill-in-the-middle, quality classifier and whitening against brute force on small inputs."""

import random
import re
import zlib
from fractions import Fraction
from hashlib import sha256
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireon.llm.fill_middle import fill_in_middle, op11_fill_middle, restored, select, starts_of
from quireon.llm.quality import NAMES, Forest, boosted, op12_quality, quality_scores, statistics
from quireon.llm.whitening import gram, limbs, op13_whitening, whiten

TEXTS = [(1, "a b c d e"), (1, "a b c d e"), (2, None), (3, ""), (4, " \n\t\r "), (5, "x" * 5000), (6, "don't é½ß 漢字😀 two  spaces\n"), (None, "no id"), (7, "holds <S> itself"), (8, "word, " * 40_000), (9, "<"), (10, "<S<M"), (11, "aé" * 300), (12, "\x00|\x7f")]
FIM = "doc_id long, text string"


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in ("_id", "_text", "n", "form", "output", "score", "_held", "_label", "stats", "_x", "quality", "deviation", "lang")})


def fim_by_hand(i, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, n, "plain", None, None, text
    if h4 % 100 < 20:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_middle_equals_brute_force(spark):
    rng = random.Random(4)
    rows = TEXTS + [(100 + k, "".join(rng.choices("abZ <>SMP\né漢😀.", k=rng.randrange(0, 60)))) for k in range(400)]
    made = fill_in_middle(clashing(spark.createDataFrame(rows, FIM)))
    want = sorted((fim_by_hand(*r) for r in rows), key=str)
    assert sorted(map(tuple, made.collect()), key=str) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    back = made.select("doc_id", restored(F.col("output"), F.col("form"))).collect()
    assert sorted(((i, t) for i, t in back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert fill_in_middle(spark.createDataFrame([], FIM)).count() == 0


def test_select_finds_every_rank():
    rng = random.Random(1)
    for _ in range(300):
        width = rng.randrange(1, 200)
        mask = rng.getrandbits(width)
        places = [width - 1 - b for b in range(width - 1, -1, -1) if mask >> b & 1]
        assert [select(mask, width, k) for k in range(len(places))] == places
        assert select(mask, width, len(places)) == width
    assert starts_of(b"") == (0, 0) and select(0, 0, 0) == 0
    assert [m.bit_count() for m in starts_of("ab, é😀c".encode())] == [6, 7]


def test_fill_middle_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = sorted((*w[:5], sha256(w[5].encode()).hexdigest(), sha256((t or "").encode()).hexdigest()) for (i, t) in docs for w in [fim_by_hand(i, t)])
    got = sorted(map(tuple, op11_fill_middle(spark, "/root/testdata/sf0.001").collect()))
    assert got == want


def test_limbs_and_gram_are_exact():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(-(1 << 62), 1 << 62, (40, 5)), rng.integers(-40, 40, (40, 5)), [[0, -1, 1, 1 << 17, -(1 << 17)]]])
    digits = limbs(x)
    assert (sum(d.astype(np.int64).astype(object) << (18 * k) for k, d in enumerate(digits)) == x).all()
    assert (gram(x) == x.astype(object).T @ x.astype(object)).all()
    assert not gram(np.zeros((0, 3), np.int64)).any()


def whitened_by_hand(vectors):
    """n, S, exact covariance and deviations by fractions."""
    x = [[floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(d)]
    cov = np.array([[float(sum((Fraction(r[i]) - Fraction(s[i], n)) * (Fraction(r[j]) - Fraction(s[j], n)) for r in x) / n) for j in range(d)] for i in range(d)])
    return n, s, cov, [sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x], x


VEC = "vec_id long, embedding array<float>"


def check_whitened(rows, model, error, vectors, ids, components):
    n, s, cov, deviations, x = whitened_by_hand(vectors)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    assert (model.n, list(model.sums)) == (n, s)
    assert np.allclose(model.values, values, rtol=1e-9) and np.isclose(model.trace, cov.trace(), rtol=1e-12)
    assert sorted((r.vec_id, int(r.deviation)) for r in rows) == sorted(zip(ids, deviations, strict=True))
    w = {r.vec_id: r.whitened for r in rows}
    mean = np.array([v / n for v in s])
    k = min(components, len(s))
    for i, row in zip(ids, x, strict=True):
        assert np.allclose(w[i], ((np.array(row) - mean) @ model.vectors)[:k] / np.sqrt(model.values[:k]), atol=1e-6)
    assert np.allclose(cov @ model.vectors, model.vectors * model.values, atol=1e-8 * values[0])
    got = np.array([w[i] for i in ids])
    assert np.abs(np.cov(got.T, bias=True) - np.eye(k)).max() < 1e-6 and error < 1e-6


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    vectors = (rng.normal(size=(90, 6)) * [1, 2, 3, 50, 5, 0.4]).astype(np.float32).tolist()
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (904, [3e38, 0.0, 0.0, 0.0, 0.0, 0.0]), (905, []), (906, [1.0, 2.0])]
    rows = [*enumerate(vectors), *bad]
    out, model, error = whiten(clashing(spark.createDataFrame(rows, VEC)), components=4)
    check_whitened(out.collect(), model, error, vectors, list(range(90)), 4)


def test_whitening_edges(spark):
    assert whiten(spark.createDataFrame([], VEC))[0].count() == 0
    assert whiten(spark.createDataFrame([(1, None), (2, [])], VEC))[0].count() == 0
    one = whiten(spark.createDataFrame([(1, [1.0, 2.0])], VEC))[0].collect()
    assert [(r.vec_id, int(r.deviation), r.whitened) for r in one] == [(1, 0, [None, None])]
    flat, model, error = whiten(spark.createDataFrame([(None, [1.0, 2.0]), (5, [1.0, 2.0]), (5, [2.0, 2.0])], VEC))
    got = flat.collect()
    assert sorted(int(r.deviation) for r in got) == [64**2, 64**2, 128**2] and error < 1e-12
    assert all(r.whitened[0] is not None and r.whitened[1] is None for r in got)
    far = whiten(spark.createDataFrame([(k, [v]) for k, v in enumerate([1e15, -1e15, 3.0])], "vec_id long, embedding array<double>"))[0].collect()
    x = [floor(64 * v) + 1_000_000 for v in (1e15, -1e15, 3.0)]
    assert sorted(int(r.deviation) for r in far) == sorted((3 * v - sum(x)) ** 2 for v in x)


def test_whitening_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    sound = [(r.vec_id, r.embedding) for r in rows if r.embedding is not None and all(c is not None and isfinite(c) for c in r.embedding)]
    n, s, cov, deviations, _ = whitened_by_hand([v for _, v in sound])
    got = op13_whitening(spark, "/root/testdata/sf0.001").collect()
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    assert len(got) == 32 * len(sound) and {r.n for r in got} == {n}
    assert {(r.vec_id, r.deviation) for r in got} == set(zip([i for i, _ in sound], deviations, strict=True))
    assert all(abs(r.explained - values[r.component - 1] / cov.trace()) < 1e-6 for r in got) and len({r.identity_error for r in got}) == 1
    table = np.zeros((n, 32))
    at = {i: k for k, (i, _) in enumerate(sound)}
    for r in got:
        table[at[r.vec_id], r.component - 1] = r.whitened
    assert np.abs(np.cov(table.T, bias=True) - np.eye(32)).max() < 1e-4 and got[0].identity_error < 1e-4


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 5)).round(2)
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < 0)).astype(float)
    f = boosted(x, y, trees=30, depth=3, bins=16)
    fast = f.score(x)
    for row, s in zip(x, fast, strict=True):
        odds = f.base
        for t in range(30):
            at = 0
            while at < f.feature.shape[1]:
                at = 2 * at + (2 if row[f.feature[t, at]] > f.threshold[t, at] else 1)
            odds += f.leaf[t, at - f.feature.shape[1]]
        assert abs(1 / (1 + np.exp(-odds)) - s) < 1e-12
    assert ((fast > 0.5) == y).mean() > 0.95
    assert boosted(np.zeros((0, 5)), np.zeros(0)).score(np.ones((2, 5))).tolist() == [0.5, 0.5]
    same = boosted(np.ones((50, 2)), np.ones(50)).score(np.ones((3, 2)))
    assert (same > 0.9).all() and (same < 1).all()


def test_first_split_is_the_best_of_all():
    """The root's split against every threshold of every column."""
    rng = np.random.default_rng(6)
    x = rng.integers(0, 12, (200, 4)).astype(float)
    y = (x[:, 2] > 6).astype(float) * (rng.random(200) < 0.9)
    f = boosted(x, y, trees=1, depth=1, bins=64)
    p = y.mean()
    gains = {}
    for c in range(4):
        for t in np.unique(x[:, c])[:-1] + 0.5:
            parts = [(y - p)[side].sum() ** 2 / (p * (1 - p) * side.sum() + 1) for side in (x[:, c] <= t, x[:, c] > t) if p * (1 - p) * side.sum() >= 2]
            gains[c, t] = sum(parts) if len(parts) == 2 else 0
    c, t = max(gains, key=gains.get)
    assert f.feature[0, 0] == c and gains[c, f.threshold[0, 0]] == pytest.approx(gains[c, t])


def test_statistics_of_any_text():
    for text in ("", " ", "\n\n", "a", "é", "| | |", "x" * 100_000, "\x00", "word word word"):
        got = statistics(text)
        assert len(got) == len(NAMES) and np.isfinite(got).all()
    assert statistics("a a a b")[NAMES.index("repeated_next")] == 0.5


def test_quality_learns_and_holds_edges(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("etaoinshr", k=rng.randrange(2, 9)))
    good = lambda: ". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(12))
    junk = lambda: " | ".join(word() for _ in range(90))
    rows = [(i, good() if i % 3 else junk()) for i in range(600)]
    labels = [(i, int(i % 3 > 0)) for i in range(600) if i % 2] + [(None, 1), (1, None), (7, 1), (7, 1)]
    docs = spark.createDataFrame([*rows, (601, None), (602, ""), (None, "no id"), (603, "long " * 200_000), rows[0]], FIM)
    marks = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("x"))
    got = quality_scores(clashing(docs).drop("quality").withColumn("quality", F.lit("x")), marks).collect()
    assert len(got) == 605 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert all(r.predicted == (r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 600)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    none = quality_scores(docs, marks.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert quality_scores(docs.limit(0), marks).count() == 0


def test_quality_held_out(spark):
    """On rows never learned from: area under the curve over 0.98; labels of held-out rows change nothing."""
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = {r.doc_id: r for r in op12_quality(spark, d).collect()}
    true = {r.doc_id: r.quality for r in labels.collect()}
    good, bad = ([got[i].score for i, q in true.items() if q == k and got[i].held_out] for k in (1, 0))
    assert good and bad
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.98
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_scores(spark.read.parquet(f"{d}/documents.parquet").drop("lang", "source"), turned).collect()
    assert all(abs(got[r.doc_id].score - r.score) < 1e-12 for r in again)
