"""The training-data operators against the libraries, brute force and planted cases on small inputs."""

import random
import re
import time
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from quireon.llm.byte_bpe import bpe_round_trip, read_ranks
from quireon.llm.decontaminate import Index, find_leaks, infix_distance
from quireon.llm.exact_dedup import exact_dedup
from quireon.llm.html_text import extract, lines_of, shared
from quireon.llm.language_id import language_id, viterbi
from quireon.llm.lattice_lm import Lattice, lattice, lm_scores
from quireon.llm.line_dedup import line_dedup
from quireon.llm.near_dedup import long_links, near_dedup, postings, rest_pairs, sketched
from quireon.llm.substring_dedup import bags, bit_maps, chains, ends, growth, hopeful, op7_substring_dedup, repeated_passages, shared_words, sharing, telling, word_keys
from quireon.llm.token_counts import token_counts

P = pytest.importorskip("public_tokenizers")
EDGES = [(1, "a b c d e"), (1, "a b c d e"), (2, None), (3, ""), (4, " \n\t "), (5, "x" * 3000), (6, "don't <|endoftext|> é ½  two  spaces\n"), (None, "no id"), (7, "word " * 3000)]


def table(spark, rows, schema="doc_id long, text string"):
    """Rows with columns beside the named ones whose names clash with those inside the operators."""
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.lit("x") for c in ("_id", "_text", "n", "kept", "lang", "_h", "word")})


def test_bpe_equals_tiktoken(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    want = []
    for i, text in EDGES:
        ids = enc.encode_ordinary(text or "")
        want.append((i, len(ids), ids, sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe_round_trip(table(spark, EDGES)).collect()), key=str) == sorted(want, key=str)
    assert bpe_round_trip(table(spark, [])).count() == 0


def test_bpe_many_long_words(spark):
    """Distinct pre-tokens of 40 and 190 bytes by the ten thousand in one batch, and one text of 400,000 tokens."""
    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    rng = random.Random(2)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    rows = [(i, " ".join(word(190) for _ in range(40))) for i in range(500)] + [(i, " ".join(word(40) for _ in range(100))) for i in range(500, 800)] + [(900, "a b " * 200_000), (901, word(5000))]
    for r in bpe_round_trip(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), with_ids=False).collect():
        text = dict(rows)[r.doc_id]
        ids = enc.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(text.encode()).hexdigest())


def test_token_counts_equal_library(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = []
    for i, text in EDGES:
        n = len(tok.encode(text or "", add_special_tokens=False).ids)
        want.append((i, len((text or "").encode()), n, n > 100))
    assert sorted(map(tuple, token_counts(table(spark, EDGES), limit=100).collect()), key=str) == sorted(want, key=str)


def test_exact_dedup_with_weak_digest(spark):
    rows = [(i, random.Random(i % 7).choice(["a", "b", "", "c d"])) for i in range(60)] + [(90, None), (91, "alone"), (None, "alone")]
    for digest in ({}, {"digest": lambda t: F.lit(b"1")}):
        got = {r.doc_id: r for r in exact_dedup(table(spark, rows), **digest).collect()}
        groups = defaultdict(list)
        for i, t in rows:
            groups[t or ""].append(i)
        for members in groups.values():
            keep = max((i for i in members if i is not None), default=None)
            for i in members:
                assert (got[i].keep_id, got[i].group_size, got[i].kept) == (keep, len(members), i == keep)
    assert exact_dedup(table(spark, [])).count() == 0


def shingled(text, size):
    """Shingles as tuples of words, by plain Python."""
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def near_rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for size in (2, 3, 90):
        base = [rng.choice(words) for _ in range(120)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(99))
            rows.append((n, " ".join(copy)))
            n += 1
    common = [rng.choice(words) for _ in range(30)]
    for _ in range(80):
        rows.append((n, " ".join([rng.choice(words) for _ in range(90)] + common)))
        n += 1
    return rows + [(n, "one two"), (n + 1, "One two"), (n + 2, None), (n + 3, ""), (n + 4, " ")]


def test_near_dedup_equals_brute_force(spark):
    rows = near_rows()
    sets = {i: shingled(t, 4) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r.doc_id: r for r in near_dedup(table(spark, rows), size=4).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_near_dedup_star_of_copies(spark):
    """Copies that are alike enough with the original only, more than an inverted list is gathered for."""
    rng = random.Random(8)
    original = [f"o{i}" for i in range(200)]
    rows = [(1500, " ".join(original))]
    for i in range(3001):
        if i != 1500:
            copy = list(original)
            for at in rng.sample(range(200), 5):
                copy[at] = f"edit{i}x{at}"
            rows.append((i, " ".join(copy)))
    sets = {i: shingled(t, 4) for i, t in rows}
    assert all(100 * len(s & sets[1500]) >= 80 * len(s | sets[1500]) for s in sets.values())
    assert {r.component_id for r in near_dedup(table(spark, rows), size=4).collect()} == {0}


def test_near_dedup_families_in_long_lists(spark, monkeypatch):
    """Families that share a passage, in lists of several blocks, against brute force."""
    monkeypatch.setattr("quireon.llm.near_dedup.BLOCK", 64)
    rng = random.Random(9)
    passage, rows = [f"p{i}" for i in range(110)], []
    for f in range(8):
        own = passage + [f"f{f}x{i}" for i in range(60)]
        for k in range(60):
            copy = list(own)
            for at in rng.sample(range(170), 4 if k else 0):
                copy[at] = f"edit{f}x{k}x{at}"
            rows.append((0, " ".join(copy)))
    rng.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    sets = [shingled(t, 4) for _, t in rows]
    root = list(range(len(sets)))
    for j in range(len(sets)):
        for i in range(j):
            if root[i] != root[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    got = {r.doc_id: r.component_id for r in near_dedup(table(spark, rows), size=4).collect()}
    assert [got[i] for i in range(len(rows))] == root and len(set(root)) < 60


def test_near_dedup_long_lists_without_leaders(spark):
    """All pairs of the blocks of long lists alone, as if no link were known."""
    rows = near_rows()
    docs = spark.createDataFrame(rows, "_id long, _text string").dropna()
    sets = {i: shingled(t, 4) for i, t in rows}
    seen = sketched(docs, 4).filter("n > 0")
    classes = seen.groupBy("same").agg(F.min(F.struct("_id", "n", "sketch")).alias("m")).select(F.col("m._id").alias("id"), "m.n", "m.sketch")
    none = spark.createDataFrame([], "id long, component long")
    _, hot = rest_pairs(postings(classes), classes, none, 80)
    found = {(r.a, r.b) for r in long_links(hot, none, docs, 4, 80).collect()}
    assert found and all(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a, b in found)


def test_near_dedup_pairs_under_one_passage(spark):
    """Pairs of near copies whose sketches are mostly values of a passage that all documents share."""
    rng = random.Random(4)
    passage, rows = [f"p{i}" for i in range(300)], []
    for p in range(1000):
        own = [f"d{p}x{i}" for i in range(40)]
        edited = list(own)
        edited[rng.randrange(40)] = f"edit{p}"
        rows += [(p, " ".join(passage + own)), (p + 1000, " ".join(passage + edited))]
    a, b, other = shingled(rows[0][1], 4), shingled(rows[1][1], 4), shingled(rows[2][1], 4)
    assert 100 * len(a & b) >= 80 * len(a | b) and 100 * len(a & other) < 80 * len(a | other)
    got = {r.doc_id: r.component_id for r in near_dedup(table(spark, rows), size=4).collect()}
    assert got == {i: i % 1000 for i in range(2000)}


def test_near_dedup_large_group(spark):
    """Two thousand near copies with differing sketches are one group; repeated and null ids, long and empty tables."""
    rng = random.Random(6)
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(2000):
        copy = list(base)
        copy[rng.randrange(150)] = f"edit{i}"
        rows.append((i, " ".join(copy)))
    rows += [(5000, "x y z w v u " * 20000), (None, rows[0][1]), (7, rows[7][1])]
    got = near_dedup(table(spark, rows), size=4).collect()
    assert len(got) == 2003 and {r.component_id for r in got if r.doc_id is not None and r.doc_id < 2000} == {0}
    assert [(r.n_shingles, r.kept) for r in got if r.doc_id == 5000] == [(6, True)] and [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, False)]
    assert near_dedup(table(spark, [])).count() == 0


def test_leaks(spark):
    rng = random.Random(5)
    words = [f"b{i}" for i in range(300)]
    items = [(k, " ".join(rng.choice(words) for _ in range(n))) for k, n in enumerate([14, 36, 59, 5])] + [(9, None), (10, "")]
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    edited = items[1][1].split()
    edited[3], edited[20] = "changed", "too"
    del edited[30]
    docs = [(0, filler(50)), (1, f"{filler(20)} {items[0][1].upper()} {filler(9)}"), (2, f"{' '.join(edited)} {filler(30)}"), (3, f"{filler(3)} {items[2][1]}"), (4, f"x {items[3][1]} y"), (5, None), (6, "")]
    got = {(r.doc_id, r.item_id): r for r in find_leaks(table(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == {(1, 0), (2, 1), (3, 2), (4, 3)} and got[2, 1].distance == 3 and got[1, 0].start_word == 20
    assert infix_distance(list("abc"), list("xxabcxx")) == (0, 5)
    short = (20, "one two three four five six seven")
    docs = [(1, "x one two 3 four five six seven y"), (2, "one two four five six seven"), (3, "one 2 three four 5 six seven"), (4, "b " + short[1] + " b " + short[1]), (5, None), (6, "")] + [(7, "z " * 30000)]
    got = find_leaks(table(spark, docs + docs[3:4]), spark.createDataFrame([short, (21, "word")], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.start_word, r.distance) for r in got) == [(1, 20, 1, 1), (2, 20, 0, 1), (4, 20, 1, 0), (4, 20, 1, 0)]
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(table(spark, []), none).count() == 0 and find_leaks(table(spark, docs), none).count() == 0


def plain_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row = row, [i]
        for j, y in enumerate(text, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1))
    return min(row)


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        out[at : at + (kind < 2)] = [f"e{rng.randrange(10**6)}"] * (kind > 0)
    return out


def test_leaks_recall():
    """Items of all sizes at the very bound of edits, against exact distances: target 0.98, and all of the short ones."""
    rng = random.Random(7)
    vocab = [f"v{i}" for i in range(2000)]
    items = [(k, " ".join(rng.choices(vocab, k=n))) for k, n in enumerate([n for n in range(3, 80) for _ in range(6)])]
    index, hits, within = Index(items, 0.8), defaultdict(int), defaultdict(int)
    for k, text in items:
        w = text.split()
        doc = rng.choices(vocab, k=30) + edited(rng, w, len(w) // 5) + rng.choices(vocab, k=30)
        d = plain_distance(w, doc)
        got = {i: x for i, _, _, x in index.search(" ".join(doc))}
        assert got.get(k, d) == d
        within[len(w) < 15] += 5 * d <= len(w)
        hits[len(w) < 15] += k in got
    assert hits[True] == within[True] and hits[False] >= 0.98 * within[False] > 300


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, "\n".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9)))) for i in range(30)] + [(40, None), (41, "")]
    for m in (1, 2, 3, 4):
        seen, want = set(), {}
        for i, text in sorted(rows, key=lambda r: r[0]):
            ls = (text or "").split("\n")
            gone = set()
            for k in range(len(ls) - m + 1):
                run = tuple(ls[k : k + m])
                gone |= set(range(k, k + m)) if run in seen else set()
                seen.add(run)
            want[i] = (len(ls), len(gone), "\n".join(x for k, x in enumerate(ls) if k not in gone))
        got = {r.doc_id: tuple(r)[1:4] for r in line_dedup(table(spark, rows), min_run=m).collect()}
        assert got == want


def test_line_runs(spark):
    """Maximal runs of 100 lines by doubling, beside repeated and null ids, an empty table and a very long line."""
    lines = [f"line {i}" for i in range(100)]
    rows = [(1, "\n".join(["a", *lines])), (2, "\n".join([*lines, "b"])), (3, "\n".join(["x", "y", *lines[40:60], "z"])), (3, "\n".join(["x", "y", *lines[40:60], "z"])), (None, "\n".join(lines)), (5, "q" * 300_000), (6, None)]
    got = [r for r in line_dedup(table(spark, rows)).collect()]
    by = {r.doc_id: r for r in got}
    assert len(got) == 7 and [tuple(x) for x in by[2].runs] == [(0, 100, 1, 1)] and [tuple(x) for x in by[3].runs] == [(2, 20, 1, 41)]
    assert (by[2].text, by[3].text, by[3].n_deleted, by[1].n_deleted, by[None].n_deleted, by[6].n_lines, by[5].text) == ("b", "x\ny\nz", 20, 0, 0, 1, "q" * 300_000)
    assert line_dedup(table(spark, [])).count() == 0


def test_passages(spark):
    rng = random.Random(2)
    filler = lambda n: [f"f{rng.randrange(10**6)}" for _ in range(n)]
    p = filler(60)
    fuzzy = list(p)
    fuzzy[30] = "edit"
    docs = [(1, filler(40) + p + filler(10)), (2, filler(5) + p), (3, fuzzy + filler(50)), (4, filler(200)), (5, filler(9) + p[:30])]
    rows = [(i, " ".join(w)) for i, w in docs]
    found = repeated_passages(table(spark, [*rows, rows[1], (6, None), (7, ""), (None, rows[0][1]), (8, "z " * 5000), (9, "z " * 5000)])).collect()
    got = {r.doc_id: r for r in found if not r.first}
    assert set(got) == {2, 3, 9} and (got[9].source_id, got[9].n_words) == (8, 5000) and (got[2].start_word, got[2].n_words, got[2].source_id, got[2].source_start) == (5, 60, 1, 40) and got[3].n_words == 60
    assert [(r.doc_id, r.start_word, r.n_words, r.source_id) for r in found if r.first and r.doc_id != 8] == [(1, 40, 60, 2)]
    assert chains([0, 5, 10], [0, 5, 10]) == [[0, 1, 2]] and repeated_passages(table(spark, [])).count() == 0


def test_passages_equal_brute_force(spark):
    """Every document that shares 50 words with another is found, others aren't; parts of passages in lower ids, repeats, and groups of copies."""
    rng = random.Random(12)
    filler = lambda n: [f"f{rng.randrange(10**6)}" for _ in range(n)]
    docs: list[list[str]] = []
    for _ in range(12):
        p = filler(rng.randrange(60, 120))
        for _ in range(rng.randrange(4)):  # holders of a part, of lower ids
            cut = rng.randrange(15, 40)
            docs.append(filler(30) + rng.choice([p[:cut], p[-cut:], p[20 : 20 + min(cut, 30)]]) + filler(30))
        for _ in range(rng.randrange(2, 6)):
            docs.append(filler(rng.randrange(50)) + p + filler(rng.randrange(50)) + (p if rng.random() < 0.4 else []))
    line = filler(20)
    docs += [filler(50) + (line + filler(25)) * 1 + line + filler(40) for _ in range(40)]
    rng.shuffle(docs)
    holders = defaultdict(set)
    for i, w in enumerate(docs):
        for at in range(len(w) - 49):
            holders[tuple(w[at : at + 50])].add(i)
    want = set().union(*(h for h in holders.values() if len(h) > 1))
    got = {r.doc_id for r in repeated_passages(table(spark, [(i, " ".join(w)) for i, w in enumerate(docs)])).collect()}
    assert got == want and 20 < len(want) < len(docs) - 40


def test_passages_whole(spark):
    """Every pair of documents that shares just 50 words, or 50 with edits near their ends, is linked, whoever else holds parts of them; less isn't."""
    rng = random.Random(21)
    filler = lambda n: [f"f{rng.randrange(10**7)}" for _ in range(n)]
    docs: list[list[str]] = []
    whole = [filler(50) for _ in range(60)]
    for _ in range(150):  # pieces of 30 words, side by side: stretches of repeated seeds, but no passage
        docs.append(filler(20) + [w for p in rng.sample(whole, 4) for at in [rng.randrange(21)] for w in p[at : at + 30] + filler(20)] + filler(20))
    pairs = set()
    for p in whole:
        for _ in range(2):
            docs.append(filler(rng.randrange(5, 60)) + p + filler(rng.randrange(5, 60)))
        pairs.add((len(docs) - 2, len(docs) - 1))
    for _ in range(60):
        p = filler(54)
        docs += [filler(30) + p + filler(30), filler(40) + p[:4] + filler(1) + p[5:49] + filler(1) + p[50:] + filler(20)]
        pairs.add((len(docs) - 2, len(docs) - 1))
    for _ in range(40):  # 44 words
        p = filler(44)
        docs += [filler(30) + p + filler(30), filler(40) + p + filler(20)]
    rows = repeated_passages(table(spark, [(i, " ".join(w)) for i, w in enumerate(docs)])).collect()
    assert {(r.source_id, r.doc_id) for r in rows if not r.first} == pairs
    assert all(r.n_words >= 50 and r.similarity >= 0.8 for r in rows)


def test_passage_classes(spark, tmp_path):
    """op7 has a row per stretch of a document, however many pairs hold it; its links, classes and sources are those of all the pairs."""
    rng = random.Random(23)
    filler = lambda n: [f"f{rng.randrange(10**7)}" for _ in range(n)]
    p, q, r = filler(90), filler(60), filler(120)
    docs = [filler(20) + p + filler(30) for _ in range(30)] + [filler(9) + q + filler(30) + p for _ in range(2)] + [q + filler(25) for _ in range(3)]
    docs += [filler(5) + r[:70] + filler(40), filler(12) + r[50:] + filler(30), filler(30) + r + filler(20), filler(150)]
    for _ in range(12):  # variants of one text, not all alike enough to each other
        v = list(r)
        for at in rng.sample(range(120), 14):
            v[at] = filler(1)[0]
        docs.append(filler(rng.randrange(30)) + v + filler(20))
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)] + [(99, None), (None, " ".join(p))]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    pairs = [x for x in repeated_passages(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect() if not x.first]
    held = defaultdict(set)
    for x in pairs:
        held[x.doc_id].update(range(x.start_word, x.start_word + x.n_words))
        held[x.source_id].update(range(x.source_start, x.source_start + x.source_words))
    spans = defaultdict(set)
    for x in pairs:
        spans[x.doc_id].add((x.start_word, x.start_word + x.n_words))
        spans[x.source_id].add((x.source_start, x.source_start + x.source_words))
    at = lambda i, w: max(s for s, _ in spans[i] if s <= w and not any(a < s < b for a, b in spans[i]))
    links = defaultdict(set)
    for x in pairs:
        a, b = (x.doc_id, at(x.doc_id, x.start_word)), (x.source_id, at(x.source_id, x.source_start))
        links[a].add(b)
        links[b].add(a)
    least = {k: min([k, *v]) for k, v in links.items()}
    for _ in links:
        least = {k: min(least[k], *(least[o] for o in v)) for k, v in links.items()}
    got = {(x.doc_id, x.start_word): x for x in op7_substring_dedup(spark, str(tmp_path)).collect()}
    assert got.keys() == links.keys() and len(pairs) > len(links) == 30 + 4 + 3 + 15
    for k, x in got.items():
        assert ((x.class_id, x.class_start), x.n_links, (x.source_id, x.source_start), x.first) == (least[k], len(links[k]), min(links[k]), min(links[k])[0] > k[0])
        assert held[k[0]].issuperset(range(k[1], k[1] + x.n_words)) and k[1] + x.n_words not in held[k[0]]
    assert len(set(least.values())) == 3


def test_passages_under_common_line(spark):
    """3,000 documents with one line and nothing else alike around it: all pairs are compared, few of them word by word."""
    rng = random.Random(22)
    filler = lambda n: [f"f{rng.randrange(10**8)}" for _ in range(n)]
    n, line = 3000, filler(20)
    p, q = [filler(25) for _ in range(n + 2)], [filler(25) for _ in range(n + 2)]
    docs = [filler(45) + p[i] + line + q[i] + filler(45) + p[i + 1] + filler(45) + q[i + 2] + filler(5) for i in range(n)]
    same = filler(30)
    docs[700], docs[2100] = docs[700][:70] + line + same + docs[700][120:], docs[2100][:70] + line + same + docs[2100][120:]
    began = time.time()
    rows = repeated_passages(table(spark, [(i, " ".join(w)) for i, w in enumerate(docs)])).collect()
    assert {(r.source_id, r.doc_id) for r in rows if not r.first} == {(700, 2100)}
    assert time.time() - began < 30


def test_passages_of_edits_under_common_line(spark):
    """A line common to all, and the only seed of 40 pairs of passages: each pair is linked, though no stretch of repeated seeds is long."""
    rng = random.Random(24)
    filler = lambda n: [f"f{rng.randrange(10**8)}" for _ in range(n)]
    line, docs, pairs = filler(20), [], set()
    for _ in range(40):
        p = filler(35)
        q = list(p)
        for at in (5, 16, 27):  # no run of these words has a seed
            q[at] = filler(1)[0]
        docs += [filler(40) + line + p + filler(60), filler(25) + line + q + filler(60)]
        pairs.add((len(docs) - 2, len(docs) - 1))
    rows = repeated_passages(table(spark, [(i, " ".join(w)) for i, w in enumerate(docs)])).collect()
    assert {(r.source_id, r.doc_id) for r in rows if not r.first} == pairs


def test_telling_words():
    """No pair of places that may lie in a passage is left out for want of a telling word or by its map of bits; few others are left."""
    rng = np.random.default_rng(6)
    n, common = 400, rng.integers(0, 65536, 40)
    left, right = (np.where(rng.random((n, 64)) < 0.3, rng.choice(common, (n, 64)), rng.integers(0, 65536, (n, 64))).astype(np.int32) for _ in range(2))
    for i in range(0, n, 4):  # alike in parts of their sides, over edits
        a, b = rng.integers(0, 60, 2)
        left[i + 1, :a], right[i + 1, :b] = left[i, :a], right[i, :b]
        right[i + 1, rng.integers(0, 64, 5)] = 7
    left[::7, rng.integers(1, 64) :] = -1
    right[:, :14] = np.arange(14)  # the rest of a line
    bag = bags(left, right)
    i, j = (k.ravel() for k in np.triu_indices(n, 1))
    u, v = np.where(left < 0, -2, left), np.where(right < 0, -2, right)
    want = hopeful((left[i], u[j]), (right[i], v[j]), 50, 0.8)
    use = telling(bag, 50, 0.8)
    got = set(zip(*(k.tolist() for k in sharing(bag, use, bag, use, n * n)), strict=True))
    assert set(zip(i[want].tolist(), j[want].tolist(), strict=True)) <= got and want.sum() > 20 and len(got) < n * n / 4
    maps = bit_maps(bag)
    assert ((bag >= 0).sum(1)[i] - np.bitwise_count(maps[i] & ~maps[j]).sum(1) >= shared_words(bag, bag)[i, j]).all()
    assert sharing(bag, use, bag, use, 10) is None


def test_word_keys(monkeypatch):
    """Words are those of bytes.split() in lower case, equal keys are equal words, wherever texts are cut."""
    rng = random.Random(25)
    texts = ["".join(rng.choice("aBé \t\n\x0b\x0c\r\x85 z\0") for _ in range(rng.randrange(40))) for _ in range(200)]
    for chunk in (7, 1 << 15):
        monkeypatch.setattr("quireon.llm.substring_dedup.CHUNK", chunk)
        got = [k.tolist() for k in word_keys(texts)]
        words = [t.encode().lower().split() for t in texts]
        assert [len(k) for k in got] == [len(w) for w in words]
        both = {(w, k) for ws, ks in zip(words, got, strict=True) for w, k in zip(ws, ks, strict=True)}
        assert len(both) == len({w for w, _ in both}) == len({k for _, k in both}) > 100
    assert [len(k) for k in word_keys(["", " "])] == [0, 0]


def test_passage_bounds():
    """Beginnings of least length against a plain table; words shared in any order bound those shared in order."""
    rng = np.random.default_rng(5)
    for _ in range(50):
        a, b = rng.integers(0, 6, (2, 64))
        t = np.zeros((65, 65), int)
        for i in range(64):
            for j in range(64):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        want = [(i, j, t[i, j]) for i in range(1, 65) for j in range(1, 65) if a[i - 1] == b[j - 1] and t[i, j] > max(t[i - 1, j], t[i, j - 1])]
        assert ends(a.tolist(), b.tolist()) == [(0, 0, 0), *want]
    left, right = (rng.integers(-1, 400, (30, 64)).astype(np.int32) for _ in range(2))
    left[1], right[2] = left[0], right[0]
    bag = bags(left, right)
    both = shared_words(bag, bag)
    i, j = (k.ravel() for k in np.indices(both.shape))
    u, v = np.where(left < 0, -2, left), np.where(right < 0, -2, right)
    assert (both.ravel() >= growth(left[i], u[j])[:, -1].astype(int) + growth(right[i], v[j])[:, -1]).all()
    sets = [Counter(x for x in row if x >= 0) for row in bag.tolist()]
    assert both.tolist() == [[sum((a & b).values()) for b in sets] for a in sets]


def test_language(spark):
    got = viterbi([np.array([[0.0, -9], [-3, 0], [0, -9]]), np.array([[-9.0, 0]]), np.array([[0.0, -9], [-9, 0], [-9, 0]])], 8.0)
    assert [p.tolist() for p in got] == [[0, 0, 0], [1], [0, 1, 1]]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang_pred <> 'und'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert r > 0.97
    odd = spark.createDataFrame([(1, None, "en"), (2, "12 !!", None), (3, "the of and", "en"), (4, "де", None)], "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in language_id(odd).collect()}
    assert got[1].lang_pred == got[2].lang_pred == "und" and got[1].score == 0 and 0 <= got[4].score <= 1


TOTAL = 1 / 2 + 1 / 3 + 1 / 4 + 1 / 6 + 256 / 6  # weights of four pieces and, at the least of them, of the 256 bytes


def test_lattice(spark):
    m = Lattice([("▁a", -1.0), ("a", -2.0), ("▁aa", -3.0), ("b", -5.0)])

    def brute(word):
        logs = {p: np.log(w) for p, w in zip(["▁a", "a", "▁aa", "b"], np.array([1 / 2, 1 / 3, 1 / 4, 1 / 6]) / TOTAL, strict=True)}
        paths = lambda s: 1.0 if not s else sum(np.exp(v) * 0.65 * paths(s[len(p) :]) for p, v in logs.items() if s.startswith(p))
        return np.log(paths("▁" + word) * 0.35 / 0.65)

    for w in ("a", "aa", "aab", "aaaa"):
        assert m.score([w])[0] == pytest.approx(brute(w))
    assert m.score(["b" * 3000])[0] < 3000 * np.log(1 / 6 / TOTAL)

    def expected(word):  # over all segmentations
        paths = lambda s: [[]] if not s else [[p, *rest] for p in ("▁a", "a", "▁aa", "b") if s.startswith(p) for rest in paths(s[len(p) :])]
        logs = dict(zip(["▁a", "a", "▁aa", "b"], np.array([1 / 2, 1 / 3, 1 / 4, 1 / 6]) / TOTAL, strict=True))
        weigh = [np.prod([logs[p] * 0.65 for p in path]) for path in paths("▁" + word)]
        return sum(w * len(path) for w, path in zip(weigh, paths("▁" + word), strict=True)) / sum(weigh)

    for w in ("a", "aab", "aaaa"):
        assert m.expected([w]).sum() == pytest.approx(expected(w))
    test_rows = [(i, random.Random(i).choice(["the cat sat", "The dog ran off", "a Cat\x0bran", "x" * 400 + " of", "dog"])) for i in range(60)] + [(60, None), (61, "unseen zzz"), (None, "the end"), (None, "the end"), (next(i for i in range(70, 99) if zlib.crc32(str(i).encode()) % 5 == 1), "zq" * 300)]
    held = {i for i, _ in test_rows if i is not None and zlib.crc32(str(i).encode()) % 5 == 1}
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    trained = [t for i, t in test_rows if i not in held]
    c = Counter(w for t in trained for w in split(t))
    n, v, k = sum(c.values()) + len(trained), len(c) + 1, Counter(c.values())
    d = k[1] / (k[1] + 2 * k[2]) if k[1] and k[2] else 0.5
    fitted = lattice(P.path("piece_bpe_32k.model"))
    fitted.logs, fitted.stop = fitted.first, 0.35
    fitted.fitted(fitted.expected(sorted(c)), len(c))
    b = {w: fitted.score([w])[0] for t in [t for _, t in test_rows] for w in split(t)}
    logsum = lambda xs: max(xs) + np.log(sum(np.exp(x - max(xs)) for x in xs))
    lp = lambda w: logsum([*([np.log((c[w] - d) / n)] if c[w] else []), np.log(d * v / n * 0.99) + b[w]]) / np.log(10)
    want = sorted((str(i), i in held, len(split(t)) + 1, sum(c[w] > 0 for w in split(t)) + 1, n, sum(np.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in split(t)) + np.log10((len(trained) + 0.5) / (n + 0.5 * (v + 1))), sum(map(lp, split(t))) + np.log10((len(trained) - d + d * v * 0.01) / n)) for i, t in test_rows)
    got = sorted((str(r.doc_id), *tuple(r)[1:]) for r in lm_scores(table(spark, test_rows)).collect())
    assert [r for r in zip(got, want) if r[0][:5] != r[1][:5]] == []
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want]) and min(r[6] for r in got) < -400
    rows = [(i, "the cat sat" if i % 2 else "The dog ran off") for i in range(40)] + [(50, None), (51, "unseen zzz")]
    got = lm_scores(table(spark, rows)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 42 and by[50].n_tokens == 1 and by[51].n_tokens == 3 and all(r.score < 0 and r.base_score < 0 for r in got) and lm_scores(table(spark, [])).count() == 0


def test_html(spark):
    page = lambda body: f"<html><body><div>Site name</div>{body}<div>All rights</div></body></html>"
    rows = [
        (1, "http://h/a/1", page("<p>First &amp; only<br>x</p>")), (2, "http://h/a/2", page("<p>Second</p>")), (3, "https://h/b?q=1", "<nav>m</nav><article><h1>T</h1><p>one<p>two  <i>w</i>ords</article><aside>s</aside>"),
        (4, None, "<p>x"), (5, "http://h/e", None), (6, "http://h/f", ""),
    ]
    got = {r.page_id: r for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i].text for i in range(1, 7)] == ["First & only x", "Second", "T\none\ntwo words", "x", "", ""] and got[3].n_chars == 15
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert shared([1, 2, 3, 4, 5], [1, 9, 3, 5]) == {0, 2, 4} and lines_of("<script>a</script><p>b") == [("open", "b")]


def test_html_differencing(spark):
    """What all pages of a site repeat goes, inside articles too and where no tag or class tells; what one neighbour shares with an article stays."""
    page = lambda k, body: f"<div>Menu one</div><div>Offer {k}</div><article><p>Subscribe here<p>{body}</article><div>The end</div>"
    bare = lambda k, body: f"<div>Menu one</div><div>Menu two</div><p>{body}</p><div>The end</div>"
    rows = [(k, f"http://h/a/{k}", page(k, f"Text {k}<p>{'Same' if k in (3, 4) else k}")) for k in range(1, 6)] + [(k, f"http://g/{k}", bare(k, f"Body {k}")) for k in range(10, 13)]
    rows += [rows[0], (20, "http://solo/x", page(20, "Alone")), (None, "http://g/10", bare(10, "Body none"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("_id", "_url", "_hashes", "text", "n_chars")})
    got = sorted((tuple(r) for r in extract(df).select("page_id", "text").collect()), key=str)
    want = [(k, f"Text {k}\n{'Same' if k in (3, 4) else k}") for k in (1, 2, 3, 4, 5)] + [(1, "Text 1\n1")] + [(k, f"Body {k}") for k in range(10, 13)] + [(20, "Subscribe here\nAlone"), (None, "Body none")]
    want[0], want[4], want[5] = (1, "Subscribe here\nText 1\n1"), (5, "Subscribe here\nText 5\n5"), (1, "Subscribe here\nText 1\n1")  # ends of the order have one neighbour
    assert got == sorted(want, key=str)


def test_html_long_and_broken_pages():
    began = time.time()
    for page in ("<a " * 300_000, '<a "' * 300_000 + ">x", "<div>" * 100_000 + "x", "<b><div>" * 50_000 + "</i>" * 100_000, "<title>" * 50_000, "< 5 " * 100_000, "<p>" + "w " * 500_000, "<!-- " * 100_000, "<x '" + "<b>" * 100_000):
        lines_of(page)
    rng = random.Random(1)
    a, b = [rng.randrange(50) for _ in range(20_000)], [rng.randrange(50) for _ in range(20_000)]
    shared(a, b)
    assert time.time() - began < 30
    for _ in range(200):
        a, b = [rng.randrange(4) for _ in range(rng.randrange(9))], [rng.randrange(4) for _ in range(rng.randrange(9))]
        row = [0] * (len(b) + 1)
        for x in a:
            last, row = row, [0]
            for j, y in enumerate(b):
                row.append(last[j] + 1 if x == y else max(row[j], last[j + 1]))
        got = sorted(shared(a, b))
        rest = iter(b)
        assert len(got) == row[-1] and all(a[i] in rest for i in got)
    assert lines_of('<div data-id="ads">x</div>') == [("open", "x")] and lines_of('<div class="ads">x</div>') == [("aside", "x")]


def test_language_edges(spark):
    """Repeated rows, null ids, clashing columns, a very long text, an empty table, and a table without labels."""
    schema = "doc_id long, text string, lang string"
    rows = [(i, "the cat and the dog" if i % 2 else "le chat et le chien", "en" if i % 2 else "fr") for i in range(40)]
    odd = [(50, "the dog " * 30_000, None), (51, "le chat", None), (51, "le chat", None), (None, "the cat", None), (52, "the dog and the cat " * 20 + "le chien et le chat " * 19, None)]
    df = spark.createDataFrame(rows + odd, schema).withColumns({c: F.lit("x") for c in ("_text", "held_out", "lang_pred", "score", "source")})
    got = language_id(df).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 45 and (by[50].lang_pred, by[51].lang_pred, by[None].lang_pred, by[None].held_out) == ("en", "fr", "en", False) and sum(r.doc_id == 51 for r in got) == 2
    assert [(s.lang, s.words) for s in by[52].spans] == [("en", 100), ("fr", 95)]
    assert language_id(spark.createDataFrame([], schema)).count() == 0
    assert {r.lang_pred for r in language_id(spark.createDataFrame([(1, "the cat", None)], schema)).collect()} == {"und"}


def test_exact_dedup_edges(spark):
    """Ids that repeat inside a group, with equal and other texts, and very long texts."""
    long = "y" * 2_000_000
    rows = [(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, long), (4, long), (5, long + "z")]
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(table(spark, rows)).collect())
    assert got == [(1, 2, 3, False), (1, 2, 3, False), (2, 2, 1, True), (2, 2, 3, True), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True)]
