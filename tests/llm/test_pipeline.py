"""The corpus pipeline, stage by stage and whole, against plain Python on a small fixture."""

import random
from hashlib import sha256

import pytest
import tiktoken

import corpus_pipeline
from quireon.llm.byte_bpe import read_ranks

from .test_operators import plain_distance, shingled

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture():
    rng = random.Random(21)
    vocab = [f"{a}{b}" for a in ("ba", "ce", "di", "fo", "gu") for b in ("lan", "mer", "nis", "pot", "rus")]
    words = lambda n: [rng.choice(vocab) + rng.choice("abcdefgh") + rng.choice("klmnop") for _ in range(n)]
    items = [(k, " ".join(words(n))) for k, n in enumerate((20, 30, 9))]
    texts = [" ".join(words(rng.randrange(30, 90))) for _ in range(40)]
    texts += texts[:6] + [texts[3]]  # exact copies
    for t in texts[10:20]:  # near copies
        w = t.split()
        w[rng.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    for _, item in items:
        w = item.split()
        w[4] = "changed"
        texts.append(" ".join(words(12) + w + words(9)))
    texts += [None, "", "12 34 !!", " \n", "short text here", "w " * 3000]
    rng.shuffle(texts)
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], items


def brute(rows, items):
    """Rows kept after each of the first four stages."""
    kept = [[r for r in rows if r[1] and any(c.isalpha() for c in r[1])]]
    kept.append([r for r in kept[-1] if r[0] == max(x[0] for x in kept[-1] if x[1] == r[1])])
    sets = {r[0]: shingled(r[1], 5) for r in kept[-1]}
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root = {k: min(root[i], root[j]) if r in (root[i], root[j]) else r for k, r in root.items()}
    kept.append([r for r in kept[-1] if root[r[0]] == r[0]])
    held = lambda t: any(5 * plain_distance(item.lower().split(), t.lower().split()) <= len(item.split()) for _, item in items)
    kept.append([r for r in kept[-1] if not held(r[1])])
    return kept


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows, items = fixture()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = brute(rows, items)
    assert [len(rows) - len(kept[0])] + [len(a) - len(b) for a, b in zip(kept, kept[1:], strict=False)] == [4, 7, 8, 3]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for (_, stage), want in zip(corpus_pipeline.STAGES, kept, strict=False):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(map(tuple, docs.collect())) == sorted(want)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = []
    for i, text, *_ in kept[-1]:
        ids = enc.encode_ordinary(text)
        want.append((i, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(text.encode()).hexdigest()))
    assert sorted(tuple(r)[:4] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(want)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_memos_are_freed(spark, monkeypatch):
    """What a task of the last stage has loaded goes when it ends; the first stage's tasks, fitting included, free what others have left."""
    import pyarrow as pa

    from quireon.llm import byte_bpe, common, language_id

    docs, tasks = spark.createDataFrame([(1, "some words here", "en"), (2, "other words", "en")], "doc_id long, text string, lang string"), []
    real = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *a, **b: tasks.append(f) or real(self, f, *a, **b))
    monkeypatch.setattr(common, "_held", {})
    corpus_pipeline.tokens(spark, docs, "")
    batch = pa.record_batch([pa.array([1]), pa.array(["some words here"])], names=["doc_id", "_text"])
    assert sum(b.num_rows for b in tasks.pop()(iter([batch]))) == 1
    assert not byte_bpe._loaded and not common._held
    language_id.language_id(docs, spans=False)
    freed = []
    common._held["other"] = lambda: freed.append("other")
    assert sum(b.num_rows for b in tasks[0](iter([pa.record_batch([pa.array(["some words"]), pa.array(["en"])], names=["text", "lang"])]))) > 0
    assert freed == ["other"]
