"""Golden cases of the archive engine and parity of its queries with DuckDB at the smallest scale."""

import json
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from quireon.functions import names as N
from quireon.functions import spans as S
from quireon.functions import text as X
from quireon.operators import boxes as B
from quireon.operators import catalogue as C
from quireon.operators import edits as E
from quireon.operators import extract as M
from quireon.operators import log as L
from quireon.operators import manifest as J
from quireon.plans import acts, layout, more, replay, rest  # noqa: F401  register their queries
from quireon.plans import queries as Q
from quireon.sources import files

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAST = [n for n in Q.ORACLE_SQL if n not in ("q_signatures", "q_fill_rate")]


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_names(spark):
    r = one(spark, N.cote(F.lit("Ch-AEV_00123bis_004.jpg")), N.canonical(F.lit("Ch-AEV_00123bis_004.jpg")), N.batch(F.lit("Ch-AEV_00822_001")), N.canonical(F.lit("nothing")), N.cote(F.lit(None).cast("string")))
    assert list(r) == ["123bis", "CH-AEV_IV_123bis_004.jpg", 8, None, None]


def test_dates(spark):
    t = F.lit("fait a Sion le 9 janvier 1815")
    code, m = M.dates(t)
    r = one(spark, code.alias("c"), M.date_parts(S.extreme(m, F.length(t))["text"]).alias("d"), M.place_in_date(S.first(m)["text"]).alias("p"))
    assert r.c == "formule_petite+date_complete" and tuple(r.d) == (9, 1, 1815)
    assert one(spark, M.dates(F.lit("rien"))[0])[0] == "no_match"


@pytest.mark.parametrize(("ymd", "want"), [((4, 1, 1), "1795-09-23"), ((8, 2, 18), "1799-11-09"), ((2, 11, 9), "1794-07-27"), ((12, 1, 1), "1803-09-24"), ((1, 1, 1), "1792-09-22"), ((14, 4, 10), "1805-12-31")])
def test_republican(spark, ymd, want):
    assert str(one(spark, M.republican_to_gregorian(*map(F.lit, ymd)))[0]) == want


def test_spans_equal_python(spark):
    for text in ["a1b22c333", "", "1", "x12 34y", "é12é3"]:
        got = one(spark, S.find(F.lit(text), r"\d+"))[0]
        assert [tuple(g) for g in got] == [(m.start(), m.end(), m[0]) for m in re.finditer(r"\d+", text)]


def test_text(spark):
    r = one(spark, X.collapse_newlines(F.lit("a\n\n\n\nb")), X.strip_punctuation(F.lit(" ,mot!? ")), X.replace_word(F.lit(",mot!"), F.lit("mots")), X.changed_positions(F.lit("abc"), F.lit("axc")), X.changed_positions(F.lit("ab"), F.lit("abc")))
    assert list(r) == ["a\n\nb", "mot", ",mots!", [1], None]
    assert one(spark, X.correct(F.lit("l815 et n0n, ler Préfident")))[0] == "1815 et non, 1er Président"


def test_harmonised(spark):
    cases = [([], [], None), ([4], [], 4), ([2, 4, 5], [], 5), ([2, 4], ["v"], 2), ([2, 4], [], 4), ([1, 5], [], 4)]
    for interests, states, want in cases:
        assert one(spark, L.harmonised(F.array(*map(F.lit, interests)).cast("array<int>"), F.array(*map(F.lit, states)).cast("array<string>")))[0] == want


def test_states(spark):
    r = one(spark, L.toggle(F.array(F.lit("f")), F.lit("d")), L.toggle(F.array(F.lit("f")), F.lit("f")), L.decode_set(F.lit("{'v', 'f'}")), L.decode_set(F.lit("set()")), L.encode_set(F.array(F.lit("f"))))
    assert list(r) == [["d", "f", "x"], [], ["f", "v"], [], "{'f'}"]


def test_manifest_values(spark):
    r = one(spark, J.french_date(F.lit(9), F.lit(1), F.lit(1815)), J.french_date(F.lit(None).cast("int"), F.lit(1), F.lit(1815)), J.french_date(*[F.lit(None).cast("int")] * 3))
    assert list(r) == ["9 janvier 1815", "janvier 1815", "-"]


def test_peaks_and_jumps():
    assert B.merge_close_peaks([51, 52, 53, 100, 200, 201]) == [52, 100, 200]
    assert B.has_no_jump((1, 1), [1, 2, 3]) and B.has_no_jump((2, 3), [1, 2, 3]) and not B.has_no_jump((1, 3), [1, 2, 3])


def test_edits():
    assert E.corrected_expressions("le Préfident", "le Président") == ["Président"]


def test_title(spark):
    assert one(spark, M.title(F.lit("Canton du Valais\nLoi concernant\nles ecoles\nVu la loi")))[0] == "Loi concernant les ecoles"
    assert one(spark, M.title(F.lit("Canton\nVu la loi")))[0] is None


def test_log_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", ["f", "v"], None)], "Z_name string, states array<string>, interest int")
    full = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None).cast("array<string>" if f.name in files.SETS else f.dataType)).alias(f.name) for f in files.LOG.fields])
    files.write_log(full, str(tmp_path / "log"))
    r = files.read_log(spark, str(tmp_path / "log")).first()
    assert r.states == ["f", "v"] and r.binary_files == [] and r.has_been_corrected is False


def test_files_round_trip(spark, tmp_path):
    """Metadata tables, caches, texts (written once), the expression bank, file lists and image sizes."""
    df = spark.createDataFrame([("1", ["a", "b"], 'say "x"\ny')], "cote string, tokens array<string>, text string")
    files.write_metadata({"cotes": df}, f"{tmp_path}/meta")
    r = files.check_columns(files.read_metadata(spark, f"{tmp_path}/meta/cotes", "cote string, tokens string, text string"), ["cote", "tokens", "text"]).first()
    assert tuple(r) == ("1", '["a","b"]', 'say "x"\ny')
    with pytest.raises(ValueError):
        files.check_columns(df, ["cote"])
    assert files.cached(spark, f"{tmp_path}/cache", lambda: df).first().tokens == ["a", "b"]
    assert files.cached(spark, f"{tmp_path}/cache", lambda: 1 / 0).count() == 1
    texts = spark.createDataFrame([("a.txt", "old"), ("b.txt", "b")], "txt_name string, text string")
    files.write_new_texts(texts.filter("txt_name = 'a.txt'"), f"{tmp_path}/texts")
    files.write_new_texts(texts.replace("old", "new"), f"{tmp_path}/texts")
    assert sorted(map(tuple, spark.read.text(f"{tmp_path}/texts").collect())) == [("b", "b.txt"), ("old", "a.txt")]
    assert files.read_bank(spark, f"{tmp_path}/none").count() == 0
    files.write_bank(spark.createDataFrame([("un mot",), ("un mot",)], "expression string"), f"{tmp_path}/bank")
    assert [r.expression for r in files.read_bank(spark, f"{tmp_path}/bank").collect()] == ["un mot"]
    (tmp_path / "img").mkdir()
    (tmp_path / "img" / "x_001.jpg").write_bytes(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x64\x00\xc8" + b"\0" * 12)
    (tmp_path / "img" / "t.txt").write_text("plain")
    assert [r.file for r in files.list_files(spark, f"{tmp_path}/img", "*.jpg").collect()] == ["x_001.jpg"]
    assert tuple(spark.read.format("binaryFile").load(f"{tmp_path}/img/x_001.jpg").select(files.image_size("content").alias("s")).first().s) == (200, 100)
    assert ("t.txt", "plain") in [tuple(r) for r in files.read_texts(spark, f"{tmp_path}/img/t.txt").collect()]
    alto = '<alto><Layout><Page><PrintSpace><TextBlock><TextLine VPOS="10" HEIGHT="10"><String CONTENT="un"/><String CONTENT="mot"/></TextLine><TextLine VPOS="25" HEIGHT="10"><String CONTENT="deux"/></TextLine></TextBlock></PrintSpace></Page></Layout></alto>'
    (tmp_path / "p.xml").write_text(alto)
    assert files.alto_text(spark, f"{tmp_path}/p.xml").first().text == "un mot\ndeux"
    files.write_manifests(spark.createDataFrame([("12", '{"a": 1}')], "cote string, manifest string"), f"{tmp_path}/man")
    assert spark.read.text(f"{tmp_path}/man").first().value == '{"a": 1}'


def test_topic_steps(spark):
    from quireon.operators import topics as T

    docs = spark.createDataFrame([(["loi", "loi", "vin"], False), (["vin", "eau"], False), (None, False), (["loi"], True), (["eau"], None)], "tokens array<string>, is_compil boolean")
    assert T.trainable(docs).count() == 2
    model, vectors = T.topic_model(T.trainable(docs), k=2, least=1, most=1.0, rounds=2)
    words = T.top_words(model, vectors, 2).collect()
    assert len(words) == 2 and all(len(r.words) == 2 and set(r.words) <= {"loi", "vin", "eau"} for r in words)


def test_catalogue_edges(spark):
    """Nulls, missing rows and empty tables of the catalogue's steps."""
    df = spark.createDataFrame([("a", "1")], "Z_name string, cote string")
    none = spark.createDataFrame([], "cote string, topic int")
    with pytest.raises(Exception, match="no topic for"):
        C.required(df, none, "cote", "topic").collect()
    assert C.recognised(spark.createDataFrame([], "Z_name string, file string, text string")).count() == 0
    assert one(spark, C.entry(F.lit("")), C.entry(F.lit("x")), C.merged(F.lit(None).cast("int"), F.lit(1), lambda a, b: a + b)).asDict().values() and list(one(spark, C.entry(F.lit("")), C.entry(F.lit("x")), C.merged(F.lit(2), F.lit(1), lambda a, b: a + b))) == [None, "x", 3]
    assert one(spark, C.assembled(F.array(F.lit("un mot cou-\n\n"), F.lit("pé\n"))))[0] == "un mot coupé\n"
    assert C.with_missing(df, {"cote": F.lit("z"), "n": F.lit(1)}).first().asDict() == {"Z_name": "a", "cote": "1", "n": 1}


def test_jpeg_size():
    assert files.jpeg_size(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x64\x00\xc8" + b"\0" * 12) == (200, 100)


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", FAST)
def test_query_equals_duckdb(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*cols).collect()), key=str)
    want = duck.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({Q.ORACLE_SQL[name]})").fetchall()
    assert [str(r) for r in got] == [str(r) for r in sorted((tuple(map(plain, r)) for r in want), key=str)]


def test_lda_uses_the_production_call(spark, monkeypatch):
    """q_lda trains as the archive does: 60 topics, 20 rounds, terms in 40 documents and at most an eighth of them."""
    seen = {}

    class Stub:
        def __init__(self, **kw):
            seen.update(kw)

        def fit(self, vectors):
            raise StopIteration

    def terms(docs, least, most, tokens="tokens"):
        seen.update(least=least, most=most)
        return spark.createDataFrame([("mot", 50)], "token string, df long")

    monkeypatch.setattr("quireon.operators.topics.LDA", Stub)
    monkeypatch.setattr("quireon.operators.topics.vocabulary", terms)
    with pytest.raises(StopIteration):
        Q.QUERIES["q_lda"](spark, SF)
    assert seen == {"k": 60, "maxIter": 20, "optimizer": "online", "seed": 0, "least": 40, "most": 1 / 8}


def test_lda_cuts_words_once(spark, monkeypatch):
    """Each of the 20 rounds reads counts that are stored; texts aren't cut into words again for it."""
    seen = []

    class Stub:
        def __init__(self, **kw):
            pass

        def fit(self, vectors):
            seen.append(vectors._jdf.queryExecution().executedPlan().toString())
            raise StopIteration

    monkeypatch.setattr("quireon.operators.topics.LDA", Stub)
    with pytest.raises(StopIteration):
        Q.QUERIES["q_lda"](spark, SF)
    assert "quireon-archive/counts" in seen[0] and "regexp_replace" not in seen[0] and "documents.parquet" not in seen[0]


def test_lda_sums_do_not_grow_with_the_input(spark, monkeypatch):
    """Each task of a round hands over k times the terms, so there are no more tasks than cores, however many splits the counts have."""
    seen = []

    class Stub:
        def __init__(self, **kw):
            pass

        def fit(self, vectors):
            seen.append(vectors.rdd.getNumPartitions())
            raise StopIteration

    monkeypatch.setattr("quireon.operators.topics.LDA", Stub)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        with pytest.raises(StopIteration):
            Q.QUERIES["q_lda"](spark, SF)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert seen[0] <= spark.sparkContext.defaultParallelism


def test_manifests_are_not_read_back(spark):
    """Thumbnail and number of canvases come from the operator, not from the manifest's text; parts are those of compilations alone."""
    from quireon.plans import queries as plans

    made = plans.QUERIES["q_manifests"](spark, "/root/testdata/sf0.001")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert made.columns == ["cote", "thumbnail", "n_canvases", "manifest"] and "get_json_object" not in plan and "_compil" in plan
    for r in made.limit(50).collect():
        told = json.loads(r.manifest)
        assert len(told["sequences"][0]["canvases"]) == r.n_canvases and told["thumbnail"]["@id"].split("/")[-4] == r.thumbnail
