"""Line dedup: prefix doubling over line-id sequences; later copies of repeated line runs are deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop, hot_join, ranked, read, sieve, spread, table

#: Lines that a repeated run has at least.
MIN_RUN = 2


def intervals(suffixes: DataFrame) -> DataFrame:
    """(k1, k2, first, times, rank) of the keys that suffixes share: intervals of the suffix array.

    Keys order the suffixes by their first lines; those with equal keys stand next to each other
    with a common prefix of at least the length compared so far. rank is the interval's place.
    """
    found = suffixes.groupBy("k1", "k2").agg(F.min(F.struct("_id", "at")).alias("first"), F.count("*").alias("times")).filter("times > 1")
    return ranked(found, ["k1", "k2"], "intervals", "rank")


def common_prefixes(docs: DataFrame, min_run: int) -> list[tuple[int, DataFrame]]:
    """(length, (_id, at, rank, first)) of each round of prefix doubling from min_run lines on, as long as any so long run repeats.

    The key of a suffix is (rank of its first h lines, rank of the h lines after them); suffixes
    whose key is unique leave, since no run of more lines repeats there. The rows of a round are
    the members of the intervals with a longest common prefix of `length` or more lines, with the
    first of the interval in order of (id, line). Lines are told apart by 128 bits of hash.
    """
    lines = docs.select("_id", F.split("_text", "\n").alias("ls"))
    size = min(min_run, 2)  # pairs need no shuffle: both lines are in the row
    at = lambda i: [F.element_at("ls", i + k) for k in range(1, size + 1)]
    keys = F.transform(F.slice("ls", 1, F.greatest(F.size("ls") - (size - 1), F.lit(0))), lambda x, i: F.struct(F.xxhash64(*at(i)).alias("k1"), F.xxhash64(F.lit("2"), *at(i)).alias("k2")))
    suffixes = lines.select("_id", F.posexplode(keys).alias("at", "k")).select("_id", "at", "k.k1", "k.k2")
    length, out, spent = size, [], []
    while True:
        groups = intervals(suffixes)
        total = groups.agg(F.sum("times")).first()[0] or 0
        if not total:
            drop(*spent)
            return out
        kept = hot_join(sieve(suffixes, "k1", groups, "run-bits"), groups, ["k1", "k2"], "times", total).select("_id", "at", "rank", "first")
        if length == size:  # rows that repeat an id are one document
            kept = kept.groupBy("_id", "at").agg(F.min(F.struct("rank", "first")).alias("m")).select("_id", "at", "m.*")
        kept = table(kept, "ranks")
        drop(*spent)
        spent = [] if length >= min_run else [kept]
        if length >= min_run:
            out.append((length, kept))
        step = length if length >= min_run else min(length, min_run - length)
        on = kept.select("_id", (F.col("at") - step).alias("at"), F.col("rank").alias("k2"))
        suffixes = table(kept.select("_id", "at", F.col("rank").alias("k1")).join(on, ["_id", "at"]), "suffixes")
        spent.append(suffixes)
        length += step


def repeated_runs(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(_id, runs): the maximal repeated runs of each document's lines that an earlier place has: start, lines, source_id, source_line.

    A line takes the longest common prefix that it has with the first of an interval; lines that
    follow each other, as their sources do, make one run, which reaches as far as the prefix of its
    last line. Runs with different sources may overlap.
    """
    levels = common_prefixes(docs, min_run)
    rows = None
    for length, kept in levels:
        later = kept.filter(F.struct("_id", "at") > F.col("first")).select("_id", "at", F.lit(length).alias("n"), "first")
        rows = later if rows is None else rows.unionAll(later)
    if rows is None:
        return docs.select("_id", F.lit(None).cast("array<struct<start: int, lines: int, source_id: long, source_line: int>>").alias("runs")).limit(0)
    best = rows.groupBy("_id", "at").agg(F.max(F.struct("n", "first")).alias("m")).select("_id", "at", "m.n", F.col("m.first._id").alias("source"), F.col("m.first.at").alias("line"))
    before = Window.partitionBy("_id").orderBy("at")
    follows = (F.lag("at").over(before) + 1 == F.col("at")) & (F.lag("source").over(before) == F.col("source")) & (F.lag("line").over(before) + 1 == F.col("line"))
    chained = best.withColumn("_new", F.when(follows, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(before))
    runs = chained.groupBy("_id", "_run").agg(F.min(F.struct("at", "source", "line")).alias("m"), F.max(F.col("at") + F.col("n")).alias("end"))
    run = F.struct(F.col("m.at").alias("start"), (F.col("end") - F.col("m.at")).alias("lines"), F.col("m.source").alias("source_id"), F.col("m.line").alias("source_line"))
    out = table(runs.groupBy("_id").agg(F.sort_array(F.collect_list(run)).alias("runs")), "runs")
    drop(*(kept for _, kept in levels))
    return out


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """One row per row of docs: id, n_lines, n_deleted, text without deleted lines, runs (start, lines, source_id, source_line).

    Lines end at \\n. A line is deleted where it lies in a run of at least min_run lines that
    starts at an earlier place too, in order of (id, line number); runs don't cross documents and
    may overlap. Null text counts as empty (one empty line). Documents without an id are left as
    they are and aren't compared; rows that repeat an id are one document. Extra columns aren't
    read; an empty table gives an empty result. DataFrame functions only.
    """
    base = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    gone = repeated_runs(spread(base).filter("_id is not null"), min_run)
    n = F.size(F.split("_text", "\n"))
    hit = sieve(base, "_id", gone, "gone-bits").join(gone, "_id", "left")
    none = F.array().cast("array<struct<start: int, lines: int, source_id: long, source_line: int>>")
    left = F.filter(F.split("_text", "\n"), lambda x, i: ~F.exists(F.coalesce("runs", none), lambda r: (i >= r["start"]) & (i < r["start"] + r["lines"])))
    hit = hit.withColumn("_left", left)
    cut = hit.select(F.col("_id").alias(id_col), n.cast("long").alias("n_lines"), (n - F.size("_left")).cast("long").alias("n_deleted"), F.array_join("_left", "\n").alias("text"), F.coalesce("runs", none).alias("runs"))
    rest = sieve(base, "_id", gone, "gone-bits", keep=False)
    return rest.select(F.col("_id").alias(id_col), n.cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_deleted"), F.col("_text").alias("text"), none.alias("runs")).unionByName(cut)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read(spark, sf_dir, "documents")).drop("runs")


OP9_SQL = """
WITH l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) - 1 AS i, unnest(ls) AS line
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
w AS (SELECT doc_id, i, line AS a, lead(line) OVER d AS b, lead(i) OVER d AS j FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, i) AS nth FROM w WHERE j IS NOT NULL),
g AS (SELECT DISTINCT doc_id, i + k AS i FROM f, (VALUES (0), (1)) v(k) WHERE nth > 1)
SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_deleted, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS text
FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id
"""
