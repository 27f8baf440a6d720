"""Exact dedup: group by a 128-bit content hash, compare bytes inside groups, keep one id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hot_join, read, table

#: Bits of the filter that tells documents whose hash is surely unique; 2^26 bits are 8 MB at any input size.
FILTER_BITS = 26
_BUCKET = 4096 * 8


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", digest: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. Texts are equal when their bytes are. Rows whose id is null
    take part in a group's size and stay only where the whole group has no id. Rows that
    repeat an id within a group are the same document and share `kept`. An empty table gives
    an empty result; columns of docs besides the two named are not read.

    Only hashes are shuffled for documents whose hash is unique: hashes seen twice fill a
    bitmap of fixed size, and the texts of the documents it lets through are grouped by
    (hash, text), which compares bytes and combines on the map side, so that a group that
    holds a third of the table is one row per map task.
    """
    pick = {"max": F.max, "min": F.min}[keep]
    base = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    base = base.withColumn("_h", digest(F.col("_text")))
    multi = base.groupBy("_h").agg(F.count("*").alias("n")).filter("n > 1")
    bit = F.pmod(F.xxhash64("_h"), F.lit(1 << FILTER_BITS))
    maps = multi.select(bit.alias("b")).select(F.expr(f"b div {_BUCKET}").alias("_bucket"), (F.col("b") % _BUCKET).alias("at"))
    maps = table(maps.groupBy("_bucket").agg(F.expr("bitmap_construct_agg(at)").alias("_map")), "dup-bits")
    tried = base.withColumn("_b", bit).withColumn("_bucket", F.expr(f"_b div {_BUCKET}")).join(F.broadcast(maps), "_bucket", "left")
    byte = F.conv(F.hex(F.substring("_map", (F.expr(f"int((_b % {_BUCKET}) div 8)") + 1), 1)), 16, 10).cast("int")
    maybe = F.coalesce(F.expr("shiftright(_byte, int(_b % 8)) & 1"), F.lit(0)) == 1
    tried = tried.withColumn("_byte", byte).withColumn("_maybe", maybe).withColumn("_sha", F.sha2(F.col("_text").cast("binary"), 256))
    alone = tried.filter(~F.col("_maybe")).select("_id", "_sha", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    shared = tried.filter("_maybe")
    classes = shared.groupBy("_h", "_text").agg(pick("_id").alias("keep_id"), F.count("*").alias("group_size"))
    classes = table(classes.select("_h", F.sha2(F.col("_text").cast("binary"), 256).alias("_sha"), "keep_id", "group_size"), "dup-classes")
    total = classes.agg(F.sum("group_size")).first()[0] or 0
    found = hot_join(shared.select("_id", "_h", "_sha"), classes, ["_h", "_sha"], "group_size", total)
    out = alone.unionByName(found.select("_id", "_sha", "keep_id", "group_size"))
    return out.select(F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_sha").alias("text_sha256"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


OP8_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.text) AS text_sha256
FROM d JOIN g ON d.text = g.text
"""
