"""The corpus pipeline: language ID, exact dedup, near dedup, decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. Stages
that repeat an id keep or drop its rows together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quireon.llm.byte_bpe import bpe_round_trip
from quireon.llm.common import read, sieve, table
from quireon.llm.decontaminate import find_leaks
from quireon.llm.exact_dedup import exact_dedup
from quireon.llm.language_id import language_id
from quireon.llm.near_dedup import near_dedup


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null text, or no letter) go."""
    return without(docs, language_id(docs, spans=False).filter("lang_pred = 'und'"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    gone = exact_dedup(docs).filter("not kept")
    return without(docs, gone)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the least doc_id."""
    gone = near_dedup(docs).filter("not kept and doc_id is not null")
    return without(docs, gone)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    gone = find_leaks(docs, read(spark, sf_dir, "benchmark"))
    return without(docs, gone)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of what is left; a small memo, freed when a task ends, since executors hold the memory of the stages before."""
    return bpe_round_trip(docs, with_ids=False, memo=100_000, keep=False)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs less the ids in gone (rows without an id stay); texts aren't shuffled for ids that a bitmap tells are not among them."""
    ids = table(gone.filter("doc_id is not null").select("doc_id").distinct(), "gone")
    rest = sieve(docs, "doc_id", ids, "gone-bits", keep=False)
    near = sieve(docs, "doc_id", ids, "gone-bits").join(ids, "doc_id", "left_anti").select(*docs.columns)
    return rest.unionByName(near)


STAGES = [("language_id", languages), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("decontamination", leaks), ("byte_bpe", tokens)]

#: Model-based and approximate stages have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and reread."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = table(docs, name)
    return docs
