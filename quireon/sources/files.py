"""Readers and writers of the archive's files."""

from __future__ import annotations

import struct
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.log import decode_set, encode_set
from .named import NamedFiles

LOG = T.StructType([T.StructField(n, t) for n, t in [
    ("Z_name", T.StringType()), ("should_be_name", T.StringType()), ("cote", T.StringType()), ("is_included", T.IntegerType()), ("states", T.StringType()), ("doublon", T.StringType()),
    ("remarque", T.StringType()), ("selection_version", T.StringType()), ("needs_transcription", T.BooleanType()), ("official_name", T.StringType()), ("binary_files", T.StringType()),
    ("txt_name", T.StringType()), ("has_been_corrected", T.BooleanType()), ("interest", T.IntegerType()), ("is_compil", T.BooleanType()),
]])
SETS = ["states", "binary_files"]


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The tab-separated log; printed sets become sorted arrays."""
    df = spark.read.csv(path, sep="\t", header=True, schema=LOG)
    return df.withColumns({c: decode_set(F.coalesce(F.col(c), F.lit("set()"))) for c in SETS}).fillna(False, ["has_been_corrected"])


def write_log(df: DataFrame, path: str) -> None:
    """A new snapshot; readers of the old one aren't disturbed."""
    df.withColumns({c: encode_set(F.col(c)) for c in SETS if c in df.columns}).write.csv(path, sep="\t", header=True, mode="overwrite")


def read_metadata(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"')


def write_metadata(tables: dict[str, DataFrame], path: str) -> None:
    """One CSV folder per table (images, shelf marks, documents); lists are written as JSON."""
    for name, df in tables.items():
        lists = {f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)}
        df.withColumns(lists).write.csv(f"{path}/{name}", header=True, escape='"', mode="overwrite")


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at path (tokens, topics, sizes; lists stay lists), made and written there where it isn't yet."""
    if not exists(spark, path):
        make().write.parquet(path)
    return spark.read.parquet(path)


def write_new_texts(df: DataFrame, path: str, name: str = "txt_name", text: str = "text") -> None:
    """A folder of one text file for each row whose name isn't there yet."""
    if exists(df.sparkSession, path):
        df = missing(df, df.sparkSession.read.text(path).select(name), name)
    df.select(name, F.col(text).alias("value")).write.partitionBy(name).mode("append").text(path)


def check_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    if set(df.columns) != set(expected):
        raise ValueError(f"columns differ: {sorted(set(df.columns) ^ set(expected))}")
    return df


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(txt_name, text), one row per file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("txt_name"), F.col("value").alias("text"))


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(F.col("_metadata.file_name").alias("file"), "length")


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_bank(spark: SparkSession, path: str) -> DataFrame:
    """Expression bank without header; a missing file is an empty bank."""
    if not exists(spark, path):
        return spark.createDataFrame([], "expression string")
    return spark.read.csv(path, sep="\t", schema="expression string").dropna().distinct()


def write_bank(df: DataFrame, path: str) -> None:
    df.select("expression").write.csv(path, sep="\t", header=False, mode="overwrite")


def jpeg_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) from the first start-of-frame segment."""
    at = 2
    while at + 9 < len(data) and data[at] == 0xFF:
        marker, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height
        at += 2 + size
    return None


def tiff_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) from the tags of the first directory, in either byte order."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if not order or len(data) < 8:
        return None
    at, found = struct.unpack(order + "I", data[4:8])[0], {}
    count = struct.unpack(order + "H", data[at : at + 2])[0] if at + 2 <= len(data) else 0
    for k in range(at + 2, min(at + 2 + 12 * count, len(data) - 11), 12):
        tag, kind = struct.unpack(order + "HH", data[k : k + 4])
        if tag in (256, 257) and kind in (3, 4):  # short or long
            found[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), data[k + 8 : k + (10 if kind == 3 else 12)])[0]
    return (found[256], found[257]) if len(found) == 2 else None


def header_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) of a JPEG, PNG or TIFF image from its header; None for anything else."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    return jpeg_size(data) if data[:2] == b"\xff\xd8" else tiff_size(data)


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def image_size(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([header_size(c) or (None, None) for c in content], columns=["width", "height"]).astype("Int32")


def write_segments(df: DataFrame, path: str) -> None:
    """<page_id>.json for each page whose segments aren't there yet."""
    write_new_files(df.select(F.col("page_id").cast("string").alias("name"), "segments"), path, ".json")


def alto_text(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of ALTO pages, in NFC: a line break before a line that begins over 3/4 of a height below the one before, a blank line over three.

    A file is read whole, and a line's place is its place in the file, so files of any size keep
    their order. Words are followed by a space, which a break takes away; empty lines count for
    the gaps. A file without lines has an empty text.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.regexp_replace("value", "(?s)<!--.*?-->", "").alias("xml"))
    cut = F.regexp_extract_all("xml", F.lit(r"(?s)(<TextLine\b(?:[^>]*/>|.*?</TextLine>))"), F.lit(1))
    lines = whole.select("file", F.posexplode_outer(cut).alias("n", "line")).select("file", "n", F.from_xml("line", "_VPOS int, _HEIGHT int, String array<struct<_CONTENT: string>>").alias("t"))
    rows = lines.select("file", "n", "t._VPOS", "t._HEIGHT", F.array_join(F.transform("t.String", lambda s: F.concat(F.coalesce(s["_CONTENT"], F.lit("")), F.lit(" "))), "").alias("line"))
    return join_lines(rows, F.col("_VPOS"), F.col("_HEIGHT"))


def join_lines(rows: DataFrame, top: Column, height: Column) -> DataFrame:
    w = Window.partitionBy("file").orderBy("n")
    before, high = F.lag(top).over(w), F.lag(height).over(w)
    below = lambda times: F.coalesce((before > 0) & (high > 0) & (top > before + times * high), F.lit(False))
    rows = rows.withColumn("piece", F.concat(F.when(below(0.75), "\n").otherwise(""), F.when(below(3), "\n").otherwise(""), F.coalesce("line", F.lit(""))))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "piece"))), lambda s: s["piece"]), "")
    return rows.groupBy("file").agg(text.alias("text")).select("file", nfc(F.rtrim(F.regexp_replace("text", " \n", "\n"))).alias("text"))


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFC", t))


def write_manifests(df: DataFrame, path: str) -> None:
    """CH-AEV_IV_<cote>.json for each shelf mark whose file isn't there yet."""
    write_new_files(df.select(F.concat(F.lit("CH-AEV_IV_"), "cote").alias("name"), "manifest"), path, ".json")


def write_new_files(df: DataFrame, path: str, suffix: str = "") -> None:
    """One file per row (name first, text last) for the names that aren't there yet; all of them or, if a task fails for good, none."""
    df.sparkSession.dataSource.register(NamedFiles)
    df.write.format("named_files").option("suffix", suffix).mode("append").save(path)


def missing(df: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows whose output doesn't exist yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")
