"""New text files as a stream: each is formatted once, as the batch form does with missing outputs."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import format_text
from ..sources.named import NamedFiles


def format_new_texts(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Format the texts that have come to source since the last run, then stop; exactly once by the checkpoint."""
    stream = spark.readStream.schema("value string").option("wholetext", True).format("text").load(source)
    out = stream.select(F.col("_metadata.file_name").alias("txt_name"), format_text(F.col("value")).alias("text"))
    return out.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def format_new_files(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """As format_new_texts(), with a file of the same name for each text."""
    spark.dataSource.register(NamedFiles)
    stream = spark.readStream.schema("value string").option("wholetext", True).format("text").load(source)
    out = stream.select(F.col("_metadata.file_name").alias("txt_name"), format_text(F.col("value")).alias("text"))
    return out.writeStream.format("named_files").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
