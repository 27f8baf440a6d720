"""Helpers shared by the training-data operators: scratch tables, salted joins, distributed ranks."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key counts as hot when it holds at least one row in HOT_SHARE; so there are at most HOT_SHARE hot keys.
HOT_SHARE = 200_000

_scratch: list[tuple[SparkSession, str]] = []
_held: dict[str, Callable[[], None]] = {}


def own_memos(owner: str, free: Callable[[], None] | None = None) -> None:
    """Called in a Python worker when a task of an operator begins: frees what tasks of other operators have left there."""
    others = [k for k in _held if k != owner]
    for other in others:
        _held.pop(other)()
    if others:
        give_back()
    _held[owner] = free or (lambda: None)


def let_go(owner: str) -> None:
    """Called when a task ends whose operator keeps nothing for its next one: idle workers hold no memos while others work."""
    if owner in _held:
        _held.pop(owner)()
    give_back()


def give_back() -> None:
    """Gives freed memory back to the machine, not only to this process."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a temporary one only where none is set on one machine (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="quireon-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def table(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/quireon/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _scratch.append((spark, path))
    out = spark.read.parquet(path)
    out._scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables made by table() that nothing still unevaluated reads."""
    for df in tables:
        mine = (df.sparkSession, df._scratch_path)
        _delete(*mine)
        _scratch.remove(mine)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _drop_scratch() -> None:
    for spark, path in _scratch:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone at exit
            return


#: Bytes of a batch of rows on its way to a Python worker; executor and worker hold it some times over.
BATCH_BYTES = 12 << 20


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per core (a small table in one file would keep one core busy), and batches for Python of bounded bytes."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(col: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def words(col: Column) -> Column:
    """Runs of anything but the six ASCII white spaces, lower-cased A-Z; null gives an empty array."""
    spaced = F.translate(F.coalesce(col, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz     ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner", share: int = HOT_SHARE) -> DataFrame:
    """Join on keys that are unique in right, where right[weight] says how many left rows a key has.

    Keys with at least total/share rows (so at most share keys) are broadcast; the others,
    none of which is large, are shuffled. No key's rows meet in one task.
    """
    least = max(2, -(-total // share))
    hot = F.broadcast(right.filter(F.col(weight) >= least).withColumn("_hot", F.lit(True)))
    tried = left.join(hot, keys, "left")
    cold = right.filter(F.col(weight) < least)
    rest = tried.filter(F.col("_hot").isNull()).select(*left.columns).join(cold, keys, how)
    out = [*left.columns, *(c for c in right.columns if c not in keys)]
    return tried.filter("_hot").select(*out).unionAll(rest.select(*out))


def ranked(df: DataFrame, order: list[str], label: str, rank: str = "_rank") -> DataFrame:
    """Number rows 0.. in a total order without a single-task window: range partitions plus offsets."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    parts = table(parts.select("*", F.spark_partition_id().alias("_part"), (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).alias("_at")), label)
    sizes = sorted((r["_part"], r["n"]) for r in parts.groupBy("_part").agg(F.count("*").alias("n")).collect())  # one row per partition
    starts, upto = [], 0
    for part, size in sizes:
        starts.append((part, upto))
        upto += size
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _start long")
    return parts.join(F.broadcast(offsets), "_part").withColumn(rank, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def sieve(df: DataFrame, key: str, keys: DataFrame, label: str, bits: int = 26, keep: bool = True) -> DataFrame:
    """The rows of df whose key may be among keys[key], by a bitmap of fixed size (2^26 bits are 8 MB).

    Rows are dropped on the map side, before a join that would shuffle them; keys that share a bit pass.
    With keep=False the other rows, whose key is surely not among them (null keys too).
    """
    bucket = 4096 * 8
    b, part, at, bits_of, byte = unused(df, "_b", "_bucket", "_at", "_map", "_byte")
    bit = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    maps = keys.select(bit.alias(b)).select(F.expr(f"{b} div {bucket}").alias(part), (F.col(b) % bucket).alias(at)).groupBy(part).agg(F.expr(f"bitmap_construct_agg({at})").alias(bits_of))
    tried = df.withColumn(b, bit).withColumn(part, F.expr(f"{b} div {bucket}")).join(F.broadcast(table(maps, label)), part, "inner" if keep else "left")
    tried = tried.withColumn(byte, F.conv(F.hex(F.substring(bits_of, F.expr(f"int(({b} % {bucket}) div 8)") + 1, 1)), 16, 10).cast("int"))
    hit = F.coalesce(F.expr(f"shiftright({byte}, int({b} % 8)) & 1"), F.lit(0)) == 1
    return tried.filter(hit if keep else ~hit | F.col(key).isNull()).select(*(f"`{c}`" for c in df.columns))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores as make it differ from the columns of df."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
