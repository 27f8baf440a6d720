"""Embedding whitening: exact covariances by digit-slice matrix products, then eigenvectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_memos, read, spread

#: Bits of a limb and rows of a product: sums of products stay under 2^53, where float64 is exact.
LIMB_BITS, PRODUCT_ROWS = 18, 1 << 16
#: Big integers travel as two decimals, high * BASE + low, whose sums Spark takes exactly.
BASE = 10**18
#: Eigenvalues at or under this share of the largest are rounding, not variance.
LEAST_SHARE = 1e-13


@dataclass(frozen=True)
class Whitening:
    """What all vectors are whitened by: n vectors, sums S by dimension, eigenvalues and unit eigenvectors (columns), trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The whole number next to each dimension's mean."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def scale(self) -> np.ndarray:
        """1 / sqrt(eigenvalue); not a number where there is no variance."""
        real = self.values > LEAST_SHARE * max(float(self.values.max(initial=0.0)), 0.0)
        return np.where(real, 1 / np.sqrt(np.where(real, self.values, 1.0)), np.nan)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates; x less its mean is taken apart into whole numbers and a rest that floats hold."""
        rest = np.array([(s - int(c) * self.n) / self.n for s, c in zip(self.sums, self.centre, strict=True)])
        return ((x - self.centre) - rest) @ self.vectors * self.scale


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """Signed digits of LIMB_BITS bits of whole numbers, the lowest first, as floats."""
    out, half = [], np.int64(1 << (LIMB_BITS - 1))
    while x.any():
        digit = ((x & ((1 << LIMB_BITS) - 1)) ^ half) - half
        out.append(digit.astype(np.float64))
        x = (x >> LIMB_BITS) + (digit < 0)
    return out


def gram(x: np.ndarray) -> np.ndarray:
    """x' x as big integers: float64 products of limbs, each exact, recombined."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for at in range(0, len(x), PRODUCT_ROWS):
        digits = limbs(x[at : at + PRODUCT_ROWS])
        for i, a in enumerate(digits):
            for j, b in enumerate(digits[: i + 1]):
                part = (a.T @ b).astype(np.int64).astype(object)
                total += ((part if i == j else part + part.T) * (1 << (LIMB_BITS * (i + j))))
    return total


def split_big(values: list[int]) -> tuple[pa.Array, pa.Array]:
    from decimal import Decimal

    pairs = [divmod(v, BASE) for v in values]
    kind = pa.decimal128(38, 0)
    return pa.array([Decimal(h) for h, _ in pairs], kind), pa.array([Decimal(l) for _, l in pairs], kind)


def whole(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The rows' whole numbers, from a list column."""
    column = batch.column(batch.num_columns - 1)
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dim)


def usable(embeddings: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(_id, _x) of the vectors that can be whitened, and their dimension.

    x = floor(64 c) + 1000000 of each entry. Vectors that are null, or hold null or non-finite
    entries or such as leave the range of long, go; of several lengths the most frequent counts
    (the longest of those), since no covariance joins vectors of different spaces.
    """
    fits = lambda v: ~F.isnan(v) & (F.abs(v.cast("double") * 64) < 2.0**62)
    to_long = lambda v: F.when(fits(v), F.floor(v.cast("double") * 64).cast("long") + 1_000_000)  # noqa: E731  filters may be evaluated after it
    kept = embeddings.filter(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & F.forall(vec_col, lambda v: F.coalesce(fits(v), F.lit(False))))
    kept = kept.select(F.col(id_col).cast("long").alias("_id"), F.transform(vec_col, to_long).alias("_x"))
    size = kept.groupBy(F.size("_x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    dim = size["d"] if size else 0
    return spread(kept.filter(F.size("_x") == dim)), dim


def fit(vectors: DataFrame, dim: int) -> Whitening:
    """n, S and the eigenvectors of the covariance of all vectors.

    First pass: n and S. Second: each task takes whole numbers next to the means away, adds up
    limb products and hands over one triangle of big integers, which Spark sums by entry; the
    rest of the centring is exact too, (n G - s s') / n^2. The driver gets a triangle, whose
    size depends on the dimension alone.
    """
    first = vectors.select(F.posexplode("_x").alias("i", "x")).groupBy("i").agg(F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect()
    if not first:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0)
    n, sums = first[0]["n"], [int(s) for _, s in sorted((r["i"], r["s"]) for r in first)]
    centre = Whitening(n, tuple(sums), np.zeros(dim), np.eye(dim), 0.0).centre
    rows, cols = np.triu_indices(dim)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memos("whitening")
        total = np.zeros((dim, dim), object)
        for batch in batches:
            total += gram(whole(batch, dim) - centre)
        high, low = split_big(total[rows, cols].tolist())
        yield pa.record_batch([pa.array(rows, pa.int32()), pa.array(cols, pa.int32()), high, low], names=["i", "j", "high", "low"])

    parts = vectors.select("_x").mapInArrow(products, "i int, j int, high decimal(38,0), low decimal(38,0)")
    merged = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    left = [s - int(c) * n for s, c in zip(sums, centre, strict=True)]
    cov = np.zeros((dim, dim))
    for r in merged:
        g = int(r["high"]) * BASE + int(r["low"])
        cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = (n * g - left[r["i"]] * left[r["j"]]) / (n * n)
    values, axes = np.linalg.eigh(cov)
    return Whitening(n, tuple(sums), np.maximum(values[::-1], 0.0), axes[:, ::-1], float(np.trace(cov)))


def identity_error(vectors: DataFrame, dim: int, model: Whitening, components: int) -> float:
    """Largest absolute entry of (covariance of the whitened vectors - identity), over components with variance."""
    real = np.flatnonzero(np.isfinite(model.scale[:components]))
    if not len(real):
        return 0.0
    rows, cols = np.triu_indices(len(real))
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memos("whitening")
        total, plain = np.zeros((len(real), len(real))), np.zeros(len(real))
        for batch in batches:
            w = shared.value.project(whole(batch, dim))[:, real]
            total += w.T @ w
            plain += w.sum(0)
        yield pa.record_batch([pa.array(np.append(rows, np.arange(len(real))), pa.int32()), pa.array(np.append(cols, np.full(len(real), -1)), pa.int32()), pa.array(np.append(total[rows, cols], plain))], names=["i", "j", "v"])

    merged = vectors.select("_x").mapInArrow(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    got = {(r["i"], r["j"]): r["v"] / model.n for r in merged}
    return max(abs(v - got[i, -1] * got[j, -1] - (i == j)) for (i, j), v in got.items() if j >= 0)


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 32) -> tuple[DataFrame, Whitening, float]:
    """(id, deviation, whitened) of each vector that can be whitened, the model, and the identity error.

    deviation is the exact sum over dimensions of (n x - S)^2, decimal(38,0); whitened is the array
    of coordinates along the components with the largest eigenvalues, numbered by them, null where
    a component has no variance (a single vector, say). Vectors that usable() drops give no row;
    null ids are carried, repeated rows repeat and count, extra columns aren't read; an empty
    table, or one without a sound vector, gives an empty result.
    """
    vectors, dim = usable(embeddings, id_col, vec_col)
    model = fit(vectors, dim)
    error = identity_error(vectors, dim, model, components) if model.n else 0.0
    shared = embeddings.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        own_memos("whitening")
        m = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                x = whole(part, dim)
                apart = x - m.centre
                rest = np.array([s - int(c) * m.n for s, c in zip(m.sums, m.centre, strict=True)], object)
                small = int(np.abs(apart).max(initial=0)) * m.n + max(map(abs, rest.tolist()), default=0)
                far = apart * np.int64(m.n) - rest.astype(np.int64) if small**2 * dim < 1 << 63 else apart.astype(object) * m.n - rest  # both are exact
                w = m.project(x)[:, :components]
                flat = pa.array(w.ravel(), mask=np.isnan(w).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), flat)
                yield pa.record_batch([part.column(0), pa.array([Decimal(v) for v in (far * far).sum(1).tolist()], pa.decimal128(38, 0)), lists], names=[id_col, "deviation", "whitened"])

    return vectors.mapInArrow(run, f"`{id_col}` long, deviation decimal(38,0), whitened array<double>"), model, error


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per vector and component; deviation is exact or, beyond long, an error of the cast."""
    rows, model, error = whiten(read(spark, sf_dir, "embeddings"))
    share = F.array(*[F.lit(float(v) / model.trace if model.trace else 0.0) for v in model.values[:32]]) if model.n else F.array().cast("array<double>")
    out = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), F.col("deviation").cast("long").alias("deviation"), "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
