"""Quality classifier: gradient-boosted trees on histograms of document statistics, traversed as flat arrays."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_remainder, own_memos, read, spread

#: Labelled rows that the trees are fitted on at most (in expectation; chosen by a hash of the id).
FIT_ROWS = 20_000
TREES, DEPTH, BINS, RATE = 80, 4, 64, 0.15
#: Least sum of second derivatives in a leaf, and the penalty on its value.
LEAF, PENALTY = 2.0, 1.0

#: Groups of bytes whose shares are statistics.
GROUPS = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": bytes(range(48, 58)), "space": b" \t", "newline": b"\n\r",
    "stop": b".", "comma": b",;:", "shout": b"!?", "bar": b"|", "dash": b"-_=~", "quote": b"'\"`", "bracket": b"()[]{}", "angle": b"<>",
    "sign": b"#$%&*+@^", "slash": b"/\\", "control": bytes([*range(0, 9), 11, 12, *range(14, 32), 127]), "beyond": bytes(range(0xC0, 0x100)),
}
_SHARES = np.array([[b in g for b in range(256)] for g in GROUPS.values()], np.float64).T
WORD_STATS = ["words", "distinct_words", "repeated_next", "commonest", "commonest_pair", "mean_length", "spread_length", "longest", "upper_words", "no_letter", "odd_end", "one_letter"]
LINE_STATS = ["lines", "distinct_lines", "mean_line", "longest_line", "lines_ended", "lines_barred", "longest_repeats"]
NAMES = ["bytes", *GROUPS, "entropy", "packed", *WORD_STATS, *LINE_STATS]


def statistics(text: str) -> list[float]:
    """The statistics of one whole text, in the order of NAMES; an empty text has all zero."""
    if not text:
        return [0.0] * len(NAMES)
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    seen = counts[counts > 0] / n
    out = [math.log1p(n), *(counts @ _SHARES / n).tolist(), float(-(seen * np.log2(seen)).sum()), len(zlib.compress(raw, 1)) / (n + 16)]
    words = text.split()
    k = len(words)
    if k:
        freq = Counter(words)
        lengths = np.fromiter(map(len, words), np.int64, k)
        pairs = Counter(zip(words, words[1:], strict=False))
        odd = sum(w[-1] not in ".,;:!?'\")»" and not w[-1].isalnum() for w in freq.elements())
        out += [math.log1p(k), len(freq) / k, sum(map(eq, words, words[1:])) / k, max(freq.values()) / k, max(pairs.values(), default=0) / k, float(lengths.mean()), float(lengths.std()), math.log1p(int(lengths.max()))]
        out += [sum(map(str.isupper, words)) / k, sum(not any(map(str.isalpha, w)) * c for w, c in freq.items()) / k, odd / k, int((lengths == 1).sum()) / k]
    else:
        out += [0.0] * len(WORD_STATS)
    lines = text.split("\n")
    m = len(lines)
    held = Counter(lines)
    sizes = np.fromiter(map(len, lines), np.int64, m)
    ended = sum(c for line, c in held.items() if line.rstrip().endswith((".", "!", "?", ":", "»", '"')))
    barred = sum(c for line, c in held.items() if "|" in line)
    out += [math.log1p(m), len(held) / m, float(sizes.mean()), math.log1p(int(sizes.max())), ended / m, barred / m, sum(len(line) * (c - 1) for line, c in held.items()) / len(text)]
    return out


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth as flat arrays: tree by tree, node i has children 2i + 1 and 2i + 2; leaves have values."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # a row goes right where its statistic is over it
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row: all rows step down all trees at once."""
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        inner = self.feature.shape[1]
        for _ in range((inner + 1).bit_length() - 1):
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.threshold[trees, at])
        odds = self.base + self.leaf[trees, at - inner].sum(1)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def edges_of(column: np.ndarray, bins: int) -> np.ndarray:
    """At most bins - 1 thresholds, halfway between values next to each other, near the quantiles."""
    values = np.unique(column)
    between = (values[:-1] + values[1:]) / 2
    if len(between) < bins:
        return between
    wanted = np.quantile(column, np.arange(1, bins) / bins)
    return np.unique(between[np.clip(np.searchsorted(between, wanted), 0, len(between) - 1)])


def boosted(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Forest:
    """Trees fitted to the logistic loss; x holds bins from here on, and each level of a tree takes one histogram of all columns."""
    n, width, inner = len(x), x.shape[1] if x.ndim == 2 else 0, (1 << depth) - 1
    if not n:
        return Forest(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    share = min(max(float(y.mean()), 0.5 / n), 1 - 0.5 / n)
    base = math.log(share / (1 - share))
    edges = [edges_of(x[:, f], bins) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], 1)  # over the edge before it
    columns = binned + np.arange(width) * bins
    feature, threshold, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    odds = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-odds))
        grad, curve = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            nodes, first = 1 << level, (1 << level) - 1
            cell = ((at - first)[:, None] * (width * bins) + columns).ravel()
            sums = [np.bincount(cell, np.repeat(v, width), nodes * width * bins).reshape(nodes, width, bins).cumsum(2) for v in (grad, curve)]
            (g, h), (g_all, h_all) = sums, (s[:, :1, -1:] for s in sums)
            worth = lambda a, b: a * a / (b + PENALTY)
            gain = np.where((h >= LEAF) & (h_all - h >= LEAF), worth(g, h) + worth(g_all - g, h_all - h) - worth(g_all, h_all), 0.0)
            best = gain.reshape(nodes, -1).argmax(1)
            f, b = best // bins, best % bins
            splits = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            feature[t, first : first + nodes] = np.where(splits, f, 0)
            threshold[t, first : first + nodes] = [edges[i][j] if ok else np.inf for i, j, ok in zip(f, b, splits, strict=True)]
            node = at - first
            at = 2 * at + 1 + (splits[node] & (binned[np.arange(n), f[node]] > b[node]))
        place = at - inner
        leaf[t] = rate * np.bincount(place, grad, inner + 1) / (np.bincount(place, curve, inner + 1) + PENALTY)
        odds += leaf[t][place]
    return Forest(base, feature, threshold, leaf)


def with_statistics(docs: DataFrame, columns: list[str], text_col: str, forest=None) -> DataFrame:
    """The named columns and, last, the statistics as float64 bytes or, with a (broadcast) forest, the score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memos("quality")
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x = np.array([statistics(t or "") for t in part.column(part.num_columns - 1).to_pylist()])
                last = pa.array([r.tobytes() for r in x], pa.binary()) if forest is None else pa.array(forest.value.score(x))
                yield pa.record_batch([*part.columns[:-1], last], names=[*columns, "score" if forest else "stats"])

    picked = docs.select(*columns, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return spread(picked).mapInArrow(run, f"{kinds}, {'score double' if forest else 'stats binary'}")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> Forest:
    """Trees over a bounded sample of labelled training documents (an id's least label, and one of its texts)."""
    known = labels.filter(F.col(label_col).isNotNull() & (id_remainder(id_col, 5) != 0)).groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.min(label_col).cast("double").alias("_label"))
    share = fit_rows / max(1, known.count())
    sample = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))  # ids are distinct: fit_rows in expectation
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id")
    got = with_statistics(rows, ["_id", "_label"], "_text").groupBy("_id").agg(F.min(F.struct("stats", "_label")).alias("m")).orderBy("_id").select("m.*").collect()
    x = np.array([np.frombuffer(r["stats"]) for r in got]).reshape(len(got), len(NAMES))
    return boosted(x, np.array([r["_label"] for r in got]))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS, least: float = 0.3) -> DataFrame:
    """One row per row of docs: id, held_out, score (0 to 1, higher where label 1 is likelier), predicted (1 from least on).

    Trees are learned from labels of ids whose crc32 mod 5 is not 0, at most fit_rows of them in
    expectation; only whole texts give statistics. Null text counts as empty, which has a score
    too. A null id counts as training (held_out false) but has no label; repeated rows repeat; ids
    labelled twice count with the least label; without labels every score is 0.5. An empty table
    gives an empty result; extra columns aren't read.
    """
    forest = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, fit_rows))
    picked = docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(id_remainder(id_col, 5) == 0, F.lit(False)).alias("_held"), F.col(text_col).alias("_body"))
    scored = with_statistics(picked, [id_col, "_held"], "_body", forest)
    return scored.select(id_col, F.col("_held").alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
