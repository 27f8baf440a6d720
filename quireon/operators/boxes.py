"""Page boxes: validity, font heights, neighbours, words, lines, reading order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_corners(boxes: DataFrame) -> DataFrame:
    return boxes.withColumn("antipod_x", F.col("anchor_x") + F.col("width")).withColumn("antipod_y", F.col("anchor_y") + F.col("height"))


def is_valid(median: Column, page_area: Column) -> Column:
    return (F.col("area") > 0.2 * median) & (F.col("area") < page_area / 2) & (F.col("width") < 4 * F.col("height")) & (F.col("height") < 8 * F.col("width"))


def is_separator(page_area: Column) -> Column:
    return (F.col("area") * 2 < page_area) & (F.col("height") > 8 * F.col("width"))


def half_disc(size: int) -> list[float]:
    """Weights of a half-disc filter of odd size, summing to one."""
    r = size // 2
    raw = [(1 - (i / (r + 1)) ** 2) ** 0.5 for i in range(-r, r + 1)]
    return [w / sum(raw) for w in raw]


def height_peaks(boxes: DataFrame, size: int = 5) -> DataFrame:
    """(page_id, height): local maxima of each page's smoothed histogram of heights."""
    hist = boxes.groupBy("page_id", "height").agg(F.count("*").alias("n"))
    span = hist.groupBy("page_id").agg(F.max("height").alias("m"))
    full = span.select("page_id", F.explode(F.sequence(F.lit(0), F.col("m") + 1)).alias("height")).join(hist, ["page_id", "height"], "left").fillna(0, ["n"])
    w, r = Window.partitionBy("page_id").orderBy("height"), size // 2
    smooth = sum((F.coalesce(F.lag("n", i).over(w) if i >= 0 else F.lead("n", -i).over(w), F.lit(0)) * F.lit(k) for i, k in zip(range(-r, r + 1), half_disc(size), strict=True)), F.lit(0.0))
    s = full.withColumn("s", F.round(smooth, 9))
    s = s.withColumn("before", F.coalesce(F.lag("s").over(w), F.lit(0.0))).withColumn("after", F.coalesce(F.lead("s").over(w), F.lit(0.0)))
    return s.filter("s > before and s >= after and s > 0").select("page_id", "height")


def merge_close_peaks(peaks: list[float]) -> list[float]:
    """Peaks nearer than a tenth of the lower one become their mean, again and again."""
    peaks = sorted(peaks)
    while True:
        runs, changed = [[p] for p in peaks[:1]], False
        for p in peaks[1:]:
            if p - runs[-1][-1] < 0.1 * runs[-1][-1]:
                runs[-1].append(p)
                changed = True
            else:
                runs.append([p])
        peaks = [round(sum(r) / len(r)) if len(r) > 1 else r[0] for r in runs]
        if not changed:
            return peaks


def beside(x: np.ndarray, z: np.ndarray, top: np.ndarray, bottom: np.ndarray, ids: np.ndarray, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Places of each box's left and right neighbour among a page's boxes, -1 for none.

    Boxes are compared by blocks in order of their upper edges, each with those that reach into
    its part of the page.
    """
    left, right = np.full(len(x), -1), np.full(len(x), -1)
    down = np.argsort(top, kind="stable")
    tops, tall = top[down], (bottom - top).max(initial=0)
    for start in range(0, len(x), block):
        i = down[start : start + block]
        j = down[np.searchsorted(tops, top[i[0]] - tall) : np.searchsorted(tops, bottom[i].max())]
        if not len(j):
            continue
        j = j[np.lexsort((ids[j], x[j]))]
        back = np.lexsort((ids[j], -x[j]))
        at = x[i][:, None]
        met = (top[i][:, None] < bottom[j]) & (top[j] < bottom[i][:, None])
        for there, to, side in ((met & (x[j] > at), j, right), ((met & (x[j] < at))[:, back], j[back], left)):
            first = there.argmax(axis=1)
            side[i] = np.where(there[np.arange(len(i)), first], to[first], -1)
    wide = z - x
    left[(left >= 0) & ~(z[left] > x - wide)] = -1
    right[(right >= 0) & ~(x[right] < z + wide)] = -1
    return left, right


def placed(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of the left and right neighbour of each row of a page's boxes; rows without corners or number have none and are none."""
    columns = [table.column(c) for c in ("anchor_x", "antipod_x", "anchor_y", "antipod_y", "box_id")]
    if not any(c.null_count for c in columns):
        return beside(*(c.to_numpy().astype("int64") for c in columns))
    known = np.flatnonzero(np.all([c.is_valid().to_numpy() for c in columns], axis=0))
    left, right = np.full(len(table), -1), np.full(len(table), -1)
    for side, found in zip((left, right), beside(*(c.take(known).to_numpy().astype("int64") for c in columns)), strict=True):
        side[known] = np.where(found >= 0, known[found], -1) if len(known) else found
    return left, right


def numbers(table: pa.Table, places: np.ndarray) -> pa.ChunkedArray:
    """Box numbers at places of a table, null for -1."""
    return table.column("box_id").take(pa.array(places, mask=places < 0))


def neighbours(boxes: DataFrame) -> DataFrame:
    """Left and right neighbour of each box: the box with the nearest left edge on either side that overlaps in y, if close enough.

    Close is nearer than the box's own width: the left one's right edge, the right one's left edge.
    A page's boxes are one group, so boxes that lie by pages already aren't shuffled, and pairs of
    boxes never leave a task.
    """

    def page(t: pa.Table) -> pa.Table:
        left, right = placed(t)
        return pa.table({"page_id": t.column("page_id"), "box_id": t.column("box_id"), "left_neighbor": numbers(t, left), "right_neighbor": numbers(t, right)})

    of = {c: boxes.schema[c].dataType.simpleString() for c in ("page_id", "box_id")}
    schema = f"page_id {of['page_id']}, box_id {of['box_id']}, left_neighbor {of['box_id']}, right_neighbor {of['box_id']}"
    return boxes.select("page_id", "box_id", "anchor_x", "anchor_y", "antipod_x", "antipod_y").groupBy("page_id").applyInArrow(page, schema)


def invalid(boxes: DataFrame, page_area: Column) -> DataFrame:
    """The boxes that are no characters, with their lower right corners."""
    m = boxes.groupBy("page_id").agg(F.median("area").alias("_m"))
    return with_corners(boxes.join(m, "page_id").filter(~is_valid(F.col("_m"), page_area)).drop("_m"))


def nearest_peak(height: Column, peaks: list[int]) -> Column:
    """The peak nearest to a height, the lower one on ties."""
    return F.array_min(F.array(*[F.struct(F.abs(height - p).alias("d"), F.lit(p).alias("p")) for p in peaks]))["p"]


def rollup(boxes: DataFrame, level: str) -> DataFrame:
    """Boxes of one word or line as one box."""
    g = boxes.groupBy("page_id", level).agg(F.min("anchor_x").alias("anchor_x"), F.min("anchor_y").alias("anchor_y"), F.max("antipod_x").alias("antipod_x"), F.max("antipod_y").alias("antipod_y"), F.count("*").alias("length"))
    return g.withColumn("width", F.col("antipod_x") - F.col("anchor_x")).withColumn("height", F.col("antipod_y") - F.col("anchor_y"))


def bigrams(sequences: DataFrame, values: str) -> DataFrame:
    """How often two values stand next to each other, in either order."""
    pairs = F.transform(F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(0))), lambda x, i: F.struct(F.least(x, F.get(values, i)).alias("a"), F.greatest(x, F.get(values, i)).alias("b")))
    return sequences.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n"))


def has_no_jump(pair: tuple, truth: list) -> bool:
    return abs(truth.index(pair[0]) - truth.index(pair[1])) <= 1
