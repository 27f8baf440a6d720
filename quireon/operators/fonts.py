"""Font sizes of a page: peaks of character heights, merged when close, grouped by what stands together in words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def half_disc(size: int) -> list[float]:
    """Heights of a half-disc over an odd number of inner points of its diameter."""
    return [(1 - (2 * i / (size + 1) - 1) ** 2) ** 0.5 for i in range(1, size + 1)]


def peaks(boxes: DataFrame, size: int = 7) -> DataFrame:
    """(page_id, peaks): sorted local maxima of each page's histogram of heights, smoothed by a half-disc.

    A plateau counts at its middle (the lower one of two); the ends of the histogram are no
    maxima. Sums are rounded to nine digits, so that equal ones are equal in any order of addition.
    """
    hist = boxes.groupBy("page_id", "height").agg(F.count("*").alias("n"))
    span = hist.groupBy("page_id").agg(F.max("height").alias("m"))
    full = span.select("page_id", F.explode(F.sequence(F.lit(0), F.col("m"))).alias("height")).join(hist, ["page_id", "height"], "left")
    w, r = Window.partitionBy("page_id").orderBy("height"), size // 2
    smooth = sum((F.coalesce(F.lag("n", i).over(w), F.lit(0)) * F.lit(k) for i, k in zip(range(-r, r + 1), half_disc(size), strict=True)), F.lit(0.0))
    s = full.select("page_id", "height", F.round(smooth, 9).alias("s"))
    s = s.withColumn("_new", F.when(F.lag("s").over(w) == F.col("s"), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w))
    runs = s.groupBy("page_id", "_run").agg(F.first("s").alias("s"), F.floor((F.min("height") + F.max("height")) / 2).cast("int").alias("height"))
    over = Window.partitionBy("page_id").orderBy("_run")
    top = runs.withColumns({"_before": F.lag("s").over(over), "_after": F.lead("s").over(over)}).filter("s > _before and s > _after")
    return top.groupBy("page_id").agg(F.array_sort(F.collect_list("height")).alias("peaks"))


def merged_peaks(values: Column) -> Column:
    """Peaks nearer to the next one than a tenth of their mean become that mean, again and again; whole numbers in the end.

    A peak that has gone into the mean with the one before it doesn't stand for itself. A round
    with a merge has one peak less, so there are no more rounds than peaks.
    """

    def once(p: Column) -> Column:
        close = lambda i: F.coalesce((F.get(p, i + 1) - F.get(p, i)) * 10 < (F.get(p, i + 1) + F.get(p, i)) / 2, F.lit(False))
        kept = F.transform(p, lambda x, i: F.when(close(i), (x + F.get(p, i + 1)) / 2).when((i == 0) | ~close(i - 1), x))
        return F.filter(kept, lambda x: x.isNotNull())

    sorted_ = F.array_sort(values).cast("array<double>")
    rounds = F.when(F.size(values) > 1, F.sequence(F.lit(2), F.size(values))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rounds, sorted_, lambda p, _: once(p)).cast("array<int>")


def closest(height: Column, of: Column) -> Column:
    """The peak nearest to a height, the lower one on ties; null where there are none."""
    return F.array_min(F.transform(of, lambda p: F.struct(F.abs(p - height).alias("d"), p.alias("p"))))["p"]


def no_jump(a: Column, b: Column, of: Column) -> Column:
    """Whether two peaks are the same or follow each other."""
    return F.abs(F.array_position(of, a) - F.array_position(of, b)) <= 1


def pairs(words: DataFrame) -> DataFrame:
    """(page_id, a, b, n): how often two peaks, the lower first, stand next to each other in words of at least three characters.

    words has page_id and heights, the peaks of a word's characters in order of box numbers.
    """
    two = F.transform(F.slice("heights", 2, F.size("heights")), lambda x, i: F.struct(F.least(x, F.get("heights", i)).alias("a"), F.greatest(x, F.get("heights", i)).alias("b")))
    return words.filter(F.size("heights") > 2).select("page_id", F.explode(two).alias("p")).groupBy("page_id", "p.a", "p.b").agg(F.count("*").alias("n"))


def font_sizes(pairs_: DataFrame, peaks_: DataFrame) -> DataFrame:
    """(page_id, sizes): the largest peak of each group, in order of the groups' first pairs.

    Pairs without a jump come by falling count (then a, b). A pair joins every group whose anchor
    (lower peak of its first pair) it holds, or that has both its peaks; if there is none it makes
    one. The fold is one expression per page, over its distinct pairs of peaks.
    """
    fit = pairs_.join(peaks_, "page_id").filter(no_jump(F.col("a"), F.col("b"), F.col("peaks")))
    rows = fit.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("_n"), "a", "b"))).alias("ps"))

    def step(groups: Column, p: Column) -> Column:
        a, b = p["a"], p["b"]
        takes = lambda g: (g["anchor"] == a) | (g["anchor"] == b) | (F.array_contains(g["held"], a) & F.array_contains(g["held"], b))
        joined = F.transform(groups, lambda g: F.when(takes(g), F.struct(g["anchor"].alias("anchor"), F.array_union(g["held"], F.array(a, b)).alias("held"))).otherwise(g))
        return F.when(F.exists(groups, takes), joined).otherwise(F.array_append(groups, F.struct(a.alias("anchor"), F.array_distinct(F.array(a, b)).alias("held"))))

    none = F.array().cast("array<struct<anchor: int, held: array<int>>>")
    return rows.select("page_id", F.transform(F.aggregate("ps", none, step), lambda g: F.array_max(g["held"])).alias("sizes"))


def peaked(boxes: DataFrame, peaks_: DataFrame) -> DataFrame:
    """Characters with the peak closest to their height."""
    return boxes.join(peaks_, "page_id", "left").withColumn("closest_peak", closest(F.col("height"), F.col("peaks"))).drop("peaks")
