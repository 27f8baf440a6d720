"""Connected components of a link table by minimum-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, table


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of links (a, b); component is the least id reachable.

    Each round a node takes the least label among itself and its neighbours (a partial
    aggregate, so a node with very many links is one row per map task), then the label of its
    label; rounds follow the logarithm of the longest path. Labels are written to the shared
    folder every round; nothing is collected but the number of changes.
    """
    both = table(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = table(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        step = table(labels.join(near, "id", "left").select("id", F.col("component").alias("old"), F.least("component", "near").alias("component")), "labels")
        jump = step.select(F.col("id").alias("component"), F.col("component").alias("root"))
        new = table(step.join(jump, "component", "left").select("id", "old", F.least("component", F.coalesce("root", "component")).alias("component")), "labels")
        drop(labels, step)
        labels = new
        if not labels.filter("component <> old").limit(1).count():
            drop(both)
            out = labels.select("id", "component")
            out._scratch_path = labels._scratch_path
            return out
