"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.session import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root): the smallest id reachable from each id that has an edge.

    Each round takes the smallest root among the neighbours and then that root's
    own root, so long chains halve. Aggregates combine before the shuffle; each
    round is written to the checkpoint folder. Nulls and self links give nothing.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v"))
    pairs = cut(pairs.union(pairs.select("v", "u")).distinct())
    roots = cut(
        pairs.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("v")).select(
            "id", F.least("id", "v").alias("root")
        )
    )
    while True:
        nearby = (
            pairs.join(roots.select(F.col("id").alias("v"), "root"), "v")
            .groupBy(F.col("u").alias("id"))
            .agg(F.min("root").alias("near"))
        )
        step = roots.join(nearby, "id").select(
            "id", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        jump = step.select(F.col("id").alias("root"), F.col("root").alias("next"))
        new = cut(
            step.join(jump, "root", "left").select(
                "id", "old", F.least("root", F.coalesce("next", "root")).alias("root")
            )
        )
        roots = new.select("id", "root")
        if new.where(F.col("root") != F.col("old")).isEmpty():
            return roots
