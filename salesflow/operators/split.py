"""Hold-out split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.operators.stats import in_fraction

# The hold-out share and the seed of the learners.
TEST_SHARE = 0.2
SEED = 42


def mark_holdout(
    df: DataFrame,
    key: Sequence[str] = ("Store", "Dept", "Date"),
    share: float = TEST_SHARE,
    seed: int = SEED,
    name: str = "is_test",
) -> DataFrame:
    """Marks about ``share`` of the rows by a hash of their key and the seed.

    Unlike a random split the same rows are marked on any partitioning and
    after a lost executor is recomputed, and nothing has to be shuffled or kept.
    """
    salted = df.withColumn("_seed", F.lit(seed))
    return salted.withColumn(name, in_fraction([*key, "_seed"], share)).drop("_seed")


def split(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Training rows and hold-out rows: disjoint, and together all rows."""
    marked = mark_holdout(df, name="_test", **options)
    return marked.where(~F.col("_test")).drop("_test"), marked.where("_test").drop("_test")
