"""Joins of sales with store features and store metadata.

No broadcast hints: Spark broadcasts a side when its size, from file statistics
or measured after a shuffle stage, is under
``spark.sql.autoBroadcastJoinThreshold``. Beyond that it is a sort-merge join,
and adaptive execution splits the partitions of hot (Store, Date) pairs. All
joins are inner or left with sales on the left, the kinds that can be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.contracts import MERGED, PROMOTION_FLAGS, PROMOTIONS
from salesflow.functions.dates import calendar


def join_features(
    sales: DataFrame,
    features: DataFrame,
    on: Sequence[str] = ("Store", "Date"),
    how: str = "left",
    clash: str = "sales",
) -> DataFrame:
    """Sales with the features of the same store and week.

    A column both sides have is taken from sales (``clash="sales"``), or kept
    twice with the suffixes ``_x`` and ``_y`` (``clash="suffix"``).
    """
    both = [c for c in features.columns if c in sales.columns and c not in on]
    if clash == "sales":
        features = features.drop(*both)
    elif clash == "suffix":
        sales = sales.withColumnsRenamed({c: f"{c}_x" for c in both})
        features = features.withColumnsRenamed({c: f"{c}_y" for c in both})
    else:
        raise ValueError(f"clash must be 'sales' or 'suffix', not {clash!r}")
    return sales.join(features, list(on), how)


def join_stores(
    sales: DataFrame, stores: DataFrame, on: Sequence[str] = ("Store",), how: str = "left"
) -> DataFrame:
    return sales.join(stores, list(on), how)


def merge_wide(sales: DataFrame, features: DataFrame, stores: DataFrame) -> DataFrame:
    """Every sales row with its features, store data and calendar.

    Without a matching week the promotion columns are 0 and the other features
    null; without a matching store Type and Size are null.
    """
    wide = join_stores(join_features(sales, features), stores)
    defaults = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in PROMOTIONS}
    defaults |= {c: F.coalesce(F.col(c), F.lit(0)) for c in PROMOTION_FLAGS}
    return wide.withColumns(defaults | calendar()).select(*MERGED.names())


def scoring_input(
    test: DataFrame, features: DataFrame, stores: DataFrame, clash: str = "sales"
) -> DataFrame:
    """Rows to score, joined the way the training rows are."""
    return join_stores(join_features(test, features, clash=clash), stores)
