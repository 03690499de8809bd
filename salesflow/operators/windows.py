"""Lag and rolling features over a series per group.

Precondition of every function here: (group columns, order column) is a unique
key, as the sales contracts say and ``checks.duplicate_keys`` verifies. With an
order column of type DATE that bounds a group by the calendar, whatever the size
of the table: the range 0001 to 9999 has 3.65 million days, ten years of weeks
have 520. One task per group is then safe.

With a finer order column (timestamps) a single group may be of any size. Pass
``chunk`` (``"year"``, ``"month"``, ``"day"``, ``"hour"`` ...) and each group is
cut into periods that are processed apart. Frames only look back a fixed number
of rows, so every row with that many rows before it in its own period is right
already; the few rows at the period edges are computed again from the edge rows
alone. The result is the same, row for row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.functions.money import exact_mean
from salesflow.operators.cleaning import fill_numeric

# From the window partition columns and the order column to the new columns.
Features = Callable[[Sequence[str], str], dict[str, Column]]


def add_series_features(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    features: Features,
    look_back: int,
    chunk: str | None = None,
) -> DataFrame:
    if chunk is None:
        return df.withColumns(features(group, order))
    period = [*group, "_chunk"]
    by_period = Window.partitionBy(*period)
    marked = df.withColumn("_chunk", F.date_trunc(chunk, F.col(order))).withColumns(
        {
            "_at": F.row_number().over(by_period.orderBy(order)),
            "_size": F.count(F.lit(1)).over(by_period),
        }
    )
    head = F.col("_at") <= look_back
    tail = F.col("_size") - F.col("_at") < look_back
    inner = marked.withColumns(features(period, order)).where(~head)
    edges = marked.where(head | tail).withColumns(features(group, order)).where(head)
    return inner.unionByName(edges).drop("_chunk", "_at", "_size")


def lagged(columns: dict[str, tuple[str, int]]) -> Features:
    """``{new: (column, n)}``: the value n rows earlier."""

    def build(group: Sequence[str], order: str) -> dict[str, Column]:
        w = Window.partitionBy(*group).orderBy(order)
        return {new: F.lag(c, n).over(w) for new, (c, n) in columns.items()}

    return build


def add_previous(
    df: DataFrame,
    columns: Sequence[str] = ("CPI", "Unemployment"),
    group: Sequence[str] = ("Store", "Dept"),
    order: str = "Date",
    chunk: str | None = None,
) -> DataFrame:
    """``Prev_<column>``: the value of the row before."""
    features = lagged({f"Prev_{c}": (c, 1) for c in columns})
    return add_series_features(df, group, order, features, 1, chunk)


def add_lags(
    df: DataFrame,
    group: Sequence[str],
    target: str,
    lags: Sequence[int],
    order: str = "Date",
    chunk: str | None = None,
) -> DataFrame:
    """``<target>_lag_<n>`` for each n."""
    features = lagged({f"{target}_lag_{n}": (target, n) for n in lags})
    return add_series_features(df, group, order, features, max(lags), chunk)


def add_mean_before(
    df: DataFrame,
    target: str = "Weekly_Sales",
    rows: int = 4,
    name: str = "Avg_Sales_Prev_4Wk",
    group: Sequence[str] = ("Store", "Dept"),
    order: str = "Date",
    chunk: str | None = None,
) -> DataFrame:
    """Mean of the ``rows`` rows before; the row itself is left out."""
    features = _mean_before(target, rows, name)
    return add_series_features(df, group, order, features, rows, chunk)


def _mean_before(target: str, rows: int, name: str) -> Features:
    def build(group: Sequence[str], order: str) -> dict[str, Column]:
        w = Window.partitionBy(*group).orderBy(order).rowsBetween(-rows, -1)
        return {name: exact_mean(target, window=w)}

    return build


def add_rolling(
    df: DataFrame,
    group: Sequence[str],
    target: str,
    windows: Sequence[int],
    order: str = "Date",
    stats: Sequence[str] = ("mean", "std"),
    chunk: str | None = None,
) -> DataFrame:
    """``<target>_rolling_mean_<n>`` and ``_rolling_std_<n>`` over n rows, the row included.

    One value is enough for a mean; the sample deviation needs two.
    """

    def build(group: Sequence[str], order: str) -> dict[str, Column]:
        out = {}
        for n in windows:
            w = Window.partitionBy(*group).orderBy(order).rowsBetween(1 - n, 0)
            if "mean" in stats:
                out[f"{target}_rolling_mean_{n}"] = exact_mean(target, window=w)
            if "std" in stats:
                out[f"{target}_rolling_std_{n}"] = F.stddev_samp(target).over(w)
        return out

    return add_series_features(df, group, order, build, max(windows) - 1, chunk)


def add_sales_features(
    df: DataFrame,
    group: Sequence[str] = ("Store", "Dept"),
    order: str = "Date",
    chunk: str | None = None,
) -> DataFrame:
    """Previous CPI and Unemployment and the four-row mean in one pass, then nulls to 0."""
    previous = lagged(
        {"Prev_CPI": ("CPI", 1), "Prev_Unemployment": ("Unemployment", 1)}
    )
    mean = _mean_before("Weekly_Sales", 4, "Avg_Sales_Prev_4Wk")

    def build(group: Sequence[str], order: str) -> dict[str, Column]:
        return previous(group, order) | mean(group, order)

    return fill_numeric(add_series_features(df, group, order, build, 4, chunk))
