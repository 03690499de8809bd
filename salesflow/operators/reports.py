"""Group-by reports, trends, drill-down and ranked rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.functions.money import exact_mean, exact_sum

TOTAL, AVERAGE, ROWS = "Total_Sales", "Avg_Sales", "record_count"


def sales_report(df: DataFrame, by: Sequence[str], value: str = "Weekly_Sales") -> DataFrame:
    """Row count, total and mean of ``value`` per group, the greatest total first."""
    return (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias(ROWS),
            exact_sum(value).alias(TOTAL),
            exact_mean(value).alias(AVERAGE),
        )
        .orderBy(F.col(TOTAL).desc(), *by)
    )


def promotion_report(df: DataFrame, flag: str = "hasMarkDown1") -> DataFrame:
    return sales_report(df, [flag])


def type_holiday_report(df: DataFrame) -> DataFrame:
    return sales_report(df, ["Type", "IsHoliday"])


def run_sql(df: DataFrame, text: str, view: str = "merged_sales", **args: object) -> DataFrame:
    """Register ``df`` as ``view`` and run a query on it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(text, args=args or None)


def average_by(
    df: DataFrame,
    by: Sequence[str],
    value: str = "Weekly_Sales",
    name: str = "Avg_Weekly_Sales",
    order: Sequence[Column] = (),
) -> DataFrame:
    out = df.groupBy(*by).agg(exact_mean(value).alias(name))
    return out.orderBy(*order) if order else out


def average_by_type(df: DataFrame) -> DataFrame:
    return average_by(df, ["Type"], name="avg_sales", order=[F.desc("avg_sales"), F.col("Type")])


def average_by_holiday(df: DataFrame) -> DataFrame:
    return average_by(df, ["IsHoliday"], name="avg_sales", order=[F.desc("IsHoliday")])


def trend(df: DataFrame, by: Sequence[str] = ("Date",), value: str = "Weekly_Sales") -> DataFrame:
    """Total per period in time order."""
    return df.groupBy(*by).agg(exact_sum(value).alias(TOTAL)).orderBy(*by)


def drill_down(
    df: DataFrame,
    by: Sequence[str] = ("Store", "Type"),
    where: dict[str, object] | None = None,
    date: str = "Date",
    value: str = "Weekly_Sales",
) -> DataFrame:
    """Per-store series over dates; ``where`` narrows it to one store or department."""
    for column, wanted in (where or {}).items():
        df = df.where(F.col(column) == F.lit(wanted))
    keys = [*by, date]
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(ROWS), exact_sum(value).alias(TOTAL))
        .orderBy(*keys)
    )


def top_rows(
    df: DataFrame,
    k: int = 10,
    value: str = "Weekly_Sales",
    key: Sequence[str] = ("Store", "Dept", "Date"),
) -> DataFrame:
    """The k greatest values; the key decides between equal ones."""
    return df.orderBy(F.col(value).desc_nulls_last(), *key).limit(k)


def first_rows(
    df: DataFrame, n: int = 5, key: Sequence[str] = ("Store", "Dept", "Date")
) -> DataFrame:
    return df.orderBy(*key).limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """Row and column count per table."""
    widths = {name: len(df.columns) for name, df in tables.items()}
    width = F.create_map(*[F.lit(x) for pair in widths.items() for x in pair])
    return table_counts(tables).withColumn("column_count", width[F.col("table_name")])


def best_row(df: DataFrame, metric: str = "Test_R2", name: str = "Model") -> DataFrame:
    """The row with the greatest metric; by name between equal ones."""
    return df.orderBy(F.col(metric).desc_nulls_last(), name).limit(1)
