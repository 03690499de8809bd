"""Views over the test tables that stand in for stores, features and weekly sales."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The calendar of the views.
HOLDOUT_START = "2001-01-01"
ECON_END = "2001-06-01"
PROMOTION_START = "1998-01-01"
HOLIDAY_WEEKS = (6, 36, 47, 52)


# The columns the views use. A declared schema saves reading file
# footers when a query is built.
SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_shipdate timestamp_ntz"
    ),
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}

# Fixed value: bytes of the file whose lines one task of the views groups.
TASK_BYTES = 2 << 20


@dataclass(frozen=True)
class Tables:
    stores: DataFrame
    features: DataFrame
    train: DataFrame
    test: DataFrame


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def _together(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dealt by store and week, which the views are grouped and joined by, for one shuffle.

    Hardly two lines of a group meet before it, so they are not added up there. The tasks are as
    many as the file is large, so that what one holds does not grow with the table.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/lineitem.parquet")
    size = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    return rows.repartition(max(1, -(-size // TASK_BYTES)), "Store", "Date")


def _holiday():
    return F.weekofyear("Date").isin(*HOLIDAY_WEEKS).alias("IsHoliday")


def base(
    spark: SparkSession, sf_dir: str, before: str | None = None, since: str | None = None
) -> DataFrame:
    """Order lines as store, department and week of shipping (its Monday).

    ``before`` and ``since`` must be Mondays: then they mean the same for the
    week and for the ship date, and the filter reaches the scan.
    """
    lines = read(spark, sf_dir, "lineitem")
    if before:
        lines = lines.where(F.col("l_shipdate") < F.lit(before).cast("timestamp_ntz"))
    if since:
        lines = lines.where(F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz"))
    return lines.select(*_line(), _week(F.col("l_shipdate").cast("date")))


def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the week of the order: a store has no row for weeks without one.

    Both sides are reduced to what the views need before the join shuffles them.
    """
    day = F.col("o_orderdate").cast("date")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", _week(day))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", *_line())
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.drop("l_orderkey", "o_orderkey")


def _week(day: Column) -> Column:
    return F.date_sub(day, F.weekday(day)).alias("Date")


def _line() -> list[Column]:
    return [
        F.col("l_suppkey").cast("int").alias("Store"),
        (F.col("l_partkey") % 5).cast("int").alias("Dept"),
        F.col("l_linenumber").alias("ln"),
        # Whole hundredths: adding them needs no decimals and no rounding.
        F.rint(F.col("l_quantity") * 100).cast("bigint").alias("qty"),
        F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.rint(F.col("l_discount") * 100).cast("bigint").alias("pct"),
        F.rint(F.col("l_tax") * 100).cast("bigint").alias("tax"),
    ]


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").select(
        key.cast("int").alias("Store"),
        F.when(key % 3 == 0, "A").when(key % 3 == 1, "B").otherwise("C").alias("Type"),
        (F.lit(30000) + (key.cast("long") * 7919) % 190000).cast("int").alias("Size"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    off = (F.col("cents") * F.col("pct")).alias("off")
    lines = ordered(spark, sf_dir).select("Store", "Date", "ln", "qty", "pct", "tax", off)
    rows = _together(lines, spark, sf_dir)
    n = F.count(F.lit(1))
    known = F.col("Date") < F.lit(ECON_END).cast("date")
    promotions = [
        (F.sum(F.when(F.col("ln") == i, F.col("off"))) / 10000.0).alias(f"MarkDown{i}")
        for i in range(1, 6)
    ]
    return (
        rows.groupBy("Store", "Date")
        .agg(
            (F.sum("qty") / 100.0 / n).alias("Temperature"),
            (F.sum("tax") / 100.0 / n).alias("Fuel_Price"),
            *promotions,
            (F.sum("pct") / 100.0 / n).alias("_cpi"),
            n.cast("double").alias("_unemployment"),
        )
        .select(
            "Store",
            "Date",
            "Temperature",
            "Fuel_Price",
            *[f"MarkDown{i}" for i in range(1, 6)],
            F.when(known, F.col("_cpi")).alias("CPI"),
            F.when(known, F.col("_unemployment")).alias("Unemployment"),
            _holiday(),
        )
    )


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = (F.col("cents") * (100 - F.col("pct"))).alias("paid")
    lines = base(spark, sf_dir, before=HOLDOUT_START).select("Store", "Dept", "Date", paid)
    rows = _together(lines, spark, sf_dir)
    revenue = F.sum("paid") / 10000.0
    return (
        rows.groupBy("Store", "Dept", "Date")
        .agg(revenue.alias("Weekly_Sales"))
        .select("Store", "Dept", "Date", "Weekly_Sales", _holiday())
    )


def test(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base(spark, sf_dir, since=HOLDOUT_START)
    return rows.select("Store", "Dept", "Date").distinct().select(
        "Store", "Dept", "Date", _holiday()
    )


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        stores(spark, sf_dir),
        features(spark, sf_dir),
        train(spark, sf_dir),
        test(spark, sf_dir),
    )
