"""Layouts: what a pattern reads, plans without exchanges, odd rows."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from salesflow.operators import joins as J
from salesflow.operators import windows as W
from salesflow.session import scratch_path
from salesflow.sources import layout as L

COLUMNS = ["Type", "IsHoliday", "Store", "Dept", "Date"]


@pytest.fixture(scope="module")
def sales(spark):
    n = spark.range(40_000)
    return n.select(
        F.substring(F.lit("ABC"), (F.col("id") % 3 + 1).cast("int"), F.lit(1)).alias("Type"),
        (F.xxhash64("id") % 10 == 0).alias("IsHoliday"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(45)) + 1).cast("int").alias("Store"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(80)).cast("int").alias("Dept"),
        F.date_add(F.lit(dt.date(2010, 2, 5)), (7 * F.pmod(F.xxhash64("id", F.lit(3)), F.lit(143))).cast("int")).alias("Date"),
        (F.col("id") / 7).alias("Weekly_Sales"),
    )


def files_that_may_hold(path, column, low, high):
    """Files whose Parquet statistics leave room for a value in [low, high], of all."""
    found = total = 0
    for file in glob.glob(f"{path.removeprefix('file://')}/part-*"):
        meta = pq.ParquetFile(file).metadata
        total += 1
        at = meta.schema.to_arrow_schema().get_field_index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        found += any(s.min <= high and s.max >= low for s in stats)
    return found, total


PATTERNS = [
    ("Type", "B", "B"), ("IsHoliday", True, True), ("Store", 20, 20), ("Dept", 40, 40),
    ("Date", dt.date(2011, 1, 1), dt.date(2011, 2, 1)),
]


def test_every_pattern_skips_files(spark, sales):
    path = L.write_interleaved(sales, scratch_path(spark, "curve"), COLUMNS, files=64)
    sorted_path = scratch_path(spark, "sorted")
    sales.repartitionByRange(64, *COLUMNS).sortWithinPartitions(*COLUMNS).write.parquet(sorted_path)
    shares = {}
    for column, low, high in PATTERNS:
        found, total = files_that_may_hold(path, column, low, high)
        assert total >= 32
        shares[column] = found / total
    assert max(shares.values()) <= 0.65, shares
    # An ordinary sort leaves its last columns in every file.
    found, total = files_that_may_hold(sorted_path, "Date", *PATTERNS[-1][1:])
    assert found / total > 0.9 > shares["Date"]
    back = spark.read.parquet(path)
    assert back.columns == sales.columns
    assert back.exceptAll(sales).isEmpty() and sales.exceptAll(back).isEmpty()


def test_a_hot_place_spreads_over_files(spark):
    hot = spark.range(9_000).select(F.lit(1).alias("Store"), F.lit("A").alias("Type"), F.col("id").alias("n"))
    path = L.write_interleaved(hot, scratch_path(spark, "hot"), ["Store", "Type"], files=8)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path.removeprefix('file://')}/part-*")]
    assert len(sizes) >= 6 and max(sizes) < 3_000 and sum(sizes) == 9_000


def test_odd_rows_and_clashing_names(spark, rows):
    odd = rows(
        "_curve int, _tie string, Type string, d double, t timestamp, a array<int>",
        (1, "x", None, None, None, None), (None, None, "", float("nan"), dt.datetime(2020, 1, 1), [1]),
        (1, "x", None, None, None, None), (3, "y", "é" * 20, -1.0, None, []),
    )
    path = L.write_interleaved(odd, scratch_path(spark, "odd"), ["Type", "d", "t"])
    back = spark.read.parquet(path)
    assert back.columns == odd.columns and back.exceptAll(odd).isEmpty() and back.count() == 4
    none = L.write_interleaved(odd.limit(0), scratch_path(spark, "none"), ["Type", "d"])
    assert spark.read.schema(odd.schema).parquet(none).count() == 0
    with pytest.raises(TypeError):
        L.as_number(odd, "a")
    with pytest.raises(ValueError):
        L.curve(odd, ["d"] * 11, {"d": []}, 6)


def test_numbers_keep_the_order_of_texts(spark, rows):
    texts = ["", "A", "AB", "B", "a", "zebra", "é", "éa"]
    df = rows("s string", *[(t,) for t in texts])
    found = {r.s: r.n for r in df.select("s", L.as_number(df, "s").alias("n")).collect()}
    ordered = sorted(texts, key=lambda t: t.encode())
    assert [found[t] for t in ordered] == sorted(found.values())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_joins_and_windows_need_no_exchange(spark, sales):
    features = sales.groupBy("Store", "Date").agg(F.max("Weekly_Sales").alias("CPI"))
    weekly = sales.groupBy("Store", "Dept", "Date").agg(F.sum("Weekly_Sales").alias("Weekly_Sales"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df, by in [
            ("by_week_sales", weekly, ["Store", "Date"]),
            ("by_week_features", features, ["Store", "Date"]),
            ("by_dept_sales", weekly, ["Store", "Dept"]),
        ]:
            L.write_bucketed(df, name, scratch_path(spark, name), by, 4, [*by, *(["Date"] if "Date" not in by else [])])
        for how in ("inner", "left"):
            joined = J.join_features(spark.table("by_week_sales"), spark.table("by_week_features"), how=how)
            assert "Exchange" not in plan(joined)
            plain = J.join_features(weekly, features, how=how)
            key = ["Store", "Dept", "Date", "CPI"]
            assert joined.select(*key).exceptAll(plain.select(*key)).isEmpty() and joined.count() == plain.count()
        lags = W.add_lags(spark.table("by_dept_sales"), ["Store", "Dept"], "Weekly_Sales", [1, 2])
        means = W.add_mean_before(spark.table("by_dept_sales"))
        for window in (lags, means):
            assert "Exchange" not in plan(window)
        key = ["Store", "Dept", "Date", "Weekly_Sales_lag_1", "Weekly_Sales_lag_2"]
        plain = W.add_lags(weekly, ["Store", "Dept"], "Weekly_Sales", [1, 2])
        assert lags.count() == plain.count()
        assert lags.select("Store", "Dept", "Date").exceptAll(plain.select("Store", "Dept", "Date")).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("by_week_sales", "by_week_features", "by_dept_sales"):
            L.drop_table(spark, name)
