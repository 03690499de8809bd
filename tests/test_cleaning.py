import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from salesflow import contracts
from salesflow.functions.dates import add_calendar, parse_date
from salesflow.functions.money import exact_mean, exact_sum
from salesflow.operators import cleaning as C
from salesflow.operators import encode as E


def test_dates_try_the_formats_in_order(rows):
    df = rows("d string", ("5/2/2010",), ("05/02/2010",), ("2010-02-05",), ("12/31/2010",), ("",), (None,))
    got = [r[0] for r in df.select(parse_date("d")).collect()]
    assert got == [date(2010, 2, 5)] * 3 + [date(2010, 12, 31), None, None]


def test_strict_dates_raise(rows):
    df = rows("d string", ("someday",))
    assert df.select(parse_date("d")).first()[0] is None
    with pytest.raises(Exception, match="not a date"):
        df.select(parse_date("d", strict=True)).collect()


def test_calendar(rows):
    df = rows("Date date", (date(2011, 1, 1),), (date(2012, 1, 1),), (date(2012, 12, 31),))
    got = [(r.Year, r.Month, r.Week, r.Season) for r in add_calendar(df, extended=True).collect()]
    assert got == [(2011, 1, 52, 0), (2012, 1, 52, 0), (2012, 12, 1, 0)]
    seasons = rows("Date date", *[(date(2012, m, 1),) for m in range(1, 13)])
    got = [r.Season for r in add_calendar(seasons, extended=True).collect()]
    assert got == [0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 0]


def test_promotion_flags_and_fill(rows):
    df = rows(
        "Date date, MarkDown1 double",
        (date(2011, 10, 31), 3.5),
        (date(2011, 11, 1), 3.5),
        (date(2011, 12, 1), None),
    )
    kept = C.clean_promotions(df, columns=["MarkDown1"]).collect()
    assert [(r.MarkDown1, r.hasMarkDown1) for r in kept] == [(3.5, 0), (3.5, 1), (0.0, 0)]
    zeroed = C.clean_promotions(df, columns=["MarkDown1"], zero_before_start=True).collect()
    assert [(r.MarkDown1, r.hasMarkDown1) for r in zeroed] == [(0.0, 0), (3.5, 1), (0.0, 0)]


def test_coerce(rows):
    df = rows(
        "Store string, Date string, Weekly_Sales string, IsHoliday string, Dept string",
        (" 1", "05/02/2010", "NaN", "TRUE", "2"),
        ("x", "", "1e3", "maybe", None),
    )
    got = [tuple(r) for r in C.coerce(df, contracts.TRAIN).collect()]
    assert got == [(1, 2, date(2010, 2, 5), None, True), (None, None, None, 1000.0, None)]


def test_coerce_defaults_and_absent_columns(rows):
    df = rows("Store int, Date date, IsHoliday boolean", (1, date(2010, 2, 5), False))
    row = C.coerce(df, contracts.FEATURES, {"MarkDown1": 0.0, "hasMarkDown1": 0}).first()
    assert row.MarkDown1 == 0.0 and row.hasMarkDown1 == 0 and row.CPI is None


def test_fill_align_resolve(rows):
    df = rows("a int, b double, s string, x boolean", (None, None, None, None))
    assert tuple(C.fill_numeric(df).first()) == (0, 0.0, None, None)
    assert C.align_columns(df, ["a", "new"]).columns == ["a", "b", "s", "x", "new"]
    assert C.keep_available(df, ["b", "none"]).columns == ["b"]
    clash = rows("IsHoliday_x boolean, IsHoliday_y boolean", (True, False))
    assert C.resolve_clash(clash).first().asDict() == {"IsHoliday": 1}
    right = rows("IsHoliday_y boolean", (True,))
    assert C.resolve_clash(right).first().asDict() == {"IsHoliday": 1}
    assert C.drop_columns(df, "a", "none").columns == ["b", "s", "x"]
    nan = rows("v double", (float("nan"),), (1.0,))
    assert [r.v for r in C.nan_to_null(nan).collect()] == [None, 1.0]


def test_encode(rows):
    known = rows("Type string", ("B",), ("A",), ("C",), ("C",))
    new = rows("Type string", ("A",), ("C",), ("D",), (None,))
    assert [r.Type_encoded for r in E.encode(new, fitted_on=known).collect()] == [0, 2, 0, 0]
    by_count = E.encode(known, "Type", "i", order="frequencyDesc")
    assert {r.Type: r.i for r in by_count.collect()} == {"C": 0, "A": 1, "B": 2}


def test_sums_do_not_depend_on_partitioning(spark):
    df = spark.range(20_000).select((F.rand(7) * 1e6).alias("v"), (F.col("id") % 3).alias("k"))
    df = df.select("k", F.round("v", 4).alias("v")).persist()
    totals = {
        n: [tuple(r) for r in df.repartition(n).groupBy("k").agg(exact_sum("v", 4), exact_mean("v", 4)).orderBy("k").collect()]
        for n in (1, 3, 7)
    }
    assert totals[1] == totals[3] == totals[7]
    df.unpersist()


def test_exact_sum_values(rows):
    df = rows("v double", (0.1,), (0.2,), (-5.05,), (None,))
    row = df.agg(exact_sum("v", 4).alias("s"), exact_mean("v", 4).alias("m")).first()
    assert row.s == -4.75 and row.m == -4.75 / 3
    empty = df.where("v > 100").agg(exact_sum("v").alias("s"), exact_mean("v").alias("m")).first()
    assert empty.s is None and empty.m is None
    big = rows("v double", *[(9e10,)] * 40)
    assert big.agg(exact_sum("v", 4)).first()[0] == 36e11


def test_sums_keep_digits_and_take_any_double(rows):
    small = rows("v double, Weekly_Sales double", (0.00001, 1.0), (0.00002, 2.0), (0.00004, None))
    row = small.agg(exact_mean("v").alias("m"), exact_sum("Weekly_Sales").alias("s")).first()
    assert row.m == pytest.approx(7e-5 / 3) and row.s == 3.0
    odd = rows("k int, Weekly_Sales double", (1, float("nan")), (1, 2.0), (2, 1e300), (3, 1e15), (3, 1.5))
    got = {r.k: r.s for r in odd.groupBy("k").agg(exact_sum("Weekly_Sales").alias("s")).collect()}
    assert math.isnan(got[1]) and got[2] == 1e300 and got[3] == 1e15 + 1.5
