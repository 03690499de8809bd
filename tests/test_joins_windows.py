from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from salesflow.operators import joins as J
from salesflow.operators import reports as A
from salesflow.operators import windows as W
from salesflow.operators.cleaning import clean_promotions

D0 = date(2012, 1, 2)


def week(n):
    return D0 + timedelta(weeks=n)


@pytest.fixture
def sales(rows):
    return rows(
        "Store int, Dept int, Date date, Weekly_Sales double, IsHoliday boolean",
        *[(1, 1, week(n), float(n + 1), n == 2) for n in range(5)],
        (2, 1, week(0), 10.0, False),
        (9, 1, week(0), 20.0, False),
    )


@pytest.fixture
def features(rows):
    df = rows(
        "Store int, Date date, Temperature double, Fuel_Price double, MarkDown1 double,"
        "MarkDown2 double, MarkDown3 double, MarkDown4 double, MarkDown5 double, CPI double,"
        "Unemployment double, IsHoliday boolean",
        *[(1, week(n), 1.0, 2.0, 7.0, None, None, None, None, 100.0 + n, 5.0, True) for n in range(4)],
        (2, week(0), 1.0, 2.0, None, None, None, None, None, 200.0, 6.0, True),
    )
    return clean_promotions(df)


@pytest.fixture
def stores(rows):
    return rows("Store int, Type string, Size int", (1, "A", 10), (2, "B", 20))


def test_left_join_keeps_every_sale(sales, features, stores):
    wide = J.merge_wide(sales, features, stores)
    assert wide.count() == sales.count()
    missed = wide.where("Store = 9").first()
    assert (missed.MarkDown1, missed.hasMarkDown1) == (0.0, 0)
    assert missed.CPI is None and missed.Type is None and missed.Size is None
    assert wide.where("Store = 1").first().MarkDown1 == 7.0


def test_holiday_comes_from_sales_or_both(sales, features):
    one = J.join_features(sales, features)
    assert one.columns.count("IsHoliday") == 1
    assert one.where("IsHoliday").count() == 1
    both = J.join_features(sales, features, clash="suffix")
    assert {"IsHoliday_x", "IsHoliday_y"} <= set(both.columns)
    with pytest.raises(ValueError):
        J.join_features(sales, features, clash="other")


def test_inner_join_drops_misses(sales, features, stores):
    joined = J.join_stores(J.join_features(sales, features, how="inner"), stores, how="inner")
    assert joined.count() == 5


def test_previous_values_and_mean_before(sales, features, stores):
    joined = J.join_stores(J.join_features(sales, features), stores)
    out = W.add_sales_features(joined).where("Store = 1").orderBy("Date").collect()
    assert [r.Avg_Sales_Prev_4Wk for r in out] == [0.0, 1.0, 1.5, 2.0, 2.5]
    assert [r.Prev_CPI for r in out] == [0.0, 100.0, 101.0, 102.0, 103.0]
    assert [r.CPI for r in out][-1] == 0.0


def test_rolling_needs_one_value_for_a_mean_and_two_for_a_deviation(sales):
    out = (
        W.add_rolling(sales, ["Store", "Dept"], "Weekly_Sales", [2])
        .where("Store = 1")
        .orderBy("Date")
        .collect()
    )
    assert [r.Weekly_Sales_rolling_mean_2 for r in out][:3] == [1.0, 1.5, 2.5]
    assert out[0].Weekly_Sales_rolling_std_2 is None
    assert out[1].Weekly_Sales_rolling_std_2 == pytest.approx(0.70710678)


@pytest.mark.parametrize("chunk", ["year", "month", "week", "day"])
def test_chunked_windows_equal_whole_ones(spark, chunk):
    """Random gaps: some periods hold fewer rows than the frames look back."""
    df = (
        spark.range(900)
        .where(F.rand(3) < 0.5)
        .select(
            (F.col("id") % 3).cast("int").alias("g"),
            F.date_add(F.lit(D0), F.col("id").cast("int")).alias("Date"),
            F.round(F.rand(5) * 100, 2).alias("v"),
        )
        .persist()
    )
    for add in (
        lambda c: W.add_lags(df, ["g"], "v", [1, 3, 6], chunk=c),
        lambda c: W.add_rolling(df, ["g"], "v", [3, 7], stats=["mean"], chunk=c),
        lambda c: W.add_mean_before(df, "v", 4, "m", ["g"], chunk=c),
    ):
        whole, cut = add(None), add(chunk)
        assert whole.exceptAll(cut.select(*whole.columns)).count() == 0
        assert whole.count() == cut.count()
    df.unpersist()


def test_reports(sales, features, stores):
    wide = J.merge_wide(sales, features, stores)
    report = A.type_holiday_report(wide).collect()
    assert [(r.Type, r.IsHoliday, r.record_count, r.Total_Sales) for r in report] == [
        (None, False, 1, 20.0),
        ("A", False, 4, 12.0),
        ("B", False, 1, 10.0),
        ("A", True, 1, 3.0),
    ]
    assert [r.avg_sales for r in A.average_by_holiday(wide).collect()][0] == 3.0
    assert A.top_rows(sales, 2).select("Weekly_Sales").collect() == [(20.0,), (10.0,)]
    assert A.drill_down(wide, where={"Store": 1}).count() == 5
    counted = {r.table_name: (r.row_count, r.column_count) for r in A.shapes({"s": sales}).collect()}
    assert counted == {"s": (7, 5)}
    again = A.run_sql(wide, "SELECT count(*) AS n FROM merged_sales WHERE Type = :t", t="A")
    assert again.first().n == 5


def test_best_row_breaks_ties_by_name(rows):
    df = rows("Model string, Test_R2 double", ("b", 0.5), ("a", 0.5), ("c", None))
    assert A.best_row(df).first().Model == "a"
