"""The same queries as SQL on the test tables, for comparison with another engine.

Written from the meaning of each query, not from the Spark code: sums are
decimals, quantiles and correlations are the other engine's own.
"""

from __future__ import annotations

_VIEWS = {
    "base": """
        SELECT CAST(l_suppkey AS INT) AS Store, CAST(l_partkey % 5 AS INT) AS Dept,
               CAST(date_trunc('week', l_shipdate) AS DATE) AS Date, l_linenumber AS ln,
               CAST(l_quantity AS DECIMAL(18,2)) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS p,
               CAST(l_discount AS DECIMAL(4,2)) AS d, CAST(l_tax AS DECIMAL(4,2)) AS t
        FROM lineitem""",
    "ordered": """
        SELECT CAST(l_suppkey AS INT) AS Store,
               CAST(date_trunc('week', o_orderdate) AS DATE) AS Date, l_linenumber AS ln,
               CAST(l_quantity AS DECIMAL(18,2)) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS p,
               CAST(l_discount AS DECIMAL(4,2)) AS d, CAST(l_tax AS DECIMAL(4,2)) AS t
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "stores": """
        SELECT CAST(s_suppkey AS INT) AS Store,
               CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS Type,
               CAST(30000 + (s_suppkey * 7919) % 190000 AS INT) AS Size
        FROM supplier""",
    "train": """
        SELECT Store, Dept, Date, CAST(sum(p * (1 - d)) AS DOUBLE) AS Weekly_Sales,
               weekofyear(Date) IN (6, 36, 47, 52) AS IsHoliday
        FROM base WHERE Date < DATE '2001-01-01' GROUP BY Store, Dept, Date""",
    "test": """
        SELECT DISTINCT Store, Dept, Date, weekofyear(Date) IN (6, 36, 47, 52) AS IsHoliday
        FROM base WHERE Date >= DATE '2001-01-01'""",
    "feats": """
        SELECT Store, Date, CAST(sum(q) AS DOUBLE) / count(*) AS Temperature,
               CAST(sum(t) AS DOUBLE) / count(*) AS Fuel_Price,
               CAST(sum(CASE WHEN ln = 1 THEN p * d END) AS DOUBLE) AS MarkDown1,
               CAST(sum(CASE WHEN ln = 2 THEN p * d END) AS DOUBLE) AS MarkDown2,
               CAST(sum(CASE WHEN ln = 3 THEN p * d END) AS DOUBLE) AS MarkDown3,
               CAST(sum(CASE WHEN ln = 4 THEN p * d END) AS DOUBLE) AS MarkDown4,
               CAST(sum(CASE WHEN ln = 5 THEN p * d END) AS DOUBLE) AS MarkDown5,
               CASE WHEN Date < DATE '2001-06-01' THEN CAST(sum(d) AS DOUBLE) / count(*) END AS CPI,
               CASE WHEN Date < DATE '2001-06-01' THEN CAST(count(*) AS DOUBLE) END AS Unemployment,
               weekofyear(Date) IN (6, 36, 47, 52) AS IsHoliday
        FROM ordered GROUP BY Store, Date""",
}

_PROMOTIONS = [f"MarkDown{i}" for i in range(1, 6)]
_FLAGS = [f"hasMarkDown{i}" for i in range(1, 6)]
_TRACKED = "Date >= DATE '1998-01-01'"


def _flag_columns() -> str:
    return ", ".join(
        f"CASE WHEN {c} IS NOT NULL AND {_TRACKED} THEN 1 ELSE 0 END AS has{c}"
        for c in _PROMOTIONS
    )


def _filled() -> str:
    return ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in _PROMOTIONS)


_CALENDAR = (
    "CAST(year(Date) AS INT) AS Year, CAST(month(Date) AS INT) AS Month, "
    "CAST(weekofyear(Date) AS INT) AS Week"
)
_EXTENDED = (
    "CAST(day(Date) AS INT) AS Day, CAST(dayofyear(Date) AS INT) AS DayOfYear, "
    "CAST(quarter(Date) AS INT) AS Quarter"
)
_SEASON = (
    "CAST(CASE WHEN month({0}) IN (12, 1, 2) THEN 0 WHEN month({0}) <= 5 THEN 1 "
    "WHEN month({0}) <= 8 THEN 2 ELSE 3 END AS INT)"
)

_VIEWS["cleaned"] = f"SELECT * REPLACE ({_filled()}), {_flag_columns()} FROM feats"
_VIEWS["joined"] = """
    SELECT * FROM train JOIN (SELECT * EXCLUDE (IsHoliday) FROM cleaned) USING (Store, Date)
    JOIN stores USING (Store)"""
_VIEWS["wide"] = f"""
    SELECT train.Store, Dept, train.Date, Weekly_Sales, train.IsHoliday, Temperature, Fuel_Price,
           {", ".join(f"coalesce({c}, 0.0) AS {c}" for c in _PROMOTIONS)},
           {", ".join(f"coalesce({c}, 0) AS {c}" for c in _FLAGS)},
           CPI, Unemployment, Type, Size, {_CALENDAR.replace("(Date)", "(train.Date)")}
    FROM train LEFT JOIN cleaned f ON train.Store = f.Store AND train.Date = f.Date
    LEFT JOIN stores s ON train.Store = s.Store"""
_VIEWS["numbers"] = f"""
    SELECT * EXCLUDE (Date, Type, IsHoliday), {_EXTENDED}, {_SEASON.format("Date")} AS Season,
           CASE Type WHEN 'A' THEN 0 WHEN 'B' THEN 1 ELSE 2 END AS Type_encoded,
           CAST(IsHoliday AS INT) AS IsHoliday
    FROM wide"""

# The numeric columns of the wide table, in order.
NUMBERS = [
    "Store",
    "Dept",
    "Weekly_Sales",
    "Temperature",
    "Fuel_Price",
    *_PROMOTIONS,
    *_FLAGS,
    "CPI",
    "Unemployment",
    "Size",
    "Year",
    "Month",
    "Week",
]
# The same after the calendar and the codes were added.
MODEL_NUMBERS = [
    "Store",
    "Dept",
    "Weekly_Sales",
    "IsHoliday",
    "Temperature",
    "Fuel_Price",
    *_PROMOTIONS,
    *_FLAGS,
    "CPI",
    "Unemployment",
    "Size",
    "Year",
    "Month",
    "Week",
    "Day",
    "DayOfYear",
    "Quarter",
    "Season",
    "Type_encoded",
]
TARGET = "Weekly_Sales"


def _needs(text: str, view: str) -> bool:
    import re

    return re.search(rf"\b{view}\b", text) is not None


def sql(body: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """The query with the views it uses in front of it."""
    views = _VIEWS | (extra or {})
    used, todo = set(), [body]
    while todo:
        text = todo.pop()
        for name in views:
            if name not in used and _needs(text, name) and text is not views[name]:
                used.add(name)
                todo.append(views[name])
    ctes = ", ".join(f"{name} AS ({text})" for name, text in views.items() if name in used)
    word = "WITH RECURSIVE" if recursive else "WITH"
    return f"{word} {ctes} {body}" if ctes else body


def _exact_sum(value: str = TARGET) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(18,4))) AS DOUBLE)"


def _exact_mean(value: str = TARGET, over: str = "") -> str:
    total = f"CAST(sum(CAST({value} AS DECIMAL(18,4))) {over} AS DOUBLE)"
    return f"{total} / nullif(count({value}) {over}, 0)"


def _plain_sum(value: str = TARGET) -> str:
    return f"round(sum({value}), 4)"


def _plain_mean(value: str = TARGET) -> str:
    """Sales have four decimals, so rounding a plain sum of them to four gives the exact sum."""
    return f"{_plain_sum(value)} / nullif(count({value}), 0)"


def _report(by: str, source: str) -> str:
    return f"""SELECT {by}, count(*) AS record_count, {_plain_sum()} AS Total_Sales,
        {_plain_mean()} AS Avg_Sales FROM {source} GROUP BY ALL"""


def _rounded_report(by: str) -> str:
    return f"""SELECT {by}, count(*) AS record_count, {_plain_sum()} AS Total_Sales,
        round(avg({TARGET}), 4) AS Avg_Sales FROM joined GROUP BY ALL"""


ORACLE: dict[str, str] = {}

# Sources and sinks
ORACLE["scan_csv"] = sql("SELECT * FROM train")
ORACLE["scan_csv_inferred"] = sql("SELECT * FROM feats")
ORACLE["typed_projection"] = sql("SELECT * FROM train")
ORACLE["coerce_records"] = sql(
    "SELECT * REPLACE (CASE WHEN NOT IsHoliday THEN Temperature END AS Temperature) FROM feats"
)
ORACLE["scan_parquet"] = """
    SELECT n_name, sum(l_quantity) AS quantity, count(*) AS line_count
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY n_name"""
ORACLE["sink_parquet_roundtrip"] = sql("SELECT * FROM wide")
_PATTERNS = {
    "Type": "Type = 'B'",
    "IsHoliday": "IsHoliday",
    "Store": "Store = 3",
    "Dept": "Dept = 2",
    "Date": "Date BETWEEN DATE '1997-01-01' AND DATE '1997-03-31'",
    "Store, Dept, Date": "Store = 3 AND Dept = 2 AND Date < DATE '1996-01-01'",
}
ORACLE["layout_interleaved"] = sql(" UNION ALL ".join(
    f"SELECT '{name}' AS pattern, count(*) AS row_count, round(sum(Weekly_Sales), 2) AS sales FROM wide WHERE {kept}"
    for name, kept in _PATTERNS.items()
))
ORACLE["layout_bucketed"] = sql(
    "SELECT * FROM train JOIN (SELECT * EXCLUDE (IsHoliday) FROM cleaned) USING (Store, Date)"
)
ORACLE["sink_csv_roundtrip"] = sql("SELECT * FROM wide")
ORACLE["scan_documents"] = sql("SELECT * FROM cleaned")
ORACLE["scan_document_dump"] = ORACLE["scan_documents"]
ORACLE["land_zone"] = sql("SELECT * FROM feats")
ORACLE["clean_features_job"] = sql("SELECT * FROM cleaned")
ORACLE["clean_sales_job"] = sql("SELECT * FROM train")

# Projections, filters, cleaning
ORACLE["parse_dates"] = """
    WITH raw AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4
        WHEN 0 THEN strftime(l_shipdate, '%d/%m/%Y') WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d')
        WHEN 2 THEN strftime(l_shipdate, '%m/%d/%Y') ELSE 'unknown' END AS raw_date FROM lineitem)
    SELECT *, CAST(coalesce(try_strptime(raw_date, '%d/%m/%Y'), try_strptime(raw_date, '%Y-%m-%d'),
        try_strptime(raw_date, '%m/%d/%Y')) AS DATE) AS parsed FROM raw"""
ORACLE["markdown_flags"] = sql(f"SELECT *, {_flag_columns()} FROM feats")
ORACLE["markdown_fill"] = sql(f"SELECT * REPLACE ({_filled()}) FROM feats")
ORACLE["markdown_zeroed"] = sql(
    "SELECT * REPLACE ("
    + ", ".join(
        f"CASE WHEN {_TRACKED} THEN coalesce({c}, 0.0) ELSE 0.0 END AS {c}" for c in _PROMOTIONS
    )
    + f"), {_flag_columns()} FROM feats"
)
_MEASURES = ["Temperature", "Fuel_Price", *_PROMOTIONS, "CPI", "Unemployment"]
ORACLE["fill_numeric"] = sql(
    f"""SELECT train.*, {", ".join(f"coalesce(f.{c}, 0.0) AS {c}" for c in _MEASURES)}
    FROM train LEFT JOIN feats f ON train.Store = f.Store AND train.Date = f.Date"""
)
ORACLE["align_columns"] = sql(
    "SELECT *, CAST(0 AS INT) AS Weekly_Sales, CAST(0 AS INT) AS Type_encoded FROM test"
)
ORACLE["resolve_holiday"] = sql("SELECT * REPLACE (CAST(IsHoliday AS INT) AS IsHoliday) FROM train")
ORACLE["cast_features"] = sql(
    """SELECT Store, Dept, Date, CAST(IsHoliday AS INT) AS IsHoliday, CAST(Size AS DOUBLE) AS Size,
    CAST(hasMarkDown1 AS DOUBLE) AS hasMarkDown1 FROM wide"""
)
ORACLE["drop_null_target"] = sql("SELECT * FROM train")
ORACLE["encode_alpha"] = sql(
    """SELECT Store, Dept, Date, CASE WHEN IsHoliday THEN 'D' ELSE Type END AS Type,
    CASE WHEN IsHoliday OR Type = 'A' THEN 0 WHEN Type = 'B' THEN 1 ELSE 2 END AS Type_encoded
    FROM train JOIN stores USING (Store)"""
)
_BY_FREQUENCY = """SELECT Type, CAST(row_number() OVER (ORDER BY count(*) DESC, Type) - 1 AS INT)
    AS Type_Index FROM {0} GROUP BY Type"""
ORACLE["encode_freq"] = sql(
    "SELECT Store, Dept, Date, Type, Type_Index FROM typed JOIN codes USING (Type)",
    {
        "typed": "SELECT * FROM train JOIN stores USING (Store)",
        "codes": _BY_FREQUENCY.format("typed"),
    },
)

# Dates
ORACLE["temporal_basic"] = sql(f"SELECT *, {_CALENDAR} FROM train")
ORACLE["temporal_extended"] = sql(f"SELECT *, {_CALENDAR}, {_EXTENDED} FROM train")
ORACLE["season"] = f"""SELECT CAST(l_shipdate AS DATE) AS ship_date, count(*) AS line_count,
    {_SEASON.format("CAST(l_shipdate AS DATE)")} AS Season FROM lineitem GROUP BY ALL"""

# Joins
ORACLE["join_inner_features"] = sql(
    "SELECT * FROM train JOIN (SELECT * EXCLUDE (IsHoliday) FROM cleaned) USING (Store, Date)"
)
ORACLE["join_inner_stores"] = sql("SELECT * FROM joined")
_SUFFIXED = """SELECT {0}.* EXCLUDE (IsHoliday), {0}.IsHoliday AS IsHoliday_x,
    f.* EXCLUDE (Store, Date, IsHoliday), f.IsHoliday AS IsHoliday_y {1}
    FROM {0} LEFT JOIN cleaned f ON {0}.Store = f.Store AND {0}.Date = f.Date"""
ORACLE["join_left_features"] = sql(_SUFFIXED.format("train", ""))
ORACLE["join_left_stores"] = sql("SELECT * FROM train LEFT JOIN stores USING (Store)")
ORACLE["merge_wide"] = sql("SELECT * FROM wide")
ORACLE["prepare_scoring"] = sql(
    _SUFFIXED.format("test", ", s.Type, s.Size") + " LEFT JOIN stores s ON test.Store = s.Store"
)

# Reports
ORACLE["report_markdown"] = sql(_report("hasMarkDown1", "joined"))
ORACLE["report_markdown_sql"] = sql(_rounded_report("hasMarkDown1"))
ORACLE["report_store_dept"] = sql(
    f"SELECT Store, Dept, {_plain_mean()} AS Avg_Weekly_Sales FROM joined GROUP BY ALL"
)
ORACLE["report_type_holiday"] = sql(_report("Type, IsHoliday", "joined"))
ORACLE["report_type_holiday_sql"] = sql(_rounded_report("Type, IsHoliday"))
ORACLE["report_run_job"] = ORACLE["report_type_holiday"]
ORACLE["report_run_merged"] = sql("SELECT * FROM joined")
ORACLE["trend_weekly"] = sql(f"SELECT Date, {_plain_sum()} AS Total_Sales FROM wide GROUP BY ALL")
ORACLE["trend_monthly"] = sql(
    f"SELECT Year, Month, {_plain_sum()} AS Total_Sales FROM wide GROUP BY ALL"
)
ORACLE["report_type"] = sql(f"SELECT Type, {_plain_mean()} AS avg_sales FROM wide GROUP BY ALL")
ORACLE["report_holiday"] = sql(
    f"SELECT IsHoliday, {_plain_mean()} AS avg_sales FROM wide GROUP BY ALL"
)
_COUNTED = {
    "stores": ("stores", 3),
    "features": ("cleaned", 17),
    "train_sales": ("train", 5),
    "test_sales": ("test", 4),
    "merged_data": ("wide", 24),
}
ORACLE["table_counts"] = sql(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {view}"
        for name, (view, _) in _COUNTED.items()
    )
)
ORACLE["table_shapes"] = sql(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS row_count,
        CAST({width} AS INT) AS column_count FROM {view}"""
        for name, (view, width) in _COUNTED.items()
    )
)
ORACLE["drill_store"] = sql(
    f"""SELECT Store, Type, Date, count(*) AS record_count, {_plain_sum()} AS Total_Sales
    FROM wide GROUP BY ALL"""
)
ORACLE["drill_one_store"] = sql(
    f"""SELECT Store, Type, Date, count(*) AS record_count, {_plain_sum()} AS Total_Sales
    FROM wide WHERE Store = 3 GROUP BY ALL"""
)
ORACLE["drill_store_dept"] = sql(
    f"""SELECT Store, Dept, Date, count(*) AS record_count, {_plain_sum()} AS Total_Sales
    FROM wide WHERE Store = 3 AND Dept = 1 GROUP BY ALL"""
)
ORACLE["drill_dept"] = sql(
    f"""SELECT Dept, Date, count(*) AS record_count, {_plain_sum()} AS Total_Sales
    FROM wide GROUP BY ALL"""
)
ORACLE["top_sales"] = sql(
    "SELECT * FROM train ORDER BY Weekly_Sales DESC, Store, Dept, Date LIMIT 10"
)
ORACLE["sample_rows"] = sql("SELECT * FROM wide ORDER BY Store, Dept, Date LIMIT 5")

# Windows
_W = "(PARTITION BY Store, Dept ORDER BY Date {0})"
_PREV4 = _W.format("ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING")


def _lags() -> str:
    w = _W.format("")
    return ", ".join(
        f"lag({TARGET}, {n}) OVER {w} AS {TARGET}_lag_{n}" for n in (1, 2, 4)
    )


def _rolling(kind: str) -> str:
    out = []
    for n in (4, 8):
        w = "OVER " + _W.format(f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")
        value = _exact_mean(over=w) if kind == "mean" else f"round(stddev_samp({TARGET}) {w}, 4)"
        out.append(f"{value} AS {TARGET}_rolling_{kind}_{n}")
    return ", ".join(out)


ORACLE["lag_econ"] = sql(
    f"""SELECT Store, Dept, Date, lag(CPI) OVER {_W.format("")} AS Prev_CPI,
    lag(Unemployment) OVER {_W.format("")} AS Prev_Unemployment FROM wide"""
)
ORACLE["lag_multi"] = sql(f"SELECT *, {_lags()} FROM train")
ORACLE["roll_prev4"] = sql(
    f"SELECT *, {_exact_mean(over='OVER ' + _PREV4)} AS Avg_Sales_Prev_4Wk FROM train"
)
ORACLE["roll_mean"] = sql(f"SELECT *, {_rolling('mean')} FROM train")
ORACLE["roll_std"] = sql(f"SELECT *, {_rolling('std')} FROM train")
_VIEWS["engineered"] = f"""
    SELECT * REPLACE ({", ".join(f"coalesce({c}, 0.0) AS {c}" for c in _MEASURES)}),
           coalesce(lag(CPI) OVER {_W.format("")}, 0.0) AS Prev_CPI,
           coalesce(lag(Unemployment) OVER {_W.format("")}, 0.0) AS Prev_Unemployment,
           coalesce({_exact_mean(over="OVER " + _PREV4)}, 0.0) AS Avg_Sales_Prev_4Wk
    FROM joined"""
ORACLE["features_engineered"] = sql("SELECT * FROM engineered")
ORACLE["features_engineered_chunked"] = ORACLE["features_engineered"]
ORACLE["lag_multi_chunked"] = ORACLE["lag_multi"]
ORACLE["roll_std_chunked"] = ORACLE["roll_std"]

# Statistics
_BOUNDS = {
    "quartiles": f"""SELECT quantile_cont({TARGET}, 0.25) AS q1,
        quantile_cont({TARGET}, 0.75) AS q3 FROM wide""",
    "bounds": """SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound,
        q3 + 1.5 * (q3 - q1) AS upper_bound FROM quartiles""",
}
ORACLE["iqr_bounds"] = sql(
    f"""SELECT round(q1, 7) AS q1, round(q3, 7) AS q3, round(iqr, 7) AS iqr,
    round(lower_bound, 7) AS lower_bound, round(upper_bound, 7) AS upper_bound,
    (SELECT count(*) FROM wide, bounds WHERE {TARGET} < lower_bound OR {TARGET} > upper_bound)
    AS outlier_count FROM bounds""",
    _BOUNDS,
)
ORACLE["iqr_outliers"] = sql(
    f"""SELECT Store, Dept, Date, {TARGET} FROM wide, bounds
    WHERE {TARGET} < lower_bound OR {TARGET} > upper_bound""",
    _BOUNDS,
)


def _described(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS "count",
        round(avg({column}), 4) AS mean, round(stddev_samp({column}), 4) AS std,
        round(CAST(min({column}) AS DOUBLE), 7) AS min,
        round(quantile_cont(CAST({column} AS DOUBLE), 0.25), 7) AS p25,
        round(quantile_cont(CAST({column} AS DOUBLE), 0.5), 7) AS p50,
        round(quantile_cont(CAST({column} AS DOUBLE), 0.75), 7) AS p75,
        round(CAST(max({column}) AS DOUBLE), 7) AS max FROM wide"""


ORACLE["describe_table"] = sql(" UNION ALL ".join(_described(c) for c in NUMBERS))
_SPAN = {
    "span": f"""SELECT min({TARGET}) AS lo, max({TARGET}) AS hi, count(*) AS n,
        stddev_samp({TARGET}) * pow(count(*), -0.2) AS h FROM wide"""
}
ORACLE["histogram_sales"] = sql(
    f"""SELECT b.bin, round(lo + (b.bin - 1) * ((hi - lo) / 50), 7) AS bin_start,
        round(lo + b.bin * ((hi - lo) / 50), 7) AS bin_end, coalesce(c, 0) AS row_count
    FROM (SELECT CAST(range AS INT) AS bin FROM range(1, 51)) b CROSS JOIN span LEFT JOIN (
        SELECT CAST(least(floor(({TARGET} - lo) / ((hi - lo) / 50)) + 1, 50) AS INT) AS bin,
               count(*) AS c FROM wide, span GROUP BY ALL) k ON b.bin = k.bin""",
    _SPAN,
)
ORACLE["density_sales"] = sql(
    f"""SELECT point, round(lo + point * (hi - lo) / 199, 4) AS x,
        round(sum(exp(-pow((lo + point * (hi - lo) / 199 - {TARGET}) / h, 2) / 2))
              / (any_value(n) * any_value(h) * sqrt(2 * pi()))
              * any_value(n) * any_value(hi - lo) / 50, 4) AS density
    FROM wide, span, (SELECT CAST(range AS INT) AS point FROM range(200)) GROUP BY point, lo, hi""",
    _SPAN,
)


def _boxes(by: str) -> str:
    return sql(
        f"""SELECT {by}, count(*) AS row_count, round(any_value(q1), 7) AS q1,
            round(any_value(median), 7) AS median, round(any_value(q3), 7) AS q3,
            round(min({TARGET}) FILTER (WHERE inside), 7) AS whisker_low,
            round(max({TARGET}) FILTER (WHERE inside), 7) AS whisker_high,
            count(*) FILTER (WHERE NOT inside) AS outlier_count
        FROM (SELECT wide.{by}, {TARGET}, q1, median, q3,
                {TARGET} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
              FROM wide JOIN groups ON wide.{by} = groups.{by}) GROUP BY {by}""",
        {
            "groups": f"""SELECT {by}, quantile_cont({TARGET}, 0.25) AS q1,
            quantile_cont({TARGET}, 0.5) AS median, quantile_cont({TARGET}, 0.75) AS q3
            FROM wide GROUP BY {by}"""
        },
    )


ORACLE["quantiles_narrowed"] = sql(
    f"""SELECT Type, round(quantile_cont({TARGET}, 0.25), 7) AS q1, round(quantile_cont({TARGET}, 0.5), 7) AS median,
    round(quantile_cont({TARGET}, 0.75), 7) AS q3 FROM wide GROUP BY Type"""
)
ORACLE["box_by_type"] = _boxes("Type")
ORACLE["box_by_month"] = _boxes("Month")
ORACLE["box_by_holiday"] = _boxes("IsHoliday")
_POINTS = f"SELECT Store, Dept, Date, Temperature, {TARGET} FROM wide WHERE Temperature IS NOT NULL"
_HASH = "substr(md5(concat_ws('|', Store, Dept, Date{0})), 1, 8)"
ORACLE["scatter_points"] = sql(_POINTS)
ORACLE["scatter_sample"] = sql(f"{_POINTS} AND {_HASH.format('')} < '19999999'")


def _corr(a: str, b: str) -> str:
    x = f"CASE WHEN {b} IS NOT NULL THEN {a} END"
    y = f"CASE WHEN {a} IS NOT NULL THEN {b} END"
    return f"""round(covar_pop({a}, {b}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0), 8)"""


def _pairs(pairs: list[tuple[str, str]]) -> str:
    """One row per pair from one pass: a struct per pair, then unnested."""
    cells = ", ".join(f"{{'f1': '{a}', 'f2': '{b}', 'corr': {_corr(a, b)}}}" for a, b in pairs)
    return f"SELECT unnest([{cells}], recursive := true) FROM numbers"


_FEATURES = [c for c in MODEL_NUMBERS if c != TARGET]
_CORRELATIONS = {
    "target_corr": f"SELECT f1 AS feature, corr FROM ({_pairs([(c, TARGET) for c in _FEATURES])})",
    "all_corr": _pairs(
        [(a, b) for i, a in enumerate(MODEL_NUMBERS) for b in MODEL_NUMBERS[:i]]
    ),
    "ranked": """SELECT feature, corr,
        CAST(row_number() OVER (ORDER BY abs(corr) DESC NULLS LAST, feature) AS INT) AS place
        FROM target_corr""",
    "strong": """SELECT *, row_number() OVER (ORDER BY place) AS step FROM ranked
        WHERE abs(corr) >= 0.01""",
    "twins": """SELECT f1 AS a, f2 AS b FROM all_corr WHERE abs(corr) > 0.95
        UNION ALL SELECT f2, f1 FROM all_corr WHERE abs(corr) > 0.95""",
    "twin_lists": "SELECT a, list(b) AS others FROM twins GROUP BY a",
    "walk": """SELECT CAST(0 AS BIGINT) AS step, CAST([] AS VARCHAR[]) AS kept,
            CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS VARCHAR) AS twin
        UNION ALL
        SELECT s.step,
            CASE WHEN len(list_filter(w.kept, lambda k: list_contains(coalesce(t.others, []), k)))
                 = 0 THEN list_append(w.kept, s.feature) ELSE w.kept END,
            s.feature,
            list_filter(w.kept, lambda k: list_contains(coalesce(t.others, []), k))[1]
        FROM walk w JOIN strong s ON s.step = w.step + 1 LEFT JOIN twin_lists t ON t.a = s.feature""",
}
ORACLE["corr_target"] = sql("SELECT * FROM target_corr", _CORRELATIONS)
ORACLE["corr_matrix"] = sql("SELECT * FROM all_corr", _CORRELATIONS)
ORACLE["select_target"] = sql("SELECT feature, corr FROM strong", _CORRELATIONS)
ORACLE["select_redundant"] = sql(
    """SELECT place, r.feature, corr FROM ranked r JOIN walk w ON r.feature = w.feature
    WHERE w.twin IS NULL""",
    _CORRELATIONS,
    recursive=True,
)
ORACLE["selection_report"] = sql(
    """SELECT place, r.feature, corr, CASE WHEN w.feature IS NULL THEN 'low'
        WHEN w.twin IS NULL THEN 'kept' ELSE 'redundant' END AS status, w.twin AS redundant_with
    FROM ranked r LEFT JOIN walk w ON r.feature = w.feature""",
    _CORRELATIONS,
    recursive=True,
)

# Models and evaluation
_CODES = {"codes": _BY_FREQUENCY.format("engineered")}
_VECTOR = {
    "Type_Index": "Type_Index",
    "IsHoliday_Int": "CAST(IsHoliday AS INT)",
}
_INPUTS = [
    "Store",
    "Dept",
    "Size",
    "Type_Index",
    "IsHoliday_Int",
    "Temperature",
    "Fuel_Price",
    "CPI",
    "Unemployment",
    "Prev_CPI",
    "Prev_Unemployment",
    "Avg_Sales_Prev_4Wk",
    *_FLAGS,
]
ORACLE["assemble"] = sql(
    f"""SELECT Store, Dept, Date, {TARGET},
    {", ".join(f"CAST({_VECTOR.get(c, c)} AS DOUBLE) AS f_{c}" for c in _INPUTS)}
    FROM engineered JOIN codes USING (Type)""",
    _CODES,
)
_HOLDOUT = _HASH.format(", 42") + " < '33333333'"
ORACLE["split_rows"] = sql(f"SELECT *, {_HOLDOUT} AS is_test FROM train")
_X = "coalesce(Temperature, 0)"
ORACLE["model_linear"] = sql(
    f"""SELECT 'Temperature' AS term, round(regr_slope({TARGET}, {_X}), 3) AS value FROM wide
    UNION ALL SELECT '(intercept)', round(regr_intercept({TARGET}, {_X}), 3) FROM wide"""
)
ORACLE["model_ridge"] = sql(
    """SELECT 'Temperature' AS term, round(w, 3) AS value FROM slope
    UNION ALL SELECT '(intercept)', round(my - w * mx, 3) FROM slope""",
    {
        "slope": f"""SELECT regr_sxy({TARGET}, {_X}) / (regr_sxx({TARGET}, {_X}) + 1.0) AS w,
        avg({_X}) AS mx, avg({TARGET}) AS my FROM wide"""
    },
)


def _mean_predicted(by: str) -> dict[str, str]:
    """Hold-out and training rows with the training mean of their group as prediction."""
    on = f"LEFT JOIN (SELECT {by}, {_exact_mean()} AS m FROM fitted GROUP BY ALL) g USING ({by})"
    return {
        "marked": f"SELECT *, {_HOLDOUT} AS is_test FROM train",
        "fitted": "SELECT * FROM marked WHERE NOT is_test",
        "scored": f"""SELECT marked.*, coalesce({"m" if by else "NULL"},
            (SELECT {_exact_mean()} FROM fitted)) AS prediction
            FROM marked {on if by else ""}""",
    }


def _quality(prefix: str = "") -> str:
    error = f"({TARGET} - prediction)"
    return f"""round(avg(abs{error}), 6) AS {prefix}MAE,
        round(sqrt(avg({error} * {error})), 6) AS {prefix}RMSE,
        round(1 - avg({error} * {error}) / var_pop({TARGET}), 6) AS {prefix}R2"""


ORACLE["metrics_regression"] = sql(
    f"""SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS part, {_quality()}
    FROM scored GROUP BY is_test""",
    _mean_predicted("Store, Dept"),
)
_CLASSES = _mean_predicted("Store, Dept") | {
    "edges": f"""SELECT quantile_cont({TARGET}, 0.25) AS lo, quantile_cont({TARGET}, 0.75) AS hi
        FROM scored WHERE is_test""",
    "classed": f"""SELECT merge_low,
            CASE WHEN {TARGET} >= hi THEN 2 WHEN {TARGET} >= lo AND NOT merge_low THEN 1 ELSE 0 END
                AS actual,
            CASE WHEN prediction >= hi THEN 2 WHEN prediction >= lo AND NOT merge_low THEN 1 ELSE 0
                END AS guess
        FROM scored, edges, (VALUES (true), (false)) v(merge_low) WHERE is_test""",
    "per_class": """SELECT merge_low, c, count(*) FILTER (WHERE actual = c) AS real,
            count(*) FILTER (WHERE guess = c) AS said,
            count(*) FILTER (WHERE actual = c AND guess = c) AS hit
        FROM classed, (VALUES (0), (1), (2)) k(c) GROUP BY ALL""",
}
ORACLE["metrics_classes"] = sql(
    """SELECT merge_low, round(sum(hit) / sum(real), 8) AS Accuracy,
        round(sum(coalesce(hit / nullif(said, 0), 0) * real) / sum(real), 8) AS "Precision",
        round(sum(coalesce(hit / nullif(real, 0), 0) * real) / sum(real), 8) AS Recall,
        round(sum(coalesce(2 * hit / nullif(said + real, 0), 0) * real) / sum(real), 8) AS F1
    FROM per_class GROUP BY merge_low""",
    _CLASSES,
)


def _one_predictor(name: str, by: str) -> str:
    views = _mean_predicted(by)
    ctes = ", ".join(f"{k} AS ({v})" for k, v in views.items())
    return f"""(WITH {ctes} SELECT '{name}' AS Model, {_quality("Test_")} FROM scored WHERE is_test)"""


ORACLE["best_model"] = sql(
    f"""SELECT * FROM ({_one_predictor("all", "")} UNION ALL {_one_predictor("store", "Store")}
    UNION ALL {_one_predictor("dept", "Dept")}
    UNION ALL {_one_predictor("store_dept", "Store, Dept")})
    ORDER BY Test_R2 DESC, Model LIMIT 1"""
)

# Contracts and upserts
_SPOILED = """SELECT * FROM (
    SELECT CASE Dept WHEN 0 THEN 'required:Store' WHEN 2 THEN 'required:Weekly_Sales' END AS
        missing, CASE Dept WHEN 1 THEN 'type:Weekly_Sales' WHEN 3 THEN 'type:Date' END AS mistyped
    FROM train WHERE IsHoliday)"""
ORACLE["check_required"] = sql(
    """SELECT missing AS violation, count(*) AS row_count FROM spoiled
    WHERE missing IS NOT NULL GROUP BY ALL""",
    {"spoiled": _SPOILED},
)
ORACLE["check_types"] = sql(
    """SELECT mistyped AS violation, count(*) AS row_count FROM spoiled
    WHERE mistyped IS NOT NULL GROUP BY ALL""",
    {"spoiled": _SPOILED},
)
ORACLE["check_enum"] = sql(
    "SELECT 'enum:Type' AS violation, count(*) AS row_count FROM train WHERE IsHoliday HAVING count(*) > 0"
)
ORACLE["check_nulls"] = sql(
    " UNION ALL ".join(
        f"""SELECT 'null:{c}' AS violation, count(*) AS row_count
        FROM train LEFT JOIN cleaned USING (Store, Date) WHERE {c} IS NULL HAVING count(*) > 0"""
        for c in _FLAGS
    )
)
ORACLE["check_unique"] = sql(
    """SELECT Store, Dept, Date, count(*) AS row_count FROM base
    GROUP BY ALL HAVING count(*) > 1"""
)
ORACLE["split_valid"] = sql(
    """SELECT CASE WHEN IsHoliday AND Dept = 0 THEN NULL ELSE CAST(Store AS VARCHAR) END AS Store,
        CAST(Dept AS VARCHAR) AS Dept,
        CASE WHEN IsHoliday AND Dept = 3 THEN 'someday' ELSE CAST(Date AS VARCHAR) END AS Date,
        CAST(IsHoliday AS VARCHAR) AS IsHoliday,
        CASE WHEN NOT IsHoliday THEN '' WHEN Dept = 0 THEN 'required:Store'
            WHEN Dept = 1 THEN 'type:Weekly_Sales' WHEN Dept = 2 THEN 'required:Weekly_Sales'
            WHEN Dept = 3 THEN 'type:Date' ELSE '' END AS reasons,
        CASE WHEN IsHoliday AND Dept IN (1, 2) THEN NULL ELSE Weekly_Sales END AS Weekly_Sales
    FROM train"""
)
ORACLE["upsert_set"] = sql(
    """SELECT Store, Dept, Date, IsHoliday, CASE WHEN NOT IsHoliday THEN Weekly_Sales
        WHEN Dept >= 3 THEN NULL ELSE Weekly_Sales + 1 END AS Weekly_Sales FROM train
    UNION ALL SELECT Store, Dept, Date, NULL, 5.0 FROM test"""
)
ORACLE["upsert_keep_on_null"] = sql(
    """SELECT Store, Dept, Date, IsHoliday,
        CASE WHEN IsHoliday THEN Weekly_Sales + 1 ELSE Weekly_Sales END AS Weekly_Sales FROM train
    UNION ALL SELECT Store, Dept, Date, NULL, 5.0 FROM test"""
)
ORACLE["upsert_counts"] = sql(
    """SELECT (SELECT count(*) FROM test) AS inserted,
    (SELECT count(*) FROM train WHERE IsHoliday) AS updated"""
)
ORACLE["upsert_replace"] = sql(
    """SELECT * REPLACE (CASE WHEN IsHoliday THEN 0.0 ELSE Weekly_Sales END AS Weekly_Sales)
    FROM train UNION ALL SELECT Store, Dept, Date, 1.0, IsHoliday FROM test"""
)
ORACLE["load_stores_job"] = sql("SELECT * FROM stores")
ORACLE["load_features_job"] = ORACLE["markdown_zeroed"]
ORACLE["load_sales_job"] = sql("SELECT * FROM train")
ORACLE["stored_loads"] = sql("SELECT * FROM train")
ORACLE["stored_load_counts"] = sql(
    """SELECT 1 AS load, count(*) FILTER (Date < '1997-01-01') AS inserted, 0::BIGINT AS updated, 0::BIGINT AS rejected FROM train
    UNION ALL SELECT 2, count(*) FILTER (Date >= '1997-01-01'), 0, 0 FROM train UNION ALL SELECT 3, 0, 0, 0"""
)
ORACLE["stored_upsert"] = sql(
    "SELECT * REPLACE (CASE WHEN IsHoliday THEN Weekly_Sales + 1 ELSE Weekly_Sales END AS Weekly_Sales) FROM train"
)
ORACLE["stored_merge"] = sql("SELECT * FROM wide")
ORACLE["load_merged_job"] = sql("SELECT * FROM wide")
ORACLE["merge_tables_job"] = sql("SELECT * FROM wide")
ORACLE["load_test_job"] = sql("SELECT * FROM test")
ORACLE["load_rejects"] = sql(
    """SELECT CASE Store % 6 WHEN 0 THEN NULL WHEN 1 THEN 'x' ELSE CAST(Store AS VARCHAR) END AS Store,
        CASE Store % 6 WHEN 2 THEN 'Z' ELSE Type END AS Type,
        CASE Store % 6 WHEN 3 THEN NULL WHEN 4 THEN Size || '.5' WHEN 5 THEN CAST(Size AS VARCHAR)
            ELSE Size || '.0' END AS Size,
        CASE Store % 6 WHEN 0 THEN 'required:Store' WHEN 1 THEN 'type:Store' WHEN 2 THEN 'enum:Type'
            WHEN 3 THEN 'required:Size' WHEN 4 THEN 'type:Size' ELSE '' END AS reasons FROM stores"""
)
ORACLE["load_twice_counts"] = sql(
    """SELECT CAST(1 AS INT) AS load, count(*) AS inserted, 0::BIGINT AS updated, 0::BIGINT AS rejected
    FROM feats UNION ALL SELECT 2, 0, 0, 0"""
)


def _summary(tables: dict[str, str], merged: str) -> str:
    counts = " UNION ALL ".join(
        f"SELECT 'rows' AS measure, '{name}' AS name, CAST(count(*) AS DOUBLE) AS value FROM {view}"
        for name, view in tables.items()
    )
    means = " UNION ALL ".join(
        f"""SELECT 'mean sales by {by}', CAST({by} AS VARCHAR), {_plain_mean()} FROM {merged}
        GROUP BY {by}"""
        for by in ("Type", "IsHoliday")
    )
    return sql(f"{counts} UNION ALL {means}")


ORACLE["load_summary"] = _summary(
    {
        "stores": "stores",
        "features": "feats",
        "train_sales": "train",
        "test_sales": "test",
        "merged_data": "train",
    },
    "wide",
)
ORACLE["load_preprocessed_summary"] = _summary(
    {"stores": "stores", "features": "feats", "merged_data": "train"}, "wide"
)
ORACLE["coerce_whole_numbers"] = """
    SELECT *, CASE WHEN l_linenumber % 5 IN (0, 3) THEN CAST(l_orderkey AS INT) END AS number
    FROM (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN l_orderkey || '.0'
        WHEN 1 THEN l_orderkey || '.25' WHEN 2 THEN '99999999999' || l_orderkey
        WHEN 3 THEN ' ' || l_orderkey ELSE l_orderkey || 'x' END AS raw FROM lineitem)"""
ORACLE["replace_duplicates"] = sql(
    """SELECT * REPLACE (CASE WHEN IsHoliday THEN 2.0 ELSE Weekly_Sales END AS Weekly_Sales)
    FROM train"""
)
ORACLE["preprocess_job"] = sql(
    f"""SELECT train.Store, Dept, train.Date, Weekly_Sales, train.IsHoliday AS IsHoliday_x,
        f.* EXCLUDE (Store, Date, IsHoliday), f.IsHoliday AS IsHoliday_y, Type, Size,
        {_CALENDAR.replace("(Date)", "(train.Date)")}
    FROM train LEFT JOIN cleaned f ON train.Store = f.Store AND train.Date = f.Date
    LEFT JOIN stores s ON train.Store = s.Store"""
)
_INPUT_TABLES = {
    "merged": ("train", 24),
    "features": ("feats", 17),
    "stores": ("stores", 3),
    "test": ("test", 4),
}
ORACLE["tables_from_files"] = sql(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS row_count, CAST({width} AS INT) AS column_count,
        CAST(sum(Store) AS BIGINT) AS store_sum FROM {view}"""
        for name, (view, width) in _INPUT_TABLES.items()
    )
)
ORACLE["tables_from_documents"] = ORACLE["tables_from_files"]
ORACLE["features_target"] = sql("SELECT Store, Dept, Date, IsHoliday, Weekly_Sales FROM train")
_ALL_ROWS = {
    "every": "SELECT * FROM train UNION ALL BY NAME SELECT *, NULL::DOUBLE AS Weekly_Sales FROM test",
    "every_wide": _VIEWS["wide"].replace("train", "every"),
    "every_number": _VIEWS["numbers"].replace("EXCLUDE (Date, ", "EXCLUDE (").replace("FROM wide", "FROM every_wide"),
}
_CASES = " ".join(f"WHEN '{c}' THEN CAST({c} AS DOUBLE)" for c in MODEL_NUMBERS if c != TARGET)
ORACLE["forecast_features"] = sql(
    f"""SELECT Store, Dept, Date, feature, coalesce(CASE feature {_CASES} END, 0) AS value
    FROM every_number, (SELECT feature FROM walk WHERE twin IS NULL AND feature IS NOT NULL)""",
    _CORRELATIONS | _ALL_ROWS,
    recursive=True,
)
_MARKED = {"marked_rows": f"SELECT *, {_HOLDOUT} AS is_test FROM engineered"}
ORACLE["model_stump"] = sql(
    """SELECT m.Month, round(CASE WHEN m.Month <= t THEN low ELSE high END, 3) AS prediction
    FROM (SELECT DISTINCT Month FROM wide) m, (
        SELECT cut.Month AS t, avg(Weekly_Sales) FILTER (wide.Month <= cut.Month) AS low,
            avg(Weekly_Sales) FILTER (wide.Month > cut.Month) AS high,
            var_pop(Weekly_Sales) FILTER (wide.Month <= cut.Month) * count(*) FILTER (wide.Month <= cut.Month)
            + var_pop(Weekly_Sales) FILTER (wide.Month > cut.Month) * count(*) FILTER (wide.Month > cut.Month) AS rest
        FROM wide, (SELECT DISTINCT Month FROM wide) cut
        WHERE cut.Month < (SELECT max(Month) FROM wide) GROUP BY cut.Month ORDER BY rest LIMIT 1)"""
)


def _tree(rows: str, deep: bool = True, names: tuple[str, ...] = ("Month", "Dept")) -> dict[str, str]:
    """Views of a least squares tree on a table: ``best1``, ``best2`` are the splits of its levels,
    ``leaves`` the rows with their node and prediction."""

    def best(source: str) -> str:
        options = " UNION ALL ".join(
            f"SELECT node, {k} AS pos, '{f}' AS feature, {f} AS v, sum(y) AS s, count(*) AS n FROM {source} GROUP BY ALL"
            for k, f in enumerate(names)
        )
        return f"""SELECT * FROM (SELECT node, pos, feature, v, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain
            FROM (SELECT node, pos, feature, v, sum(s) OVER w AS sl, sum(n) OVER w AS nl,
                sum(s) OVER (PARTITION BY node, feature) AS s, sum(n) OVER (PARTITION BY node, feature) AS n
              FROM ({options}) WINDOW w AS (PARTITION BY node, feature ORDER BY v))
            WHERE n >= 5 AND nl >= 2 AND n - nl >= 2)
          WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, pos, v) = 1"""

    def below(source: str, split: str) -> str:
        value = " ".join(f"WHEN '{f}' THEN r.{f}" for f in names)
        return f"""SELECT r.* REPLACE (CASE WHEN b.node IS NULL THEN r.node ELSE 2 * r.node
            + CASE WHEN CASE b.feature {value} END <= b.v THEN 0 ELSE 1 END END AS node)
          FROM {source} r LEFT JOIN {split} b ON b.node = r.node"""

    return {
        "middle": f"SELECT avg(Weekly_Sales) AS mean FROM {rows}",
        "level0": f"SELECT *, 1 AS node, Weekly_Sales - mean AS y FROM {rows}, middle",
        "best1": best("level0"),
        "level1": below("level0", "best1"),
        "best2": best("level1"),
        "level2": below("level1", "best2"),
        "nodes": "SELECT node, any_value(mean) + avg(y) AS prediction FROM level2 GROUP BY node",
    }


ORACLE["model_tree"] = sql(
    "SELECT DISTINCT Month, Dept, round(prediction, 3) AS prediction FROM level2 JOIN nodes USING (node)", _tree("wide")
)
ORACLE["model_tree_importances"] = sql(
    """SELECT f.feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM (SELECT gain FROM best1 UNION ALL SELECT gain FROM best2)), 6) AS score
    FROM (SELECT unnest(['Month', 'Dept']) AS feature) f
    LEFT JOIN (SELECT feature, gain FROM best1 UNION ALL SELECT feature, gain FROM best2) b ON b.feature = f.feature GROUP BY f.feature""",
    _tree("wide"),
)
_ROUND = """SELECT v, sl / (nl + 1) AS low, (s - sl) / (n - nl + 1) AS high FROM (
    SELECT Month AS v, sum(sum(y)) OVER (ORDER BY Month) AS sl, sum(count(*)) OVER (ORDER BY Month) AS nl,
      sum(sum(y)) OVER () AS s, sum(count(*)) OVER () AS n FROM {rows} GROUP BY Month)
  WHERE nl < n ORDER BY sl * sl / (nl + 1) + (s - sl) * (s - sl) / (n - nl + 1) DESC, v LIMIT 1"""
ORACLE["model_boosted_rounds"] = sql(
    """SELECT DISTINCT Month, round(said + 0.1 * CASE WHEN Month <= v THEN low ELSE high END, 3) AS prediction FROM second, round2""",
    {
        "first": "SELECT Month, Weekly_Sales, mean AS said, Weekly_Sales - mean AS y FROM wide, (SELECT avg(Weekly_Sales) AS mean FROM wide)",
        "round1": _ROUND.format(rows="first"),
        "second": """SELECT Month, said + step AS said, y - step AS y FROM (
            SELECT *, 0.1 * CASE WHEN Month <= v THEN low ELSE high END AS step FROM first, round1)""",
        "round2": _ROUND.format(rows="second"),
    },
)
_SPLIT_TREE = {"parts": f"SELECT *, {_HOLDOUT} AS is_test FROM wide", "learned": "SELECT * FROM parts WHERE NOT is_test"} | _tree("learned") | {
    "side1": "SELECT * FROM best1",
    "walked1": """SELECT p.*, 2 + CASE WHEN CASE b.feature WHEN 'Month' THEN p.Month ELSE p.Dept END <= b.v THEN 0 ELSE 1 END AS up
        FROM parts p, side1 b""",
    "walked": """SELECT w.*, CASE WHEN b.node IS NULL THEN up ELSE 2 * up
        + CASE WHEN CASE b.feature WHEN 'Month' THEN w.Month ELSE w.Dept END <= b.v THEN 0 ELSE 1 END END AS node
        FROM walked1 w LEFT JOIN best2 b ON b.node = w.up""",
    "said": "SELECT w.*, prediction FROM walked w JOIN nodes USING (node)",
}
ORACLE["tree_predictions"] = sql(
    "SELECT Store, Dept, Date, Weekly_Sales AS actual, round(prediction, 3) AS prediction FROM said WHERE is_test", _SPLIT_TREE
)
ORACLE["tree_metrics"] = sql(
    """SELECT 'Tree' AS Model, round(m1, 5) AS Train_MAE, round(r1, 5) AS Train_RMSE, round(1 - r1 * r1 / v1, 5) AS Train_R2,
      round(m2, 5) AS Test_MAE, round(r2, 5) AS Test_RMSE, round(1 - r2 * r2 / v2, 5) AS Test_R2,
      round(accuracy, 5) AS Test_Accuracy, round(weighted_precision, 5) AS Test_Precision, round(accuracy, 5) AS Test_Recall,
      round(weighted_f1, 5) AS Test_F1
    FROM errors, shares""",
    _SPLIT_TREE
    | {
        "errors": """SELECT avg(abs(Weekly_Sales - prediction)) FILTER (NOT is_test) AS m1, avg(abs(Weekly_Sales - prediction)) FILTER (is_test) AS m2,
            sqrt(avg((Weekly_Sales - prediction) ** 2) FILTER (NOT is_test)) AS r1, sqrt(avg((Weekly_Sales - prediction) ** 2) FILTER (is_test)) AS r2,
            var_pop(Weekly_Sales) FILTER (NOT is_test) AS v1, var_pop(Weekly_Sales) FILTER (is_test) AS v2 FROM said""",
        "classes": """SELECT CAST(Weekly_Sales >= edge AS INT) AS a, CAST(prediction >= edge AS INT) AS p
            FROM said, (SELECT quantile_cont(Weekly_Sales, 0.75) AS edge FROM said WHERE is_test) WHERE is_test""",
        "confusion": """SELECT c, count(*) FILTER (a = c) AS real, count(*) FILTER (p = c) AS told, count(*) FILTER (a = c AND p = c) AS hit, count(*) AS n
            FROM classes, (SELECT unnest([0, 1]) AS c) GROUP BY c""",
        "shares": """SELECT sum(hit) / any_value(n) AS accuracy, sum(real * CASE WHEN told > 0 THEN hit / told ELSE 0 END) / any_value(n) AS weighted_precision,
            sum(real * CASE WHEN real + told > 0 THEN 2.0 * hit / (real + told) ELSE 0 END) / any_value(n) AS weighted_f1 FROM confusion""",
    },
)
