"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow import contracts, fixtures
from salesflow.functions import dates
from salesflow.functions.dates import add_calendar, parse_date
from salesflow.functions.money import exact_mean
from salesflow.operators import checks as Q
from salesflow.operators import cleaning as C
from salesflow.operators import encode as E
from salesflow.operators import evaluate as V
from salesflow.operators import histogram_trees as H
from salesflow.operators import joins as J
from salesflow.operators import models as M
from salesflow.operators import reports as A
from salesflow.operators import selection as S
from salesflow.operators import stats as D
from salesflow.operators import upsert as U
from salesflow.operators import windows as W
from salesflow.operators.quantiles import summary
from salesflow.operators.split import mark_holdout, split
from salesflow.plans import clean, features, forecast, load, preprocess
from salesflow.session import cut, scratch_path
from salesflow.sources import layout as L
from salesflow.sources import readers as R
from salesflow.sources import zones as Z
from salesflow.sources.catalog import ForecastInputs, load_tables
from salesflow.sources.dumps import write_dump
from salesflow.sources.stored import StoredTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

START = fixtures.PROMOTION_START
KEY = ["Store", "Dept", "Date"]
GROUP = ["Store", "Dept"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Doubles rounded for comparison with another engine; all of them by default."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in names})


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_promotions(fixtures.features(spark, sf), start=START)


def wide(spark: SparkSession, sf: str) -> DataFrame:
    return J.merge_wide(
        fixtures.train(spark, sf), cleaned(spark, sf), fixtures.stores(spark, sf)
    )


def inner(spark: SparkSession, sf: str) -> DataFrame:
    joined = J.join_features(fixtures.train(spark, sf), cleaned(spark, sf), how="inner")
    return J.join_stores(joined, fixtures.stores(spark, sf), how="inner")


def numeric(spark: SparkSession, sf: str) -> DataFrame:
    """The wide table with everything as numbers, nulls kept: what the correlations see."""
    dated = add_calendar(wide(spark, sf), extended=True)
    made = E.encode(dated, fitted_on=fixtures.stores(spark, sf))
    return C.resolve_clash(made)


def as_text(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


# Sources and sinks


@query
def scan_csv(spark, sf):
    path = R.write_csv(fixtures.train(spark, sf), scratch_path(spark, "scan_csv"))
    return R.scan_csv(spark, path, contracts.TRAIN.schema())


@query
def scan_csv_inferred(spark, sf):
    path = R.write_csv(fixtures.features(spark, sf), scratch_path(spark, "scan_csv_inferred"))
    return R.scan_csv(spark, path)


@query
def typed_projection(spark, sf):
    text = as_text(fixtures.train(spark, sf))
    types = {f.name: f.type for f in contracts.TRAIN.fields}
    return C.cast_columns(text, types)


@query
def coerce_records(spark, sf):
    raw = as_text(fixtures.features(spark, sf)).withColumns(
        {
            "CPI": F.coalesce("CPI", F.lit("NaN")),
            "Unemployment": F.coalesce("Unemployment", F.lit("")),
            "Temperature": F.when(F.col("IsHoliday") == "true", "n/a").otherwise(
                F.col("Temperature")
            ),
            "IsHoliday": F.initcap("IsHoliday"),
        }
    )
    return C.coerce(raw, contracts.RAW_FEATURES)


@query
def scan_parquet(spark, sf):
    lines = R.scan_parquet(spark, f"{sf}/lineitem.parquet", ["l_suppkey", "l_quantity"])
    suppliers = R.scan_parquet(spark, f"{sf}/supplier.parquet", ["s_suppkey", "s_nationkey"])
    nations = R.scan_parquet(spark, f"{sf}/nation.parquet", ["n_nationkey", "n_name"])
    return (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("line_count"))
    )


@query
def sink_parquet_roundtrip(spark, sf):
    path = R.write_parquet(
        wide(spark, sf),
        scratch_path(spark, "sink_parquet"),
        partition_by=["Year", "Month"],
        sort_by=KEY,
    )
    return R.scan_parquet(spark, path)


CURVE = ["Type", "IsHoliday", "Store", "Dept", "Date"]


@query
def layout_interleaved(spark, sf):
    """Rows and sales of each access pattern, read from one table in the order of a curve."""
    path = L.write_interleaved(wide(spark, sf), scratch_path(spark, "curve"), CURVE)
    table = R.scan_parquet(spark, path, [*CURVE, "Weekly_Sales"])
    patterns = {
        "Type": F.col("Type") == "B",
        "IsHoliday": F.col("IsHoliday"),
        "Store": F.col("Store") == 3,
        "Dept": F.col("Dept") == 2,
        "Date": F.col("Date").between(F.lit("1997-01-01").cast("date"), F.lit("1997-03-31").cast("date")),
        "Store, Dept, Date": (F.col("Store") == 3) & (F.col("Dept") == 2) & (F.col("Date") < F.lit("1996-01-01").cast("date")),
    }
    found = [
        table.where(kept).agg(
            F.lit(name).alias("pattern"), F.count(F.lit(1)).alias("row_count"), F.sum("Weekly_Sales").alias("sales")
        )
        for name, kept in patterns.items()
    ]
    return rounded(union(found), 2, "sales")


@query
def layout_bucketed(spark, sf):
    """The inner join of sales and features from tables hashed by its key, without an exchange."""
    sides = []
    for name, df in [("sales", fixtures.train(spark, sf)), ("features", cleaned(spark, sf))]:
        path = scratch_path(spark, f"bucketed_{name}")
        table = L.write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), path, ["Store", "Date"], 8)
        sides.append(spark.table(table))
        L.drop_table(spark, table)
    return J.join_features(*sides, how="inner")


@query
def sink_csv_roundtrip(spark, sf):
    path = R.write_csv(wide(spark, sf), scratch_path(spark, "sink_csv"))
    return R.scan_csv(spark, path, contracts.MERGED.schema())


@query
def scan_documents(spark, sf):
    documents = cleaned(spark, sf).withColumn("_id", F.concat_ws("/", "Store", "Date"))
    path = R.write_documents(documents, scratch_path(spark, "documents"))
    schema = T.StructType([T.StructField("_id", T.StringType()), *contracts.FEATURES.schema()])
    return R.scan_documents(spark, path, schema=schema)


@query
def scan_document_dump(spark, sf):
    documents = cleaned(spark, sf).withColumn("_id", F.concat_ws("/", "Store", "Date"))
    path = write_dump(documents, scratch_path(spark, "dump"))
    schema = T.StructType([T.StructField("_id", T.StringType()), *contracts.FEATURES.schema()])
    return R.scan_documents(spark, path, "bson", schema=schema)


def _raw_files(spark: SparkSession, sf: str) -> str:
    """The four raw files: features with day-first dates, the others with year-first ones."""
    folder = scratch_path(spark, "raw_files")
    dated = fixtures.features(spark, sf).withColumn("Date", F.date_format("Date", "dd/MM/yyyy"))
    R.write_csv(dated, f"{folder}/features.csv")
    R.write_csv(fixtures.train(spark, sf), f"{folder}/train.csv")
    R.write_csv(fixtures.test(spark, sf), f"{folder}/test.csv")
    R.write_csv(fixtures.stores(spark, sf), f"{folder}/stores.csv")
    return folder


@query
def land_zone(spark, sf):
    zones = Z.Zones(scratch_path(spark, "zones"))
    Z.land(spark, _raw_files(spark, sf), zones.raw())
    return clean.read_raw(spark, zones.raw("features.csv"), contracts.RAW_FEATURES)


@query
def clean_features_job(spark, sf):
    base = scratch_path(spark, "zones")
    return clean.clean_zone(spark, _raw_files(spark, sf), base, promotion_start=START)["features"]


@query
def clean_sales_job(spark, sf):
    base = scratch_path(spark, "zones")
    return clean.clean_zone(spark, _raw_files(spark, sf), base, promotion_start=START)["train"]


@query
def preprocess_job(spark, sf):
    """Raw files to the preprocessed zone; its merged file read back."""
    zones = preprocess.preprocess(spark, _raw_files(spark, sf), scratch_path(spark, "zones"), START)
    return clean.read_raw(spark, zones.preprocessed("merged_train.csv"), PREPROCESSED)


#: The merged file as it is written: both IsHoliday columns, nulls where no features match.
PREPROCESSED = contracts.Contract(
    "merged_train",
    contracts.MERGED.key,
    tuple(
        contracts.Field(n, "boolean")
        if f.name == "IsHoliday"
        else f
        for f in contracts.MERGED.fields
        for n in (("IsHoliday_x", "IsHoliday_y") if f.name == "IsHoliday" else (f.name,))
    ),
)


def _shapes_of(inputs: ForecastInputs) -> DataFrame:
    tables = {n: getattr(inputs, n) for n in ("merged", "features", "stores", "test")}
    keys = [
        df.agg(F.sum("Store").alias("store_sum")).select(F.lit(n).alias("table_name"), "store_sum")
        for n, df in tables.items()
    ]
    return A.shapes(tables).join(union(keys), "table_name")


@query
def tables_from_files(spark, sf):
    """The tables of a forecast run from the preprocessed and raw zones."""
    base = scratch_path(spark, "zones")
    raw = _raw_files(spark, sf)
    preprocess.preprocess(spark, raw, base, START)
    Z.land(spark, raw, Z.Zones(base).raw())
    return _shapes_of(load_tables(spark, "files", base=base))


@query
def tables_from_documents(spark, sf):
    """The same tables from document collections and a test file."""
    base = scratch_path(spark, "collections")
    for name, df in (
        ("merged_data", wide(spark, sf)),
        ("features", cleaned(spark, sf)),
        ("stores", fixtures.stores(spark, sf)),
    ):
        R.write_documents(df, f"{base}/{name}")
    R.write_csv(fixtures.test(spark, sf), Z.Zones(base).raw("test.csv"))
    return _shapes_of(load_tables(spark, "documents", base=base))


@query
def report_run_job(spark, sf):
    """Cleaned zone to enriched zone: the report by type and holiday as it was written."""
    base = scratch_path(spark, "zones")
    clean.clean_zone(spark, _raw_files(spark, sf), base, promotion_start=START)
    return preprocess.report_run(spark, base).holiday_sales


@query
def report_run_merged(spark, sf):
    """The joined table the report run writes."""
    base = scratch_path(spark, "zones")
    clean.clean_zone(spark, _raw_files(spark, sf), base, promotion_start=START)
    return preprocess.report_run(spark, base).merged


# Projections, filters, cleaning


@query
def parse_dates(spark, sf):
    """Every ship date in one of three spellings, or none."""
    lines = fixtures.read(spark, sf, "lineitem")
    ln, day = F.col("l_linenumber"), F.col("l_shipdate").cast("date")
    text = (
        F.when(ln % 4 == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(ln % 4 == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(ln % 4 == 2, F.date_format(day, "MM/dd/yyyy"))
        .otherwise("unknown")
    )
    return lines.select("l_orderkey", "l_linenumber", text.alias("raw_date")).withColumn(
        "parsed", parse_date("raw_date")
    )


@query
def markdown_flags(spark, sf):
    return C.flag_promotions(fixtures.features(spark, sf), start=START)


@query
def markdown_fill(spark, sf):
    return C.fill_promotions(fixtures.features(spark, sf), start=START)


@query
def markdown_zeroed(spark, sf):
    return C.clean_promotions(
        fixtures.features(spark, sf), start=START, zero_before_start=True
    )


@query
def fill_numeric(spark, sf):
    joined = J.join_features(fixtures.train(spark, sf), fixtures.features(spark, sf))
    return C.fill_numeric(joined)


@query
def align_columns(spark, sf):
    wanted = ["Store", "Dept", "Date", "IsHoliday", "Weekly_Sales", "Type_encoded"]
    aligned = C.align_columns(fixtures.test(spark, sf), wanted)
    return C.keep_available(aligned, [*wanted, "not_there"])


@query
def resolve_holiday(spark, sf):
    joined = J.join_features(
        fixtures.train(spark, sf), fixtures.features(spark, sf), clash="suffix"
    )
    return C.resolve_clash(joined).select(*KEY, "Weekly_Sales", "IsHoliday")


@query
def cast_features(spark, sf):
    types = {"IsHoliday": "int", "Size": "double", "hasMarkDown1": "double"}
    return C.cast_columns(wide(spark, sf), types).select(*KEY, *types)


@query
def drop_null_target(spark, sf):
    both = fixtures.train(spark, sf).unionByName(
        fixtures.test(spark, sf), allowMissingColumns=True
    )
    return C.drop_null_target(both)


@query
def encode_alpha(spark, sf):
    """Holiday rows carry a type the encoder has not seen."""
    rows = J.join_stores(fixtures.train(spark, sf), fixtures.stores(spark, sf))
    rows = rows.withColumn("Type", F.when(F.col("IsHoliday"), "D").otherwise(F.col("Type")))
    coded = E.encode(rows, fitted_on=fixtures.stores(spark, sf))
    return coded.select(*KEY, "Type", "Type_encoded")


@query
def encode_freq(spark, sf):
    rows = J.join_stores(fixtures.train(spark, sf), fixtures.stores(spark, sf))
    coded = E.encode(rows, "Type", "Type_Index", order="frequencyDesc")
    return coded.select(*KEY, "Type", "Type_Index")


# Dates


@query
def temporal_basic(spark, sf):
    return add_calendar(fixtures.train(spark, sf))


@query
def temporal_extended(spark, sf):
    return add_calendar(fixtures.train(spark, sf), extended=True).drop("Season")


@query
def season(spark, sf):
    lines = fixtures.read(spark, sf, "lineitem")
    return (
        lines.groupBy(F.col("l_shipdate").cast("date").alias("ship_date"))
        .agg(F.count(F.lit(1)).alias("line_count"))
        .withColumn("Season", dates.season("ship_date"))
    )


# Joins


@query
def join_inner_features(spark, sf):
    return J.join_features(fixtures.train(spark, sf), cleaned(spark, sf), how="inner")


@query
def join_inner_stores(spark, sf):
    return inner(spark, sf)


@query
def join_left_features(spark, sf):
    return J.join_features(fixtures.train(spark, sf), cleaned(spark, sf), clash="suffix")


@query
def join_left_stores(spark, sf):
    return J.join_stores(fixtures.train(spark, sf), fixtures.stores(spark, sf))


@query
def merge_wide(spark, sf):
    return wide(spark, sf)


@query
def prepare_scoring(spark, sf):
    return J.scoring_input(
        fixtures.test(spark, sf), cleaned(spark, sf), fixtures.stores(spark, sf), clash="suffix"
    )


# Reports


@query
def report_markdown(spark, sf):
    return A.promotion_report(inner(spark, sf))


@query
def report_markdown_sql(spark, sf):
    text = """
        SELECT hasMarkDown1, count(*) AS record_count, sum(Weekly_Sales) AS Total_Sales,
               avg(Weekly_Sales) AS Avg_Sales
        FROM merged_sales GROUP BY hasMarkDown1 ORDER BY Total_Sales DESC
    """
    return rounded(A.run_sql(inner(spark, sf), text), 4)


@query
def report_type_holiday_sql(spark, sf):
    text = """
        SELECT Type, IsHoliday, count(*) AS record_count, sum(Weekly_Sales) AS Total_Sales,
               avg(Weekly_Sales) AS Avg_Sales
        FROM merged_sales GROUP BY Type, IsHoliday ORDER BY Total_Sales DESC
    """
    return rounded(A.run_sql(inner(spark, sf), text), 4)


@query
def report_store_dept(spark, sf):
    return A.average_by(inner(spark, sf), GROUP)


@query
def report_type_holiday(spark, sf):
    return A.type_holiday_report(inner(spark, sf))


@query
def trend_weekly(spark, sf):
    return A.trend(wide(spark, sf))


@query
def trend_monthly(spark, sf):
    return A.trend(wide(spark, sf), ["Year", "Month"])


@query
def report_type(spark, sf):
    return A.average_by_type(wide(spark, sf))


@query
def report_holiday(spark, sf):
    return A.average_by_holiday(wide(spark, sf))


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "stores": fixtures.stores(spark, sf),
        "features": cleaned(spark, sf),
        "train_sales": fixtures.train(spark, sf),
        "test_sales": fixtures.test(spark, sf),
        "merged_data": wide(spark, sf),
    }


@query
def table_counts(spark, sf):
    return A.table_counts(_tables(spark, sf))


@query
def table_shapes(spark, sf):
    return A.shapes(_tables(spark, sf))


@query
def drill_store(spark, sf):
    return A.drill_down(wide(spark, sf))


@query
def drill_one_store(spark, sf):
    return A.drill_down(wide(spark, sf), where={"Store": 3})


@query
def drill_store_dept(spark, sf):
    narrowed = A.drill_down(wide(spark, sf), by=["Store", "Dept"], where={"Store": 3, "Dept": 1})
    return narrowed


@query
def drill_dept(spark, sf):
    return A.drill_down(wide(spark, sf), by=["Dept"])


@query
def top_sales(spark, sf):
    return A.top_rows(fixtures.train(spark, sf), 10)


@query
def sample_rows(spark, sf):
    return A.first_rows(wide(spark, sf), 5)


# Windows


@query
def lag_econ(spark, sf):
    return W.add_previous(wide(spark, sf)).select(*KEY, "Prev_CPI", "Prev_Unemployment")


@query
def lag_multi(spark, sf):
    return W.add_lags(fixtures.train(spark, sf), GROUP, "Weekly_Sales", [1, 2, 4])


@query
def roll_prev4(spark, sf):
    return W.add_mean_before(fixtures.train(spark, sf))


@query
def roll_mean(spark, sf):
    return W.add_rolling(
        fixtures.train(spark, sf), GROUP, "Weekly_Sales", [4, 8], stats=["mean"]
    )


@query
def roll_std(spark, sf):
    out = W.add_rolling(fixtures.train(spark, sf), GROUP, "Weekly_Sales", [4, 8], stats=["std"])
    return rounded(out, 4, "Weekly_Sales_rolling_std_4", "Weekly_Sales_rolling_std_8")


@query
def features_engineered(spark, sf):
    return features.report_features(
        fixtures.train(spark, sf), cleaned(spark, sf), fixtures.stores(spark, sf)
    )


@query
def features_engineered_chunked(spark, sf):
    return features.report_features(
        fixtures.train(spark, sf), cleaned(spark, sf), fixtures.stores(spark, sf), chunk="year"
    )


@query
def lag_multi_chunked(spark, sf):
    train = fixtures.train(spark, sf)
    return W.add_lags(train, GROUP, "Weekly_Sales", [1, 2, 4], chunk="month")


@query
def roll_std_chunked(spark, sf):
    train = fixtures.train(spark, sf)
    out = W.add_rolling(train, GROUP, "Weekly_Sales", [4, 8], stats=["std"], chunk="quarter")
    return rounded(out, 4, "Weekly_Sales_rolling_std_4", "Weekly_Sales_rolling_std_8")


# Statistics


@query
def iqr_bounds(spark, sf):
    return rounded(D.iqr_bounds(wide(spark, sf)), 7)


@query
def quantiles_narrowed(spark, sf):
    """Quartiles per type with tasks of 100 rows only, so that groups have to be narrowed first."""
    found = summary(
        wide(spark, sf), "Weekly_Sales", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["Type"], task_rows=100, bins=16
    )
    return rounded(found, 7)


@query
def iqr_outliers(spark, sf):
    return D.iqr_outliers(wide(spark, sf)).select(*KEY, "Weekly_Sales")


@query
def describe_table(spark, sf):
    return rounded(rounded(D.describe(wide(spark, sf)), 7), 4, "mean", "std")


@query
def histogram_sales(spark, sf):
    return rounded(D.histogram(wide(spark, sf)), 7)


@query
def density_sales(spark, sf):
    return rounded(D.density(wide(spark, sf)), 4)


@query
def box_by_type(spark, sf):
    return rounded(D.box_stats(wide(spark, sf), "Type"), 7)


@query
def box_by_month(spark, sf):
    return rounded(D.box_stats(wide(spark, sf), "Month"), 7)


@query
def box_by_holiday(spark, sf):
    return rounded(D.box_stats(wide(spark, sf), "IsHoliday"), 7)


@query
def scatter_points(spark, sf):
    return D.scatter_points(wide(spark, sf), "Temperature", "Weekly_Sales", KEY)


@query
def scatter_sample(spark, sf):
    return D.scatter_points(wide(spark, sf), "Temperature", "Weekly_Sales", KEY, 0.1)


@query
def corr_target(spark, sf):
    return rounded(D.target_correlations(numeric(spark, sf)), 8)


@query
def corr_matrix(spark, sf):
    return rounded(D.correlation_matrix(numeric(spark, sf)), 8)


# Feature selection


@query
def select_target(spark, sf):
    return S.related_to_target(numeric(spark, sf))


@query
def select_redundant(spark, sf):
    report = S.selection_report(numeric(spark, sf))
    return report.where("status = 'kept'").select("place", "feature", "corr")


@query
def selection_report(spark, sf):
    return S.selection_report(numeric(spark, sf))


@query
def forecast_features(spark, sf):
    test = J.scoring_input(
        fixtures.test(spark, sf), cleaned(spark, sf), fixtures.stores(spark, sf)
    )
    made = features.forecast_features(wide(spark, sf), test, types=fixtures.stores(spark, sf))
    if not made.columns:
        # No correlation reaches the minimum: no feature, so no row.
        return made.train.select(*KEY, F.lit("").alias("feature"), F.lit(0.0).alias("value")).where(F.lit(False))
    long = [
        part.select(*KEY, *[F.col(c).cast("double").alias(f"value of {c}") for c in made.columns])
        .unpivot(KEY, [f"value of {c}" for c in made.columns], "feature", "value")
        for part in (made.train, made.test)
    ]
    return union(long).withColumn("feature", F.expr("substr(feature, 10)"))


@query
def features_target(spark, sf):
    """A column the table lacks is left out, rows without a target go."""
    rows = fixtures.train(spark, sf).unionByName(fixtures.test(spark, sf), allowMissingColumns=True)
    return C.features_and_target(rows, ["IsHoliday", "Size"], keep=KEY)


# Models and evaluation


def report_rows(spark: SparkSession, sf: str) -> DataFrame:
    return features.report_model_rows(features_engineered(spark, sf))


def assembled(spark: SparkSession, sf: str, keep=(*KEY, M.TARGET)) -> DataFrame:
    return M.assemble(report_rows(spark, sf), M.REPORT_FEATURES, keep)


@query
def assemble(spark, sf):
    rows = assembled(spark, sf).withColumn("v", vector_to_array(M.VECTOR))
    parts = {f"f_{name}": F.col("v")[i] for i, name in enumerate(M.REPORT_FEATURES)}
    return rows.select(*KEY, M.TARGET, *[c.alias(n) for n, c in parts.items()])


@query
def split_rows(spark, sf):
    return mark_holdout(fixtures.train(spark, sf))


def _scored(spark: SparkSession, sf: str, learner: M.Learner) -> DataFrame:
    """A model's hold-out rows: key, actual value, prediction."""
    train, test = split(assembled(spark, sf), key=KEY)
    predicted = M.predict(M.fit(learner, train), test)
    return predicted.select(*KEY, F.col(M.TARGET).alias("actual"), "prediction")


@query
def model_rf_small(spark, sf):
    """Hold-out metrics of the small forest."""
    scored = cut(_scored(spark, sf, M.forest(**M.SMALL_FOREST)))
    return V.regression_metrics(scored, "actual").select(
        scored.agg(F.count(F.lit(1))).scalar().alias("row_count"), "MAE", "RMSE", "R2"
    )


@query
def predict_rows(spark, sf):
    """Hold-out rows with the small forest's predictions."""
    return _scored(spark, sf, M.forest(**M.SMALL_FOREST))


@query
def importances(spark, sf):
    """The small forest's features and their scores, the greatest first."""
    train, _ = split(assembled(spark, sf), key=KEY)
    model = M.fit(M.forest(**M.SMALL_FOREST), train)
    return M.importances(train, model, M.REPORT_FEATURES, top=20)


TREE = H.Settings(trees=1, depth=2, rate=1.0, penalty=0.0, least_rows=2, split_rows=5, boosted=False)
ROUNDS = H.Settings(trees=2, depth=1, rate=0.1, penalty=1.0)


def _by_group(model: H.TreeModel, rows: DataFrame, by: Sequence[str]) -> DataFrame:
    predicted = model.predict(rows).groupBy(*by).agg(F.max("prediction").alias("prediction"))
    return rounded(predicted, 3)


@query
def model_tree(spark, sf):
    """One tree of two levels on month and department, with a least number of rows to split."""
    rows = wide(spark, sf)
    return _by_group(H.fit(rows, ["Month", "Dept"], M.TARGET, TREE), rows, ["Month", "Dept"])


@query
def model_tree_importances(spark, sf):
    """The same tree's features by their share of the gains, the greatest first."""
    shares = H.fit(wide(spark, sf), ["Month", "Dept"], M.TARGET, TREE).importances()
    table = spark.createDataFrame(shares, "feature string, score double").orderBy(F.col("score").desc(), "feature")
    return rounded(table, 6)


@query
def model_boosted_rounds(spark, sf):
    """Two rounds of second-order boosting on the month: each leaf shrunk by penalty and rate."""
    rows = wide(spark, sf)
    return _by_group(H.fit(rows, ["Month"], M.TARGET, ROUNDS), rows, ["Month"])


def _holdout_tree(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Training and hold-out rows with the predictions of the tree, learned from the former."""
    train, test = split(wide(spark, sf), key=KEY)
    model = H.fit(train, ["Month", "Dept"], M.TARGET, TREE)
    return model.predict(train), model.predict(test)


@query
def tree_predictions(spark, sf):
    """Hold-out rows: actual value, and what the tree says."""
    _, test = _holdout_tree(spark, sf)
    return rounded(test.select(*KEY, F.col(M.TARGET).alias("actual"), "prediction"), 3, "prediction")


@query
def tree_metrics(spark, sf):
    """The tree's row of a model comparison: errors and classes of training and hold-out rows."""
    train, test = _holdout_tree(spark, sf)
    return rounded(V.evaluation_row("Tree", cut(train), cut(test), M.TARGET), 5)


@query
def model_stump(spark, sf):
    """One tree with one split of the month, on all rows: the best split and its two means."""
    rows = M.assemble(wide(spark, sf), ["Month"], keep=("Month", M.TARGET))
    stump = {"numTrees": 1, "maxDepth": 1, "bootstrap": False, "featureSubsetStrategy": "all"}
    predicted = M.predict(M.fit(M.forest(**stump, maxBins=M.BINS), rows), rows)
    return rounded(predicted.groupBy("Month").agg(F.max("prediction").alias("prediction")), 3)


def _one_feature(spark: SparkSession, sf: str, learner: M.Learner) -> DataFrame:
    rows = M.assemble(wide(spark, sf).fillna(0, ["Temperature"]), ["Temperature"])
    model = M.fit(learner, rows)
    return rounded(M.coefficients(rows, model, ["Temperature"]), 3)


@query
def model_linear(spark, sf):
    return _one_feature(spark, sf, M.linear())


@query
def model_ridge(spark, sf):
    return _one_feature(spark, sf, M.ridge())


def mean_predictor(
    train: DataFrame, rows: DataFrame, by: Sequence[str], otherwise: str = "overall"
) -> DataFrame:
    """Predicts the training mean of the row's group, or of everything for a new group."""
    overall = train.agg(exact_mean(M.TARGET).alias(otherwise)).scalar()
    if not by:
        return rows.withColumn("prediction", overall)
    means = train.groupBy(*by).agg(exact_mean(M.TARGET).alias("_mean"))
    return (
        rows.join(means, list(by), "left")
        .withColumn("prediction", F.coalesce("_mean", overall))
        .drop("_mean")
    )


def _mean_scored(spark: SparkSession, sf: str, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    train, test = split(fixtures.train(spark, sf))
    return mean_predictor(train, train, by), mean_predictor(train, test, by)


@query
def metrics_regression(spark, sf):
    on_train, on_test = _mean_scored(spark, sf, GROUP)
    parts = [
        V.regression_metrics(rows).select(F.lit(name).alias("part"), "*")
        for name, rows in (("train", on_train), ("test", on_test))
    ]
    return rounded(union(parts), 6)


@query
def metrics_classes(spark, sf):
    _, on_test = _mean_scored(spark, sf, GROUP)
    parts = [
        V.class_metrics(on_test, merge_low=merge).select(F.lit(merge).alias("merge_low"), "*")
        for merge in (True, False)
    ]
    return rounded(union(parts), 8)


@query
def best_model(spark, sf):
    """The best of four mean predictors by hold-out R2."""
    choices = {"all": [], "store": ["Store"], "dept": ["Dept"], "store_dept": GROUP}
    rows = []
    for name, by in choices.items():
        _, on_test = _mean_scored(spark, sf, by)
        metrics = V.regression_metrics(on_test, prefix="Test_")
        rows.append(metrics.select(F.lit(name).alias("Model"), "*"))
    return rounded(A.best_row(union(rows)), 6)


def _inputs(spark: SparkSession, sf: str) -> ForecastInputs:
    return ForecastInputs(
        wide(spark, sf), cleaned(spark, sf), fixtures.stores(spark, sf), fixtures.test(spark, sf)
    )


_RUNS: dict[tuple[str, str], str] = {}
FULL_RUN = (
    "model_rf",
    "model_gbt",
    "model_gbt_sampled",
    "model_comparison",
    "score_test",
    "predicted_actual",
    "forecast_run",
)


def _full_run(spark: SparkSession, sf: str) -> str:
    """Folder with the results of the whole forecast run: five full learners, the best one's scores.

    Written once per session and table; the queries below read it.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        folder = scratch_path(spark, "forecast_run")
        done = forecast.run(_inputs(spark, sf))
        for name in ("comparison", "predictions", "fitted"):
            getattr(done, name).write.parquet(f"{folder}/{name}")
        trees = [
            (name, type(model).__name__, int(model.getNumTrees))
            for name, model in done.models.items()
            if hasattr(model, "getNumTrees")
        ]
        spark.createDataFrame(trees, "Model string, kind string, trees int").write.parquet(
            f"{folder}/trees"
        )
        _RUNS[key] = folder
    return _RUNS[key]


def _model_row(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A compared model: its trees and its metrics."""
    folder = _full_run(spark, sf)
    row = spark.read.parquet(f"{folder}/comparison").where(F.col("Model") == name)
    return row.join(spark.read.parquet(f"{folder}/trees").select("Model", "trees"), "Model")


@query
def model_rf(spark, sf):
    return _model_row(spark, sf, "RandomForest")


@query
def model_gbt(spark, sf):
    return _model_row(spark, sf, "GradientBoosting")


@query
def model_gbt_sampled(spark, sf):
    return _model_row(spark, sf, "SampledBoosting")


@query
def model_comparison(spark, sf):
    """The five compared models with their ten metrics."""
    return spark.read.parquet(f"{_full_run(spark, sf)}/comparison")


@query
def score_test(spark, sf):
    """Every row to score, with what the best of the five models predicts."""
    return spark.read.parquet(f"{_full_run(spark, sf)}/predictions")


@query
def predicted_actual(spark, sf):
    """Hold-out rows of the forecast run: actual value and prediction."""
    return spark.read.parquet(f"{_full_run(spark, sf)}/fitted")


@query
def forecast_run(spark, sf):
    """The models of the run, the best one marked, with hold-out metrics made again from its rows."""
    folder = _full_run(spark, sf)
    table = spark.read.parquet(f"{folder}/comparison")
    best = A.best_row(table).select("Model").scalar()
    again = V.regression_metrics(spark.read.parquet(f"{folder}/fitted"), "actual")
    made = [F.when(F.col("Model") == best, again.select(m).scalar()).alias(f"again_{m}") for m in ("MAE", "RMSE", "R2")]
    return table.select("Model", "Test_MAE", "Test_RMSE", "Test_R2", (F.col("Model") == best).alias("best"), *made)


# Contracts and upserts


def _dirty_train(spark: SparkSession, sf: str) -> DataFrame:
    """Training rows as text, with gaps and garbage in the holiday weeks."""
    rows = as_text(fixtures.train(spark, sf))
    holiday = F.col("IsHoliday") == "true"

    def spoil(name: str, dept: str, value: str | None):
        hit = holiday & (F.col("Dept") == dept)
        return F.when(hit, F.lit(value)).otherwise(F.col(name))

    return rows.withColumns(
        {
            "Store": spoil("Store", "0", None),
            "Weekly_Sales": F.when(holiday & (F.col("Dept") == "1"), "n/a").otherwise(
                spoil("Weekly_Sales", "2", "")
            ),
            "Date": spoil("Date", "3", "someday"),
        }
    )


@query
def check_required(spark, sf):
    return Q.violation_counts(_dirty_train(spark, sf), contracts.TRAIN, ["required", "null"])


@query
def check_types(spark, sf):
    return Q.violation_counts(_dirty_train(spark, sf), contracts.TRAIN, ["type"])


@query
def check_enum(spark, sf):
    rows = wide(spark, sf).withColumn(
        "Type", F.when(F.col("IsHoliday"), "D").otherwise(F.col("Type"))
    )
    return Q.violation_counts(rows, contracts.MERGED, ["enum"])


@query
def check_nulls(spark, sf):
    """Flags must not be null; measures may."""
    rows = J.join_features(fixtures.train(spark, sf), cleaned(spark, sf))
    return Q.violation_counts(rows, contracts.MERGED, ["null"])


@query
def check_unique(spark, sf):
    return Q.duplicate_keys(fixtures.base(spark, sf), KEY)


@query
def split_valid(spark, sf):
    valid, rejected = Q.split_valid(_dirty_train(spark, sf), contracts.TRAIN)
    both = valid.withColumn("reasons", F.lit("")).unionByName(
        rejected.withColumn("reasons", F.array_join(Q.VIOLATIONS, ",")).drop(Q.VIOLATIONS)
    )
    # Doubles are spelled differently in other engines; compare the value, not its text.
    return both.withColumn("Weekly_Sales", F.expr("try_cast(Weekly_Sales AS DOUBLE)"))


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    """Holiday rows, some of them again without a value, and new rows."""
    train, test = fixtures.train(spark, sf), fixtures.test(spark, sf)
    again = train.where("IsHoliday").select(*KEY, "Weekly_Sales")
    first = again.withColumns({"Weekly_Sales": F.col("Weekly_Sales") + 1, "at": F.lit(1)})
    second = again.where("Dept >= 3").withColumns(
        {"Weekly_Sales": F.lit(None).cast("double"), "at": F.lit(2)}
    )
    new = test.select(*KEY, F.lit(5.0).alias("Weekly_Sales"), F.lit(3).alias("at"))
    return union([first, second, new])


@query
def upsert_set(spark, sf):
    return U.upsert(fixtures.train(spark, sf), _batch(spark, sf), KEY, ["at"])


@query
def upsert_keep_on_null(spark, sf):
    return U.upsert(
        fixtures.train(spark, sf), _batch(spark, sf), KEY, ["at"], keep_on_null=["Weekly_Sales"]
    )


@query
def upsert_counts(spark, sf):
    return U.upsert_counts(fixtures.train(spark, sf), _batch(spark, sf), KEY, ["at"])


@query
def upsert_replace(spark, sf):
    train, test = fixtures.train(spark, sf), fixtures.test(spark, sf)
    batch = union(
        [
            train.where("IsHoliday").withColumn("Weekly_Sales", F.lit(0.0)),
            test.withColumn("Weekly_Sales", F.lit(1.0)),
        ]
    )
    return U.replace_by_key(train, batch, KEY)


@query
def replace_duplicates(spark, sf):
    """A batch that has every holiday row three times: the last one counts."""
    train = fixtures.train(spark, sf)
    again = train.where("IsHoliday")
    batch = union(
        [again.withColumns({"Weekly_Sales": F.lit(v), "at": F.lit(at)}) for v, at in ((1.0, 2), (2.0, 3), (3.0, 1))]
    )
    return U.replace_by_key(train, batch, KEY, ["at"])


@query
def load_stores_job(spark, sf):
    path = f"{_raw_files(spark, sf)}/stores.csv"
    return load.load_stores(spark, path, load.load_stores(spark, path).table).table


@query
def load_features_job(spark, sf):
    """Loaded twice: the second load changes nothing."""
    path = f"{_raw_files(spark, sf)}/features.csv"
    once = load.load_features(spark, path, promotion_start=START).table
    return load.load_features(spark, path, once, promotion_start=START).table


@query
def load_sales_job(spark, sf):
    path = f"{_raw_files(spark, sf)}/train.csv"
    return load.load_sales(spark, path, load.load_sales(spark, path).table).table


@query
def load_test_job(spark, sf):
    path = f"{_raw_files(spark, sf)}/test.csv"
    return load.load_sales(spark, path, holdout=True).table


def _three_loads(spark: SparkSession, sf: str) -> tuple[StoredTable, list[DataFrame]]:
    """A stored table after the sales before 1997, all sales, and all sales again."""
    table = StoredTable(spark, scratch_path(spark, "stored_sales"), contracts.TRAIN)
    train = fixtures.train(spark, sf)
    early = R.write_csv(train.where("Date < '1997-01-01'"), scratch_path(spark, "early"))
    whole = R.write_csv(train, scratch_path(spark, "whole"))
    return table, [load.load_sales(spark, path, table).counts for path in (early, whole, whole)]


@query
def stored_loads(spark, sf):
    """A stored table after three loads, by the readers' way."""
    return _three_loads(spark, sf)[0].read()


@query
def stored_load_counts(spark, sf):
    _, counts = _three_loads(spark, sf)
    return union([c.select(F.lit(k).alias("load"), "*") for k, c in enumerate(counts, 1)])


@query
def stored_upsert(spark, sf):
    """A batch with nulls to set and rows to insert, merged into a stored table."""
    table = StoredTable(spark, scratch_path(spark, "stored_upsert"), contracts.TRAIN)
    table.merge(fixtures.train(spark, sf))
    hot = fixtures.train(spark, sf).where("IsHoliday").select(*KEY, F.col("Weekly_Sales") + 1, "IsHoliday")
    table.merge(hot.toDF(*KEY, "Weekly_Sales", "IsHoliday"))
    return table.read()


@query
def stored_merge(spark, sf):
    """The wide table merged into a stored one that has some of its rows, with other values."""
    table = StoredTable(spark, scratch_path(spark, "stored_wide"), contracts.MERGED)
    table.merge(wide(spark, sf).where("IsHoliday").withColumn("Weekly_Sales", F.lit(0.0)))
    parts = (fixtures.train(spark, sf), cleaned(spark, sf), fixtures.stores(spark, sf))
    return load.merge_tables(*parts, target=table)


@query
def load_rejects(spark, sf):
    """A store file with bad rows: what the load refuses, and why."""
    key = F.col("Store") % 6
    rows = as_text(fixtures.stores(spark, sf)).withColumns(
        {
            "Store": F.when(key == 0, F.lit(None)).when(key == 1, "x").otherwise(F.col("Store")),
            "Type": F.when(key == 2, "Z").otherwise(F.col("Type")),
            "Size": F.when(key == 3, F.lit(None)).when(key == 4, F.concat("Size", F.lit(".5"))).otherwise(F.concat("Size", F.lit(".0"))),
        }
    )
    loaded = load.load_stores(spark, R.write_csv(rows, scratch_path(spark, "bad_stores")))
    refused = loaded.rejected.select(
        "Store", "Type", "Size", F.array_join("violations", ",").alias("reasons")
    )
    kept = as_text(loaded.table).withColumn("reasons", F.lit(""))
    return refused.unionByName(kept)


@query
def load_twice_counts(spark, sf):
    """The same file twice: the second load inserts and updates nothing."""
    path = f"{_raw_files(spark, sf)}/features.csv"
    first = load.load_features(spark, path, promotion_start=START)
    second = load.load_features(spark, path, first.table, promotion_start=START)
    return union(
        [
            part.counts.select(F.lit(n).alias("load"), "inserted", "updated", "rejected")
            for n, part in ((1, first), (2, second))
        ]
    )


@query
def load_summary(spark, sf):
    loads = load.load_all(spark, _raw_files(spark, sf), promotion_start=START)
    return load.summary(loads)


@query
def load_preprocessed_summary(spark, sf):
    zones = preprocess.preprocess(spark, _raw_files(spark, sf), scratch_path(spark, "zones"), START)
    return load.summary(load.load_all(spark, zones.preprocessed(), preprocessed=True))


@query
def coerce_whole_numbers(spark, sf):
    """Order keys in several spellings, as whole numbers."""
    ln, key = F.col("l_linenumber"), F.col("l_orderkey").cast("string")
    text = (
        F.when(ln % 5 == 0, F.concat(key, F.lit(".0")))
        .when(ln % 5 == 1, F.concat(key, F.lit(".25")))
        .when(ln % 5 == 2, F.concat(F.lit("99999999999"), key))
        .when(ln % 5 == 3, F.concat(F.lit(" "), key))
        .otherwise(F.concat(key, F.lit("x")))
    )
    rows = fixtures.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("raw"))
    return rows.select("*", C.whole_number(F.trim("raw")).alias("number"))


@query
def load_merged_job(spark, sf):
    """Raw tables merged, written as the preprocessed file and loaded from there."""
    path = R.write_csv(wide(spark, sf), scratch_path(spark, "merged_train"))
    return load.load_merged(spark, path).table


@query
def merge_tables_job(spark, sf):
    """Merged again into a table whose holiday rows had been emptied."""
    full = wide(spark, sf)
    stale = full.withColumn(
        "Weekly_Sales", F.when(F.col("IsHoliday"), 0.0).otherwise(F.col("Weekly_Sales"))
    )
    return load.merge_tables(
        fixtures.train(spark, sf), cleaned(spark, sf), fixtures.stores(spark, sf), stale
    )
