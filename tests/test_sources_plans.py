import io
import re
from contextlib import redirect_stdout
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesflow import contracts, fixtures, session
from salesflow import queries as X
from salesflow.operators import windows as W
from salesflow.plans import clean, features, forecast, load, preprocess
from salesflow.sources import catalog
from salesflow.sources import readers as R
from salesflow.sources import zones as Z

SF = "/root/testdata/sf0.001"


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_csv_splits_lines_on_carriage_returns(spark, tmp_path):
    path = tmp_path / "stores.csv"
    path.write_bytes(b"Store,Type,Size\r1,A,10\r2,B,NA\r")
    got = R.scan_csv(spark, str(path), contracts.STORES.schema()).collect()
    assert [tuple(r) for r in got] == [(1, "A", 10), (2, "B", None)]


def test_input_order_follows_the_file(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("Store,Type,Size\n" + "".join(f"{i},A,{i}\n" for i in range(30_000)))
    small = {"spark.sql.files.maxPartitionBytes": "40000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    df = R.scan_csv(spark, str(path), contracts.STORES.schema(), input_order=True)
    assert df.rdd.getNumPartitions() > 3
    assert [r.Store for r in df.orderBy(R.ORDER).collect()] == list(range(30_000))
    for k, v in before.items():
        spark.conf.set(k, v)


def test_landing_skips_absent_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "stores.csv").write_text("Store,Type,Size\n1,A,10\n")
    zones = Z.Zones(str(tmp_path / "base"))
    assert Z.land(spark, str(tmp_path / "in"), zones.raw()) == ["stores.csv"]
    done = clean.clean_zone(spark, zones.raw(), zones.base)
    assert set(done) == {"stores"}
    assert done["stores"].collect() == [(1, "A", 10)]


def test_last_line_of_the_file_wins(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text(
        "Store,Dept,Date,Weekly_Sales,IsHoliday\n"
        "1,1,05/02/2010,10.0,FALSE\n1,1,2010-02-05,20.0,TRUE\n1,1,2010-02-05,NA,TRUE\n"
    )
    once = load.load_sales(spark, str(path))
    # The last line has no value: it sets the holiday and leaves the sale.
    assert once.table.collect() == [(1, 1, date(2010, 2, 5), 20.0, True)]
    assert once.rejected.count() == 0 and tuple(once.counts.first()) == (1, 0, 0)


def test_a_line_without_a_sale_needs_one_before(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text(
        "Store,Dept,Date,Weekly_Sales,IsHoliday\n1,1,2010-02-05,NA,TRUE\n2.0,1,2010-02-05,NA,TRUE\n"
        ",1,2010-02-05,3,TRUE\n3.5,1,2010-02-05,3,TRUE\n4,1,someday,3,TRUE\n5,1,2010-02-05,3,TRUE\n"
    )
    old = spark.createDataFrame([(1, 1, date(2010, 2, 5), 7.0, False)], contracts.TRAIN.schema())
    done = load.load_sales(spark, str(path), old)
    assert sorted(done.table.collect()) == [(1, 1, date(2010, 2, 5), 7.0, True), (5, 1, date(2010, 2, 5), 3.0, True)]
    reasons = sorted((r.Store, *r.violations) for r in done.rejected.fillna("").collect())
    assert reasons == [
        ("", "required:Store"), ("2", "required:Weekly_Sales"), ("3.5", "type:Store"), ("4", "type:Date"),
    ]
    assert tuple(done.counts.first()) == (1, 1, 4)
    again = load.load_sales(spark, str(path), done.table)
    assert tuple(again.counts.first()) == (0, 0, 4)


def test_tables_from_files_and_documents(spark, tmp_path):
    base = str(tmp_path / "zone")
    wide, cleaned = X.wide(spark, SF), X.cleaned(spark, SF)
    stores, test = fixtures.stores(spark, SF), fixtures.test(spark, SF)
    zones = Z.Zones(base)
    suffixed = wide.withColumnRenamed("IsHoliday", "IsHoliday_x").withColumn("IsHoliday_y", F.col("IsHoliday_x"))
    R.write_csv(suffixed, zones.preprocessed("merged_train.csv"))
    R.write_csv(cleaned, zones.preprocessed("features_cleaned.csv"))
    R.write_csv(stores, zones.preprocessed("stores.csv"))
    R.write_csv(test, zones.raw("test.csv"))
    for name, df in {"merged_data": wide, "features": cleaned, "stores": stores}.items():
        R.write_documents(df.withColumn("_id", F.lit("x")), f"{base}/{name}")
    for source in ("files", "documents"):
        got = catalog.load_tables(spark, source, base=base)
        assert got.merged.exceptAll(wide).count() == 0 and got.merged.count() == wide.count()
        assert got.features.count() == cleaned.count()
        assert got.stores.exceptAll(stores).count() == 0
        assert got.test.count() == test.count()
    with pytest.raises(ValueError, match="unknown source"):
        catalog.load_tables(spark, "carrier pigeon")


def test_stores_are_broadcast_and_columns_pruned(spark):
    plan = plan_of(X.QUERIES["report_type_holiday"](spark, SF))
    assert re.search(r"BroadcastHashJoin \[Store#\d+\], \[Store#\d+\], Inner, BuildRight", plan)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    scans = re.findall(r"PushedFilters: \[[^\]]*LessThan\(l_shipdate", plan)
    assert scans and "l_tax" not in plan


def test_both_window_kinds_share_one_exchange_and_sort(spark):
    schema = "Store int, Dept int, Date date, CPI double, Unemployment double, Weekly_Sales double"
    df = spark.createDataFrame([(1, 1, date(2012, 1, 2), 1.0, 1.0, 1.0)], schema)
    plan = plan_of(W.add_sales_features(df))
    assert len(re.findall(r"Exchange hashpartitioning\(Store", plan)) == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1


def test_partitioned_layout_prunes(spark, tmp_path):
    path = R.write_parquet(X.wide(spark, SF), str(tmp_path / "t"), ["Year", "Month"], X.KEY)
    df = R.scan_parquet(spark, path).where("Year = 1999 AND Month = 2 AND Store = 3")
    plan = plan_of(df)
    assert re.search(r"PartitionFilters: \[[^\]]*Year", plan)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(Store,3\)", plan)
    assert df.count() == X.wide(spark, SF).where("Year = 1999 AND Month = 2 AND Store = 3").count()


def test_no_query_uses_a_cartesian_product(spark):
    for name in ("iqr_outliers", "histogram_sales", "box_by_type", "metrics_classes"):
        plan = plan_of(X.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_forecast_features_align_test_with_train(spark):
    test = X.J.scoring_input(fixtures.test(spark, SF), X.cleaned(spark, SF), fixtures.stores(spark, SF))
    made = features.forecast_features(X.wide(spark, SF), test.drop("Size"))
    assert set(made.columns) <= set(made.test.columns)
    assert made.test.count() == test.count()
    for c in made.columns:
        assert made.train.where(F.col(c).isNull()).count() == 0
    assert "Weekly_Sales" not in made.columns and "IsHoliday" in dict(made.train.dtypes)
    assert dict(made.train.dtypes)["IsHoliday"] == "int"


def test_forecast_run(spark, tmp_path):
    learners = {"LinearRegression": X.M.linear(), "RandomForest": X.M.forest(numTrees=3, maxDepth=4)}
    run = forecast.run(X._inputs(spark, SF), learners, output=str(tmp_path))
    assert run.best in learners
    assert run.comparison.count() == 2
    assert run.predictions.count() == fixtures.test(spark, SF).count()
    saved = R.scan_csv(spark, str(tmp_path / "predictions"))
    assert saved.columns == ["Store", "Dept", "Date", "Predicted_Weekly_Sales"]
    assert run.fitted.columns == [*X.KEY, "actual", "prediction"]


def _unrelated(rows):
    """Sales that no column is related to: each store and week has the same ones, mean 20."""
    days = [date(2010, 1, 4 + 7 * w) for w in range(4)]
    sales = [(s, d, day, v) for s in (1, 2) for day in days for d, v in ((1, 10.0), (2, 30.0), (3, 10.0), (4, 30.0), (5, 20.0))]
    flat = [(s, day, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, False) for s in (1, 2) for day in days]
    names = [f"{f.name} {f.type}" for f in contracts.RAW_FEATURES.fields]
    # A department has the same mean as the opposite one.
    train = rows("Store int, Dept int, Date date, Weekly_Sales double, IsHoliday boolean", *[(s, abs(d - 3), day, v, False) for s, d, day, v in sales])
    return train, rows(", ".join(names), *flat), rows("Store int, Type string, Size int", (1, "A", 5), (2, "A", 5))


def test_forecast_without_a_related_feature_predicts_the_mean(spark, rows, tmp_path):
    train, feats, stores = _unrelated(rows)
    test = train.drop("Weekly_Sales").withColumn("Date", F.date_add("Date", 700))
    feats = X.C.clean_promotions(feats, start="2012-01-01")
    assert features.forecast_features(X.J.merge_wide(train, feats, stores), types=stores).columns == []
    settings = {"trees": 3, "depth": 3}
    learners = {
        "LinearRegression": X.M.linear(),
        "Ridge": X.M.ridge(),
        "RandomForest": X.M.histograms(X.H.Settings(**settings, rate=1.0, penalty=0.0, boosted=False, rows=0)),
        "GradientBoosting": X.M.boosted(maxIter=3, maxDepth=3),
        "SampledBoosting": X.M.histograms(X.H.Settings(**settings)),
    }
    inputs = catalog.ForecastInputs(X.J.merge_wide(train, feats, stores), feats, stores, test)
    run = forecast.run(inputs, learners, output=str(tmp_path))
    assert {r.Model for r in run.comparison.collect()} == set(learners)
    kept = X.split(inputs.merged, key=X.KEY)[0].agg(F.avg("Weekly_Sales")).first()[0]
    for name, model in run.models.items():
        found = X.M.score(model, test, []).collect()
        assert len(found) == test.count(), name
        assert all(r.Predicted_Weekly_Sales == pytest.approx(kept, abs=0.01) for r in found), name
        if hasattr(model, "featureImportances"):
            assert X.M.importances(train, model, []).count() == 0


def test_forecast_features_query_without_a_related_feature(spark, rows, monkeypatch):
    train, feats, stores = _unrelated(rows)
    monkeypatch.setattr(X.fixtures, "train", lambda *_: train)
    monkeypatch.setattr(X.fixtures, "test", lambda *_: train.drop("Weekly_Sales"))
    monkeypatch.setattr(X.fixtures, "features", lambda *_: feats)
    monkeypatch.setattr(X.fixtures, "stores", lambda *_: stores)
    found = X.forecast_features(spark, "")
    assert found.collect() == [] and found.columns == [*X.KEY, "feature", "value"]


def test_a_load_parses_its_file_once(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text("Store,Dept,Date,Weekly_Sales,IsHoliday\n1,1,2010-02-05,1.5,false\n1,1,05/02/2010,2.5,false\n1,x,2010-02-05,1,true\n1,2,2010-02-05\n")
    found = load.load_sales(spark, str(path))
    assert [tuple(r) for r in found.table.collect()] == [(1, 1, date(2010, 2, 5), 2.5, False)]
    assert sorted((r.Dept, r.violations) for r in found.rejected.collect() if r.Dept == "x") == [("x", ["type:Dept"])]
    assert any(r.violations == ["line:1,2,2010-02-05"] for r in found.rejected.collect())
    assert found.counts.first().asDict() == {"inserted": 1, "updated": 0, "rejected": 2}
    # The table is made of typed rows: nothing is parsed again when it is read.
    for made in (found.table, found.counts, found.rejected):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "gettimestamp" not in plan and "decimal(38,10)" not in plan


def test_documents_are_written_compressed(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 2 else f"text {i}") for i in range(1000)], "long_field_name int, other string")
    path = R.write_documents(df, str(tmp_path / "docs"))
    files = [f for f in (tmp_path / "docs").iterdir() if f.name.startswith("part-")]
    assert files and all(f.name.endswith(".json.gz") for f in files)
    back = R.scan_documents(spark, path, schema=df.schema)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == [tuple(r) for r in df.collect()]


def test_views_are_grouped_and_joined_by_one_shuffle(spark, monkeypatch):
    """Lines of both sides go once to the tasks of their store and week; the file's size says how many."""
    monkeypatch.setattr(fixtures, "TASK_BYTES", 20_000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = X.J.join_features(fixtures.train(spark, SF), fixtures.features(spark, SF))
    text = plan_of(joined)
    tasks = -(-Path(SF, "lineitem.parquet").stat().st_size // 20_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert tasks > 4
    assert text.count("Exchange hashpartitioning(Store") == 2
    assert len(re.findall(rf"hashpartitioning\(Store#\d+, Date#\d+, {tasks}\), REPARTITION_BY_NUM", text)) == 2
    assert text.count("Exchange ") == 4


def _shuffled(spark) -> int:
    """Shuffle files that lie about."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    return blocks.diskBlockManager().getAllFiles().mkString("|").count("shuffle_")


def test_what_is_written_leaves_no_shuffle_files(spark, tmp_path):
    df = spark.range(1000).repartition(3, "id")
    before = _shuffled(spark)
    R.write_csv(df, str(tmp_path / "csv"))
    R.write_parquet(df, str(tmp_path / "parquet"))
    kept = session.cut(df, release=True)
    assert _shuffled(spark) <= before and kept.count() == 1000
    # The setting is the caller's again.
    assert spark.conf.get(session._RELEASE) == "false"
    assert R.scan_csv(spark, str(tmp_path / "csv"), df.schema).count() == df.count() == 1000


def test_csv_is_written_compressed(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 1.5), (2, "a,b", None)], "k int, t string, v double")
    path = R.write_csv(df, str(tmp_path / "t.csv"))
    files = [f for f in (tmp_path / "t.csv").iterdir() if f.name.startswith("part-")]
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    back = R.scan_csv(spark, path, df.schema, input_order=True).orderBy(R.ORDER).drop(R.ORDER)
    assert back.collect() == df.collect()


def test_a_load_holds_its_lines_only_while_it_runs(spark, tmp_path):
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    path = R.write_csv(spark.range(300).select(F.col("id").alias("Store"), F.lit("A").alias("Type"), F.lit(7).alias("Size")), str(tmp_path / "s.csv"))
    done = load.load_stores(spark, path)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= held
    # A first load has nothing to meet: its batch is not shuffled again.
    assert "Exchange" not in plan_of(done.table)
    assert done.table.count() == 300 and tuple(done.counts.first()) == (300, 0, 0)


def test_preprocessing_holds_no_table_that_grows(spark, tmp_path, monkeypatch):
    held, kept = [], preprocess.kept
    monkeypatch.setattr(preprocess, "kept", lambda df: (held.append(df.columns), kept(df))[1])
    zones = preprocess.preprocess(spark, X._raw_files(spark, SF), str(tmp_path / "zone"), X.START)
    assert held == [["Store", "Type", "Size"]]
    assert clean.read_raw(spark, zones.preprocessed("features_cleaned.csv"), contracts.FEATURES).count() == fixtures.features(spark, SF).count()
