import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesflow.operators import evaluate as V
from salesflow.operators import models as M
from salesflow.operators.split import mark_holdout, split


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 3))
    y = 3 * x[:, 0] - 2 * x[:, 1] + np.where(x[:, 2] > 0, 4, 0) + 10 + 0.1 * rng.normal(size=600)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["Weekly_Sales"], pdf["id"] = y, range(600)
    return spark.createDataFrame(pdf).persist()


def test_split_is_disjoint_complete_and_stable(planted):
    train, test = split(planted, key=["id"])
    assert train.count() + test.count() == 600
    assert train.select("id").intersect(test.select("id")).count() == 0
    again = mark_holdout(planted.repartition(9), ["id"]).where("is_test")
    assert again.select("id").exceptAll(test.select("id")).count() == 0
    other = mark_holdout(planted, ["id"], seed=7).where("is_test")
    assert other.select("id").exceptAll(test.select("id")).count() > 0


def test_regression_metrics_equal_numpy(spark):
    y, p = np.array([1.0, 2.0, 4.0, 9.0]), np.array([1.5, 2.0, 3.0, 7.0])
    df = spark.createDataFrame(pd.DataFrame({"Weekly_Sales": y, "prediction": p}))
    row = V.regression_metrics(df).first()
    assert row.MAE == pytest.approx(np.abs(y - p).mean())
    assert row.RMSE == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert row.R2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_class_metrics(spark):
    y = np.arange(1.0, 9.0)
    p = np.array([1.0, 2, 9, 4, 5, 6, 1, 8])
    df = spark.createDataFrame(pd.DataFrame({"Weekly_Sales": y, "prediction": p}))
    two = V.class_metrics(df).first()
    # High from 6.25 on: labels 7 and 8; said of 3 and 8.
    assert two.Accuracy == pytest.approx(6 / 8)
    assert two.Precision == pytest.approx((6 * 5 / 6 + 2 * 1 / 2) / 8)
    assert two.Recall == pytest.approx(6 / 8)
    three = V.class_metrics(df, merge_low=False).first()
    assert three.Accuracy < 1 and three.Recall == pytest.approx(three.Accuracy)


def test_value_on_an_edge_is_in_the_upper_class(rows):
    df = rows("v double", (1.0,), (2.0,), (3.0,))
    low, high = F.lit(2.0), F.lit(3.0)
    assert [r[0] for r in df.select(V.sales_class(F.col("v"), low, high)).collect()] == [0, 0, 1]
    three = df.select(V.sales_class(F.col("v"), low, high, merge_low=False)).collect()
    assert [r[0] for r in three] == [0, 1, 2]


def test_ridge_has_the_closed_form(planted):
    x = planted.toPandas()
    centred = x[["a", "b", "c"]] - x[["a", "b", "c"]].mean()
    y = x["Weekly_Sales"] - x["Weekly_Sales"].mean()
    want = np.linalg.solve(centred.T @ centred + 50.0 * np.eye(3), centred.T @ y)
    model = M.fit(M.ridge(50.0), M.assemble(planted, ["a", "b", "c"]))
    assert np.allclose(model.coefficients.toArray(), want, atol=1e-6)


def test_models_beat_the_mean_and_repeat(planted):
    features = ["a", "b", "c"]
    train, test = split(planted, key=["id"])
    chosen = {
        "LinearRegression": M.linear(),
        "RandomForest": M.forest(numTrees=5, maxDepth=5),
        "GradientBoosting": M.boosted(maxIter=5, maxDepth=3),
    }
    runs = [
        M.compare(M.assemble(train, features), M.assemble(test, features), chosen)
        for _ in range(2)
    ]
    tables = [{r.Model: r for r in table.collect()} for _, table in runs]
    assert set(tables[0]) == set(chosen)
    assert all(r.Test_R2 > 0.3 for r in tables[0].values())
    assert runs[0][1].columns == ["Model", *V.METRICS]
    for name in chosen:
        assert tables[0][name].Test_RMSE == pytest.approx(tables[1][name].Test_RMSE)
    forest = runs[0][0]["RandomForest"]
    ranked = M.importances(planted, forest, features).collect()
    assert {r.feature for r in ranked[:2]} <= {"a", "b", "c"}
    assert sum(r.score for r in ranked) == pytest.approx(1.0)


def test_score_names_its_columns(planted):
    model = M.fit(M.linear(), M.assemble(planted, ["a", "b", "c"]))
    keyed = planted.select(
        F.col("id").alias("Store"), F.lit(1).alias("Dept"), F.current_date().alias("Date"), "a", "b",
        F.when(F.col("id") > 5, F.col("c")).alias("c"),
    )
    out = M.score(model, keyed, ["a", "b", "c"])
    assert out.columns == ["Store", "Dept", "Date", "Predicted_Weekly_Sales"]
    assert out.where("Predicted_Weekly_Sales IS NULL").count() == 0 and out.count() == 600


def test_full_settings_are_there(planted):
    assert list(M.learners()) == [
        "LinearRegression",
        "Ridge",
        "RandomForest",
        "GradientBoosting",
        "SampledBoosting",
    ]
    forest = M.learners()["RandomForest"](planted)
    s = forest.settings
    assert (s.trees, s.depth, s.least_rows, s.split_rows, s.bins, s.boosted) == (100, 20, 2, 5, 256, False)
    s = M.learners()["SampledBoosting"](planted).settings
    assert (s.trees, s.depth, s.rate, s.rows, s.columns, s.boosted) == (200, 8, 0.1, 0.8, 0.8, True)


def test_models_do_not_depend_on_the_partitioning(planted):
    train = M.assemble(planted, ["a", "b", "c"])
    settings = {"numTrees": 5, "maxDepth": 6, "maxBins": M.BINS}
    found = [
        M.predict(M.fit(M.forest(**settings), train.repartition(n)), train).orderBy(M.TARGET).select("prediction").collect()
        for n in (1, 3, 7)
    ]
    assert found[0] == found[1] == found[2]


def test_partitions_grow_with_the_rows_only_beyond_their_fill(spark):
    few, many = (
        M.assemble(spark.range(n).select("id", F.col("id").cast("double").alias(M.TARGET)), ["id"]) for n in (12_000, 600_000)
    )
    assert M.arranged(few).rdd.getNumPartitions() == 3
    assert M.arranged(many).rdd.getNumPartitions() <= 96
    assert M.arranged(many).count() == 600_000


def test_shallow_forests_keep_no_node_per_row_and_tree(planted):
    small, deep = M.forest(**M.SMALL_FOREST)(planted), M.forest(numTrees=2, maxDepth=20)(planted)
    assert not small.getCacheNodeIds() and deep.getCacheNodeIds()
    rows = M.arranged(M.assemble(planted, ["a", "b", "c"])).persist()
    trees = [small.copy({small.cacheNodeIds: kept}).fit(rows).toDebugString.split("\n", 1)[1] for kept in (False, True)]
    rows.unpersist()
    assert trees[0] == trees[1]
