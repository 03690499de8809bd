import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesflow.operators import selection as S
from salesflow.operators import stats as D
from salesflow.operators.quantiles import exact_quantiles, summary


def quantiles(df, probs, **options):
    out = exact_quantiles(df, "v", probs, **options).collect()
    return {r.prob: r.quantile for r in out}


def test_quartiles(rows):
    df = rows("v double", (1.0,), (2.0,), (3.0,), (4.0,), (None,), (float("nan"),))
    assert quantiles(df, [0.25, 0.75]) == {0.25: 1.75, 0.75: 3.25}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(
        st.one_of(
            st.floats(-1e6, 1e6),
            st.sampled_from([0.0, 1.0, 1e300, -1e300, 5e-324]),
        ),
        min_size=1,
        max_size=60,
    ),
    task_rows=st.sampled_from([1, 3, 1000]),
)
def test_narrowing_finds_the_same_quantiles(rows, values, task_rows):
    df = rows("v double", *[(float(v),) for v in values])
    got = quantiles(df, [0.0, 0.25, 0.5, 1.0], task_rows=task_rows, bins=4)
    data = sorted(values)
    for p, q in got.items():
        at = p * (len(data) - 1)
        low, high = data[int(np.floor(at))], data[int(np.ceil(at))]
        assert q == pytest.approx(low + (high - low) * (at - np.floor(at)), rel=1e-12)


def test_narrowing_per_group_with_a_hot_group(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("g"),
        F.when(F.col("id") % 5 == 0, 7.0).otherwise(F.pow(F.rand(1) * 10, 4)).alias("v"),
    ).persist()
    got = summary(df, "v", {"q1": 0.25, "q3": 0.75}, ["g"], task_rows=20, bins=8)
    want = df.groupBy("g").agg(F.percentile("v", 0.25).alias("q1"), F.percentile("v", 0.75).alias("q3"))
    a = got.toPandas().set_index("g").sort_index()
    b = want.toPandas().set_index("g").sort_index()
    pd.testing.assert_frame_equal(a, b)
    df.unpersist()


def test_outliers_and_boxes(rows):
    df = rows("k string, v double", *[("a", float(x)) for x in [1, 2, 3, 4, 100]], (None, 5.0))
    bounds = D.iqr_bounds(df.where("k = 'a'"), "v").first()
    assert (bounds.q1, bounds.q3, bounds.outlier_count) == (2.0, 4.0, 1)
    assert D.iqr_outliers(df.where("k = 'a'"), "v").collect() == [("a", 100.0)]
    box = D.box_stats(df, "k", "v").collect()
    assert len(box) == 1
    assert (box[0].median, box[0].whisker_low, box[0].whisker_high) == (3.0, 1.0, 4.0)


def test_describe_equals_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, None, 7.5], "b": [3, 1, 4, 1], "s": list("wxyz")})
    df = spark.createDataFrame(pdf).withColumn("none", F.lit(None).cast("double"))
    got = D.describe(df).toPandas().set_index("column")
    assert got.loc["none", "count"] == 0 and np.isnan(got.loc["none", "mean"])
    got = got.drop("none")
    want = pdf[["a", "b"]].describe().T
    for name, other in {"p25": "25%", "p50": "50%", "p75": "75%", "mean": "mean", "std": "std"}.items():
        assert np.allclose(got[name], want[other].loc[got.index])


def test_histogram_puts_the_maximum_into_the_last_bin(rows):
    df = rows("v double", (0.0,), (10.0,), (4.9,), (None,))
    counts = {r.bin: r.row_count for r in D.histogram(df, "v", 10).collect()}
    assert counts[1] == 1 and counts[5] == 1 and counts[10] == 1 and sum(counts.values()) == 3
    same = rows("v double", (5.0,), (5.0,))
    assert sum(r.row_count for r in D.histogram(same, "v", 10).collect()) == 2


def test_density_equals_numpy(spark):
    values = np.random.default_rng(1).normal(size=200)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = D.density(df, "v", points=20, scale_to_bins=None).orderBy("point").toPandas()
    h = values.std(ddof=1) * len(values) ** -0.2
    z = (got["x"].to_numpy()[:, None] - values[None, :]) / h
    want = np.exp(-z * z / 2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert np.allclose(got["density"], want)


def test_density_of_far_and_crowded_values_equals_numpy(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=3_000), np.full(1_000, 2.5), rng.normal(1e4, 5.0, size=50), [-1e6]])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    for bandwidth in (None, 0.01, 3.0):
        got = D.density(df, "v", points=301, bandwidth=bandwidth, scale_to_bins=None).orderBy("point").toPandas()
        h = bandwidth or values.std(ddof=1) * len(values) ** -0.2
        z = (got["x"].to_numpy()[:, None] - values[None, :]) / h
        want = np.exp(-z * z / 2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
        assert np.allclose(got["density"], want, rtol=1e-9, atol=1e-11 / h)


def test_correlations_equal_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(1e6, 1.0, size=(300, 4)), columns=list("abcd"))
    pdf["b"] += pdf["a"]
    pdf.loc[rng.random(300) < 0.3, "c"] = np.nan
    pdf.loc[rng.random(300) < 0.3, "d"] = np.nan
    pdf["e"] = 5.0
    df = spark.createDataFrame(pdf).repartition(5)
    df = df.select([F.when(~F.isnan(c), F.col(c)).alias(c) for c in df.columns])
    want = pdf.corr()
    got = D.correlation_matrix(df).collect()
    assert len(got) == 10
    for r in got:
        if "e" in (r.f1, r.f2):
            assert r.corr is None
        else:
            assert r.corr == pytest.approx(want.loc[r.f1, r.f2], abs=1e-9)
    target = {r.feature: r.corr for r in D.target_correlations(df, "a").collect()}
    assert target["b"] == pytest.approx(want.loc["a", "b"], abs=1e-9)


def test_scatter_sample_is_the_same_on_any_partitioning(spark):
    df = spark.range(1000).select("id", F.rand(1).alias("x"), F.rand(2).alias("y")).persist()
    a = D.scatter_points(df.repartition(1), "x", "y", ["id"], 0.2)
    b = D.scatter_points(df.repartition(7), "x", "y", ["id"], 0.2)
    assert 120 < a.count() < 280
    assert a.exceptAll(b).count() == 0
    df.unpersist()


def test_selection(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(size=500)
    a = y + rng.normal(size=500)
    pdf = pd.DataFrame({"y": y, "a": a, "b": 2 * a, "c": y * 0.5 + rng.normal(size=500), "k": 5.0})
    df = spark.createDataFrame(pdf)
    verdicts = {v.feature: v for v in S.judge_features(df, "y")}
    assert verdicts["a"].status == "kept"
    assert (verdicts["b"].status, verdicts["b"].redundant_with) == ("redundant", "a")
    assert verdicts["c"].status == "kept"
    assert verdicts["k"].status == "low" and verdicts["k"].corr is None
    assert S.judge_features(df, "none") == []
    assert [r.feature for r in S.related_to_target(df, "y").collect()][:2] == ["a", "b"]


def test_selection_never_keeps_a_pair_above_the_threshold(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(200, 3))
    mixed = base @ rng.normal(size=(3, 8)) + 0.1 * rng.normal(size=(200, 8))
    pdf = pd.DataFrame(mixed, columns=[f"c{i}" for i in range(8)])
    verdicts = S.judge_features(spark.createDataFrame(pdf), "c0", redundancy=0.8)
    kept = S.selected(verdicts)
    corr = pdf[kept].corr().abs().to_numpy()
    assert (corr[~np.eye(len(kept), dtype=bool)] <= 0.8).all()


def test_narrowing_reads_the_source_once(spark):
    """Rounds read held keys and values: each row of the source is made once."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    df = spark.range(400).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    got = summary(df.mapInArrow(count, "g bigint, v double"), "v", {"q": 0.5}, ["g"], task_rows=10, bins=4)
    assert sorted(map(tuple, got.collect())) == [(0, 199.0), (1, 200.0)]
    assert made.value == 400
