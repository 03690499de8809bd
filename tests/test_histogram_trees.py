"""Trees from histograms against plain loops over all splits, and on any partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesflow.operators import histogram_trees as H

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(400):
        a, b, c = int(rng.integers(12)), int(rng.integers(5)), float(rng.integers(30)) / 2
        rows.append((a, b, c, float(10 * (a > 4) + 5 * (b == 2) * (c > 6) + rng.integers(4))))
    return spark.createDataFrame(rows, "a int, b int, c double, y double").cache()


def plain(x, y, depth, penalty, least_rows, split_rows, rate=1.0, base=None):
    """Predictions of one tree by trying every split of every node."""
    g = (y.mean() if base is None else base) - y
    out = np.zeros(len(y))

    def score(v):
        return v.sum() ** 2 / (len(v) + penalty)

    def grow(at, level):
        out[at] = -rate * g[at].sum() / (len(at) + penalty)
        if level == depth or len(at) < split_rows:
            return
        best = (0.0, None)
        for c in range(x.shape[1]):
            values = np.unique(x[:, c])
            for edge in (values[:-1] + values[1:]) / 2:
                low = x[at, c] <= edge
                if min(low.sum(), (~low).sum()) < least_rows:
                    continue
                gain = round(score(g[at[low]]) + score(g[at[~low]]) - score(g[at]), 9)
                if gain > best[0]:
                    best = (gain, low)
        if best[1] is not None:
            grow(at[best[1]], level + 1)
            grow(at[~best[1]], level + 1)

    grow(np.arange(len(y)), 0)
    return out


def arrays(frame):
    pandas = frame.toPandas()
    return pandas[FEATURES].to_numpy(float), pandas["y"].to_numpy()


@pytest.mark.parametrize(
    ("depth", "penalty", "least", "split"), [(1, 0.0, 1, 2), (3, 0.0, 2, 5), (3, 1.0, 20, 60), (4, 5.0, 1, 200), (0, 0.0, 1, 2)]
)
def test_one_tree_equals_all_splits_tried(frame, depth, penalty, least, split):
    settings = H.Settings(trees=1, depth=depth, penalty=penalty, least_rows=least, split_rows=split, boosted=False)
    model = H.fit(frame, FEATURES, "y", settings)
    x, y = arrays(frame)
    want = y.mean() + plain(x, y, depth, penalty, least, split)
    assert model.values(x.T) == pytest.approx(want, abs=1e-4)
    got = model.predict(frame).toPandas()
    assert got["prediction"].to_numpy() == pytest.approx(model.values(got[FEATURES].to_numpy(float).T))


def test_rounds_of_boosting_equal_all_splits_tried(frame):
    settings = H.Settings(trees=3, depth=2, rate=0.3, penalty=1.0)
    model = H.fit(frame, FEATURES, "y", settings)
    x, y = arrays(frame)
    want = np.full(len(y), y.mean())
    for _ in range(3):
        want = want + plain(x, y - want, 2, 1.0, 1, 2, rate=0.3, base=0.0)
    assert model.values(x.T) == pytest.approx(want, abs=1e-4)


@pytest.mark.parametrize("boosted", [True, False])
def test_the_same_model_on_any_partitioning(frame, boosted):
    settings = H.Settings(trees=4, depth=3, rows=0.8, columns=0.7, boosted=boosted)
    models = [H.fit(frame.repartition(n).orderBy(F.rand(n)), FEATURES, "y", settings) for n in (1, 7)]
    assert models[0] == models[1]
    used = [{c for c, _ in t.splits.values()} for t in models[0].trees]
    assert all(len(u) <= 2 for u in used)
    x, y = arrays(frame)
    assert len({tuple(sorted(t.leaves.items())) for t in models[0].trees}) == 4
    assert ((models[0].values(x.T) - y) ** 2).mean() < y.var()


@pytest.mark.parametrize("boosted", [True, False])
def test_nodes_finished_in_a_task_are_the_same(frame, monkeypatch, boosted):
    settings = H.Settings(trees=3, depth=5, rows=0.9, columns=0.7, split_rows=5, least_rows=2, boosted=boosted, penalty=0.5)
    models = []
    for rows, sums in ((50_000, 4_000_000), (60, 4_000_000), (0, 4_000_000), (0, 500)):
        monkeypatch.setattr(H, "LOCAL_ROWS", rows)
        monkeypatch.setattr(H, "MOST_SUMS", sums)
        models.append(H.fit(frame, FEATURES, "y", settings))
    assert all(m == models[0] for m in models[1:])


@pytest.mark.parametrize("local", [0, 60])
def test_a_pass_walks_no_more_trees_than_are_not_yet_in_the_scores(frame, monkeypatch, local):
    settings = H.Settings(trees=7, depth=2, rate=0.3, rows=0.8, columns=0.7)
    monkeypatch.setattr(H, "LOCAL_ROWS", local)
    walked, sums = [], H._sums
    monkeypatch.setattr(H, "_sums", lambda rows, before, *more: (walked.append(len(before)), sums(rows, before, *more))[1])
    whole = H.fit(frame, FEATURES, "y", settings)
    assert max(walked) == 6
    monkeypatch.setattr(H, "CARRIED", 2)
    walked.clear()
    assert H.fit(frame, FEATURES, "y", settings) == whole
    assert max(walked) == 1


def test_split_rows_refuses_small_nodes(frame):
    model = H.fit(frame, FEATURES, "y", H.Settings(trees=1, depth=9, penalty=0.0, split_rows=100, boosted=False))
    x, _ = arrays(frame)
    tree = model.trees[0]
    numbers, _ = H._walk(H._in_bins(tree, H.thresholds(frame, FEATURES)), np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(H.thresholds(frame, FEATURES))]))
    for node in tree.splits:
        below = sum(int(n) >> (int(n).bit_length() - node.bit_length()) == node for n in numbers if int(n) >= node)
        assert below >= 100


def test_importances_are_shares_of_the_gains(frame):
    shares = H.fit(frame, FEATURES, "y", H.Settings(trees=2, depth=3)).importances()
    assert sum(s for _, s in shares) == pytest.approx(1) and shares[0][0] == "a"
    assert [s for _, s in shares] == sorted((s for _, s in shares), reverse=True)


def test_odd_rows(spark, frame):
    settings = H.Settings(trees=2, depth=2)
    none = H.fit(frame.limit(0), FEATURES, "y", settings)
    assert none.predict(frame).select(F.max("prediction")).first()[0] == 0
    rows = spark.createDataFrame(
        [(1, None, float("nan"), 1.0), (None, 2, 3.0, 2.0), (1, 2, 3.0, None)] * 5, "a int, b int, c double, y double"
    )
    model = H.fit(rows, FEATURES, "y", settings)
    assert model.base == 1.5
    assert model.predict(rows).where("prediction is null").count() == 0
    same = spark.createDataFrame([(1, 1, 1.0, 4.0)] * 9, "a int, b int, c double, y double")
    assert H.fit(same, FEATURES, "y", settings).predict(same).first().prediction == 4.0


def test_many_values_get_bins_of_like_size(spark):
    rows = spark.range(20_000).selectExpr("cast(id as double) a", "cast(id % 7 as double) b", "0.0 c", "cast(id as double) y")
    edges = H.thresholds(rows, FEATURES, bins=64)
    assert len(edges[0]) == 63 and list(edges[1]) == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5] and len(edges[2]) == 0
    counts = np.diff([0, *np.searchsorted(np.arange(20_000), edges[0], "right"), 20_000])
    assert counts.max() < 2 * 20_000 / 64
    model = H.fit(rows, FEATURES, "y", H.Settings(trees=1, depth=6, bins=64, boosted=False, penalty=0.0))
    error = model.predict(rows).agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert error < 200


def test_a_frequent_value_leaves_bins_to_the_others(spark):
    rows = spark.range(10_000).selectExpr("cast(if(id % 10 = 0, id, 0) as double) a", "0.0 b", "0.0 c", "cast(id as double) y")
    edges = H.thresholds(rows, FEATURES, bins=64)[0]
    assert len(edges) >= 60 and edges[0] == 0 and len(np.unique(edges)) == len(edges)


def test_rows_travel_in_blocks(frame, monkeypatch):
    settings = H.Settings(trees=3, depth=3, rate=0.3, rows=0.8, columns=0.7)
    monkeypatch.setattr(H, "LOCAL_ROWS", 0)
    passed, sums = [], H._sums
    monkeypatch.setattr(H, "_sums", lambda rows, *more: (passed.append((rows.rdd.getNumPartitions(), rows.count())), sums(rows, *more))[1])
    count, wide = frame.count(), frame.repartition(7)
    models = []
    for block, task in ((1 << 16, 50_000), (100, 50_000), (100, count // 3)):
        monkeypatch.setattr(H, "BLOCK_ROWS", block)
        monkeypatch.setattr(H, "TASK_ROWS", task)
        models.append(H.fit(wide, FEATURES, "y", settings))
    assert models[0] == models[1] == models[2]
    assert {1} == {parts for parts, blocks in passed if blocks == 1} and max(parts for parts, _ in passed) == 3
    assert max(blocks for _, blocks in passed) < count / 50


@pytest.mark.parametrize("large", [1, 1 << 52, 1 << 62])
def test_parts_of_gradients_add_up_exactly(large):
    g = np.array([large, 3, -large + 1, -5, large - 7], np.int64)
    high, low = H._halves(g)
    assert (int(high.sum()) << 20 if high is not None else 0) + int(low.sum()) == sum(int(v) for v in g)
    assert (high is None) == (large == 1)
