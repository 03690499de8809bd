from datetime import date

import pytest
from pyspark.sql import functions as F

from salesflow import contracts
from salesflow.operators import checks as Q
from salesflow.operators import quantiles
from salesflow.operators import upsert as U

D = date(2012, 1, 2)


def test_violations(rows):
    df = rows(
        "Store string, Type string, Size string",
        ("1", "A", "10"),
        (None, "D", "ten"),
        ("2", " ", "5"),
    )
    got = [set(r.violations) for r in Q.add_violations(df, contracts.STORES).orderBy("Size").collect()]
    assert got == [
        set(),
        {"required:Type"},
        {"required:Store", "enum:Type", "type:Size"},
    ]


def test_absent_required_column_and_nulls(rows):
    df = rows("Store int, Date date, hasMarkDown1 int, CPI double", (1, D, None, None))
    row = Q.add_violations(df, contracts.FEATURES).first()
    assert set(row.violations) == {"required:IsHoliday", "null:hasMarkDown1"}


def test_whole_numbers_only(rows):
    df = rows("Store double, Type string, Size int", (1.0, "A", 1), (1.5, "A", 1))
    assert [r.violations for r in Q.add_violations(df, contracts.STORES).collect()] == [[], ["type:Store"]]


def test_split_valid_is_complete(rows):
    df = rows("Store int, Type string, Size int", (1, "A", 1), (2, "X", 1), (None, "B", 1))
    valid, rejected = Q.split_valid(df, contracts.STORES)
    assert (valid.count(), rejected.count()) == (1, 2)
    assert valid.columns == df.columns


def test_duplicate_keys(rows):
    df = rows("Store int", (1,), (1,), (2,))
    assert [tuple(r) for r in Q.duplicate_keys(df, ["Store"]).collect()] == [(1, 2)]


@pytest.fixture
def target(rows):
    return rows("k int, a string, b int", (1, "old", 1), (2, "old", 2), (3, "old", 3))


def test_upsert_last_record_wins_and_other_columns_stay(rows, target):
    batch = rows("k int, a string, at int", (1, "x", 1), (1, "y", 2), (2, None, 1), (9, "n", 1))
    once = U.upsert(target, batch, ["k"], ["at"])
    assert sorted(map(tuple, once.collect())) == [
        (1, "y", 1),
        (2, None, 2),
        (3, "old", 3),
        (9, "n", None),
    ]
    twice = U.upsert(once, batch, ["k"], ["at"])
    assert twice.exceptAll(once).count() == 0 and twice.count() == once.count()
    kept = U.upsert(target, batch, ["k"], ["at"], keep_on_null=["a"])
    assert kept.where("k = 2").first().a == "old"
    assert tuple(U.upsert_counts(target, batch, ["k"], ["at"]).first()) == (1, 2)
    assert tuple(U.upsert_counts(once, batch, ["k"], ["at"]).first()) == (0, 0)


def test_upsert_adds_new_columns(rows, target):
    batch = rows("k int, c int, at int", (1, 7, 1))
    out = {r.k: r.c for r in U.upsert(target, batch, ["k"], ["at"]).collect()}
    assert out == {1: 7, 2: None, 3: None}


def test_replace_by_key(rows, target):
    batch = rows("k int, a string, b int", (1, None, None), (5, "n", 5))
    out = sorted(map(tuple, U.replace_by_key(target, batch, ["k"]).collect()))
    assert out == [(1, None, None), (2, "old", 2), (3, "old", 3), (5, "n", 5)]


def test_replace_by_key_takes_the_last_of_equal_keys(rows, target):
    batch = rows("k int, a string, b int, at int", (1, "x", 1, 2), (1, "y", 2, 3), (1, "z", 3, 1))
    out = U.replace_by_key(target, batch, ["k"], ["at"]).where("k = 1").collect()
    assert list(map(tuple, out)) == [(1, "y", 2)]


def test_a_row_without_a_key_is_refused(rows, target):
    batch = rows("k int, a string, at int", (None, "x", 1))
    with pytest.raises(Exception, match="without a key"):
        U.upsert(target, batch, ["k"], ["at"]).collect()
    with pytest.raises(Exception, match="without a key"):
        U.replace_by_key(target, batch.drop("at"), ["k"]).collect()


def test_hot_key_in_the_batch(spark, target):
    batch = spark.range(50_000).select(
        F.lit(1).alias("k"), F.col("id").cast("string").alias("a"), F.col("id").alias("at")
    )
    out = U.upsert(target, batch, ["k"], ["at"])
    assert out.where("k = 1").collect()[0].a == "49999" and out.count() == 3


def test_the_last_record_is_found_where_the_rows_are(spark, rows):
    """A batch dealt by columns of the key is reduced there, without a shuffle; a null in the key still fails."""
    df = rows("a int, b int, v int", (1, 1, 5), (1, 1, 7), (2, 1, None)).repartition(3, "a")
    last = U.last_per_key(df, ["a", "b"])
    assert last._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert sorted((r.a, r.b, r._new.v) for r in last.collect()) == [(1, 1, 7), (2, 1, None)]
    with pytest.raises(Exception, match="a row without a key in a, b"):
        U.last_per_key(rows("a int, b int, v int", (1, None, 5)), ["a", "b"]).collect()


def test_a_large_batch_is_shuffled_once(spark, monkeypatch):
    target = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a"), F.lit("x").alias("b"))
    target = target.unionByName(target.where("k = 3").withColumn("a", F.lit(-1).cast("bigint")))
    batch = spark.range(150, 260).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("a"), F.lit(1).alias("at"))

    def found():
        out = U.upsert(target, batch, ["k"], ["at"], keep_on_null=["a"])
        counts = U.upsert_counts(target, batch, ["k"], ["at"], keep_on_null=["a"])
        return sorted(map(str, out.collect())), counts.collect()

    small = found()
    monkeypatch.setattr(quantiles, "BROADCAST_ROWS", 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found() == small and len(small[0]) == 261
        new = U.cut(U.last_per_key(batch, ["k"], ["at"]))
        plan = U.paired(target, new, ["k"]).rows._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Scan ExistingRDD") == 1 and "FullOuter" in plan
