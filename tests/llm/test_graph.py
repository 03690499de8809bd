import random

from pyspark.sql import functions as F

from salesflow.llm.graph import components


def want(edges):
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in root}


def check(spark, edges):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r["id"]: r["root"] for r in components(df).collect()} == want(edges)


def test_chain_star_nulls_and_none(spark):
    chain = list(range(40))
    random.Random(1).shuffle(chain)
    check(spark, list(zip(chain, chain[1:], strict=False)) + [(100, k) for k in range(101, 130)] + [(None, 3), (7, None), (5, 5), (300, 300)])
    check(spark, [])


def test_rounds_are_written_to_the_checkpoint_folder(spark):
    df = components(spark.range(3).select("id", (F.col("id") + 1).alias("to")), "id", "to")
    assert "ExistingRDD" in df._jdf.queryExecution().toString()
