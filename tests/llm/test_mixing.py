import pytest
from oracle_check import compare, connect

from conftest import SF
from salesflow.llm import mixing
from salesflow.llm.oracle import ORACLE
from salesflow.llm.queries import op2_mix_sources


def fill(sizes, weights, total, most):
    """Targets by repeated resharing."""
    want, fixed = total * sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        if not free:
            return [fixed[i] for i in range(len(sizes))]
        left = want - sum(fixed.values())
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] > most * sizes[i] + 1e-12]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed |= {i: most * sizes[i] for i in over}


@pytest.mark.parametrize("sizes", [[10, 20, 30, 40], [0, 0], [1, 1000, 1, 1, 1], [5], [0, 7, 0, 900, 3, 3]])
def test_targets(spark, sizes):
    rows = [(chr(97 + i), n) for i, n in enumerate(sizes)]
    got = mixing.targets(spark.createDataFrame(rows, "source string, source_size bigint")).collect()
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    want = fill(sizes, weights, 1.5, 2.0)
    assert [r.target for r in sorted(got)] == pytest.approx(want)


def test_null_is_the_last_source(spark):
    rows = [(None, 10), ("z", 10), ("", 10), ("Z", 10)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, source_size bigint")).collect()}
    assert got == pytest.approx(dict(zip(["", "Z", "z", None], fill([10] * 4, [5, 2, 1, 5], 1.5, 2.0), strict=True)))


def test_query_equals_sql(spark):
    db = connect(SF)
    assert compare(op2_mix_sources(spark, SF), db, ORACLE["op2_mix_sources"]) == []


def test_totals_are_near_targets_and_reruns_agree(spark):
    got = op2_mix_sources(spark, "/root/testdata/sf0.01").toPandas()
    assert (got.taken <= 2 * got["size"]).all()
    by = got.groupby(["source_size", "target"]).taken.sum().reset_index()
    assert (abs(by.taken - by.target) / by.target).max() < 0.1
    again = op2_mix_sources(spark, "/root/testdata/sf0.01").repartition(3).toPandas()
    key = ["doc_id", "taken"]
    assert got[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()


def test_odd_rows(spark, odd):
    got = mixing.mixed(odd)
    assert got.columns == [*odd.columns, "size", "source_size", "_mix_target", "_mix_copies"]
    rows = got.collect()
    assert len(rows) == odd.count()
    assert {r.doc_id: r["size"] for r in rows if r.doc_id in (2, 3, 4, 7)} == {2: 0, 3: 0, 4: 0, 7: 120_000}
    emitted = mixing.emit(odd)
    assert emitted.columns == odd.columns
    assert emitted.count() == sum(r["_mix_copies"] for r in rows)
    assert mixing.emit(odd.limit(0)).count() == 0 and mixing.mixed(odd.limit(0)).count() == 0


def test_rows_without_ids_meet_their_targets(spark):
    texts = [("a" if k % 3 else "b", f"w{k} " * 10) for k in range(2_000)]
    df = spark.createDataFrame(texts, "source string, text string").selectExpr("cast(null as bigint) as doc_id", "*")
    by = mixing.mixed(df).selectExpr("source", "target", "size * copies as taken").toPandas().groupby("source")
    assert (abs(by.taken.sum() - by.target.first()) / by.target.first()).max() < 0.05


def test_columns_named_like_its_own(spark):
    rows = [(k, f"w{k} " * 5, "a", 1, 2, 3, 4) for k in range(9)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "source", "_mix_source", "_MIX_size", "_mix_rate", "Copies"])
    got = mixing.mixed(df)
    assert got.columns == [*df.columns, "size", "source_size", "target", "__mix_copies"]
    assert got.count() == 9 and mixing.emit(df).columns == df.columns
    assert mixing.emit(df).count() == sum(r["__mix_copies"] for r in got.collect())
