"""Stored tables: what a merge reads, writes, and leaves behind when it fails."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from salesflow.contracts import STORES, TRAIN
from salesflow.operators.upsert import upsert
from salesflow.plans import load
from salesflow.sources.readers import write_csv
from salesflow.sources.stored import StoredTable

SCHEMA = "Store int, Dept int, Date date, Weekly_Sales double, IsHoliday boolean"


def day(year, week=1):
    return datetime.date(year, 1, 1) + datetime.timedelta(weeks=week)


def sales(spark, *rows):
    return spark.createDataFrame([(s, d, t, v, False) for s, d, t, v in rows], SCHEMA)


def files(path):
    return {os.path.join(r, f): os.stat(os.path.join(r, f)).st_mtime_ns for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    made = StoredTable(spark, str(tmp_path / "sales"), TRAIN)
    made.merge(sales(spark, *[(s, 1, day(y, w), 10.0 * s) for s in range(4) for y in (2010, 2011, 2012) for w in range(5)]))
    return made


def test_only_touched_partitions_are_read_and_written(spark, table):
    before, old = table.partitions(), files(table.path)
    done = table.merge(sales(spark, (1, 1, day(2011), 99.0), (9, 9, day(2011), 1.0), (9, 9, day(2020), 2.0)))
    assert (done.inserted, done.updated) == (2, 1)
    assert done.read == ("2011",) and done.written == ("2011", "2020")
    after = table.partitions()
    assert {p: after[p] for p in ("2010", "2012")} == {p: before[p] for p in ("2010", "2012")}
    assert old.items() <= files(table.path).items()
    assert all("part=2011" in f for f in table.read(["2011"]).inputFiles())
    got = {(r.Store, r.Dept, r.Date): r.Weekly_Sales for r in table.read().collect()}
    assert len(got) == 62 and got[1, 1, day(2011)] == 99.0 and got[9, 9, day(2020)] == 2.0


def test_loading_twice_leaves_equal_files(spark, table, tmp_path):
    path = write_csv(table.read().withColumn("Weekly_Sales", F.col("Weekly_Sales") + 1), str(tmp_path / "again"))
    first = load.load_sales(spark, path, table)
    assert tuple(first.counts.first()) == (0, 60, 0)
    there, named = files(table.path), table.partitions()
    second = load.load_sales(spark, path, table)
    assert tuple(second.counts.first()) == (0, 0, 0)
    assert files(table.path) == there and table.partitions() == named


def test_the_same_rows_as_the_upsert_of_frames(spark, table):
    batch = spark.createDataFrame(
        [(1, 1, day(2010), None, 1), (1, 1, day(2010), 5.0, 0), (2, 1, day(2012), None, 3), (7, 7, day(2012), 4.0, 4)],
        "Store int, Dept int, Date date, Weekly_Sales double, at int",
    )
    for keep in ((), ("Weekly_Sales",)):
        want = upsert(table.read(), batch, TRAIN.key, ["at"], keep).select(*TRAIN.names())
        want = sorted(map(tuple, want.collect()), key=repr)
        if not keep:
            # The table refuses what its contract refuses: sales that are null.
            with pytest.raises(RuntimeError, match="required"):
                table.merge(batch.withColumn("IsHoliday", F.lit(True)), ["at"])
            continue
        done = table.merge(batch.where("Store < 7"), ["at"], keep)
        assert done.updated == 1
        assert sorted(map(tuple, table.read().collect()), key=repr) == [r for r in want if r[0] != 7]


def test_a_failed_write_leaves_the_old_table(spark, table, monkeypatch):
    rows, named = sorted(map(tuple, table.read().collect())), table.partitions()
    monkeypatch.setattr(StoredTable, "_check", lambda *a: (_ for _ in ()).throw(RuntimeError("the disk is gone")))
    with pytest.raises(RuntimeError, match="gone"):
        table.merge(sales(spark, (1, 1, day(2011), 99.0)))
    assert table.partitions() == named and sorted(map(tuple, table.read().collect())) == rows
    monkeypatch.undo()
    # A manifest whose writer died is passed over, by readers and by the next merge.
    with open(f"{table.path}/_published/0000000002.json", "w") as f:
        f.write('{"2010": "lo')
    assert table.partitions() == named
    assert table.merge(sales(spark, (1, 1, day(2011), 99.0))).updated == 1
    assert table.read().where("Weekly_Sales = 99").count() == 1


def test_two_merges_cannot_publish_the_same_manifest(spark, table):
    number, parts = table._newest()
    table._publish(number + 1, parts)
    with pytest.raises(Exception, match="already exists|FileAlreadyExists"):
        table._publish(number + 1, parts)


def test_vacuum_removes_what_nothing_names(spark, table):
    table.merge(sales(spark, *[(1, 1, day(y), 1.0) for y in (2010, 2011, 2012)]))
    rows = table.read().count()
    assert len(table.vacuum()) == 1 and table.vacuum() == []
    assert table.read().count() == rows == 60


def test_empty_null_keys_and_one_partition(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "stores"), STORES, part="'all'")
    assert table.read().count() == 0 and table.read().columns == STORES.names()
    none = spark.createDataFrame([], STORES.schema())
    assert table.merge(none).written == () and table.partitions() == {}
    rows = spark.createDataFrame([(1, "A", 5), (2, "B", 6)], "Store int, Type string, Size int")
    assert table.merge(rows).inserted == 2
    assert table.merge(rows.withColumn("Size", F.lit(7)), whole=True).updated == 2
    with pytest.raises(Exception, match="without a key"):
        table.merge(spark.createDataFrame([(None, "A", 5)], "Store int, Type string, Size int"))
    assert sorted(map(tuple, table.read().collect())) == [(1, "A", 7), (2, "B", 7)]


def test_a_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(200_000).selectExpr("cast(id as int) k", "id v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame([(1, 5, 0), (-1, 6, 0)], "k int, v bigint, at int")
    done = upsert(target, batch, ["k"], ["at"])
    assert len(done.collect()) == 200_001
    plan = done._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
    # The only rows shuffled are the few that the target and the batch share.
    assert "FullOuter" not in plan and "Exchange hashpartitioning" not in plan.split("Union")[1].split("BroadcastHashJoin")[0]


def test_lines_that_do_not_parse_are_refused_whole(spark, tmp_path):
    lines = ["Store,Type,Size", "1,A,5", "2,B,6,7", "3,C", '4,"A,5', "5,D,1", '6,"B",8', "", "7,A,NA"]
    (tmp_path / "stores.csv").write_text("\n".join(lines) + "\n")
    loaded = load.load_stores(spark, str(tmp_path / "stores.csv"))
    assert sorted(r.Store for r in loaded.table.collect()) == [1, 6]
    refused = {r.violations[0] for r in loaded.rejected.collect()}
    assert refused == {"line:2,B,6,7", "line:3,C", 'line:4,"A,5', "enum:Type", "required:Size"}
    counts = loaded.counts.first()
    # All lines but the header and the empty one.
    assert counts.inserted + counts.updated + counts.rejected == len(lines) - 2
