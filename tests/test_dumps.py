"""Dumps of document collections: the format, splits, types, broken files."""

import datetime as dt
import gzip
import math
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.session import scratch_path
from salesflow.sources import dumps as B
from salesflow.sources import readers as R

UTC = dt.timezone.utc
# Every type of the format a flat scan has to step over or read.
ODD = b"".join([
    b"\x07_id\0" + bytes(range(12)),
    b"\x03deep\0" + B.document({"a": 1, "Store": 99}),
    b"\x04list\0" + B.document({"0": 5}),
    b"\x05blob\0" + struct.pack("<i", 3) + b"\0abc",
    b"\x06gone\0", b"\x0bexpr\0a.*\0i\0", b"\x0dcode\0" + struct.pack("<i", 2) + b"x\0",
    b"\x11stamp\0" + bytes(8), b"\xffleast\0", b"\x7fmost\0",
    b"\x13exact\0" + struct.pack("<QQ", 12345, (6176 - 2) << 49),
    b"\x12Store\0" + struct.pack("<q", 7), b"\x01Sales\0" + struct.pack("<d", 2.5),
])
ODD = struct.pack("<i", len(ODD) + 5) + ODD + b"\0"


def put(spark, name, *contents):
    folder = scratch_path(spark, name).removeprefix("file://")
    import os

    os.makedirs(folder)
    for k, content in enumerate(contents):
        with open(f"{folder}/part{k}.bson", "wb") as f:
            f.write(content)
    return folder


def test_published_example():
    assert B.document({"hello": "world"}) == b"\x16\0\0\0\x02hello\0\x06\0\0\0world\0\0"


VALUES = st.one_of(
    st.none(), st.booleans(), st.integers(-(2**63), 2**63 - 1), st.floats(), st.text(),
    st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2200, 1, 1)).map(lambda d: d.replace(microsecond=d.microsecond // 1000 * 1000, tzinfo=UTC)),
)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.text(st.characters(exclude_characters="\0", exclude_categories=["Cs"]), min_size=1), VALUES, max_size=6))
def test_fields_round_trip(row):
    back = {name: B.value(kind, raw) for name, kind, raw in B.elements(B.document(row))}
    assert back.keys() == row.keys()
    for k, v in row.items():
        assert back[k] == v or (isinstance(v, float) and math.isnan(v) and math.isnan(back[k]))
        assert type(back[k]) is type(v)


def test_every_type_is_stepped_over(spark):
    folder = put(spark, "odd", ODD + B.document({"Store": 8, "Sales": None}))
    schema = T.StructType.fromDDL("Store int, Sales double, exact double, deep string, missing date")
    rows = [tuple(r) for r in B.scan_dump(spark, folder, schema).collect()]
    assert rows == [(7, 2.5, 123.45, None, None), (8, None, None, None, None)]
    assert B.scan_dump(spark, folder, T.StructType.fromDDL("_id string")).first()[0] == bytes(range(12)).hex()


@pytest.mark.parametrize("split_bytes", [1, 200, 5_000, 1 << 30])
def test_splits_lose_and_repeat_nothing(spark, split_bytes, monkeypatch):
    rows = [{"n": n, "text": "é\0x" * (n % 50)} for n in range(700)]
    contents = b"".join(map(B.document, rows))
    folder = put(spark, "splits", contents, b"", B.document({"n": 700, "text": "y" * 100_000}))
    ranges = B.splits(spark, folder, split_bytes).collect()
    assert sum(r.stop - r.start for r in ranges) == len(contents) + len(B.document({"n": 700, "text": "y" * 100_000}))
    if split_bytes == 200:
        assert len(ranges) > 100
    found = B.scan_dump(spark, folder, T.StructType.fromDDL("n bigint, text string"), split_bytes)
    assert sorted(map(tuple, found.collect())) == [*((r["n"], r["text"]) for r in rows), (700, "y" * 100_000)]


def test_documents_longer_than_a_read(monkeypatch, tmp_path):
    monkeypatch.setattr(B, "_READ_BYTES", 7)
    rows = [B.document({"n": n, "t": "x" * n}) for n in range(40)]
    file = tmp_path / "a.bson"
    file.write_bytes(b"".join(rows))
    with B._open(f"file:{file}") as source:
        assert [bytes(d) for d in B._documents(source, "a", 0, file.stat().st_size)] == rows


def test_packed_files(spark):
    rows = [B.document({"n": n}) for n in range(100)]
    folder = put(spark, "packed", rows[0])
    with gzip.open(f"{folder}/more.bson.gz", "wb") as f:
        f.write(b"".join(rows[1:]))
    found = B.scan_dump(spark, folder, T.StructType.fromDDL("n int"), 10)
    assert sorted(r.n for r in found.collect()) == list(range(100))


@pytest.mark.parametrize("broken", [
    B.document({"n": 1})[:-3], B.document({"n": 1}) + b"\1\2", struct.pack("<i", 3) + b"\0", struct.pack("<i", -5) + bytes(9),
    B.document({"n": 1})[:-1] + b"\1",
])
def test_broken_files_fail(spark, broken):
    folder = put(spark, "broken", B.document({"n": 0}) + broken)
    with pytest.raises(Exception, match="document at byte|no document"):
        B.scan_dump(spark, folder, T.StructType.fromDDL("n int")).collect()


def test_values_a_type_cannot_hold_are_null(spark):
    rows = [{"v": v} for v in (1, 2**40, 1.0, 1.5, "1", True, None, dt.datetime(2012, 2, 3, 23, tzinfo=UTC), "2012-02-03", float("nan"))]
    folder = put(spark, "types", b"".join(map(B.document, rows)))

    def got(kind):
        return [r.v for r in B.scan_dump(spark, folder, T.StructType.fromDDL(f"v {kind}")).collect()]

    day = dt.date(2012, 2, 3)
    assert got("int") == [1, None, 1, None, None, None, None, None, None, None]
    assert got("bigint") == [1, 2**40, 1, None, None, None, None, None, None, None]
    assert got("double")[:9] == [1.0, 2.0**40, 1.0, 1.5, None, None, None, None, None]
    assert got("boolean") == [None] * 5 + [True] + [None] * 4
    assert got("date") == [None] * 7 + [day, day, None]
    assert got("string")[:6] == ["1", str(2**40), "1.0", "1.5", "1", "true"]
    with pytest.raises(TypeError):
        got("array<int>")


def test_table_round_trip_with_found_types(spark, rows):
    table = rows(
        "_id string, Store int, Sales double, Date timestamp, Holiday boolean, Note string, Size bigint",
        ("a", 1, 1.5, dt.datetime(2010, 2, 5), True, "x\ny\0z", 2**40), ("b", None, None, None, None, None, None),
        ("b", None, None, None, None, None, None), ("c", 3, float("-inf"), dt.datetime(1960, 1, 1), False, "", -1),
    )
    path = B.write_dump(table, scratch_path(spark, "dump"))
    back = R.scan_documents(spark, path, "bson")
    kinds = dict(back.dtypes)
    assert kinds == {"Store": "bigint", "Sales": "double", "Date": "timestamp", "Holiday": "boolean", "Note": "string", "Size": "bigint"}
    wanted = table.drop("_id").withColumn("Store", F.col("Store").cast("bigint")).select(*back.columns)
    assert back.exceptAll(wanted).isEmpty() and wanted.exceptAll(back).isEmpty()
    empty = B.write_dump(table.limit(0), scratch_path(spark, "none"))
    assert R.scan_documents(spark, empty, "bson", table.schema).collect() == []
