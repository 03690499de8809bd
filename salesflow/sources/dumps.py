"""Dumps of document collections (BSON files): read in splits, and written, without a server.

Reading takes two steps. One task per file hops over the documents' lengths and names splits of
about ``split_bytes`` that begin and end between documents; then every split is read on its own,
so a file of any size is shared by many tasks. Only the asked fields are decoded. Files that end
in ``.gz`` cannot be entered in the middle and are one split each.

Documents are flat: numbers, texts, booleans, dates, nulls. Of a field that repeats in a document
the last counts; absent fields, nulls and values that the asked type cannot hold are null, as in
a JSON scan. A file that ends inside a document, or where a length leads nowhere, fails the job
with the file's name and the place.

Files are opened by pyarrow, which knows local and shared folders, HDFS, S3 and GCS.
"""

from __future__ import annotations

import datetime as dt
import math
import re
import struct
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from salesflow.session import cut

SPLIT_BYTES = 64 << 20
_READ_BYTES = 4 << 20
_ROWS_AT_ONCE = 8192
_LEAST = 5

# Element types of the format, and the sizes of those that have one.
_DOUBLE, _STRING, _BINARY, _BOOL, _DATETIME, _NULL = 0x01, 0x02, 0x05, 0x08, 0x09, 0x0A
_REGEX, _INT32, _INT64, _DECIMAL = 0x0B, 0x10, 0x12, 0x13
_SIZES = {0x01: 8, 0x06: 0, 0x07: 12, 0x08: 1, 0x09: 8, 0x0A: 0, 0x10: 4, 0x11: 8, 0x12: 8, 0x13: 16, 0x7F: 0, 0xFF: 0}
# Those led by the length of their bytes, of themselves with it, and of a binary after its kind.
_TEXTS, _NESTED = (0x02, 0x0D, 0x0E), (0x03, 0x04, 0x0F)
_EXPONENT_BIAS = 6176

_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _open(path: str, stream: bool = False):
    """The file, and by its ending unpacked where it is read as a stream."""
    system, place = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return system.open_input_stream(place, compression="detect") if stream else system.open_input_file(place)


def _documents(source, path: str, at: int, end: int | None) -> Iterator[memoryview]:
    """Each document of the opened file from ``at`` to ``end`` (None: to the last)."""
    held, low = b"", 0
    while end is None or at < end:
        if len(held) - low < 4:
            held, low = held[low:] + source.read(_READ_BYTES), 0
        if not held and end is None:
            return
        size = struct.unpack_from("<i", held, low)[0] if len(held) - low >= 4 else 0
        if size < _LEAST:
            raise ValueError(f"{path}: no document at byte {at}")
        if len(held) - low < size:
            held, low = held[low:] + source.read(max(_READ_BYTES, size - len(held) + low)), 0
        if len(held) - low < size or held[low + size - 1]:
            raise ValueError(f"{path}: the document at byte {at} is cut off or broken")
        yield memoryview(held)[low : low + size]
        low += size
        at += size


def elements(document: bytes | memoryview) -> Iterator[tuple[str, int, memoryview]]:
    """(name, type, bytes of the value) of a document's fields."""
    body, at, end = bytes(document), 4, len(document) - 1
    view = memoryview(body)
    while at < end:
        kind = body[at]
        stop = body.index(0, at + 1)
        name = body[at + 1 : stop].decode("utf-8", "replace")
        at = stop + 1
        if kind in _SIZES:
            size = _SIZES[kind]
        elif kind == _REGEX:
            size = body.index(0, body.index(0, at) + 1) + 1 - at
        else:
            size = struct.unpack_from("<i", body, at)[0]
            if kind in _TEXTS:
                size += 4
            elif kind == _BINARY:
                size += 5
            elif kind not in _NESTED:
                raise ValueError(f"field {name}: no type {kind:#04x}")
        if size < 0 or at + size > end:
            raise ValueError(f"field {name} is longer than its document")
        yield name, kind, view[at : at + size]
        at += size


def value(kind: int, raw: memoryview) -> Any:
    """A plain Python value; None for nulls and for what has none."""
    if kind == _DOUBLE:
        return struct.unpack("<d", raw)[0]
    if kind in (_INT32, _INT64):
        return int.from_bytes(raw, "little", signed=True)
    if kind in _TEXTS:
        return bytes(raw[4:-1]).decode("utf-8", "replace")
    if kind == _BOOL:
        return raw[0] != 0
    if kind == _DATETIME:
        try:
            return _EPOCH + dt.timedelta(milliseconds=int.from_bytes(raw, "little", signed=True))
        except OverflowError:
            return None
    if kind == _DECIMAL:
        low, high = struct.unpack("<QQ", raw)
        if high >> 61 & 3 == 3:
            return None
        digits = (high & (1 << 49) - 1) << 64 | low
        number = Decimal(digits).scaleb((high >> 49 & 0x3FFF) - _EXPONENT_BIAS)
        return -number if high >> 63 else number
    if kind == 0x07:
        return bytes(raw).hex()
    return None


def _whole(least: int, most: int) -> Callable[[Any], int | None]:
    def made(v: Any) -> int | None:
        if isinstance(v, bool) or not isinstance(v, (int, float, Decimal)):
            return None
        if isinstance(v, (float, Decimal)) and (not math.isfinite(v) or v != int(v)):
            return None
        return int(v) if least <= v <= most else None

    return made


def _number(v: Any) -> float | None:
    return float(v) if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool) else None


def _moment(v: Any) -> dt.datetime | None:
    if isinstance(v, str):
        try:
            v = dt.datetime.fromisoformat(v)
        except ValueError:
            return None
    if not isinstance(v, dt.datetime):
        return None
    return v if v.tzinfo else v.replace(tzinfo=dt.timezone.utc)


def _day(v: Any) -> dt.date | None:
    moment = _moment(v)
    return moment.astimezone(dt.timezone.utc).date() if moment else None


def _text(v: Any) -> str | None:
    if isinstance(v, bool):
        return str(v).lower()
    return v if v is None or isinstance(v, str) else v.isoformat() if isinstance(v, dt.datetime) else str(v)


def _maker(kind: T.DataType) -> Callable[[Any], Any]:
    """What makes a value of the asked type, or null, of a document's value."""
    wholes = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
    if type(kind) in wholes:
        half = 1 << (wholes[type(kind)] - 1)
        return _whole(-half, half - 1)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _number
    if isinstance(kind, T.StringType):
        return _text
    if isinstance(kind, T.BooleanType):
        return lambda v: v if isinstance(v, bool) else None
    if isinstance(kind, T.DateType):
        return _day
    if isinstance(kind, T.TimestampType):
        return _moment
    raise TypeError(f"no {kind.simpleString()} in a dump of flat documents")


def splits(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, start, stop): ranges of whole documents; a packed file is one range without a stop."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                found: list[tuple[str, int, int | None]] = []
                if name.endswith(".gz"):
                    found.append((name, 0, None))
                else:
                    with _open(name) as source:
                        size, start, at = source.size(), 0, 0
                        for document in _documents(source, name, 0, size):
                            at += len(document)
                            if at - start >= split_bytes:
                                found.append((name, start, at))
                                start = at
                        if at > start:
                            found.append((name, start, at))
                yield pa.RecordBatch.from_pylist([dict(zip(("path", "start", "stop"), f, strict=True)) for f in found], fields)

    fields = pa.schema([("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
    # The contents are not read here: only the columns asked for are.
    files = cut(spark.read.format("binaryFile").load(path).where("length > 0").select("path"))
    return cut(files.repartition(max(1, files.count())).mapInArrow(walk, "path string, start bigint, stop bigint"))


def _each_document(batches: Iterator[pa.RecordBatch]) -> Iterator[memoryview]:
    for batch in batches:
        for row in batch.to_pylist():
            with _open(row["path"], stream=row["stop"] is None) as source:
                if row["start"]:
                    source.seek(row["start"])
                yield from _documents(source, row["path"], row["start"], row["stop"])


def infer_schema(ranges: DataFrame) -> T.StructType:
    """Fields of all documents, by name, with a type that holds all their values."""

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {(name, kind) for document in _each_document(batches) for name, kind, _ in elements(document)}
        pairs = sorted(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.int32())], ["name", "kind"]
        )

    found: dict[str, set[int]] = {}
    # One row per field and type.
    for name, kind in ranges.mapInArrow(kinds, "name string, kind int").distinct().collect():
        found.setdefault(name, set()).add(kind)
    return T.StructType([T.StructField(name, _holding(found[name] - {_NULL})) for name in sorted(found)])


def _holding(kinds: set[int]) -> T.DataType:
    if kinds and kinds <= {_INT32, _INT64}:
        return T.LongType()
    if kinds and kinds <= {_INT32, _INT64, _DOUBLE, _DECIMAL}:
        return T.DoubleType()
    return {frozenset([_BOOL]): T.BooleanType(), frozenset([_DATETIME]): T.TimestampType()}.get(frozenset(kinds), T.StringType())


def scan_dump(
    spark: SparkSession, path: str, schema: T.StructType | None = None, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """The documents of a dump with the fields of ``schema``, found by a pass if there is none."""
    ranges = splits(spark, path, split_bytes)
    schema = schema if schema is not None else infer_schema(ranges)
    makers = [(f.name, _maker(f.dataType)) for f in schema]
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = {name for name, _ in makers}

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            columns = [
                pa.array([make(r.get(name)) for r in rows], f.type) for (name, make), f in zip(makers, arrow, strict=True)
            ]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        rows: list[dict] = []
        for document in _each_document(batches):
            rows.append({name: value(kind, raw) for name, kind, raw in elements(document) if name in wanted})
            if len(rows) == _ROWS_AT_ONCE:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    return ranges.repartition(max(1, ranges.count())).mapInArrow(read, schema)


def document(row: dict[str, Any]) -> bytes:
    """One row as a document; whole numbers take four bytes where they fit."""
    parts = []
    for name, v in row.items():
        if v is None:
            kind, raw = _NULL, b""
        elif isinstance(v, bool):
            kind, raw = _BOOL, bytes([v])
        elif isinstance(v, int):
            kind, raw = (_INT32, struct.pack("<i", v)) if -(1 << 31) <= v < 1 << 31 else (_INT64, struct.pack("<q", v))
        elif isinstance(v, float):
            kind, raw = _DOUBLE, struct.pack("<d", v)
        elif isinstance(v, dt.date):
            moment = v if isinstance(v, dt.datetime) else dt.datetime(v.year, v.month, v.day)
            since = (moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)) - _EPOCH
            kind, raw = _DATETIME, struct.pack("<q", since // dt.timedelta(milliseconds=1))
        elif isinstance(v, str):
            text = v.encode()
            kind, raw = _STRING, struct.pack("<i", len(text) + 1) + text + b"\0"
        else:
            raise TypeError(f"{name}: no {type(v).__name__} in a dump of flat documents")
        parts.append(bytes([kind]) + name.encode() + b"\0" + raw)
    body = b"".join(parts)
    return struct.pack("<i", len(body) + _LEAST) + body + b"\0"


def write_dump(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A dump of a flat table, each task its file, through Spark's own text writer.

    Every document ends in a zero byte; the writer sets it as what separates lines.
    """
    for f in df.schema:
        _maker(f.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([document(r)[:-1] for r in batch.to_pylist()], pa.binary())], ["value"])

    lines = df.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.mode(mode).option("lineSep", "\0").text(path)
    return path
