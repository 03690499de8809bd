"""Token ids in files of fixed-width bits, with block offsets for random access.

An archive is a folder of files in ascending id order, each holding, in order of documents:

    block     ids of up to ``BLOCK_IDS`` tokens, each in the fewest bits that hold every id
              of the vocabulary, low bits first, padded with zero bits to whole bytes
    index     JSON: bits, n_ids, byte offset and number of ids of each block, and the
              documents' ids and numbers of tokens
    trailer   index length as 12 decimal digits, then the magic word

Every piece ends with a newline: files are written by Spark's text writer, whose commit
protocol leaves no part of a lost or repeated task and which reaches any file system Spark
does. Reading takes whole files as Spark's binary source gives them; ``docs_per_file``
bounds their size.

Rows are ordered by id (nulls last), then by a hash of the text, then text, so that files cut
rows of one id, or of none, too, where their texts differ; null text is no token but the end id.
Repeated rows are written as often as they occur, equal ones into one file. An empty table gives an archive without
documents. Columns other than the named ones are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesflow.llm.bpe import encoder, word_table
from salesflow.session import cut, scratch_path

BLOCK_IDS = 1 << 16
DOCS_PER_FILE = 20_000
TEXTS_AT_ONCE = 512
MAGIC = b"TOKBITS1"
_DIGITS = 12
BROADCAST_FILES = 100_000


def width_of(vocabulary: int) -> int:
    """The fewest bits that hold every id of a vocabulary."""
    return max(1, int(vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    ids = np.asarray(ids, "<u4")
    if bits % 8 == 0:
        return ids.view(np.uint8).reshape(-1, 4)[:, : bits // 8].tobytes()
    spread = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, count=bits, bitorder="little")
    return np.packbits(spread.ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, bits: int, count: int, first: int = 0) -> np.ndarray:
    """``count`` ids from the ``first`` on; only their bytes are touched."""
    low = first * bits
    raw = np.frombuffer(data, np.uint8)[low // 8 : ((first + count) * bits + 7) // 8]
    out = np.zeros((count, 4), np.uint8)
    if bits % 8 == 0:
        out[:, : bits // 8] = raw.reshape(count, bits // 8)
    elif count:
        flat = np.unpackbits(raw, bitorder="little")[low % 8 : low % 8 + count * bits]
        packed = np.packbits(flat.reshape(count, bits), axis=1, bitorder="little")
        out[:, : packed.shape[1]] = packed
    return out.view("<u4").ravel()


class File:
    """One file of an archive, from its bytes."""

    def __init__(self, content: bytes):
        self.content = content
        end = len(content) - len(MAGIC) - 1 - _DIGITS
        if content[end + _DIGITS : -1] != MAGIC:
            raise ValueError("no token archive")
        size = int(content[end : end + _DIGITS])
        index = json.loads(content[end - 1 - size : end - 1])
        self.bits, self.block_ids = index["bits"], index["block_ids"]
        self.offsets, self.counts = index["offsets"], index["counts"]
        self.doc_ids = index["doc_ids"]
        self.sizes = np.array(index["sizes"], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from position ``start`` of the file."""
        parts = [np.zeros(0, np.uint32)]
        while count > 0:
            block, first = divmod(start, self.block_ids)
            take = min(count, self.counts[block] - first)
            at = self.offsets[block]
            data = memoryview(self.content)[at : at + (self.counts[block] * self.bits + 7) // 8]
            parts.append(unpack_bits(data, self.bits, take, first))
            start, count = start + take, count - take
        return np.concatenate(parts)

    def blocks(self) -> Iterator[np.ndarray]:
        for at, count in zip(self.offsets, self.counts, strict=True):
            data = memoryview(self.content)[at : at + (count * self.bits + 7) // 8]
            yield unpack_bits(data, self.bits, count)


def _pieces(documents: Iterator[tuple], bits: int, block_ids: int) -> Iterator[bytes]:
    """The pieces of one file, without their newlines."""
    held: list[np.ndarray] = []
    n_held = written = 0
    offsets, counts, doc_ids, sizes = [], [], [], []

    def block(ids: np.ndarray) -> bytes:
        nonlocal written
        data = pack_bits(ids, bits)
        offsets.append(written)
        counts.append(len(ids))
        written += len(data) + 1
        return data

    for key, ids in documents:
        doc_ids.append(key)
        sizes.append(len(ids))
        held.append(ids)
        n_held += len(ids)
        if n_held >= block_ids:
            flat = np.concatenate(held)
            whole = len(flat) - len(flat) % block_ids
            for at in range(0, whole, block_ids):
                yield block(flat[at : at + block_ids])
            held, n_held = [flat[whole:].copy()], len(flat) - whole
    if n_held:
        yield block(np.concatenate(held))
    if doc_ids:
        index = {"bits": bits, "block_ids": block_ids, "offsets": offsets, "counts": counts}
        body = json.dumps(index | {"doc_ids": doc_ids, "sizes": sizes}).encode()
        yield body
        yield f"{len(body):0{_DIGITS}d}".encode() + MAGIC


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Send fewer rows at once to Python while a job runs."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write(
    df: DataFrame,
    path: str,
    tokenizer: str,
    vocabulary: int,
    end_id: int,
    id: str = "doc_id",
    text: str = "text",
    docs_per_file: int = DOCS_PER_FILE,
    block_ids: int = BLOCK_IDS,
    drops_space: bool = False,
) -> None:
    """Encode all texts, each followed by the end id, into an archive at ``path``.

    ``drops_space`` says that the tokenizer splits at all white space and keeps none of it.
    """
    bits = width_of(vocabulary)
    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("tie"))
    files = max(-(-df.count() // docs_per_file), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], np.uint32)

        def encoded(part: pa.RecordBatch) -> Iterator[np.ndarray]:
            if drops_space:
                ids, bounds = word_table(tokenizer).encode(part.column(1))
                yield from (ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
            else:
                yield from encoder(tokenizer).encode([t or "" for t in part.column(1).to_pylist()])

        def documents():
            for batch in batches:
                for lo in range(0, len(batch), TEXTS_AT_ONCE):
                    part = batch.slice(lo, TEXTS_AT_ONCE)
                    for key, ids in zip(part.column(0).to_pylist(), encoded(part), strict=True):
                        yield key, np.concatenate([ids, end])

        for piece in _pieces(documents(), bits, block_ids):
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.binary())], ["piece"])

    # The rows that Spark samples for the ranges hold no texts, and many rows of one id get several files.
    ranges = [F.col("id").asc_nulls_last(), F.col("tie")]
    ordered = rows.repartitionByRange(files, *ranges).sortWithinPartitions(*ranges, "text").drop("tie")
    # The bytes as they are: this cast checks and changes nothing.
    pieces = ordered.mapInArrow(run, "piece binary").select(F.col("piece").cast("string").alias("value"))
    with small_batches(df.sparkSession, TEXTS_AT_ONCE):
        pieces.write.option("lineSep", "\n").text(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of an archive's files."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return found.where(F.col("length") > 0).select("path", "content")


def read(spark: SparkSession, path: str, id_type: str = "bigint", ids: bool = False) -> DataFrame:
    """(file, number, doc_id, start, n_tokens, ids_crc32): every document of an archive.

    ``start`` counts the ids of all documents before it. With ``ids`` the ids come along.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                name = batch.column(0)[k].as_py()
                file = File(batch.column(1)[k].as_py())
                flat = np.zeros(0, np.uint32)
                base, blocks = 0, file.blocks()
                rows: list[tuple] = []
                for number, (start, size) in enumerate(zip(file.starts.tolist(), file.sizes.tolist(), strict=True)):
                    # One block after the other is held, and as many as one document needs.
                    parts = [flat[start - base :]]
                    have = len(parts[0])
                    while have < size:
                        parts.append(next(blocks))
                        have += len(parts[-1])
                    flat, base = np.concatenate(parts), start
                    own = flat[:size]
                    row = (name, number, file.doc_ids[number], start, size, zlib.crc32(own.astype("<u4").tobytes()))
                    rows.append((*row, own.tolist()) if ids else row)
                    if len(rows) == (256 if ids else 10_000) or number == len(file.sizes) - 1:
                        names = ["file", "number", "doc_id", "start", "n_tokens", "ids_crc32", "ids"]
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=False)) for r in rows], pa.schema(fields))
                        rows = []

    fields = [
        ("file", pa.string()), ("number", pa.int64()),
        ("doc_id", pa.string() if id_type == "string" else pa.int64()),
        ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
    ] + ([("ids", pa.list_(pa.int64()))] if ids else [])
    kind = "string" if id_type == "string" else "bigint"
    schema = f"file string, number bigint, doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
    documents = files(spark, path).mapInArrow(run, schema + (", ids array<bigint>" if ids else ""))
    if not ids:
        documents = cut(documents)
    # One row per file; files are numbered in the order of their ids.
    totals = documents.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy(
        F.regexp_extract(F.element_at(F.split("file", "/"), -1), r"part-(\d+)", 1).cast("bigint"), "file"
    ).rowsBetween(Window.unboundedPreceding, -1)
    bases = cut(totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    side = F.broadcast(bases) if bases.count() <= BROADCAST_FILES else bases
    return documents.join(side, "file").withColumn("start", F.col("start") + F.col("base")).drop("base")


def round_trip(df: DataFrame, tokenizer: str, vocabulary: int, end_id: int, **options) -> DataFrame:
    """Write an archive in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, "tokens")
    write(df, path, tokenizer, vocabulary, end_id, **options)
    return read(spark, path)
