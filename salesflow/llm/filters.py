"""Bitmaps of 64-bit hashes: what is not in one was never put there.

A bitmap is broadcast, so its size is bounded: 2**``MOST_BITS`` bits (64 MB), and as much
smaller as its hashes allow. Where so many are put in that it would hold little back there is
none, and readers go on without. Hashes that share a bit are taken for each other: a reader
that needs certainty checks the rows it lets through, so results never depend on it.

Counts that only say what to put in travel packed, four bytes a hash: of it the lowest bits,
which tell ``PARTS`` parts and 2**24 keys in each apart, and the count up to what is enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 29
#: Bits for each hash, if that many fit; and the share of bits set that is too much.
BITS_EACH = 16
FULL = 0.25
PARTS = 1 << 12
KEY = np.uint64(PARTS * (1 << 24) - 1)
PACKED = "shard int, part int, keys binary, counts binary"


class Bitmap:
    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(64 * len(words) - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may have been put in."""
        place = hashes & self.mask
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def bitmap(hashes: DataFrame, column: str | Column, bits: int = MOST_BITS, each: int = BITS_EACH) -> Broadcast | None:
    """A broadcast Bitmap of a column of hashes, or None where there are too many.

    It has at least ``each`` bits for a hash, if that many fit.
    The bits are put together in Spark; the driver reads at most 2**(bits - 6) rows of 12 bytes.
    """
    hash = F.col(column) if isinstance(column, str) else column
    place = hash.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    words = (
        hashes.select(place.alias("_place"))
        .select(F.shiftright("_place", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(_place & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    full = np.zeros(1 << (bits - 6), np.uint64)
    full[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    if np.bitwise_count(full).sum() > FULL * (1 << bits):
        return None
    while len(full) > 1 and each * np.bitwise_count(full).sum() < 32 * len(full):
        full = full[: len(full) // 2] | full[len(full) // 2 :]
    return hashes.sparkSession.sparkContext.broadcast(Bitmap(full))


def maybe(filter: Broadcast | None, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the bitmap; without one, all may."""
    return np.ones(len(hashes), bool) if filter is None else filter.value.has(hashes)


def _count_type(enough: int) -> np.dtype:
    return np.min_scalar_type(enough)


def packed(hashes: list[np.ndarray], shard: int, enough: int) -> pa.RecordBatch:
    """The keys of some hashes and their counts, up to ``enough``, as one row of bytes for each part."""
    keys, counts = np.unique(np.concatenate(hashes) & KEY, return_counts=True)
    parts, starts = np.unique(keys >> np.uint64(24), return_index=True)
    starts = np.append(starts, len(keys)).astype(np.int64)
    low = keys.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
    counts = np.minimum(counts, enough).astype(_count_type(enough))
    columns = [pa.array(np.full(len(parts), shard, np.int32)), pa.array(parts.astype(np.int32))]
    for cells in (low, counts):
        bounds = pa.py_buffer((starts * (cells.nbytes // max(1, len(cells)))).astype(np.int32))
        columns.append(pa.Array.from_buffers(pa.binary(), len(parts), [None, bounds, pa.py_buffer(cells.tobytes())]))
    return pa.RecordBatch.from_arrays(columns, ["shard", "part", "keys", "counts"])


def reaching(counted: DataFrame, enough: int) -> DataFrame:
    """(hash): the keys of ``PACKED`` rows with so many occurrences in a shard."""

    def added(part: int, keys: list[bytes], counts: list[bytes]) -> pa.RecordBatch:
        low = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 3)
        wide = np.zeros((len(low), 4), np.uint8)
        wide[:, :3] = low
        low = wide.view("<u4")[:, 0]
        order = np.argsort(low, kind="stable")
        low = low[order]
        starts = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        counts = np.frombuffer(b"".join(counts), _count_type(enough))[order]
        found = low[starts[np.add.reduceat(counts, starts, dtype=np.int64) >= enough]]
        return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64) + (part << 24))], ["hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts = None, [], []
        for batch in batches:
            for shard, part, some, times in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if keys and (shard, part) != now:
                    yield added(now[1], keys, counts)
                    keys, counts = [], []
                now = shard, part
                keys.append(some)
                counts.append(times)
        if keys:
            yield added(now[1], keys, counts)

    together = counted.repartition("shard", "part").sortWithinPartitions("shard", "part")
    return together.mapInArrow(run, "hash bigint")
