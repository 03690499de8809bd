"""Words of text columns as 64-bit hashes, computed on whole Arrow batches.

Words are runs of bytes other than space and \\x09-\\x0D; A-Z count as a-z. A text
is never cut: a batch is worked through in blocks that end between words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(20240601)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[_SPACE] = 0
_FOLDED = _BYTE.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each text's bounds in them; null texts are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), bounds


def _up_to(length: int) -> np.ndarray:
    global _powers
    if length > len(_powers):
        grown = np.full(max(length, 2 * len(_powers)), _STEP, np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown, dtype=np.uint64)
    return _powers


def _blocks(data: np.ndarray, lo: int, hi: int):
    while lo < hi:
        end = min(hi, lo + BLOCK_BYTES)
        while end < hi and not _SPACE[data[end]]:
            stop = np.flatnonzero(_SPACE[data[end : end + 4096]])
            end = end + stop[0] if len(stop) else min(hi, end + 4096)
        yield lo, end
        lo = end


def gathered(batches, column: str, size: int):
    """Batches put together until ``column`` has about ``size`` bytes; a longer text stands alone.

    Its rows come as one batch with large strings.
    """
    held, so_far = [], 0
    for batch in batches:
        for lo in range(0, len(batch), 256):
            part = batch.slice(lo, 256)
            held.append(part)
            so_far += pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if so_far >= size:
                yield _together(held, column)
                held, so_far = [], 0
    if held:
        yield _together(held, column)


def _together(parts: list[pa.RecordBatch], column: str) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts)
    at = table.column_names.index(column)
    table = table.set_column(at, column, table.column(at).cast(pa.large_string())).combine_chunks()
    arrays = [pa.concat_arrays(c.chunks) for c in table.columns]
    return pa.RecordBatch.from_arrays(arrays, table.column_names)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch in order, and the bounds of each text's words."""
    data, bounds = buffers(column)
    hashes, _, _, ends = spelled(data, bounds, _FOLDED)
    return hashes, ends


def word_hashes_exact(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same with A-Z unlike a-z."""
    hashes, _, _, ends = spelled(*buffers(column))
    return hashes, ends


def spelled(
    data: np.ndarray, bounds: np.ndarray, values: np.ndarray = _BYTE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first bytes, lengths) of all words in texts, and the bounds of each text's words.

    ``values`` gives each byte's number: by default A-Z differ from a-z.
    """
    hashes, first_bytes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, hi in _blocks(data, int(bounds[0]), int(bounds[-1])):
        part = data[lo:hi]
        space = _SPACE[part]
        begins = ~space
        begins[1:] &= space[:-1]
        stops = ~space
        stops[:-1] &= space[1:]
        cuts = bounds[np.searchsorted(bounds, lo, "right") : np.searchsorted(bounds, hi)] - lo
        begins[cuts] = ~space[cuts]
        stops[cuts - 1] = ~space[cuts - 1]
        starts = np.flatnonzero(begins)
        if not len(starts):
            continue
        lengths = np.diff(starts, append=len(part))
        place = np.arange(starts[0], len(part)) - np.repeat(starts, lengths)
        weights = _up_to(int(lengths.max()))[place] * values[part[starts[0] :]]
        hashes.append(mix(np.add.reduceat(weights, starts - starts[0])))
        first_bytes.append(starts + lo)
        sizes.append(np.flatnonzero(stops) + 1 - starts)
    first = np.concatenate(first_bytes)
    return np.concatenate(hashes), first, np.concatenate(sizes), np.searchsorted(first, bounds)


def hash_word(word: str) -> int:
    """The hash of one word, as word_hashes gives it."""
    return int(word_hashes(pa.array([word]))[0][0])


class Lookup:
    """Positions of 64-bit hashes in a fixed table, by their low bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        bits = max(8, int(len(hashes)).bit_length())
        self.shift = np.uint64(64 - bits)
        # Sorted hashes with the same high bits are neighbours: a slot names the first.
        slots = np.bincount((self.hashes >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = (np.cumsum(slots) - slots).astype(np.int32)
        self.longest = int(slots.max(initial=0)) + 1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash stands, -1 if nowhere."""
        out = np.full(len(hashes), -1, np.int64)
        if not len(self.hashes):
            return out
        left = np.arange(len(hashes))
        at = self.first[(hashes >> self.shift).astype(np.int64)]
        for _ in range(self.longest):
            # One step along the run of each hash that is not found yet.
            at = np.minimum(at, len(self.hashes) - 1)
            there = self.hashes[at]
            hit = there == hashes
            out[left[hit]] = at[hit]
            going = there < hashes
            left, hashes, at = left[going], hashes[going], at[going] + 1
            if not len(left):
                break
        return out
