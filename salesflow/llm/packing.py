"""Packing token ids into fixed windows by the sum-of-squares rule.

Documents arrive in partition order and each is placed at once: full windows are
cut off its front, and the rest goes to the fill level (or a new window) for which
the sum of squared counts of partly filled windows grows least. One array holds
the count of open windows per level, so a placement is one vectorised comparison.

At the end of a partition the windows still open are run together and cut to whole
windows; what is left over is cut to powers of two, which need no padding.

Every partition packs on its own, without a shuffle; a task holds one document and
the open windows. A document that fills a partition alone is streamed like any other.

Null or empty texts are the end id alone. Repeated rows and ids are packed as often
as they occur; null ids stay null. An empty table gives no pieces. Columns other than
the named ones are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 2048
FLUSH_ROWS = 20_000
PIECES = (
    "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)

_encodings: dict = {}


class ByteBpe:
    """A byte-level BPE file of the tokenizers library, run by tiktoken: the same ids, faster."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # Byte-level files write bytes without a printable form as characters from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        chars = {chr(b): b for b in plain}
        chars |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(chars[c] for c in token): rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in special
        }
        self.encoding = tiktoken.Encoding(
            "file",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens=special,
        )

    def encode(self, text: str) -> np.ndarray:
        """Ids as the tokenizers library gives them; special tokens' strings are those tokens."""
        return self.encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())


def byte_bpe(path: str) -> ByteBpe:
    if path not in _encodings:
        _encodings[path] = ByteBpe(path)
    return _encodings[path]


class SumOfSquares:
    """Open windows by fill level, and the rule that picks a level."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list] = [[] for _ in range(window + 1)]

    def level(self, size: int) -> int:
        """The fill level that takes ``size`` tokens (0: a new window); ties go to the fuller one."""
        counts = self.counts
        room = self.window - size
        # Moving a window from level h to h + size changes the sum by 2 (N[h+size] - N[h]) + 2,
        # opening one by 2 N[size] + 1; full and empty windows are not counted.
        growth = 2 * (counts[size:] - counts[: room + 1]) + 2
        growth[room] -= 1
        growth[0] = 2 * counts[size] + 1 if size < self.window else 0
        possible = counts[: room + 1] > 0
        possible[0] = True
        growth = np.where(possible, growth, np.iinfo(np.int64).max)
        return room - int(np.argmin(growth[::-1]))

    def place(self, piece: tuple, size: int) -> list | None:
        """Put a piece in its window; the window's pieces if that fills it."""
        h = self.level(size)
        window = self.open[h].pop() if h else []
        if h:
            self.counts[h] -= 1
        window.append(piece)
        if h + size == self.window:
            return window
        self.counts[h + size] += 1
        self.open[h + size].append(window)
        return None

    def rest(self) -> list:
        """The pieces of all windows still open, fuller windows first."""
        pieces = [p for level in reversed(self.open) for w in level for p in w]
        self.__init__(self.window)
        return pieces


def sequences(
    documents: Iterator[tuple], window: int = WINDOW
) -> Iterator[list[tuple]]:
    """Sequences as lists of (doc_id, start, ids, doc_tokens), from (doc_id, ids)."""
    state = SumOfSquares(window)
    for key, ids in documents:
        total = len(ids)
        whole = total - total % window
        for at in range(0, whole, window):
            yield [(key, at, ids[at : at + window], total)]
        if total > whole:
            full = state.place((key, whole, ids[whole:].copy(), total), total - whole)
            if full:
                yield full
    pieces = state.rest()[::-1]
    left = sum(len(p[2]) for p in pieces)
    while left:
        room = window if left >= window else 1 << (left.bit_length() - 1)
        left -= room
        sequence = []
        while room:
            key, at, ids, total = pieces.pop()
            if len(ids) > room:
                pieces.append((key, at + room, ids[room:], total))
                ids = ids[:room]
            sequence.append((key, at, ids, total))
            room -= len(ids)
        yield sequence


def pack(
    df: DataFrame,
    tokenizer: str,
    end_id: int,
    id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    ids: bool = False,
) -> DataFrame:
    """The pieces of all documents: where each lies in its document and in its sequence.

    ``sequence_id`` is the partition's number times 2^40 plus a count. With ``ids`` the
    token ids come along.
    """
    kind = dict(df.dtypes)[id]
    schema = PIECES.format(id=kind) + (", ids array<bigint>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer).encode
        end = np.array([end_id], np.uint32)
        key_type = None

        def documents():
            nonlocal key_type
            for batch in batches:
                key_type = batch.column(0).type
                for lo in range(0, len(batch), 256):
                    part = batch.slice(lo, 256)
                    keys, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                    for key, value in zip(keys, texts, strict=True):
                        yield key, np.concatenate([encode(value or ""), end])

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            arrays = [pa.array(columns[0], key_type), *(pa.array(c, pa.int64()) for c in columns[1:7])]
            if ids:
                names.append("ids")
                arrays.append(pa.array(columns[7], pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(arrays, names)

        rows: list[tuple] = []
        first = TaskContext.get().partitionId() << 40
        for number, sequence in enumerate(sequences(documents(), window)):
            offset = 0
            for key, at, piece, total in sequence:
                crc = zlib.crc32(piece.astype("<u4").tobytes())
                row = (key, at, len(piece), crc, total, first + number, offset)
                rows.append((*row, piece) if ids else row)
                offset += len(piece)
            if len(rows) >= FLUSH_ROWS:
                yield flush(rows)
                rows = []
        if rows:
            yield flush(rows)

    return df.select(id, text).mapInArrow(run, schema)
