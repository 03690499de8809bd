"""Removal of passages that stand in several places, by suffix automata of reference shards.

Words are runs of bytes other than \\x20 and \\x09-\\x0D, unchanged. A window is ``length``
neighbouring words of a text. Each word covered by a window whose words also start anywhere
else, in the same text too, is removed; windows are judged on the input.

How: each window has an anchor, the shorter run of words in it with the least hash (the first of
equal ones), so equal windows have equal anchors. Neighbouring windows with one anchor are a
passage. Anchors met once are passed over, by a bitmap of bounded size that may let others
through. Equal passages are counted, and of each one copy is fetched, as its words: these are the reference.
It is dealt into shards of about ``SHARD_WORDS`` words, the passages of an anchor together.
A task builds the suffix automaton of a shard, with the places each of its states ends at, and
streams the passages through it for matching statistics: the longest run that ends at a word and
stands in two places. Where that reaches ``length``, the window goes. Every window lies in one
passage, so an automaton counts all its places in the table.

The corpus is its own reference here, so automata are not sent to all documents, which would
cost documents times shards; the passages of the documents come to the one automaton that can
know them. An anchor with more than ``MOST_PASSAGES`` different passages is dealt out by the
hashes of its windows, so no shard grows with a hot passage. Results are exact. Texts without a
passage that goes are not shuffled; a bitmap of the others tells them apart.

Null and empty texts have no words. Rows that repeat a text are other places, so texts of
``length`` words or more that repeat lose all their words. Ids are not needed: null or shared
ones make no difference. Texts are worked through whole, however long. An empty table gives no
rows. A result name that the table has already gets the prefix ``_cut_``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm import filters, words
from salesflow.llm.filters import PACKED, bitmap, maybe, packed, reaching
from salesflow.session import cut

LENGTH = 35
#: Windows of a passage at most; anchors are that much shorter than windows.
REACH = 24
SHARD_WORDS = 50_000
MOST_PASSAGES = 2_048
BLOCK_BYTES = 6_000_000
#: Passages whose anchors a task counts before it sends them on.
HELD = 4_000_000

_SEGMENT = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = 0x9E3779B1
_OWN = "_cut_"


class Passages:
    """The passages of some texts: where they begin, how many windows they have, their hashes."""

    def __init__(self, texts: pa.Array, length: int):
        self.length = length
        self.data, bounds = words.buffers(texts)
        self.words, self._first, self._size, self.bounds = words.spelled(self.data, bounds)
        n = len(self.words)
        powers = np.full(n + 1, _FACTOR, np.uint64)
        back = np.full(n + 1, _BACK, np.uint64)
        powers[0] = back[0] = 1
        np.cumprod(powers, out=powers)
        self._back = np.cumprod(back, out=back)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.words * powers[:-1], out=self._sums[1:])
        of = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        starts, anchors = self._windows(of)
        new = np.ones(len(starts), bool)
        new[1:] = anchors[1:] != anchors[:-1]
        first = np.flatnonzero(new)
        self.begin = starts[first]
        self.windows = np.diff(first, append=len(starts))
        self.text = of[self.begin]
        self.start = self.begin - self.bounds[self.text]
        size = self._anchor_words()
        self.anchor = self._hash(anchors[first], anchors[first] + size)
        self.hash = self._hash(self.begin, self.end) + self.windows.astype(np.uint64)

    @property
    def end(self) -> np.ndarray:
        return self.begin + self.windows + self.length - 1

    def _anchor_words(self) -> int:
        return self.length - min(REACH, self.length) + 1

    def _hash(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return words.mix((self._sums[hi] - self._sums[lo]) * self._back[lo])

    def _windows(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows, and of their anchors."""
        reach, size = min(REACH, self.length), self._anchor_words()
        starts, anchors = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        total = len(self.words) - self.length + 1
        for lo in range(0, max(total, 0), _SEGMENT):
            hi = min(lo + _SEGMENT, total)
            at = np.arange(lo, hi + reach - 1)
            key = (self._hash(at, at + size) & ~_PLACE) | (at - lo).astype(np.uint64)
            span = 1
            while 2 * span <= reach:
                key = np.minimum(key[:-span], key[span:])
                span *= 2
            if span < reach:
                key = np.minimum(key[: hi - lo], key[reach - span : reach - span + hi - lo])
            inside = np.flatnonzero(of[lo:hi] == of[lo + self.length - 1 : hi + self.length - 1])
            starts.append(inside + lo)
            anchors.append((key[: hi - lo][inside] & _PLACE).astype(np.int64) + lo)
        return np.concatenate(starts), np.concatenate(anchors)

    def spell(self, at: np.ndarray) -> list[bytes]:
        """The words of the given passages, joined by single spaces."""
        last = self.end[at] - 1
        spans = zip(self._first[self.begin[at]].tolist(), (self._first[last] + self._size[last]).tolist(), strict=True)
        return [b" ".join(self.data[a:b].tobytes().split()) for a, b in spans]

    def places(self, texts: np.ndarray) -> np.ndarray:
        """Where each passage stands, from hashes of the texts; as _place() has it."""
        return (texts[self.text] ^ (self.start * _STEP)).view(np.uint64)


class Automaton:
    """A suffix automaton of word sequences, each with a weight: the number of its places."""

    def __init__(self, sequences: list[tuple[list[int], int]]):
        self.steps: list[dict[int, int]] = [{}]
        self.links, self.lengths = [-1], [0]
        for sequence, _ in sequences:
            self._add(sequence)
        counts = [0] * len(self.steps)
        for sequence, weight in sequences:
            state = 0
            for word in sequence:
                state = self.steps[state][word]
                counts[state] += weight
        for state in sorted(range(1, len(counts)), key=self.lengths.__getitem__, reverse=True):
            counts[self.links[state]] += counts[state]
        self.counts = counts

    def _add(self, sequence: list[int]) -> None:
        steps, links, lengths = self.steps, self.links, self.lengths
        last = 0
        for word in sequence:
            known = steps[last].get(word)
            if known is not None:
                last = known if lengths[known] == lengths[last] + 1 else self._split(last, word, known)
                continue
            state = len(steps)
            steps.append({})
            links.append(0)
            lengths.append(lengths[last] + 1)
            at = last
            while at >= 0 and word not in steps[at]:
                steps[at][word] = state
                at = links[at]
            if at >= 0:
                known = steps[at][word]
                links[state] = known if lengths[known] == lengths[at] + 1 else self._split(at, word, known)
            last = state

    def _split(self, at: int, word: int, known: int) -> int:
        """The part of a state that the shorter sequences reach, as a state of its own."""
        steps, links, lengths = self.steps, self.links, self.lengths
        state = len(steps)
        steps.append(dict(steps[known]))
        links.append(links[known])
        lengths.append(lengths[at] + 1)
        while at >= 0 and steps[at].get(word) == known:
            steps[at][word] = state
            at = links[at]
        links[known] = state
        return state

    def statistics(self, sequence: list[int], places: int = 2) -> list[int]:
        """For each word the length of the longest run that ends there and stands in so many places."""
        steps, links, lengths, counts = self.steps, self.links, self.lengths, self.counts
        state = length = 0
        out = []
        for word in sequence:
            while True:
                after = steps[state].get(word)
                if after is not None and counts[after] >= places:
                    state, length = after, length + 1
                    break
                if state == 0:
                    length = 0
                    break
                state = links[state]
                length = lengths[state]
            out.append(length)
        return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, int, list[int]]]]:
    """(key, passage, weight, hashes of the words) in shards that end with a key.

    Rows come sorted by key and passage: one with the weight, then those with the words, from as
    many tasks as fetched them. Words that nobody asked for have no weight before them.
    """
    shard, size, asked = [], 0, None
    for batch in batches:
        hashes, bounds = words.word_hashes_exact(batch.column(3))
        hashes = hashes.view(np.int64)
        bounds = bounds.tolist()
        rows = zip(*[c.to_pylist() for c in batch.columns[:3]], bounds[:-1], bounds[1:], strict=True)
        for key, passage, weight, lo, hi in rows:
            if weight is not None:
                asked = (key, passage, weight)
            elif asked is not None and asked[:2] == (key, passage):
                if size >= SHARD_WORDS and key != shard[-1][0]:
                    yield shard
                    shard, size = [], 0
                shard.append((*asked, hashes[lo:hi].tolist()))
                size += hi - lo
                asked = None
    if shard:
        yield shard


def _judged(asked: DataFrame, contents: DataFrame, length: int) -> DataFrame:
    """(key, passage, mask): bit k is set where the passage's window k stands in two places.

    ``asked`` has key, passage and weight, ``contents`` key, passage and words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            sequences = [(row[3], row[2]) for row in shard]
            automaton = Automaton(sequences)
            masks = []
            for sequence, _ in sequences:
                found = automaton.statistics(sequence)[length - 1 :]
                masks.append(sum(1 << k for k, n in enumerate(found) if n >= length))
            columns = [[row[0] for row in shard], [row[1] for row in shard], masks]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "passage", "mask"])

    rows = asked.select("key", "passage", "weight", F.lit(None).cast("binary").alias("words")).union(
        contents.select("key", "passage", F.lit(None).cast("long"), "words")
    )
    together = rows.repartition("key").sortWithinPartitions("key", "passage", F.col("weight").asc_nulls_last())
    return together.mapInArrow(run, "key bigint, passage bigint, mask bigint")


def _hashed(docs: DataFrame, length: int, run) -> DataFrame:
    """What ``run`` makes of the passages of each block of texts."""
    make, schema = run

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in words.gathered(batches, "text", BLOCK_BYTES):
            columns = make(Passages(batch.column("text"), length), batch)
            for lo in range(0, len(columns[0]), 1 << 14):
                part = [c[lo : lo + (1 << 14)] for c in columns]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in part], names)

    return docs.mapInArrow(work, schema)


def _by_windows(rows: DataFrame, length: int) -> DataFrame:
    """Masks of passages whose anchor has too many for one shard: window by window."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            all_words, bounds = words.word_hashes_exact(batch.column(3))
            for at, (key, passage, weight, raw) in enumerate(zip(*[c.to_pylist() for c in batch.columns], strict=True)):
                seq, parts = all_words[bounds[at] : bounds[at + 1]], raw.split()
                for k in range(len(seq) - length + 1):
                    window = seq[k : k + length]
                    hashes = [int(words.mix(np.cumsum(words.mix(window + np.uint64(s)) * _FACTOR, dtype=np.uint64)).sum().view(np.int64)) for s in (1, 2)]
                    for c, v in zip(out, (key, passage, k, weight, hashes, b" ".join(parts[k : k + length])), strict=True):
                        c.append(v)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(out, types, strict=False)]
            first, second = ([h[s] for h in out[4]] for s in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(out[5], pa.binary())],
                ["key", "passage", "bit", "weight", "window", "other", "words"],
            )

    once = rows.groupBy("key", "passage").agg(F.first("weight").alias("weight"), F.first("words").alias("words"))
    windows = cut(
        once.mapInArrow(
            split, "key bigint, passage bigint, bit int, weight bigint, window bigint, other bigint, words binary"
        )
    )
    each = windows.groupBy("window", "other").agg(F.sum("weight").alias("weight"), F.first("words").alias("words"))
    asked = each.select(F.col("window").alias("key"), F.col("other").alias("passage"), "weight", "words")
    again = _judged(asked, asked, length).where(F.col("mask") != 0).select(F.col("key").alias("window"), F.col("passage").alias("other"))
    bit = F.expr("shiftleft(1L, bit)")
    return windows.join(again, ["window", "other"]).groupBy("key", "passage").agg(F.bit_or(bit).alias("mask"))


def repeated(docs: DataFrame, length: int = LENGTH, most_passages: int = MOST_PASSAGES) -> DataFrame:
    """(h1, h2, spans) of texts with windows that stand in several places.

    ``docs`` has h1, h2, a text's hashes, and text; ``spans`` are (start, mask) of passages:
    their first words, and which of the windows from there on go.
    """
    several = bitmap(reaching(_counted_anchors(docs, length), 2), "hash")

    def candidates(found: Passages, batch: pa.RecordBatch) -> list:
        at = np.flatnonzero(maybe(several, found.anchor))
        h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
        text = found.text[at]
        return [h1[text], h2[text], found.start[at].astype(np.int32), found.anchor[at].view(np.int64), found.hash[at].view(np.int64)]

    # Made twice, from the texts: that takes less than to keep it.
    places = _hashed(docs, length, (candidates, "h1 bigint, h2 bigint, start int, key bigint, passage bigint"))
    copy = F.min(F.struct("h1", "h2", "start"))
    passages = cut(
        places.groupBy("key", "passage").agg(F.count(F.lit(1)).alias("weight"), copy.alias("copy")).select("key", "passage", "weight", "copy.*")
    )
    totals = passages.groupBy("key").agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("kinds"))
    # Other bits of the anchors than in the first bitmap, so that what it let through is held back.
    other = F.shiftrightunsigned("key", 34)
    reference = passages.where(_may(bitmap(totals.where(F.col("total") > 1), other), other))
    # A bitmap may call a few anchors hot that are not: that takes longer, results are the same.
    hot_keys = filters.bitmap(totals.where(F.col("kinds") > most_passages), other, each=4096)
    if hot_keys is not None and not hot_keys.value.words.any():
        masks = _judged(reference, _contents(_distinct(docs), reference, several, length), length)
    else:
        is_hot = _may(hot_keys, other)
        some, hot = reference.where(~is_hot), reference.where(is_hot)
        masks = _judged(some, _contents(_distinct(docs), some, several, length), length)
        rows = _contents(docs, hot, several, length).join(hot.select("key", "passage", "weight"), ["key", "passage"])
        masks = masks.unionByName(_by_windows(rows.select("key", "passage", "weight", "words"), length))
    gone = places.join(masks.where(F.col("mask") != 0), ["key", "passage"])
    return gone.groupBy("h1", "h2").agg(F.collect_set(F.struct("start", "mask")).alias("spans"))


def _distinct(docs: DataFrame) -> DataFrame:
    """One row for each text; only texts that repeat are shuffled."""
    numbers = docs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    repeats = _may(filters.bitmap(numbers.where(F.col("n") > 1), "h1", each=256), "h1")
    return docs.where(~repeats).union(docs.where(repeats).dropDuplicates(["h1", "h2"]))


def _may(held: Broadcast | None, column: str | Column) -> Column:
    """Whether a column of hashes may be in a bitmap."""

    def found(hashes: pa.Array) -> pa.Array:
        return pa.array(held.value.has(hashes.to_numpy(zero_copy_only=False).view(np.uint64)))

    return F.lit(True) if held is None else F.arrow_udf(found, "boolean")(column)


def _contents(docs: DataFrame, reference: DataFrame, several: Broadcast | None, length: int) -> DataFrame:
    """(key, passage, words) of the copies named in the reference, and maybe of others.

    By a bitmap of their places, or where there are too many, by a join with their texts. Other
    passages than those of the anchors in ``several`` are passed over.
    """
    place = F.col("h1").bitwiseXOR(F.col("start") * F.lit(_STEP).cast("long"))
    copies = bitmap(reference, place)
    if copies is None:
        named = reference.groupBy("h1", "h2").agg(F.collect_set("start").alias("starts"))
        docs = docs.join(named, ["h1", "h2"])

    def contents(found: Passages, batch: pa.RecordBatch) -> list:
        if copies is None:
            lists = batch.column("starts")
            of = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
            wanted = (of << 32) + lists.flatten().to_numpy()
            at = np.flatnonzero(np.isin((found.text << 32) + found.start, wanted))
        else:
            at = np.flatnonzero(maybe(several, found.anchor) & copies.value.has(found.places(batch.column("h1").to_numpy())))
        at = at[np.unique(found.hash[at], return_index=True)[1]]
        return [found.anchor[at].view(np.int64), found.hash[at].view(np.int64), pa.array(found.spell(at), pa.binary())]

    return _hashed(docs, length, (contents, "key bigint, passage bigint, words binary"))


def _counted_anchors(docs: DataFrame, length: int) -> DataFrame:
    """Counts of the anchors of all passages, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in words.gathered(batches, "text", BLOCK_BYTES):
            held.append(Passages(batch.column("text"), length).anchor)
            size += len(held[-1])
            if size >= HELD:
                yield packed(held, 0, 2)
                held, size = [], 0
        if size:
            yield packed(held, 0, 2)

    return docs.select("text").mapInArrow(run, PACKED)


def remove(df: DataFrame, text: str = "text", length: int = LENGTH, most_passages: int = MOST_PASSAGES) -> DataFrame:
    """``df`` with n_words, n_removed, and ``kept``: the words left, joined by single spaces."""
    hashes = {f"{_OWN}h1": F.xxhash64(F.col(text)), f"{_OWN}h2": F.xxhash64(F.lit(1), F.col(text))}
    docs = df.select(*[c.alias(n.removeprefix(_OWN)) for n, c in hashes.items()], F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = repeated(docs, length, most_passages)

    def left(texts: pa.Array, marks: pa.Array) -> pa.Array:
        out = []
        for said, spans in zip(texts.cast(pa.large_binary()).to_pylist(), marks.to_pylist(), strict=True):
            parts = said.split() if said else []
            if spans:
                gone = bytearray(len(parts))
                for span in spans:
                    for k in range(span["mask"].bit_length()):
                        if span["mask"] >> k & 1:
                            a = span["start"] + k
                            gone[a : a + length] = b"\1" * length
                kept = [w for w, g in zip(parts, gone, strict=True) if not g]
            else:
                kept = parts
            out.append({"n_words": len(parts), "n_removed": len(parts) - len(kept), "kept": b" ".join(kept).decode()})
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))

    answer = F.arrow_udf(left, "struct<n_words: bigint, n_removed: bigint, kept: string>")
    spans = cut(spans.select(F.col("h1").alias(f"{_OWN}h1"), F.col("h2").alias(f"{_OWN}h2"), F.col("spans").alias(f"{_OWN}spans")))
    # Only texts that may lose words are shuffled to their spans.
    loses = _may(filters.bitmap(spans, f"{_OWN}h1", each=256), f"{_OWN}h1")
    rows = df.withColumns(hashes)
    marked = rows.where(loses).join(spans, [f"{_OWN}h1", f"{_OWN}h2"], "left")
    marked = marked.unionByName(rows.where(~loses).withColumn(f"{_OWN}spans", F.lit(None).cast(spans.schema[-1].dataType)))
    done = marked.withColumn(f"{_OWN}answer", answer(F.col(text), F.col(f"{_OWN}spans")))
    return done.select(
        *df.columns,
        *[F.col(f"{_OWN}answer.{c}").alias(f"{_OWN}{c}" if c in df.columns else c) for c in ("n_words", "n_removed", "kept")],
    )
