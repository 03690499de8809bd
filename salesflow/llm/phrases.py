"""Phrase collocations by partitioned mining (SON), scored and ranked per language.

A-Z count as a-z. Texts are split at ``.,;:!?`` and \\x0A-\\x0D into pieces and those at \\x20
and \\x09 into words; phrases are 2 to ``LONGEST`` neighbouring words of a piece, overlaps
included. A phrase of a language with at least ``support`` occurrences a is a candidate. Each
cut of it into two parts with l and r occurrences scores floor(2000000 a / (l + r)); the lowest
cut counts, ties to the smallest first part. Candidates inside a longer candidate of at least
80% of their count are dropped. Each language's first ``top`` by score, a and phrase return.

How: the table is dealt into ``SHARDS`` shards, whatever its size. A phrase with the support in
all of it has a shard with at least ceil(support / SHARDS), so each shard is mined completely
at that support, in many tasks, and the phrases frequent in any shard are the candidates: those
are counted over all shards, and those below the support go. Words come first, then pairs, then
longer phrases, whose pairs all have to be frequent. What a task may skip it knows from bitmaps
of bounded size; they let some others through, which the count by the words themselves removes.
Tasks count whole texts in blocks of ``BLOCK_BYTES`` (a longer text is a block of its own), so
frequent phrases are added up before any shuffle. What a shard counts travels packed, four bytes a
phrase (``filters.packed``). Phrases that share a key only let each other through, to the count by the words.

Null text has no words, null lang is ``und``. Repeated rows count again. Ids are not needed, so
null or shared ones make no difference, and other columns may have any name. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm import words
from salesflow.llm.filters import PACKED, bitmap, maybe, packed, reaching
from salesflow.session import cut

SUPPORT = 30
LONGEST = 4
SHARDS = 3
TOP = 2000
#: About 700,000 words.
BLOCK_BYTES = 4_000_000
#: Phrases a task adds up before it sends their counts on.
HELD = 4_000_000

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Block:
    """The words of some texts: hashes that also tell languages apart, and where they stand."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, bounds = words.buffers(texts)
        self.data = _LOWER[data[bounds[0] : bounds[-1]]]
        self.bytes = self.data.tobytes()
        breaks = _BREAK[self.data]
        hashes, self.first, self.size, ends = words.spelled(np.where(breaks, np.uint8(32), self.data), bounds - bounds[0])
        names = langs.dictionary_encode()
        self.names = names.dictionary.to_pylist()
        seeds = np.array([xxhash.xxh64_intdigest(n.encode()) for n in self.names], np.uint64)
        self.lang = np.repeat(names.indices.to_numpy(), np.diff(ends))
        self.words = words.mix(hashes ^ seeds[self.lang]) if len(hashes) else hashes
        seen = np.cumsum(breaks, dtype=np.int32)[self.first] if len(hashes) else np.zeros(0, np.int64)
        new = np.ones(len(hashes), bool)
        new[1:] = seen[1:] != seen[:-1]
        new[ends[:-1][np.diff(ends) > 0]] = True
        self.piece = np.cumsum(new)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first words, hashes) of all phrases of n words."""
        if len(self.words) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        out = self.words[: len(self.words) - n + 1]
        for k in range(1, n):
            out = out * _FACTOR + self.words[k : len(self.words) - n + 1 + k]
        at = np.flatnonzero(self.piece[: len(out)] == self.piece[n - 1 :])
        return at, words.mix(out[at] + np.uint64(n))

    def spell(self, at: np.ndarray, n: int) -> list[bytes]:
        """Phrases of n words from the given ones on, joined by single spaces."""
        data = self.bytes
        first, stop = self.first, self.first + self.size
        if n == 1:
            return [data[a:b] for a, b in zip(first[at].tolist(), stop[at].tolist(), strict=True)]
        spans = [(first[at + k].tolist(), stop[at + k].tolist()) for k in range(n)]
        parts = [[data[a:b] for a, b in zip(*s, strict=True)] for s in spans]
        return [b" ".join(p) for p in zip(*parts, strict=True)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in words.gathered(batches, "text", BLOCK_BYTES):
        yield Block(batch.column("text"), batch.column("lang"))


#: Which phrases of a block to count: positions in the arrays of grams().
Chooser = Callable[[Block, np.ndarray, np.ndarray, int], np.ndarray]


def _rows(df: DataFrame, text: str, lang: str) -> DataFrame:
    return df.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"))


def _local(docs: DataFrame, lengths: tuple[int, ...], passes: Chooser, enough: int) -> DataFrame:
    """(shard, part, keys, counts): occurrences of phrases in some blocks, packed; ``passes`` chooses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() % SHARDS
        held, size = [], 0
        for block in _blocks(batches):
            for n in lengths:
                at, hashes = block.grams(n)
                held.append(hashes[passes(block, at, hashes, n)])
                size += len(held[-1])
                if size >= HELD:
                    yield packed(held, shard, enough)
                    held, size = [], 0
        if size:
            yield packed(held, shard, enough)

    return docs.mapInArrow(run, PACKED)


def _spelled(docs: DataFrame, lengths: tuple[int, ...], passes: Chooser) -> DataFrame:
    """(lang, words, phrase, n): occurrences of phrases in each block, with the phrases themselves.

    With single words come rows of 0 words: how many words a language has in all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "words", "phrase", "n"]
        for block in _blocks(batches):
            langs = pa.array(block.names, pa.string())
            if 1 in lengths:
                all_words = np.bincount(block.lang, minlength=len(langs))
                nothing = np.zeros(len(langs), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [langs, pa.array(nothing.astype(np.int32)), pa.array([""] * len(langs)), pa.array(all_words)], names
                )
            for n in lengths:
                at, hashes = block.grams(n)
                chosen = passes(block, at, hashes, n)
                found, where, counts = np.unique(hashes[chosen], return_index=True, return_counts=True)
                first = at[chosen][where]
                for lo in range(0, len(found), 1 << 15):
                    part = slice(lo, lo + (1 << 15))
                    columns = [
                        langs.take(pa.array(block.lang[first[part]])),
                        pa.array(np.full(len(found[part]), n, np.int32)),
                        pa.array(block.spell(first[part], n), pa.binary()).cast(pa.string()),
                        pa.array(counts[part]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, "lang string, words int, phrase string, n bigint")


def _counted(found: DataFrame) -> DataFrame:
    """Counts over all shards, by the words themselves."""
    return found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))


def _hashes(phrases: DataFrame, n: int) -> DataFrame:
    """(hash) of phrases of n words each, as grams() has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(block.grams(n)[1].view(np.int64))], ["hash"])

    return phrases.select(F.col("phrase").alias("text"), "lang").mapInArrow(run, "hash bigint")


def _mined(docs: DataFrame, lengths: tuple[int, ...], passes: Chooser, support: int) -> DataFrame:
    """Phrases with the support in all of the table: mine the shards, then count what they found."""
    local = -(-support // SHARDS)
    frequent = bitmap(reaching(_local(docs, lengths, passes, local), local), "hash")

    def candidates(block: Block, at: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        chosen = passes(block, at, hashes, n)
        return chosen[maybe(frequent, hashes[chosen])]

    return cut(_counted(_spelled(docs, lengths, candidates)).where((F.col("f") >= support) | (F.col("words") == 0)))


def _everything(block: Block, at: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    return np.arange(len(at))


def _of_frequent(parts: Broadcast | None, size: int) -> Chooser:
    """Chooses phrases all of whose neighbouring ``size`` words may be frequent."""

    def passes(block: Block, at: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        good = np.zeros(len(block.words) + 1, bool)
        starts, parts_of = block.grams(size)
        good[starts] = maybe(parts, parts_of)
        keep = np.ones(len(at), bool)
        for k in range(n - size + 1):
            keep &= good[at + k]
        return np.flatnonzero(keep)

    return passes


def frequent(
    df: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, f) with f >= support, (lang, n) of all words)."""
    docs = _rows(df, text, lang)
    single = _mined(docs, (1,), _everything, support)
    sizes = single.where(F.col("words") == 0).select("lang", F.col("f").alias("n"))
    levels = [single.where(F.col("words") == 1)]
    if longest > 1:
        levels.append(_mined(docs, (2,), _of_frequent(bitmap(_hashes(levels[0], 1), "hash"), 1), support))
    if longest > 2:
        pairs = _of_frequent(bitmap(_hashes(levels[1], 2), "hash"), 2)
        levels.append(_mined(docs, tuple(range(3, longest + 1)), pairs, support))
    all_levels = levels[0]
    for level in levels[1:]:
        all_levels = all_levels.union(level)
    return all_levels, sizes


def _part(first: Column | int, last: Column) -> Column:
    """Words of a phrase from one to another, from 0."""
    return F.array_join(F.slice(F.split("phrase", " "), F.lit(first) + 1, last - F.lit(first) + 1), " ")


def scored(found: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of all phrases of two words and more."""
    several = found.where(F.col("words") >= 2).select("lang", "words", "phrase", F.col("f").alias("a"))
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "*", _part(0, F.col("k") - 1).alias("left"), _part(F.col("k"), F.col("words") - 1).alias("right")
    )
    known = found.select("lang", "phrase", "f")
    both = cuts.join(
        known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]
    ).join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    # Whole numbers of up to 38 digits: the product may pass 64 bits, the quotient does not.
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div cast(l + r as decimal(20,0))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return both.groupBy("lang", "words", "phrase", "a").agg(lowest.alias("cut")).select(
        "lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )


def outermost(scores: DataFrame) -> DataFrame:
    """Without phrases inside a longer one that has at least 80% of their occurrences."""
    spans = F.expr(
        "flatten(transform(sequence(2, words - 1), s -> transform(sequence(0, words - s), k -> named_struct('a', k, 'b', k + s - 1))))"
    )
    inner = (
        scores.where(F.col("words") > 2)
        .select("lang", "words", "phrase", "a", F.explode(spans).alias("span"))
        .select("lang", _part(F.col("span.a"), F.col("span.b")).alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    hundred = F.expr("100 * cast(longer as decimal(19,0)) >= 80 * cast(a as decimal(19,0))")
    return scores.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(hundred, F.lit(False))).drop("longer")


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    support: int = SUPPORT,
    longest: int = LONGEST,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    found, sizes = frequent(df, text, lang, support, longest)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = outermost(scored(found)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
