"""N-gram Jaccard self join of texts by MinHash banding, with exact checks.

1. Texts become sets of hashed n-grams of lower-cased words; texts with equal word
   sequences form a class, and one of each class (the smallest id) goes on.
2. Signatures are cut into bands; band and row counts follow from the threshold and the
   wanted recall. Rows are shuffled on band hashes; each band group names its smallest
   member as pivot, which gives one (member, pivot) row per membership, never pairs.
3. All members of a pivot meet in tiles of bounded size: a group of m members is cut into
   blocks, and each pair of blocks is a tile. A tile compares full n-gram sets by matrix
   products and emits a count of links per member and one edge to the smallest linked
   member. A pair with several common pivots counts at the smallest of them. So the rows
   stay near the number of members, and no link is left out of the counts.
4. Classes of linked texts are the connected components of those edges.

Any size of group is worked through whole: more members mean more tiles, not a cap.

Texts with fewer words than n are one n-gram as a whole. Null texts and texts without
words link with nothing. Rows that repeat an id are one document with several texts: any
of them may link. Null ids are not compared. Empty tables give empty results; other
columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.graph import components
from salesflow.llm.tiles import compared, pivots, tiles
from salesflow.llm.words import mix, word_hashes
from salesflow.session import cut

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
#: Members of a block, and bytes of their sets.
BLOCK_ROWS = 512
BLOCK_BYTES = 4 << 20
#: N-grams compared by one matrix product.
COLUMNS = 4096

_rng = np.random.default_rng(7)
_MULTIPLIERS = _rng.integers(1, 1 << 31, MAX_HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADDENDS = _rng.integers(0, 1 << 32, MAX_HASHES, dtype=np.uint32)
_PLACES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands_for(
    threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES
) -> tuple[int, int]:
    """(bands, rows): the longest bands that find a pair at the threshold with the wanted recall."""
    best = (most, 1)
    for rows in range(1, 33):
        hit = threshold**rows
        bands = math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def ngram_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram hashes of a batch, bounds per text, two hashes of each text's word sequence).

    Two, because texts with equal sequences become one: 128 bits tell any number apart.
    """
    words, bounds = word_hashes(column)
    counts = np.diff(bounds)
    grams = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for k in range(n):
        grams += words[k : k + len(grams)] * _PLACES[k]
    grams = mix(grams)
    place = np.arange(len(words), dtype=np.uint64)
    # Position within the text, so that the sequence's hash is the same wherever it lies.
    place -= np.repeat(bounds[:-1], counts).astype(np.uint64)
    placed = mix(words + place * np.uint64(0x9E3779B97F4A7C15))
    wholes, others = np.zeros((2, len(counts)), np.uint64)
    filled = np.flatnonzero(counts)
    if len(filled):
        wholes[filled] = np.add.reduceat(placed, bounds[:-1][filled])
        others[filled] = np.add.reduceat(mix(placed * _PLACES[0] + _PLACES[2]), bounds[:-1][filled])
    wholes = mix(wholes + counts.astype(np.uint64))
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    long = counts >= n
    if long.any():
        take = np.repeat(bounds[:-1][long] - starts[long], sizes[long])
        where = np.concatenate([np.arange(a, b) for a, b in zip(starts[long], ends[long], strict=True)])
        out[where] = grams[where + take]
    short = (counts > 0) & ~long
    out[starts[short]] = wholes[short]
    return out, np.append(starts, ends[-1:] if len(ends) else 0), wholes, others


def signatures(
    df: DataFrame, id: str, text: str, n: int = NGRAM, bands: int = 24, rows: int = 5
) -> DataFrame:
    """(id, whole, other, bands, bytes): hashes of the word sequence (0 without words) and of the bands."""
    kind = dict(df.dtypes)[id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 64):
                part = batch.slice(lo, 64)
                grams, bounds, wholes, others = ngram_sets(part.column(1), n)
                filled = np.flatnonzero(np.diff(bounds))
                out = np.zeros((len(part), bands), np.uint64)
                if len(filled):
                    low = grams.astype(np.uint32)
                    starts = bounds[:-1][filled]
                    for b in range(bands):
                        band = np.full(len(filled), b, np.uint64)
                        for r in range(rows):
                            j = b * rows + r
                            least = np.minimum.reduceat(low * _MULTIPLIERS[j] + _ADDENDS[j], starts)
                            band = mix(band * _PLACES[1] + least)
                        out[filled, b] = band
                wholes[np.diff(bounds) == 0] = 0
                lists = pa.ListArray.from_arrays(
                    np.arange(0, out.size + 1, bands, dtype=np.int32), out.view(np.int64).ravel()
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(wholes.view(np.int64)),
                        pa.array(others.view(np.int64)),
                        lists,
                        pa.array(8 * np.diff(bounds)),
                    ],
                    ["id", "whole", "other", "bands", "bytes"],
                )

    return df.select(F.col(id), F.lower(text)).mapInArrow(
        run, f"id {kind}, whole bigint, other bigint, bands array<bigint>, bytes bigint"
    )


def similar(threshold: float):
    """Compares sets of n-grams, given as bytes of distinct 64-bit hashes."""

    def linked(left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # Only n-grams on both sides matter for the intersections.
        flat = [np.frombuffer(b"".join(side), np.uint64) for side in (left, right)]
        sizes = [np.array([len(s) // 8 for s in side]) for side in (left, right)]
        common = np.intersect1d(*flat)
        if left is not right and not len(common):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hits = []
        for grams, counts in zip(flat, sizes, strict=True):
            at = np.searchsorted(common, grams)
            at[at == len(common)] = 0
            found = common[at] == grams
            of = np.repeat(np.arange(len(counts)), counts)[found]
            order = np.argsort(at[found], kind="stable")
            hits.append((at[found][order], of[order]))
        shared = np.zeros((len(left), len(right)), np.float32)
        for lo in range(0, len(common), COLUMNS):
            hi = min(lo + COLUMNS, len(common))
            parts = []
            for (at, of), n in zip(hits, shared.shape, strict=True):
                a, b = np.searchsorted(at, (lo, hi))
                dense = np.zeros((n, hi - lo), np.float32)
                dense[of[a:b], at[a:b] - lo] = 1
                parts.append(dense)
            shared += parts[0] @ parts[1].T
        union = sizes[0][:, None] + sizes[1][None, :] - shared.astype(np.float64)
        return np.nonzero(shared >= threshold * union - 1e-9)

    return linked


def join(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    n: int = NGRAM,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """(id, class_id, n_links, n_copies) of every row with an id.

    ``n_links`` counts the other rows linked directly, ``n_copies`` the rows with the same
    words; ``class_id`` is the smallest id reachable over links.
    """
    bands, rows = bands_for(threshold, recall)
    kind = dict(df.dtypes)[id]
    signed = cut(
        signatures(df.where(F.col(id).isNotNull()), id, text, n, bands, rows).withColumn(
            # Texts without words are classes of their own.
            "whole", F.when(F.col("whole") != 0, F.col("whole"))
        )
    )
    classes = cut(
        signed.where(F.col("whole").isNotNull())
        .groupBy("whole", "other")
        .agg(
            F.min("id").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("bands").alias("bands"),
            F.first("bytes").alias("bytes"),
        )
    )
    light = classes.select(F.col("rep").alias("id"), "whole", "other", "copies")
    groups = pivots(
        classes.select(F.col("rep").alias("id"), F.explode("bands").alias("cell"), "bytes"),
        BLOCK_ROWS,
        BLOCK_BYTES,
    )
    texts = df.where(F.col(id).isNotNull()).select(F.col(id).alias("id"), F.lower(text).alias("text"))
    members = groups.join(light, "id").join(texts, "id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 64):
                part = batch.slice(lo, 64)
                grams, bounds, wholes, _ = ngram_sets(part.column("text"), n)
                # A repeated id may come with other texts than the class's own.
                same = wholes.view(np.int64) == part.column("whole").to_numpy()
                payload = [
                    np.unique(grams[bounds[k] : bounds[k + 1]]).tobytes() if same[k] else None
                    for k in range(len(part))
                ]
                names = ["id", "copies", "groups"]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(payload, pa.binary())],
                    [*names, "payload"],
                )

    payload = members.select("id", "copies", "whole", "groups", "text").mapInArrow(
        sets,
        f"id {kind}, copies bigint, groups array<struct<pivot: {kind}, blocks: int>>, payload binary",
    )
    found = cut(compared(tiles(payload.where(F.col("payload").isNotNull())), similar(threshold)))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = (
        light.join(links, "id", "left")
        .join(roots, "id", "left")
        .select(
            "whole",
            "other",
            F.coalesce("root", "id").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.col("copies").alias("n_copies"),
        )
    )
    return signed.select("id", "whole", "other").join(named, ["whole", "other"], "left").select(
        F.col("id").alias(id),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"),
    )
