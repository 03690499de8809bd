"""Links within groups of any size, found in tiles of bounded size.

Members of a cell share a hash. Each cell names its smallest member as pivot, and all
members of a pivot are compared: a group is cut into blocks by a hash of the id, and each
pair of blocks is one tile, so a group of m members gives m * (number of blocks) rows. A
tile emits counts and one edge per linked member, never its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.session import cut

#: Linked positions (in left, in right) of two lists of payloads.
Compare = Callable[[list[bytes], list[bytes]], tuple[np.ndarray, np.ndarray]]


def pivots(cells: DataFrame, block_rows: int, block_bytes: int) -> DataFrame:
    """(id, groups): each id's pivots with their numbers of blocks, from (id, cell, bytes).

    Cells with one member give nothing. The tables joined are written first, so that a hot
    cell or pivot can be split by adaptive execution.
    """
    shared = cut(
        cells.groupBy("cell")
        .agg(F.min("id").alias("pivot"), F.max("id").alias("last"))
        .where(F.col("pivot") < F.col("last"))
        .select("cell", "pivot")
    )
    stars = cut(cells.join(shared, "cell").select("id", "pivot", "bytes").distinct())
    blocks = cut(
        stars.groupBy("pivot").agg(
            F.ceil(
                F.greatest(
                    F.count(F.lit(1)) / float(block_rows), F.sum("bytes") / float(block_bytes)
                )
            )
            .cast("int")
            .alias("blocks")
        )
    )
    return stars.join(blocks, "pivot").groupBy("id").agg(
        F.collect_list(F.struct("pivot", "blocks")).alias("groups")
    )


def tiles(members: DataFrame) -> DataFrame:
    """One row per member and tile, from (id, copies, groups, payload)."""
    block = F.expr("cast(pmod(xxhash64(id), group.blocks) as int)")
    spread = (
        members.select("id", "copies", "payload", F.col("groups.pivot").alias("pivots"), F.explode("groups").alias("group"))
        .select("id", "copies", "payload", "pivots", "group", block.alias("own"))
        .select("*", F.explode(F.expr("sequence(0, group.blocks - 1)")).alias("other"))
    )
    return spread.select(
        F.col("group.pivot").alias("pivot"),
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "id",
        "copies",
        "pivots",
        "payload",
    )


def local_roots(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each position the smallest id among those linked to it directly or over others."""
    roots = ids.copy()
    while len(a):
        low = np.minimum(roots[a], roots[b])
        before = roots.copy()
        np.minimum.at(roots, a, low)
        np.minimum.at(roots, b, low)
        if (roots == before).all():
            break
    return roots


def first_common(lists: pa.ListArray, a: np.ndarray, b: np.ndarray, pivot: int) -> np.ndarray:
    """Which pairs have no pivot in common that is smaller than this one."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    counts = np.diff(lists.offsets.to_numpy())
    smaller = flat < pivot
    names = np.unique(flat[smaller])
    if not len(names) or not len(a):
        return np.ones(len(a), bool)
    has = np.zeros((len(lists), len(names)), bool)
    owner = np.repeat(np.arange(len(lists)), counts)
    has[owner[smaller], np.searchsorted(names, flat[smaller])] = True
    has = np.packbits(has, axis=1)
    out = np.empty(len(a), bool)
    for lo in range(0, len(a), 1 << 16):
        part = slice(lo, lo + (1 << 16))
        out[part] = ~(has[a[part]] & has[b[part]]).any(1)
    return out


def _tile(rows: pa.Table, compare: Compare) -> pa.RecordBatch | None:
    side = rows["side"].to_numpy()
    ids = rows["id"].to_numpy()
    same = rows["i"][0].as_py() == rows["j"][0].as_py()
    first = np.flatnonzero(side == 0)
    second = first if same else np.flatnonzero(side == 1)
    if not len(first) or not len(second):
        return None
    payload = rows["payload"].to_pylist()
    a, b = compare([payload[k] for k in first], [payload[k] for k in second])
    a, b = first[a], second[b]
    keep = ids[a] != ids[b]
    if same:
        keep &= a < b
    a, b = a[keep], b[keep]
    if not len(a):
        return None
    roots = local_roots(ids, a, b)
    own = first_common(rows["pivots"].combine_chunks(), a, b, rows["pivot"][0].as_py())
    copies = rows["copies"].to_numpy()
    links = np.bincount(a[own], copies[b[own]], len(ids)) + np.bincount(b[own], copies[a[own]], len(ids))
    linked = np.unique(np.concatenate([a, b]))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[linked]), pa.array(links[linked].astype(np.int64)), pa.array(roots[linked])],
        ["id", "links", "root"],
    )


def compared(rows: DataFrame, compare: Compare) -> DataFrame:
    """(id, links, root) per tile and linked member: links counted here, smallest id linked here."""
    kind = dict(rows.dtypes)["id"]
    key = ["pivot", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not len(batch):
                continue
            columns = [batch.column(k).to_numpy() for k in range(3)]
            change = np.zeros(len(batch), bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), len(batch)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                now = tuple(c[lo] for c in columns)
                if held and now != last:
                    found = _tile(pa.Table.from_batches(held), compare)
                    held = []
                    if found is not None:
                        yield found
                last = now
                held.append(batch.slice(lo, hi - lo))
        if held:
            found = _tile(pa.Table.from_batches(held), compare)
            if found is not None:
                yield found

    return (
        rows.repartition(*key)
        .sortWithinPartitions(*key)
        .mapInArrow(run, f"id {kind}, links bigint, root {kind}")
    )
