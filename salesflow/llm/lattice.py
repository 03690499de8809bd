"""Near-duplicate embeddings by E8 lattice hashing, checked by exact cosine.

Unit vectors are projected to eight dimensions by several random matrices and decoded to
the nearest point of the E8 lattice; a vector also enters the cells of the neighbouring
points (of the 240 nearest to its own) that lie closest to its projection. A cell joins
the points of two projections, whatever the number of vectors: the links found do not depend
on the table's size. Vectors that
share a cell meet in tiles (see ``tiles``) and are compared by cosine in double precision;
equal vectors are one member with a count. Components of the links follow.

Vectors that are null, zero, or hold null or non-finite components link with nothing; so do
rows with a null id. Vectors of different lengths never link. Rows repeated with one id and
vector count as other rows. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.graph import components
from salesflow.llm.tiles import compared, pivots, tiles
from salesflow.llm.words import mix
from salesflow.session import cut

THRESHOLD = 0.95
#: Vectors a plan is cheapest up to, and lattice codes joined to one cell, tables, neighbouring
#: cells probed per code, and length of a lattice unit in standard deviations of a projected unit
#: vector. All find a pair at the threshold with a chance of 0.99; longer codes keep the number of
#: unrelated vectors in a cell about the same as there are more vectors.
PLANS = (
    (200_000, (1, 10, 8, 0.6)),
    (20_000_000, (2, 20, 2, 1.0)),
    (math.inf, (3, 48, 2, 1.0)),
)
#: The plan of all tables unless the caller names another.
PLAN = PLANS[1][1]
BLOCK_ROWS = 1024
BLOCK_BYTES = 8 << 20
ROWS_AT_ONCE = 512
_STEP = 0x9E3779B97F4A7C15


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    rows = []
    for a, b in combinations(range(8), 2):
        for s, t in product((1.0, -1.0), repeat=2):
            row = np.zeros(8)
            row[a], row[b] = s, t
            rows.append(row)
    rows += [np.array(s) / 2 for s in product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(rows)


ROOTS = _roots()
_HASH = np.random.default_rng(8).integers(1, 1 << 62, 8, dtype=np.int64) * 2 + 1


def _d8(y: np.ndarray) -> np.ndarray:
    """Nearest whole points with an even sum."""
    x = np.rint(y)
    odd = np.flatnonzero(x.sum(1) % 2)
    gap = y[odd] - x[odd]
    worst = np.abs(gap).argmax(1)
    x[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return x


def decode(y: np.ndarray) -> np.ndarray:
    """Nearest E8 points of rows of eight numbers."""
    a, b = _d8(y), _d8(y - 0.5) + 0.5
    near = ((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1)
    return np.where(near[:, None], a, b)


def cells(unit: np.ndarray, codes: int, tables: int, probes: int, cell: float) -> np.ndarray:
    """Hashes of the lattice cells of unit vectors: (rows, tables * (1 + probes) ** codes)."""
    size = unit.shape[1]
    out = np.empty((len(unit), tables, (1 + probes) ** codes), np.uint64)
    for t in range(tables):
        joined = np.full((len(unit), 1), t, np.uint64)
        for k in range(codes):
            seed = t * codes + k
            salt = np.random.default_rng((seed, size)).integers(1, 1 << 62)
            matrix = np.random.default_rng((size, seed)).standard_normal((size, 8)) / cell
            y = unit @ matrix
            own = decode(y)
            gain = (y - own) @ ROOTS.T
            near = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
            points = np.concatenate([own[:, None, :], own[:, None, :] + ROOTS[near]], axis=1)
            code = (np.rint(points * 2).astype(np.int64) @ _HASH + salt).view(np.uint64)
            joined = mix(joined[:, :, None] * np.uint64(_STEP) + mix(code)[:, None, :])
            joined = joined.reshape(len(unit), -1)
        out[:, t] = joined
    return out.reshape(len(unit), -1)


def _unit(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length one, and which rows can be: finite and not zero."""
    with np.errstate(all="ignore"):
        # Scaling by the largest component first keeps very small and large vectors.
        scaled = raw / np.abs(raw).max(1, keepdims=True)
        unit = scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))
    return unit, np.isfinite(unit).all(1)


def _close(threshold: float, number: type):
    """Compares vectors given as bytes of ``number``, in double precision."""

    def units(side: list[bytes]) -> np.ndarray:
        return _unit(np.frombuffer(b"".join(side), number).reshape(len(side), -1).astype(np.float64))[0]

    def linked(left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        a, b = units(left), units(right)
        return np.nonzero(a @ b.T >= threshold)

    return linked


def near_duplicates(
    df: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
    plan: tuple[int, int, int, float] = PLAN,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    ``plan`` is (codes, tables, probes, cell). The default is the same for any number of rows;
    beyond some 20 million vectors the last of ``PLANS`` compares fewer pairs.
    """
    kind = dict(df.dtypes)[id]
    single = dict(df.dtypes)[vector] == "array<float>"
    number = np.float32 if single else np.float64
    values = F.col(vector) if single else F.col(vector).cast("array<double>")
    rows = df.select(F.col(id).alias("id"), values.alias("v"))
    keyed = rows.withColumn("key", F.when(F.col("id").isNotNull(), F.xxhash64("v")))
    # Equal vectors are told apart from equal hashes by the vector itself.
    classes = cut(
        keyed.where(F.col("id").isNotNull() & F.col("v").isNotNull())
        .groupBy("key", "v")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(lo, ROWS_AT_ONCE)
                lists = part.column("v")
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                lengths = np.diff(lists.offsets.to_numpy())
                ends = np.cumsum(lengths)
                for size in np.unique(lengths[lengths > 0]):
                    at = np.flatnonzero(lengths == size)
                    raw = flat[(ends[at] - size)[:, None] + np.arange(size)].astype(np.float64)
                    unit, fine = _unit(raw)
                    at, unit = at[fine], unit[fine]
                    if not len(at):
                        continue
                    found = cells(unit, *plan)
                    offsets = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(part.column(c).take(pa.array(at)) for c in ("key", "id", "copies")),
                            pa.array([r.astype(number).tobytes() for r in raw[fine]], pa.binary()),
                            pa.ListArray.from_arrays(offsets, found.view(np.int64).ravel()),
                        ],
                        ["key", "id", "copies", "payload", "cells"],
                    )

    usable = cut(
        classes.select("key", "id", "copies", "v").mapInArrow(
            run, f"key bigint, id {kind}, copies bigint, payload binary, cells array<bigint>"
        )
    )
    groups = pivots(
        usable.select("id", F.explode("cells").alias("cell"), F.length("payload").alias("bytes")),
        BLOCK_ROWS,
        BLOCK_BYTES,
    )
    members = groups.join(usable.select("id", "copies", "payload"), "id")
    found = cut(compared(tiles(members), _close(threshold, number)))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = (
        usable.select("key", "id", "copies")
        .join(links, "id", "left")
        .join(roots, "id", "left")
        .select(
            "key",
            F.coalesce("root", "id").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    root = F.coalesce("component_id", "id")
    return keyed.select("id", "key").join(named, "key", "left").select(
        F.col("id").alias(id),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        root.alias("component_id"),
        F.coalesce(F.col("id") == root, F.lit(True)).alias("kept"),
    )
