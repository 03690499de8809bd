"""Regression trees grown from histograms: boosting of second order, and forests with a least
number of rows to split.

Each feature's values are put into bins, by its exact quantiles or one bin for each of a few
values. A tree grows level by level: tasks add up, for each open node, column and bin, the
gradients, the Hessians and the rows, Spark adds those up, and only these sums leave the tasks:
at most ``MOST_SUMS`` a pass, whatever the table. A node with few rows is grown to its end by
one task, with the same result. The best split of a node has the largest gain

    G_l^2 / (H_l + penalty) + G_r^2 / (H_r + penalty) - G^2 / (H + penalty)

with ties to the first column and the lowest bin. With squared error the gradient is prediction
minus label and the Hessian 1, so ``penalty=0`` and a first tree give the least squares tree.
Gradients are added as whole numbers of ``SCALE``-ths, so any partitioning gives the same model.

Rows and columns drawn for a tree follow from hashes of the row's content or the column's place
and of the tree's number, not from partitions. Missing values count as 0 and null labels are not
learned from. A table without rows gives a model that predicts 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.session import cut

BINS = 256
#: Gradients are added in units of one millionth of a label's unit.
SCALE = 1_000_000

_OWN = "_tree_"


@dataclass(frozen=True)
class Settings:
    trees: int = 100
    depth: int = 6
    rate: float = 0.1
    penalty: float = 1.0
    least_gain: float = 0.0
    least_rows: int = 1
    split_rows: int = 2
    rows: float = 1.0
    columns: float = 1.0
    bins: int = BINS
    seed: int = 42
    boosted: bool = True


# The settings of the compared learners.
SECOND_ORDER = Settings(trees=200, depth=8, rate=0.1, rows=0.8, columns=0.8)
DEEP_FOREST = Settings(trees=100, depth=20, rate=1.0, penalty=0.0, least_rows=2, split_rows=5, boosted=False)


@dataclass
class Tree:
    """Nodes by number: 1 is the root, 2n and 2n+1 are the children of n."""

    splits: dict[int, tuple[int, float]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)
    gains: dict[int, tuple[int, float]] = field(default_factory=dict)

    def arrays(self) -> tuple[np.ndarray, ...]:
        """(column, threshold, left, right, value) of nodes in order; column -1 is a leaf."""
        numbers = sorted({*self.splits, *self.leaves})
        place = {n: k for k, n in enumerate(numbers)}
        column = np.array([self.splits[n][0] if n in self.splits else -1 for n in numbers])
        threshold = np.array([self.splits[n][1] if n in self.splits else 0.0 for n in numbers])
        left = np.array([place[2 * n] if n in self.splits else 0 for n in numbers])
        right = np.array([place[2 * n + 1] if n in self.splits else 0 for n in numbers])
        return column, threshold, left, right, np.array([self.leaves.get(n, 0.0) for n in numbers])


@dataclass
class TreeModel:
    """Trees whose leaves are added up (boosting) or averaged (forest) to a base value."""

    features: tuple[str, ...]
    base: float
    trees: list[Tree]
    boosted: bool

    def importances(self) -> list[tuple[str, float]]:
        """Each feature's share of all gains, the greatest first."""
        total = dict.fromkeys(range(len(self.features)), 0.0)
        for tree in self.trees:
            for _, (column, gain) in sorted(tree.gains.items()):
                total[column] += gain
        whole = sum(total.values()) or 1.0
        return sorted(((self.features[c], g / whole) for c, g in total.items()), key=lambda x: (-x[1], x[0]))

    def values(self, columns: np.ndarray) -> np.ndarray:
        """Predictions for rows given as (features, rows)."""
        total = np.zeros(columns.shape[1])
        for column, threshold, left, right, value in (t.arrays() for t in self.trees):
            at = np.zeros(columns.shape[1], np.int64)
            while True:
                split = column[at] >= 0
                if not split.any():
                    break
                low = columns[np.maximum(column[at], 0), np.arange(len(at))] <= threshold[at]
                at = np.where(split, np.where(low, left[at], right[at]), at)
            total += value[at]
        return self.base + (total if self.boosted else total / max(len(self.trees), 1))

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self)
        count = len(self.features)

        def run(*features: pa.Array) -> pa.Array:
            return pa.array(shared.value.values(np.stack([f.to_numpy(zero_copy_only=False) for f in features]).reshape(count, -1)))

        score = F.arrow_udf(run, "double")
        return df.withColumn(name, score(*[_number(c) for c in self.features]))


def _number(name: str):
    value = F.col(name).cast("double")
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(value)


def thresholds(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper edges of the bins of each feature, the last bin open; at most ``bins - 1``.

    A feature with few values gets an edge between each two of them; of others a frequent value
    gets a bin, and the others bins of about equal rows, by the built-in quantile summaries.
    """
    shares = [k / bins for k in range(1, bins)]
    few = df.agg(*[F.approx_count_distinct(c).alias(c) for c in features]).first()
    plain = [c for c in features if few[c] <= bins // 2]
    exact: dict[str, list[float]] = {}
    if plain:
        found = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in plain]).first()
        exact = {c: [float(v) for v in found[c]] for c in plain if len(found[c]) <= bins}
    rest = [c for c in features if c not in exact]
    marks = dict(zip(rest, df.approxQuantile(rest, shares, 1 / (8 * bins)) if rest else [], strict=True))
    out = []
    for c in features:
        if c in exact:
            values = np.array(exact[c])
            out.append((values[:-1] + values[1:]) / 2 if len(values) > 1 else np.zeros(0))
            continue
        edges, seen = np.unique(np.array(marks[c], float), return_counts=True)
        if len(edges) < len(shares):
            # Frequent values took several marks: those go to the other values.
            often = [float(v) for v in edges[seen > 1]]
            left = max(2, bins - len(often))
            others = df.where(~F.col(c).isin(often)).approxQuantile(c, [k / left for k in range(1, left)], 1 / (8 * bins))
            edges = np.unique([*often, *others])[: bins - 1]
        out.append(edges)
    return out


def _binned(df: DataFrame, features: Sequence[str], label: str, edges: list[np.ndarray]) -> DataFrame:
    """(id, label, bins): one unsigned byte or short for each feature, and a hash of the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.stack([np.searchsorted(e, batch.column(k + 2).to_numpy(zero_copy_only=False), "left") for k, e in enumerate(edges)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _cells(place)], ["id", "label", "bins"])

    numbers = [_number(c).alias(f"{_OWN}{k}") for k, c in enumerate(features)]
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), *numbers)
    id = F.xxhash64("label", *[f"{_OWN}{k}" for k in range(len(features))])
    return rows.select(id.alias("id"), "*").mapInArrow(run, "id bigint, label double, bins binary")


def _cells(bins: np.ndarray) -> pa.Array:
    """A binary value for each row of bins given as (features, rows)."""
    raw = np.ascontiguousarray(bins.T.astype("<u2"))
    bounds = np.arange(len(raw) + 1, dtype=np.int32) * (2 * raw.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(bounds), pa.py_buffer(raw)])


def _from_cells(cells: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells), "<u2").reshape(len(cells), width).T


def _blocks(rows: DataFrame, base: float, width: int, count: int) -> DataFrame:
    """The rows in blocks, kept: (ids, labels, bins, scores), each the bytes of an array.

    Every pass over the rows of a model reads them whole, so a block travels as four values in
    place of four a row; a task has ``TASK_ROWS`` rows at least, where there are so many.
    """

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
        bins = _from_cells(table.column("bins").to_pylist(), width)
        return _block(ids, labels, bins, np.full(len(ids), base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for lo in range(0, len(batch), BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                if size and size + len(part) > BLOCK_ROWS:
                    yield packed(held)
                    held, size = [], 0
                held.append(part)
                size += len(part)
        if size:
            yield packed(held)

    done = rows.coalesce(max(1, count // TASK_ROWS)).mapInArrow(run, _BLOCK).persist(StorageLevel.MEMORY_AND_DISK)
    done.count()
    return done


_BLOCK = "ids binary, labels binary, bins binary, scores binary"


def _block(*arrays: np.ndarray) -> pa.RecordBatch:
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in arrays], names)


def _unblocked(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, labels, bins as (features, rows), scores) of each block."""
    for batch in batches:
        for block in zip(*batch.columns, strict=True):
            ids, labels, bins, scores = (
                np.frombuffer(v.as_buffer(), t) for v, t in zip(block, (np.int64, np.float64, "<u2", np.float64), strict=True)
            )
            yield ids, labels, bins.reshape(width, -1), scores


def _mixed(values: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit hashes and a salt."""
    h = values.view(np.uint64) ^ np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    for a, b in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(a))) * np.uint64(b)
    return (h ^ (h >> np.uint64(31))).astype(np.float64) / 2.0**64


def _columns_of(settings: Settings, tree: int, count: int) -> np.ndarray:
    """The columns a tree may split."""
    wanted = max(1, round(settings.columns * count))
    order = np.argsort(_mixed(np.arange(1, count + 1, dtype=np.int64) * 0x51ED270B, settings.seed + 7919 * tree), kind="stable")
    return np.sort(order[:wanted])


def _weights(ids: np.ndarray, settings: Settings, tree: int) -> np.ndarray:
    """How often each row counts for a tree: sampled once or not for boosting, Poisson for bagging."""
    if settings.boosted:
        return (_mixed(ids, settings.seed + 104729 * tree) < settings.rows).astype(np.int64)
    if settings.trees == 1 or settings.rows <= 0:
        return np.ones(len(ids), np.int64)
    steps = np.cumsum(np.exp(-settings.rows) * np.array([settings.rows**k / np.prod(np.arange(1.0, k + 1)) for k in range(9)]))
    return np.searchsorted(steps, _mixed(ids, settings.seed + 104729 * tree), "right").astype(np.int64)


def _sums(rows: DataFrame, before: list[Tree], edges: list[np.ndarray], open_: list[tuple[int, Tree, dict]], settings: Settings) -> list:
    """(tree, node, column, bin, gradient, rows) of all open nodes, added up in tasks and then in Spark."""
    width = len(edges)
    spread = max([len(e) + 1 for e in edges], default=1)
    shared = rows.sparkSession.sparkContext.broadcast(([_in_bins(t, edges) for t in before], open_))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, growing = shared.value
        totals: dict[int, np.ndarray] = {}
        slots = [np.array([nodes.get(int(n), -1) for n in splits[-1]]) for _, splits, nodes in growing]
        for ids, labels, bins, scores in _unblocked(batches, width):
            gradient = np.rint((_scored(scores, before, bins) - labels) * SCALE).astype(np.int64)
            for (number, splits, nodes), slot_of in zip(growing, slots, strict=True):
                weight = _weights(ids, settings, number)
                slot = slot_of[_places(splits, bins)]
                used = np.flatnonzero((slot >= 0) & (weight > 0))
                size = len(nodes) * width * spread
                sums = totals.setdefault(number, np.zeros((3, size), np.int64))
                slot, weight, g = slot[used], weight[used], gradient[used] * weight[used]
                high, low = _halves(g)
                # A row that counts once is its own Hessian.
                h = None if settings.boosted else weight.astype(float)
                for c in range(width):
                    cell = slot * spread + bins[c, used]

                    def added(part: np.ndarray | None) -> np.ndarray:
                        return np.bincount(cell, part, len(nodes) * spread).astype(np.int64)

                    n = added(None)
                    whole = added(low) if high is None else (added(high) << 20) + added(low)
                    place = slice(c * len(nodes) * spread, (c + 1) * len(nodes) * spread)
                    sums[:, place] += np.stack([whole, n if h is None else added(h), n])
        for number, sums in totals.items():
            cells = np.flatnonzero(sums[2])
            columns = [np.full(len(cells), number), cells, *(s[cells] for s in sums)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["tree", "cell", "g", "h", "n"])

    partial = rows.mapInArrow(run, "tree bigint, cell bigint, g bigint, h bigint, n bigint")
    added = partial.groupBy("tree", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toArrow()
    out = []
    for number, _, nodes in open_:
        mine = added.filter(pa.compute.equal(added.column("tree"), number))
        sums = np.zeros((3, len(nodes) * width * spread))
        sums[:, mine.column("cell").to_numpy()] = [mine.column(c).to_numpy() for c in ("g", "h", "n")]
        out.append(sums.reshape(3, width, len(nodes), spread).transpose(0, 2, 1, 3))
    return out


def _in_bins(tree: Tree, edges: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """A tree whose thresholds are bins: rows up to one go left."""
    column, threshold, left, right, value = tree.arrays()
    place = np.array([np.searchsorted(edges[c], t) if c >= 0 else 0 for c, t in zip(column, threshold, strict=True)], np.int64)
    return column, place, left, right, value, np.array(sorted({*tree.splits, *tree.leaves}), np.int64)


def _halves(g: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
    """Parts of whole numbers whose floating sums are exact; one where the numbers' own sums are."""
    if not len(g) or max(int(g.max()), -int(g.min())) * len(g) < 1 << 53:
        return None, g.astype(float)
    return (g >> 20).astype(float), (g & 0xFFFFF).astype(float)


def _places(tree: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """The place of each row's node among the tree's nodes."""
    column, place, left, right, _, _ = tree
    at = np.zeros(bins.shape[1], np.int64)
    rows = np.arange(len(at))
    while True:
        split = column[at] >= 0
        if not split.any():
            return at
        low = bins[np.maximum(column[at], 0), rows] <= place[at]
        at = np.where(split, np.where(low, left[at], right[at]), at)


def _walk(tree: tuple[np.ndarray, ...], bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's node, and its value."""
    *_, value, numbers = tree
    at = _places(tree, bins)
    return numbers[at], value[at]


def _scored(scores: np.ndarray, trees: list[tuple[np.ndarray, ...]], bins: np.ndarray) -> np.ndarray:
    """The rows' scores with what the trees add, in the trees' order."""
    score = scores.copy()
    for tree in trees:
        value = tree[-2]
        score += value[0] if len(value) == 1 else value[_places(tree, bins)]
    return score


def _carried(rows: DataFrame, trees: list[Tree], edges: list[np.ndarray]) -> DataFrame:
    """The rows with the trees added to their scores, kept in place of the given ones."""
    width = len(edges)
    shared = rows.sparkSession.sparkContext.broadcast([_in_bins(t, edges) for t in trees])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, bins, scores in _unblocked(batches, width):
            yield _block(ids, labels, bins, _scored(scores, shared.value, bins))

    done = rows.mapInArrow(run, _BLOCK).persist(StorageLevel.MEMORY_AND_DISK)
    done.count()
    return done


def _best(sums: np.ndarray, columns: np.ndarray, settings: Settings) -> tuple[float, int, int]:
    """(gain, column, bin) of the best split of one node; a gain of -1 where none is allowed."""
    g, h, n = (np.cumsum(s[columns], 1) for s in sums)
    total_g, total_h, total_n = g[:, -1:], h[:, -1:], n[:, -1:]
    if total_n[0, 0] < settings.split_rows:
        return -1.0, 0, 0

    def score(a, b):
        return np.divide(a * a, b + settings.penalty, out=np.zeros_like(a), where=b + settings.penalty > 0)

    gain = score(g / SCALE, h) + score((total_g - g) / SCALE, total_h - h) - score(total_g / SCALE, total_h)
    fits = (n >= max(settings.least_rows, 1)) & (total_n - n >= max(settings.least_rows, 1))
    gain = np.where(fits, np.round(gain, 9), -1.0)
    k = int(np.argmax(gain))
    c, b = divmod(k, gain.shape[1])
    return float(gain[c, b]), int(columns[c]), b


#: Rows that travel together, the fewest of a task, and those a task sends on at once.
BLOCK_ROWS = 1 << 16
TASK_ROWS = 50_000
SENT_ROWS = 10_000
#: Boosted trees after which their values go into the rows' scores: a pass walks no more of them.
CARRIED = 20
#: Rows times trees that are grown together.
MOST_MEMBERS = 50_000_000
#: Sums of one pass: nodes x columns x bins. More nodes are worked through in several passes.
MOST_SUMS = 4_000_000


def _in_passes(
    rows: DataFrame, before: list[Tree], edges: list[np.ndarray], waiting: list[tuple[int, int]], shapes: dict, settings: Settings
) -> Iterator[tuple]:
    """The open nodes of each tree with their sums, so many at a time that the sums stay bounded."""
    each = len(edges) * max([len(e) + 1 for e in edges], default=1)
    step = max(1, MOST_SUMS // max(each, 1))
    for lo in range(0, len(waiting), step):
        nodes: dict[int, dict[int, int]] = {}
        for k, n in waiting[lo : lo + step]:
            mine = nodes.setdefault(k, {})
            mine[n] = len(mine)
        asked = [(k, shapes[k], mine) for k, mine in nodes.items()]
        yield from zip(asked, _sums(rows, before, edges, asked, settings), strict=True)


def _grow(
    rows: DataFrame, before: list[Tree], edges: list[np.ndarray], numbers: Sequence[int], settings: Settings, rows_in_all: int
) -> list[Tree]:
    """Trees of a forest side by side, or the one next tree of a boosted model, after those the
    rows' scores don't have yet."""
    trees = {k: Tree(leaves={1: 0.0}) for k in numbers}
    open_ = {k: [1] for k in numbers}
    share = settings.rate if settings.boosted else 1.0
    local = {k: [] for k in numbers}
    if rows_in_all <= LOCAL_ROWS:
        open_, local = local, open_
    for level in range(settings.depth + 1):
        waiting = [(k, n) for k, nodes in open_.items() for n in nodes]
        if not waiting:
            break
        shapes = {k: _in_bins(trees[k], edges) for k in numbers}
        open_ = {k: [] for k in numbers}
        for (k, _, nodes), sums in _in_passes(rows, before, edges, waiting, shapes, settings):
            tree, columns, further = trees[k], _columns_of(settings, k, len(edges)), open_[k]
            for node, i in nodes.items():
                g, h = sums[0, i, 0].sum() / SCALE, sums[1, i, 0].sum()
                tree.leaves[node] = -share * g / (h + settings.penalty) if h + settings.penalty > 0 else 0.0
                if level == settings.depth:
                    continue
                gain, column, place = _best(sums[:, i], columns, settings)
                if gain > settings.least_gain:
                    tree.splits[node] = (column, float(edges[column][place]))
                    tree.gains[node] = (column, gain)
                    del tree.leaves[node]
                    tree.leaves |= {2 * node: 0.0, 2 * node + 1: 0.0}
                    left = int(sums[2, i, column, : place + 1].sum())
                    for child, n in ((2 * node, left), (2 * node + 1, int(sums[2, i, column].sum()) - left)):
                        (local[k] if n <= LOCAL_ROWS else further).append(child)
    if any(local.values()):
        _finish(rows, before, edges, trees, local, settings)
    return list(trees.values())


#: A node of no more rows is grown to its end in one task: the same tree in fewer passes.
LOCAL_ROWS = 50_000


def _finish(
    rows: DataFrame, before: list[Tree], edges: list[np.ndarray], trees: dict[int, Tree], local: dict[int, list[int]], settings: Settings
) -> None:
    """Grow the given nodes of each tree to their ends, a node in a task."""
    growing = [(k, _in_bins(trees[k], edges), np.array(sorted(nodes))) for k, nodes in local.items() if nodes]
    shared = rows.sparkSession.sparkContext.broadcast(([_in_bins(t, edges) for t in before], growing))
    width, spread = len(edges), max([len(e) + 1 for e in edges], default=1)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, asked = shared.value
        for ids, labels, bins, scores in _unblocked(batches, width):
            gradient = np.rint((_scored(scores, before, bins) - labels) * SCALE).astype(np.int64)
            for number, splits, nodes in asked:
                weight = _weights(ids, settings, number)
                at, _ = _walk(splits, bins)
                used = np.flatnonzero(np.isin(at, nodes) & (weight > 0))
                for lo in range(0, len(used), SENT_ROWS):
                    some = used[lo : lo + SENT_ROWS]
                    columns = [pa.array(np.full(len(some), number)), pa.array(at[some]), _cells(bins[:, some])]
                    columns += [pa.array(gradient[some] * weight[some]), pa.array(weight[some])]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "bins", "g", "h"])

    def grown(table: pa.Table) -> pa.Table:
        number, root = (table.column(c)[0].as_py() for c in ("tree", "node"))
        bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), "<u2").reshape(len(table), width).T.astype(np.int64)
        found = _subtree(root, bins, table.column("g").to_numpy(), table.column("h").to_numpy(), spread, _columns_of(settings, number, width), settings)
        return _as_table([(number, *r) for r in found])

    parted = rows.mapInArrow(members, "tree bigint, node bigint, bins binary, g bigint, h bigint")
    done = parted.groupBy("tree", "node").applyInArrow(grown, _NODES)
    for k, *node in zip(*[c.to_pylist() for c in done.toArrow().columns], strict=True):
        _put(trees[k], edges, *node)


_NODES = "tree bigint, node bigint, at bigint, place bigint, gain double, value double"


def _as_table(nodes: list[tuple]) -> pa.Table:
    names = [c.split()[0] for c in _NODES.split(", ")]
    columns = [pa.array([r[k] for r in nodes], pa.int64() if k < 4 else pa.float64()) for k in range(6)]
    return pa.Table.from_arrays(columns, names)


def _put(tree: Tree, edges: list[np.ndarray], node: int, column: int, place: int, gain: float, value: float) -> None:
    if column < 0:
        tree.leaves[node] = value
    else:
        tree.leaves.pop(node, None)
        tree.splits[node] = (column, float(edges[column][place]))
        tree.gains[node] = (column, gain)


def _all_rounds(rows: DataFrame, base: float, edges: list[np.ndarray], settings: Settings) -> list[Tree]:
    """All trees of a boosted model of at most ``LOCAL_ROWS`` rows, in one task."""
    width, spread = len(edges), max([len(e) + 1 for e in edges], default=1)

    def grown(table: pa.Table) -> pa.Table:
        ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
        bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), "<u2").reshape(len(table), width).T.astype(np.int64)
        score, nodes = np.full(len(ids), base), []
        for number in range(settings.trees):
            gradient = np.rint((score - labels) * SCALE).astype(np.int64)
            weight = _weights(ids, settings, number)
            used = np.flatnonzero(weight > 0)
            found = _subtree(1, bins[:, used], gradient[used] * weight[used], weight[used], spread, _columns_of(settings, number, width), settings)
            tree = Tree()
            for node in found:
                _put(tree, edges, *node)
            score += _walk(_in_bins(tree, edges), bins)[1]
            nodes += [(number, *node) for node in found]
        return _as_table(nodes)

    done = rows.withColumn("all", F.col("id") * 0).groupBy("all").applyInArrow(grown, _NODES).toArrow()
    trees = [Tree() for _ in range(settings.trees)]
    for k, *node in zip(*[c.to_pylist() for c in done.columns], strict=True):
        _put(trees[k], edges, *node)
    return trees


def _subtree(
    root: int, bins: np.ndarray, g: np.ndarray, h: np.ndarray, spread: int, columns: np.ndarray, settings: Settings
) -> list[tuple]:
    """(node, column or -1, bin, gain, value) of a node and all below it, from its rows."""
    share = settings.rate if settings.boosted else 1.0
    width = len(bins)
    offset = spread * np.arange(width)[:, None]
    halves = (g >> 20, g & 0xFFFFF, h)
    out, waiting = [], [(root, np.arange(len(g)))]
    while waiting:
        node, rows = waiting.pop()
        total_g, total_h = g[rows].sum() / SCALE, h[rows].sum()
        value = -share * total_g / (total_h + settings.penalty) if total_h + settings.penalty > 0 else 0.0
        gain = -1.0
        if node.bit_length() <= settings.depth:
            cells = (bins[:, rows] + offset).ravel()
            high, low, hess = (np.bincount(cells, np.tile(p[rows], width), width * spread) for p in halves)
            count = np.bincount(cells, minlength=width * spread)
            whole = (high.astype(np.int64) << 20) + low.astype(np.int64)
            sums = np.stack([whole.astype(float), hess, count.astype(float)]).reshape(3, width, spread)
            gain, column, place = _best(sums, columns, settings)
        if gain > settings.least_gain:
            out.append((node, column, place, gain, 0.0))
            low_side = bins[column, rows] <= place
            waiting += [(2 * node, rows[low_side]), (2 * node + 1, rows[~low_side])]
        else:
            out.append((node, -1, 0, 0.0, value))
    return out


def fit(df: DataFrame, features: Sequence[str], label: str, settings: Settings = SECOND_ORDER) -> TreeModel:
    """Learn from the rows of ``df``; boosting adds tree to tree, a forest grows trees together."""
    edges = thresholds(df.select(*[_number(c).alias(c) for c in features]), features, settings.bins)
    rows, scored = cut(_binned(df, features, label, edges)), None
    try:
        # A whole sum, so that the base too is the same on any partitioning.
        whole = F.sum(F.rint(F.col("label") * SCALE).cast("decimal(38,0)"))
        total = rows.agg(whole.alias("s"), F.count(F.lit(1)).alias("n")).first()
        base = float(total["s"]) / SCALE / total["n"] if total["n"] else 0.0
        model = TreeModel(tuple(features), base, [], settings.boosted)
        if not total["n"]:
            return model
        if settings.boosted and total["n"] <= LOCAL_ROWS:
            model.trees = _all_rounds(rows, base, edges, settings)
            return model
        scored = _blocks(rows, base, len(edges), total["n"])
        if settings.boosted:
            added = 0
            for k in range(settings.trees):
                if k - added == CARRIED:
                    last, scored = scored, _carried(scored, model.trees[added:], edges)
                    last.unpersist()
                    added = k
                model.trees += _grow(scored, model.trees[added:], edges, [k], settings, total["n"])
        else:
            # A row goes to each tree's tasks: so many trees at a time.
            step = max(1, MOST_MEMBERS // total["n"])
            for lo in range(0, settings.trees, step):
                model.trees += _grow(scored, [], edges, range(lo, min(lo + step, settings.trees)), settings, total["n"])
        return model
    finally:
        if scored is not None:
            scored.unpersist()
