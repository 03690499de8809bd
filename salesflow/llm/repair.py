"""Conversation structure repair: cheapest edits, the ASCII-least audit of them, repaired rows.

Rows of a conversation are taken by turn (nulls first; ties by role, then by a hash of the
text). Faults, the first of them per row: ``blank`` (no byte but \\x20 and \\x09-\\x0D),
``duplicate`` (role and text seen earlier), ``truncated`` (does not end in one of .!?).
The initials of the roles must read ``(s?(ua)+)?``. Edits are Keep (0), Rerole (3), Delete (4,
the only one for blank and duplicate rows) and Insert of an empty row (3); a truncated row that
stays costs 3 more. Of the cheapest audits (letters D, I, K, R) the ASCII-least is taken.

How: rows are sorted over ranges, so a long conversation lies in many tasks, and cut into
chunks of at most ``CHUNK_ROWS``, one byte a row. A chunk's costs from each grammar state at
its start to each at its end are a min-plus matrix; these are chained from the end of each
conversation. With the cost that is left at its end, each chunk finds its optimal arcs, ranks
their nodes by audits of 1, 2, 4, ... letters, and follows the ranks through doubled pointers.
Chunks are chained once more by their states. Only the chains (48 bytes a chunk) and the audit,
which the result holds as one string, grow with a conversation in one row.

Null roles and texts count as one space, and an empty role has no legal initial. Null ids are
one conversation; null turns stand first and give no gap. Repeated rows are duplicates. Other
columns are not read, so they may have any name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.session import cut

CHUNK_BITS = 14
CHUNK_ROWS = 1 << CHUNK_BITS

FAULTS = ("blank", "duplicate", "truncated")

# Edits in ASCII order and what they cost.
LETTERS = b"DIKR"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3

# Grammar states: nothing yet, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = np.array([_USER, _USER, _ASSISTANT, _USER])
#: State after keeping a row of class other, s, u, a in each state; -1 is illegal.
_KEEP = np.array([[-1, -1, -1, -1], [_SYSTEM, -1, -1, -1], [_USER, _USER, -1, _USER], [-1, -1, _ASSISTANT, -1]])
#: Cost and inserts from each state to an end of the grammar.
_LAST = np.array([0, 2 * INSERT, INSERT, 0])
_TRAILING = ["", "II", "I", ""]
_NEVER = 1 << 40

_BLANKS = " \t\n\u000b\u000c\r"
_FORCED, _CUT_OFF = 4, 8


@dataclass(frozen=True)
class Repaired:
    """``conversations``: one row per id with the counts, cost and audit. ``rows``: what is left,
    (id, place, line, role, text) in the order of place and line."""

    conversations: DataFrame
    rows: DataFrame


def key(id: str) -> Column:
    """A text for each id; null has its own."""
    return F.when(F.col(id).isNull(), "").otherwise(F.concat(F.lit("="), F.col(id).cast("string")))


def _costs(codes: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Cheapest cost from every node (chunk, row, state), given those at the chunks' ends.

    ``codes`` has a row per chunk, aligned at the end; ``left`` any axes, then states.
    """
    chunks, n = codes.shape
    out = np.empty((chunks, n + 1, *left.shape[1:]), np.int64)
    out[:, n] = left
    for i in range(n - 1, -1, -1):
        out[:, i] = _inserted(np.minimum.reduce([c for c, _ in _steps(codes[:, i], out[:, i + 1])]))
    return out


def _steps(code: np.ndarray, after: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(cost to the end, next state) of Delete, Keep and Rerole of one row per chunk."""
    shape = (-1, *[1] * (after.ndim - 2), 4)
    extra = np.where(code & _CUT_OFF, TRUNCATED, 0)[:, None]
    forced = ((code & _FORCED) > 0)[:, None]
    kept = _KEEP[code & 3]
    target = np.maximum(kept, 0)
    keep = np.where((kept < 0) | forced, _NEVER, extra).reshape(shape)
    rerole = np.where(forced, _NEVER, REROLE + extra).reshape(shape[:-1] + (1,))
    own = np.broadcast_to(np.arange(4), kept.shape)
    along = np.broadcast_to(target.reshape(shape), after.shape)
    return [
        (DELETE + after, own),
        (keep + np.take_along_axis(after, along, -1), target),
        (rerole + after[..., _NEXT], np.broadcast_to(_NEXT, kept.shape)),
    ]


def _inserted(costs: np.ndarray) -> np.ndarray:
    """The least with any number of inserts before: a fourth would come back to a state seen."""
    best, more = costs, costs
    for _ in range(3):
        more = INSERT + more[..., _NEXT]
        best = np.minimum(best, more)
    return best


def _least_paths(codes: np.ndarray, lengths: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """End states and audits of the ASCII-least cheapest paths from each state of each chunk."""
    chunks, n = codes.shape
    cost = _costs(codes, left)
    # Arcs that lie on a cheapest path: letter by letter, the node they lead to, or -1.
    ids = np.arange(chunks * (n + 1) * 4).reshape(chunks, n + 1, 4)
    arcs = np.full((4, *ids.shape), -1, np.int64)
    for i in range(n):
        for letter, (total, state) in zip((0, 2, 3), _steps(codes[:, i], cost[:, i + 1]), strict=True):
            target = np.take_along_axis(ids[:, i + 1], state, 1)
            arcs[letter, :, i] = np.where(total == cost[:, i], target, -1)
    more = INSERT + cost[:, :n][..., _NEXT]
    arcs[1, :, :n] = np.where(more == cost[:, :n], ids[:, :n][..., _NEXT], -1)
    arcs = arcs.reshape(4, -1)
    some = arcs >= 0
    end = ~some.any(0)
    # Letters that leave a node differ, so the first letter decides; an end comes before any.
    letter = np.where(end, 0, some.argmax(0) + 1)
    step = np.where(end, np.arange(len(end)), arcs[letter - 1, np.arange(len(end))])
    rank, jump, jumps = letter.astype(np.int64), step, [step]
    while not end[jump].all():
        # Rank of the audits of twice as many letters: by the first half, then by the second.
        rank = np.unique((rank << 32) | rank[jump], return_inverse=True)[1]
        jump = jump[jump]
        jumps.append(jump)
    # Each node takes, of its optimal arcs, the least by letter and by the rank of what follows.
    order = np.where(some, (np.arange(1, 5)[:, None] << 32) | rank[np.maximum(arcs, 0)], np.iinfo(np.int64).max)
    chosen = np.where(end, 0, order.argmin(0) + 1).astype(np.uint8)
    path = ids[np.arange(chunks), n - lengths].reshape(-1, 1)
    for jump in reversed(jumps):
        path = np.stack([path, jump[path]], -1).reshape(len(path), -1)
    finish = np.where(end[path[:, -1]], path[:, -1], jumps[0][path[:, -1]]) % 4
    spelled = np.frombuffer(b"\0" + LETTERS, np.uint8)[chosen[path]]
    audits = [row[row > 0].tobytes() for row in spelled]
    return finish.reshape(chunks, 4), [audits[i : i + 4] for i in range(0, len(audits), 4)]


def _classes(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions, codes aligned at the end, lengths) of chunks of like length."""
    raw = column.to_pylist()
    sizes = np.array([len(c) for c in raw], np.int64)
    width = np.array([int(s - 1).bit_length() for s in sizes])
    for w in np.unique(width):
        mine = np.flatnonzero(width == w)
        at_once = max(1, (1 << 16) >> w)
        for lo in range(0, len(mine), at_once):
            part = mine[lo : lo + at_once]
            n = int(sizes[part].max())
            codes = np.zeros((len(part), n), np.int64)
            for k, i in enumerate(part):
                codes[k, n - sizes[i] :] = np.frombuffer(raw[i], np.uint8)
            yield part, codes, sizes[part]


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Min-plus matrices, from the state at a chunk's start to that at its end."""
    goals = np.where(np.eye(4, dtype=bool), 0, _NEVER)
    for batch in batches:
        out = np.zeros((len(batch), 16), np.int64)
        for part, codes, lengths in _classes(batch.column("codes")):
            costs = _costs(codes, np.broadcast_to(goals, (len(part), 4, 4)))
            first = costs[np.arange(len(part)), codes.shape[1] - lengths]
            out[part] = first.transpose(0, 2, 1).reshape(len(part), 16)
        lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, 16, dtype=np.int32), out.ravel())
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("chunk"), lists], ["key", "chunk", "matrix"])


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each state at a chunk's start: the state at its end and the audit."""
    for batch in batches:
        ends = np.zeros((len(batch), 4), np.int64)
        audits: list = [None] * len(batch)
        lefts = np.array(batch.column("left").to_pylist(), np.int64).reshape(len(batch), 4)
        for part, codes, lengths in _classes(batch.column("codes")):
            ends[part], found = _least_paths(codes, lengths, lefts[part])
            for i, four in zip(part, found, strict=True):
                audits[i] = [a.decode() for a in four]
        lists = pa.ListArray.from_arrays(np.arange(0, ends.size + 1, 4, dtype=np.int32), ends.ravel())
        names = ["key", "chunk", "places", "left", "ends", "audits"]
        columns = [batch.column(c) for c in names[:4]] + [lists, pa.array(audits, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names)


def _lefts(chains: pd.Series) -> pd.Series:
    """Costs left at the end of each chunk, by the matrices of the chunks after it."""

    def run(matrices) -> list:
        left, out = _LAST, []
        for m in reversed(matrices):
            out.append(left)
            left = (np.asarray(m).reshape(4, 4) + left).min(1)
        return out[::-1]

    return chains.map(run)


def _entries(chains: pd.Series) -> pd.Series:
    """The state at the start of each chunk, and that at the end of the conversation."""

    def run(ends) -> list:
        states = [_START]
        for e in ends:
            states.append(int(e[states[-1]]))
        return states

    return chains.map(run)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What becomes of each row: roles of empty rows before it, its own role, those after it."""
    names = np.array(["", "", "user", "assistant"])
    for batch in batches:
        places, befores, owns, afters, kinds = [], [], [], [], []
        for rows, audit, state, trailing in zip(*[batch.column(c).to_pylist() for c in ("places", "audit", "entry", "trailing")], strict=True):
            before: list[str] = []
            k = 0
            for letter in audit:
                if letter == "I":
                    state = _NEXT[state]
                    before.append(names[state])
                    continue
                row = rows[k]
                k += 1
                if letter == "K":
                    state = int(_KEEP[row["code"] & 3][state])
                elif letter == "R":
                    state = _NEXT[state]
                places.append(row["place"])
                befores.append(before)
                owns.append(names[state] if letter == "R" else None)
                kinds.append(letter)
                afters.append([])
                before = []
            for _ in trailing or "":
                state = _NEXT[state]
                afters[-1].append(names[state])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(places, pa.int64()),
                pa.array(kinds, pa.string()),
                pa.array(befores, pa.list_(pa.string())),
                pa.array(owns, pa.string()),
                pa.array(afters, pa.list_(pa.string())),
            ],
            ["place", "kind", "before", "own", "after"],
        )


def ordered(df: DataFrame, id: str, turn: str, role: str, text: str) -> DataFrame:
    """(key, place, turn, role, text): rows of a conversation next to each other, by place.

    Sorted over ranges, equal rows too, so no conversation is held by one task; written once.
    """
    rows = df.select(
        key(id).alias("key"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("tie"),
    ).withColumn("spread", F.xxhash64("text"))
    order = ["key", F.col("turn").asc_nulls_first(), "role", "spread", "tie"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(placed.select("key", F.monotonically_increasing_id().alias("place"), "turn", "role", "text"))


def _coded(rows: DataFrame) -> DataFrame:
    """(key, place, initial, code, fault) of each row, without its text."""
    tail = F.rtrim(F.col("text"), F.lit(_BLANKS))
    light = rows.select(
        "key",
        "place",
        F.substring("role", 1, 1).alias("initial"),
        (tail == "").alias("blank"),
        (~F.substring(tail, -1, 1).isin(".", "!", "?")).alias("open"),
        F.xxhash64("role", "text").alias("h1"),
        F.xxhash64("text", F.lit(1), "role").alias("h2"),
    )
    # Places rise with the order inside a conversation: the least of equal rows is the first.
    firsts = light.groupBy("key", "h1", "h2").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("new"))
    fault = F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(F.col("open"), "truncated")
    kind = F.when(F.col("initial") == "s", 1).when(F.col("initial") == "u", 2).when(F.col("initial") == "a", 3).otherwise(0)
    code = kind + F.when(F.col("fault").isin("blank", "duplicate"), _FORCED).when(F.col("fault") == "truncated", _CUT_OFF).otherwise(0)
    return light.join(firsts, "place", "left").withColumn("fault", fault).select("key", "place", "initial", "fault", code.alias("code"))


def repair(
    df: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> Repaired:
    """Repair every conversation of ``df``; see the module for the rules."""
    kind = dict(df.dtypes)[id]
    rows = ordered(df, id, turn, role, text)
    coded = _coded(rows)
    # A place is the partition and the row in it, so a chunk of places lies in one partition.
    row = F.struct("place", "code", "initial", "fault")
    pieces = cut(
        coded.groupBy("key", F.shiftright("place", CHUNK_BITS).alias("chunk"))
        .agg(F.array_sort(F.collect_list(row)).alias("rows"))
        .select(
            "key",
            "chunk",
            F.transform("rows", lambda r: F.struct(r["place"].alias("place"), r["code"].alias("code"))).alias("places"),
            F.unhex(F.array_join(F.transform("rows", lambda r: F.lpad(F.hex(r["code"]), 2, "0")), "")).alias("codes"),
            _pairs(F.col("rows")).alias("illegal"),
            F.element_at("rows", 1)["initial"].alias("first"),
            F.element_at("rows", -1)["initial"].alias("last"),
            *[_having(k).alias(k) for k in FAULTS],
        )
    )
    matrices = pieces.select("key", "chunk", "codes").mapInArrow(_matrices, "key string, chunk bigint, matrix array<bigint>")
    chained = matrices.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("chunk", "matrix"))).alias("chain"))
    lefts = chained.select("key", "chain.chunk", F.pandas_udf(_lefts, "array<array<bigint>>")(F.col("chain.matrix")).alias("lefts")).select(
        "key", F.explode(F.arrays_zip("chunk", "lefts")).alias("one")
    )
    solved = cut(
        pieces.select("key", "chunk", "places", "codes")
        .join(lefts.select("key", "one.chunk", F.col("one.lefts").alias("left")), ["key", "chunk"])
        .mapInArrow(
            _audits,
            "key string, chunk bigint, places array<struct<place: bigint, code: int>>, left array<bigint>, "
            "ends array<bigint>, audits array<string>",
        )
    )
    chains = (
        solved.groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("chunk", "ends"))).alias("chain"))
        .select("key", "chain.chunk", F.pandas_udf(_entries, "array<bigint>")(F.col("chain.ends")).alias("entry"))
    )
    trailing = F.element_at(F.array(*[F.lit(t) for t in _TRAILING]), (F.element_at("entry", -1) + 1).cast("int"))
    walks = chains.select(
        "key", F.explode(F.arrays_zip("chunk", F.expr("slice(entry, 1, size(chunk))").alias("entry"))).alias("one"),
        F.element_at("chunk", -1).alias("final"), trailing.alias("trailing"),
    ).select("key", "one.chunk", "one.entry", F.when(F.col("final") == F.col("one.chunk"), F.col("trailing")).alias("trailing"))
    walked = cut(
        solved.join(walks, ["key", "chunk"]).select(
            "key", "chunk", "places", "entry", "trailing",
            F.col("audits")[F.col("entry").cast("int")].alias("audit"),
        )
    )
    return Repaired(_summary(df, id, rows, pieces, walked), _left_over(df, id, kind, rows, walked))


def _having(fault: str) -> Column:
    return F.size(F.filter("rows", lambda r: r["fault"] == fault)).cast("long")


def _pairs(rows: Column) -> Column:
    """How many neighbours in a list have initials that may not follow each other."""
    two = F.zip_with(F.slice(rows, F.lit(1), F.size(rows) - 1), F.slice(rows, F.lit(2), F.size(rows) - 1), _illegal)
    return F.size(F.filter(two, lambda bad: bad)).cast("long")


def _illegal(a: Column, b: Column) -> Column:
    return ~F.concat(a["initial"], b["initial"]).isin("su", "ua", "au")


def _summary(df: DataFrame, id: str, rows: DataFrame, pieces: DataFrame, walked: DataFrame) -> DataFrame:
    """The counts of each conversation; chunks are added up, and their joints looked at once."""
    turns = rows.groupBy("key", "turn").agg(F.lit(1).alias("one")).groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    joints = F.array_sort(F.collect_list(F.struct("chunk", "first", "last")))
    counts = pieces.groupBy("key").agg(
        *[F.sum(c).alias(c) for c in FAULTS], F.sum("illegal").alias("inside"), joints.alias("joints")
    )
    between = F.zip_with(
        F.slice("joints", F.lit(1), F.size("joints") - 1),
        F.slice("joints", F.lit(2), F.size("joints") - 1),
        lambda a, b: ~F.concat(a["last"], b["first"]).isin("su", "ua", "au"),
    )
    illegal = F.col("inside") + F.size(F.filter(between, lambda bad: bad))
    audits = walked.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("chunk", F.concat("audit", F.coalesce("trailing", F.lit(""))).alias("audit")))).alias("all")
    )
    audit = F.array_join("all.audit", "")
    costs = {"D": DELETE, "I": INSERT, "R": REROLE}
    edits = sum((F.length(F.regexp_replace("audit", f"[^{k}]", "")) * v for k, v in costs.items()), F.lit(0))
    kept = walked.select("key", F.explode(_open_letters()).alias("letter")).groupBy("key").agg(
        (F.count_if(F.col("letter") != "D") * TRUNCATED).alias("stays")
    )
    found = (
        audits.select("key", audit.alias("audit"))
        .join(counts.select("key", *FAULTS, illegal.cast("long").alias("illegal")), "key")
        .join(turns, "key")
        .join(kept, "key", "left")
        .withColumn("cost", (edits + F.coalesce("stays", F.lit(0))).cast("long"))
    )
    ids = df.select(F.col(id).alias("_id")).distinct().withColumn("key", key("_id"))
    return ids.join(found, "key").select(F.col("_id").alias(id), "gaps", *FAULTS, "illegal", "cost", "audit")


def _open_letters() -> Column:
    """Letters of the truncated rows of a chunk: its audit without inserts stands row by row."""
    letters = F.split(F.regexp_replace("audit", "I", ""), "")
    both = F.arrays_zip(F.col("places.code").alias("code"), letters.alias("letter"))
    return F.transform(F.filter(both, lambda r: r["code"].bitwiseAND(_CUT_OFF) > 0), lambda r: r["letter"])


def _left_over(df: DataFrame, id: str, kind: str, rows: DataFrame, walked: DataFrame) -> DataFrame:
    """The repaired rows. Rows of one conversation go by their places, so none is held together."""
    edits = walked.select("places", "audit", "entry", "trailing").mapInArrow(
        _edits, "place bigint, kind string, before array<string>, own string, after array<string>"
    )
    empty = lambda r: F.struct(r.alias("role"), F.lit("").alias("text"))
    own = F.when(
        F.col("kind") != "D", F.array(F.struct(F.coalesce("own", "role").alias("role"), F.col("text").alias("text")))
    ).otherwise(F.array().cast("array<struct<role: string, text: string>>"))
    lines = F.concat(F.transform("before", empty), own, F.transform("after", empty))
    left = rows.join(edits, "place").select("key", "place", F.posexplode(lines).alias("line", "one"))
    value = F.when(F.col("key") != "", F.substr("key", F.lit(2))).cast(kind)
    return left.select(value.alias(id), "place", "line", "one.role", "one.text")


def digests(rows: DataFrame, id: str) -> DataFrame:
    """(id, repaired_sha256) of lines ``role:text`` joined by newlines, streamed row by row."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        done: list = []
        for batch in batches:
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode())
            if len(done) > 4096:
                yield _pairs_batch(done)
                done = []
        if state is not None:
            done.append((now, state.hexdigest()))
        yield _pairs_batch(done)

    lines = rows.select(key(id).alias("key"), F.concat_ws(":", "role", "text").alias("said"), "place", "line")
    together = lines.repartition("key").sortWithinPartitions("key", "place", "line")
    return together.select("key", "said").mapInArrow(run, "key string, repaired_sha256 string")


def _pairs_batch(pairs: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())],
        ["key", "repaired_sha256"],
    )


def damaged(df: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with known faults, by crc32 of ``id:turn`` (nulls: one space): to try a repair on.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 takes its .!? away, 3 repeats it,
    4 makes its role user. Keeps the four columns.
    """
    space = F.lit(" ")
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in (id, turn)])
    rows = df.select(
        id,
        turn,
        F.coalesce(F.col(role), space).alias(role),
        F.coalesce(F.col(text), space).alias(text),
        (F.crc32(place.cast("binary")) % 20).alias("_hit"),
    ).where(F.col("_hit") != 0)
    said = F.when(F.col("_hit") == 1, "").when(F.col("_hit") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text))
    who = F.when(F.col("_hit") == 4, "user").otherwise(F.col(role))
    times = F.explode(F.array_repeat(F.lit(1), F.when(F.col("_hit") == 3, 2).otherwise(1)))
    return rows.select(id, turn, who.alias(role), said.alias(text), times.alias("_one")).drop("_one")
