"""Exact quantiles of columns of any size.

``percentile`` keeps all distinct values of a group in one task. Here a group
is narrowed first: count its values in equal bins, move to the bin that holds the
wanted rank, and repeat until that bin is small enough for one task. Each round
shuffles only bin counts. Groups that are small to begin with skip the rounds.
All rounds read the keys and values alone, held on the executors, so what the rows come from
runs once. A caller who holds them already says so (``held``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.session import cut

TASK_ROWS = 2_000_000
BINS = 512
BROADCAST_ROWS = 200_000


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    keys: Sequence[str] = (),
    task_rows: int = TASK_ROWS,
    bins: int = BINS,
    held: bool = False,
) -> DataFrame:
    """One row (keys, prob, quantile) per group and probability.

    Linear interpolation between the neighbouring ranks. Null and NaN values do
    not count, rows with a null key are left out, values must be finite.
    """
    return _quantiles(_values(df, value, keys), probs, list(keys), {}, task_rows, bins, held)[0]


def summary(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    keys: Sequence[str] = (),
    extra: dict[str, Callable[[str], Column]] | None = None,
    task_rows: int = TASK_ROWS,
    bins: int = BINS,
    held: bool = False,
) -> DataFrame:
    """One row per group: a column per entry of ``{name: probability}``, and ``extra``.

    ``extra`` maps names to aggregate functions of the value. They are computed
    in the pass that counts the group, so they cost no scan of their own.
    """
    keys, extra = list(keys), extra or {}
    long, ranks = _quantiles(
        _values(df, value, keys), sorted(set(probs.values())), keys, extra, task_rows, bins, held
    )
    columns = [
        F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name)
        for name, p in probs.items()
    ]
    wide = long.groupBy(*keys).agg(*columns)
    if not extra:
        return wide
    if keys:
        return wide.join(ranks.select(*keys, *extra).distinct(), keys)
    facts = {name: ranks.select(name).limit(1).scalar() for name in extra}
    return wide.withColumns(facts)


def _values(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    return rows


def _quantiles(
    rows: DataFrame,
    probs: Sequence[float],
    keys: list[str],
    extra: dict[str, Callable[[str], Column]],
    task_rows: int,
    bins: int,
    held: bool,
) -> tuple[DataFrame, DataFrame]:
    """The quantiles in long form, and the rank table they were read from."""
    if held:
        return _found(rows, probs, keys, extra, task_rows, bins)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found, ranks = _found(rows, probs, keys, extra, task_rows, bins)
        return cut(found), ranks
    finally:
        rows.unpersist()


def _found(
    rows: DataFrame,
    probs: Sequence[float],
    keys: list[str],
    extra: dict[str, Callable[[str], Column]],
    task_rows: int,
    bins: int,
) -> tuple[DataFrame, DataFrame]:
    ranks = cut(_wanted_ranks(rows, keys, probs, extra))
    narrowed = False
    while ranks.where(_too_wide(task_rows)).limit(1).count():
        ranks = cut(_narrow(rows, ranks, keys, task_rows, bins))
        narrowed = True
    if narrowed:
        rows = _tag(rows, _brackets(ranks, keys), keys)
    else:
        rows = rows.withColumn("_below", F.lit(0).cast("long"))
    return _pick(rows, ranks, keys), ranks


def small_side(df: DataFrame) -> DataFrame:
    """A join side with a broadcast hint if a count shows that it is small.

    Only for frames that are cheap to count, such as checkpointed ones. A larger
    one goes without hint: a shuffled join, whose hot keys adaptive execution splits.
    """
    return F.broadcast(df) if is_small(df) else df


def is_small(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _too_wide(task_rows: int) -> Column:
    return (F.col("_inside") > task_rows) & (F.col("_lo") < F.col("_hi"))


def _wanted_ranks(
    rows: DataFrame,
    keys: list[str],
    probs: Sequence[float],
    extra: dict[str, Callable[[str], Column]],
) -> DataFrame:
    """A row per group, probability and neighbouring rank, with the whole group as bracket."""
    whole = rows.groupBy(*keys).agg(
        F.count("_v").alias("_inside"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
        *[f("_v").alias(name) for name, f in extra.items()],
    )
    wanted = F.array(
        *[
            F.struct(F.lit(float(p)).alias("prob"), F.lit(upper).alias("_upper"))
            for p in probs
            for upper in (False, True)
        ]
    )
    at = F.col("prob") * (F.col("_inside") - 1)
    rank = F.when(F.col("_upper"), F.ceil(at)).otherwise(F.floor(at)).cast("long")
    return (
        whole.where(F.col("_inside") > 0)
        .select("*", F.inline(wanted))
        .withColumns({"_rank": rank, "_share": at - F.floor(at)})
        .withColumn("_below", F.lit(0).cast("long"))
    )


def _brackets(ranks: DataFrame, keys: list[str]) -> DataFrame:
    """The brackets in use. Those of one group never overlap, so ``_below`` tells them apart."""
    return ranks.select(*keys, "_below", "_lo", "_hi").distinct()


def _tag(rows: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    """Rows inside a bracket, with the bracket's columns."""
    inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    if keys:
        return rows.join(small_side(brackets), keys).where(inside)
    # Without keys there are at most two brackets per probability.
    known = brackets.collect()
    tag = F.coalesce(
        *[
            F.when(
                F.col("_v").between(b["_lo"], b["_hi"]),
                F.struct(
                    F.lit(b["_below"]).cast("long").alias("_below"),
                    F.lit(b["_lo"]).alias("_lo"),
                    F.lit(b["_hi"]).alias("_hi"),
                ),
            )
            for b in known
        ]
    )
    return rows.withColumn("_tag", tag).where("_tag is not null").select("*", "_tag.*").drop("_tag")


def _running(df: DataFrame, group: list[str], order: str) -> DataFrame:
    """Adds ``_first``, the rank of the first row of each entry."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_first", F.col("_below") + F.sum("_c").over(w) - F.col("_c"))


def _holds_rank() -> Column:
    return (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_first") + F.col("_c"))


def _narrow(
    rows: DataFrame, ranks: DataFrame, keys: list[str], task_rows: int, bins: int
) -> DataFrame:
    wide, done = ranks.where(_too_wide(task_rows)), ranks.where(~_too_wide(task_rows))
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    # Halves where the width of a bracket of huge doubles would be infinite.
    place = F.when(hi - lo < float("inf"), (v - lo) / (hi - lo)).otherwise(
        (v / 2 - lo / 2) / (hi / 2 - lo / 2)
    )
    group = [*keys, "_below"]
    counts = (
        _tag(rows, _brackets(wide, keys), keys)
        .withColumn("_bin", F.least(F.floor(place * bins), F.lit(bins - 1)))
        .groupBy(*group, "_bin")
        .agg(F.count("_v").alias("_c"), F.min("_v").alias("_blo"), F.max("_v").alias("_bhi"))
    )
    moved = (
        wide.join(_running(counts, group, "_bin"), group)
        .where(_holds_rank())
        .withColumns(
            {
                "_lo": F.col("_blo"),
                "_hi": F.col("_bhi"),
                "_inside": F.col("_c"),
                "_below": F.col("_first"),
            }
        )
    )
    return done.unionByName(moved.select(*done.columns))


def _pick(rows: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    group = [*keys, "_below"]
    counts = rows.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_c"))
    found = ranks.join(_running(counts, group, "_v"), group).where(_holds_rank())
    low = F.max(F.when(~F.col("_upper"), F.col("_v")))
    high = F.max(F.when(F.col("_upper"), F.col("_v")))
    return (
        found.groupBy(*keys, "prob", "_share")
        .agg(low.alias("_low"), high.alias("_high"))
        .select(
            *keys,
            "prob",
            (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias("quantile"),
        )
    )
