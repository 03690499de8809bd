"""Mixing sources to target weights, in DataFrame functions only.

Sizes are words (runs of bytes other than space and \\x09-\\x0D). They are added up per
source, before and after the shuffle; each source's target is its weight's share of the
wanted total, but at most a fixed multiple of its size, the excess shared out again by
weight (one water level over all sources). A document is emitted floor(rate) times, rate
being target over size, and once more if a hash of a seed, its id and its text, as a number
in [0, 1), is below the rate's fraction. Of a few fixed seeds each source takes the one that
lands nearest its target, so a source with few long documents also comes close. Reruns
on any partitioning agree.

Nothing is collected and no source is held together: a hot source is one partial sum per
task. Null text has size 0; null is a source of its own, after all others; a null id
is hashed as a word, so rows without an id or with a shared one still differ by their texts.
Rows repeated with one id and text are copied alike. A source without words has rate 0. An
empty table gives no rows. Extra columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.session import cut

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
MOST = 2.0
SEEDS = 16
BROADCAST_SOURCES = 10_000

_OWN = "_mix_"


def words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def key_of(id: Column, text: Column) -> Column:
    """What a document is drawn by: its id and a hash of its text."""
    content = F.md5(F.coalesce(text, F.lit("")))
    return F.concat_ws(":", F.coalesce(id.cast("string"), F.lit("null")), content)


def draw(key: Column, seed: Column) -> Column:
    """A number in [0, 1) from a seed and a document's key."""
    text = F.concat_ws(":", seed.cast("string"), key)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(2**32)


def own_prefix(columns: Sequence[str]) -> str:
    """A prefix that none of the columns has, whatever their case."""
    prefix = _OWN
    while any(c.lower().startswith(prefix) for c in columns):
        prefix = f"_{prefix}"
    return prefix


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from one (source, source_size) row per source.

    The windows run over one row per source, not over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight",
        F.element_at(
            F.array(*[F.lit(float(w)) for w in weights]),
            (F.col("rank") % len(weights) + 1).cast("int"),
        ),
    )
    all_rows = Window.partitionBy()
    # Sources reach their cap in the order of cap per weight as the level rises.
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        (total * F.sum("source_size").over(all_rows))
        - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    ) / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    cap = most * F.col("source_size")
    levels = ranked.withColumn("level", level)
    stands = F.when(F.col("level") * F.col("weight") <= cap, F.struct("order", "level"))
    return (
        levels.withColumn("order", F.row_number().over(filling))
        .withColumn("water", F.min(stands).over(all_rows)["level"])
        .select(
            "source",
            "source_size",
            F.least(cap, F.col("water") * F.col("weight")).cast("double").alias("target"),
        )
    )


def mixed(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    total: float = TOTAL,
    most: float = MOST,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Each document with ``size``, ``source_size``, ``target`` and the number of ``copies``.

    ``keep`` names the columns to carry besides (all by default); a kept column with one
    of these four names stays under it and the operator's goes to ``_mix_<name>``, with
    more underscores in front where kept columns begin so.
    """
    columns = list(df.columns if keep is None else keep)
    own, named = own_prefix(columns), {c.lower() for c in columns}
    light = df.select(
        F.col(source).alias("of"), key_of(F.col(id), F.col(text)).alias("key"), words(F.col(text)).alias("size")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = light.groupBy(F.col("of").alias("source")).agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(
        F.lit(0.0)
    )
    aims = cut(targets(sizes, weights, total, most).withColumn("rate", rate))
    small = aims.count() <= BROADCAST_SOURCES
    side = F.broadcast(aims) if small else aims
    fraction = F.col("rate") - F.floor("rate")
    taken = light.join(side, F.col("of").eqNullSafe(F.col("source"))).select(
        "source",
        "rate",
        "target",
        "source_size",
        *[
            (
                F.col("size")
                * (F.floor("rate") + (draw(F.col("key"), F.lit(k)) < fraction).cast("long"))
            ).alias(f"t{k}")
            for k in range(SEEDS)
        ],
    )
    sums = taken.groupBy("source").agg(
        F.first("rate").alias("rate"),
        F.first("target").alias("target"),
        F.first("source_size").alias("source_size"),
        *[F.sum(f"t{k}").alias(f"t{k}") for k in range(SEEDS)],
    )
    misses = [
        F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("miss"), F.lit(k).alias("seed"))
        for k in range(SEEDS)
    ]
    nearest = F.array_min(F.array(*misses))["seed"]
    plan = sums.select(
        F.col("source").alias(f"{own}key"),
        F.col("source_size").alias(f"{own}source_size"),
        F.col("target").alias(f"{own}target"),
        F.col("rate").alias(f"{own}rate"),
        nearest.alias(f"{own}seed"),
    )
    plan = cut(plan)
    light.unpersist()
    plan = F.broadcast(plan) if small else plan
    rows = df.select(
        *[F.col(c) for c in columns],
        F.col(source).alias(f"{own}source"),
        key_of(F.col(id), F.col(text)).alias(f"{own}document"),
        words(F.col(text)).alias(f"{own}size"),
    )
    joined = rows.join(plan, F.col(f"{own}source").eqNullSafe(F.col(f"{own}key")))
    whole = F.floor(f"{own}rate")
    number = draw(F.col(f"{own}document"), F.col(f"{own}seed"))
    copies = whole + (number < F.col(f"{own}rate") - whole).cast("long")
    made = {n: F.col(f"{own}{n}") for n in ("size", "source_size", "target")} | {"copies": copies}
    return joined.select(
        *columns, *[c.alias(f"{own}{n}" if n in named else n) for n, c in made.items()]
    )


def emit(df: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``df``, each as often as the mix takes it."""
    columns = df.columns
    own = own_prefix(columns)
    name = f"{own}copies" if "copies" in {c.lower() for c in columns} else "copies"
    rows = mixed(df, **options).where(F.col(name) > 0)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(name)))
    return rows.select(*columns, times.alias(f"{own}copy")).select(*columns)
