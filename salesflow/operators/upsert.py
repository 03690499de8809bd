"""Upsert and merge of a batch into a keyed table.

Both sides are keyed: the target by contract, the batch after it has been
reduced to its last record per key. A row without a key ends the job: it could never match. No key is hot in the join, however many
copies the batch brings, because the reduction combines them before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.operators.quantiles import is_small
from salesflow.session import cut


def keyed(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows as they are; reading one with a null in its key fails."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    refuse = F.raise_error(F.lit(f"a row without a key in {', '.join(key)}"))
    return df.withColumn(key[0], F.when(complete, F.col(key[0])).otherwise(refuse))


def last_per_key(
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[str] = (),
    keep_on_null: Sequence[str] = (),
) -> DataFrame:
    """The last record of each key by ``order``, taken whole, nulls included.

    A null in a ``keep_on_null`` column leaves what an earlier record says. Without an order
    the records' own values decide.
    """
    names = [c for c in batch.columns if c not in key and c not in order]
    newest = F.max_by(F.struct(*names), F.struct(*order)) if order else F.max(F.struct(*names))
    place = F.struct(*order) if order else F.struct(*names)
    kept = {
        c: F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_kept_{c}")
        for c in keep_on_null
        if c in names
    }
    # Looked for after the reduction, rows without a key leave the batch's partitioning as it is.
    last = keyed(batch.groupBy(*key).agg(newest.alias("_new"), *kept.values()), key)
    if not kept:
        return last
    values = [F.col(f"_kept_{c}" if c in kept else f"_new.{c}").alias(c) for c in names]
    return last.select(*key, F.struct(*values).alias("_new"))


INSERTED = "_inserted"
CHANGED = "_changed"


@dataclass(frozen=True)
class Pairs:
    """Target and batch side by side per key, each packed into one struct; null where absent."""

    rows: DataFrame
    kept: list[str]
    incoming: list[str]

    @property
    def names(self) -> list[str]:
        return [*[c for c in self.rows.columns if c not in ("_old", "_new")], *self.kept, *self.incoming]


def paired(target: DataFrame, new: DataFrame, key: Sequence[str]) -> Pairs:
    """``new`` comes from last_per_key and is kept. For a batch of few rows, which are counted, the
    target is only ever the streamed side, so the batch is broadcast and the target is not shuffled;
    keys to insert are the batch's without those found in the target. Of a larger one both sides
    are shuffled, each once.
    """
    incoming = new.schema["_new"].dataType.names
    kept = [c for c in target.columns if c not in key]
    old = keyed(target, key).select(*key, F.struct(*kept).alias("_old"))
    if not is_small(new):
        return Pairs(old.join(new, list(key), "full_outer"), kept, incoming)
    new = F.broadcast(new)
    found = target.select(*key).join(new.select(*key), list(key), "left_semi")
    added = new.join(found, list(key), "left_anti")
    nothing = F.lit(None).cast(old.schema["_old"].dataType).alias("_old")
    rows = old.join(new, list(key), "left").unionByName(added.select(*key, nothing, "_new"))
    return Pairs(rows, kept, incoming)


def resolved(
    pairs: Pairs, key: Sequence[str], keep_on_null: Sequence[str] = (), changes: bool = False
) -> DataFrame:
    """The rows after an upsert; with ``changes``, also which are inserted or really changed."""
    arrived, there = F.col("_new").isNotNull(), F.col("_old").isNotNull()

    def value(name: str) -> Column:
        if name not in pairs.incoming:
            return F.col(f"_old.{name}")
        if name not in pairs.kept:
            return F.col(f"_new.{name}")
        if name in keep_on_null:
            return F.coalesce(F.col(f"_new.{name}"), F.col(f"_old.{name}"))
        return F.when(arrived, F.col(f"_new.{name}")).otherwise(F.col(f"_old.{name}"))

    names = [*pairs.kept, *[c for c in pairs.incoming if c not in pairs.kept]]
    flags = []
    if changes:
        changed = F.lit(False)
        for c in pairs.incoming:
            if c not in pairs.kept:
                changed = changed | F.col(f"_new.{c}").isNotNull()
                continue
            differs = ~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
            changed = changed | (differs & F.col(f"_new.{c}").isNotNull() if c in keep_on_null else differs)
        flags = [(arrived & ~there).alias(INSERTED), (arrived & there & changed).alias(CHANGED)]
    return pairs.rows.select(*key, *[value(n).alias(n) for n in names], *flags)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    keep_on_null: Sequence[str] = (),
) -> DataFrame:
    """Set the batch's columns on matching keys, insert the other keys.

    Columns the batch lacks keep their value. A null in the batch is a value to
    set, except in ``keep_on_null`` columns.
    """
    return upserted(target, batch, key, order, keep_on_null)[0]


def upsert_counts(
    target: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    keep_on_null: Sequence[str] = (),
) -> DataFrame:
    """How many keys an upsert inserts and how many it really changes; one row."""
    return upserted(target, batch, key, order, keep_on_null)[1]


def upserted(
    target: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    keep_on_null: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """The table after an upsert, and its counts; the batch is reduced once for both."""
    pairs = paired(target, cut(last_per_key(batch, key, order, keep_on_null), release=True), key)
    counts = resolved(pairs, key, keep_on_null, changes=True).agg(
        F.count_if(INSERTED).alias("inserted"), F.count_if(CHANGED).alias("updated")
    )
    return resolved(pairs, key, keep_on_null), counts


def replace_by_key(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Matching rows replaced whole by the batch's, the other batch rows inserted.

    Of several batch rows with one key the last by ``order`` counts.
    """
    new = last_per_key(batch, key, order).select(*key, "_new.*")
    untouched = keyed(target, key).join(new.select(*key), list(key), "left_anti")
    return untouched.unionByName(new, allowMissingColumns=True)
