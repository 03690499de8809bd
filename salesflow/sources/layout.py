"""Layouts of stored tables for several query patterns at once.

``write_interleaved`` orders rows along a curve through all named columns, so that every file and
row group spans a small part of each of them and Parquet's own statistics skip most of the table
for a filter on any of them, where an ordinary sort serves its first column only.

``write_bucketed`` stores a table hashed by a key, once, so that joins and windows on that key
read it without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits a column has on the curve; all columns together stay below 63.
BITS = 6
_MOST_BITS = 62
_PREFIX = 7


def as_number(df: DataFrame, column: str) -> Column:
    """A number in the column's own order; of texts, as far as their first bytes tell."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.NumericType):
        return F.nanvl(c.cast("double"), F.lit(float("inf")))
    if isinstance(kind, T.StringType):
        # A double keeps the first 53 of 56 bits: the order holds, near prefixes may share a number.
        start = F.rpad(F.hex(F.substring(c.cast("binary"), 1, _PREFIX)), 2 * _PREFIX, "0")
        return F.conv(start, 16, 10).cast("double")
    raise TypeError(f"{column}: {kind.simpleString()} has no place on a curve")


def boundaries(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """Up to 2**bits - 1 values of each column that cut its rows into like shares, in one pass.

    A value many rows share is one boundary, so columns of few values get a bin for each.
    """
    shares = [k / 2**bits for k in range(1, 2**bits)]
    found = df.agg(
        *[F.percentile_approx(as_number(df, c), shares, 100 * 2**bits).alias(f"q{k}") for k, c in enumerate(columns)]
    ).first()
    return {c: sorted(set(found[k] or [])) for k, c in enumerate(columns)}


def _spread(number: int, bits: int, place: int, columns: int) -> int:
    """The bits of a bin's number, moved apart to the column's places on the curve."""
    return sum(((number >> b) & 1) << (b * columns + columns - 1 - place) for b in range(bits))


def curve(df: DataFrame, columns: Sequence[str], cuts: dict[str, list[float]], bits: int = BITS) -> Column:
    """A row's place on the curve: the bits of its columns' bins, interleaved.

    Each column's bin is found by halving, as nested conditions that end in the moved bits
    themselves; a null goes with the least values.
    """
    if len(columns) * bits > _MOST_BITS:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit a long")

    def place(k: int, name: str) -> Column:
        value, known = as_number(df, name), cuts[name]
        # Few values use the highest bits, so that they count as much as a finer column's.
        scale = 2**bits / (len(known) + 1)

        def below(low: int, high: int) -> Column:
            if low == high:
                return F.lit(_spread(int(low * scale), bits, k, len(columns))).cast("bigint")
            middle = (low + high + 1) // 2
            return F.when(value >= known[middle - 1], below(middle, high)).otherwise(below(low, middle - 1))

        return below(0, len(known))

    places = [place(k, c) for k, c in enumerate(columns)]
    total = places[0]
    for p in places[1:]:
        total = total + p
    return total


def write_interleaved(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    files: int | None = None,
    bits: int = BITS,
    row_group_bytes: int | None = None,
    mode: str = "overwrite",
) -> str:
    """Parquet in the order of the curve through ``columns``; rows and columns are those of ``df``.

    Files are ranges of the curve, found by Spark's sampling; a hash of the row comes second, so
    that a place which holds a third of all rows still spreads over several files. ``df`` is
    read twice, once for the boundaries. An empty table is written as one.
    """
    z, tie = "_curve", "_tie"
    while z in df.columns or tie in df.columns:
        z, tie = f"{z}_", f"{tie}_"
    plain = [f.name for f in df.schema if isinstance(f.dataType, (T.AtomicType, T.NullType))]
    placed = df.withColumns({z: curve(df, columns, boundaries(df, columns, bits), bits), tie: F.xxhash64(*plain)})
    ranged = placed.repartitionByRange(*([files] if files else []), z, tie)
    writer = ranged.sortWithinPartitions(z, *columns).drop(z, tie).write.mode(mode)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    return path


def write_bucketed(
    df: DataFrame, table: str, path: str, by: Sequence[str], buckets: int, sort_by: Sequence[str] = ()
) -> str:
    """A catalogue table hashed by ``by`` into as many files as ``buckets``, each sorted.

    Joins and windows on exactly these columns (windows: on more, too) then need no exchange. A
    key's rows share a bucket, so choose keys whose groups the calendar bounds, as (Store, Date)
    and (Store, Dept) are, not one that may hold a third of the rows. Both sides of a join need
    the same number of buckets.
    """
    placed = df.repartition(buckets, *by)
    writer = placed.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *by).sortBy(*(sort_by or by)).saveAsTable(table)
    return table


def drop_table(spark: SparkSession, table: str) -> None:
    """Forget the table's name; the files of an own path stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
