"""Load jobs: a file's rows that keep the contract become an upsert into its keyed table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.contracts import (
    FEATURES,
    MERGED,
    PROMOTION_FLAGS,
    PROMOTION_START,
    PROMOTIONS,
    RAW_FEATURES,
    STORES,
    TEST,
    TRAIN,
    Contract,
)
from salesflow.operators.checks import VIOLATIONS, add_violations
from salesflow.operators.cleaning import clean_promotions, coerce
from salesflow.operators.joins import merge_wide
from salesflow.operators.reports import average_by, table_counts
from salesflow.operators.upsert import replace_by_key, upserted
from salesflow.session import cut
from salesflow.sources.readers import BROKEN, ORDER, scan_csv
from salesflow.sources.stored import StoredTable

_TEXT = "_text"
_PROMOTION_DEFAULTS = dict.fromkeys(PROMOTIONS, 0.0) | dict.fromkeys(PROMOTION_FLAGS, 0)


@dataclass(frozen=True)
class Loaded:
    """What a load gives: the table, the file's rows that break the contract, and the counts.

    ``rejected`` has the file's columns as text and the array ``violations``; ``counts`` is
    one row with ``inserted``, ``updated`` and ``rejected``.
    """

    table: DataFrame
    rejected: DataFrame
    counts: DataFrame


@contextmanager
def _checked(
    spark: SparkSession, path: str, contract: Contract, defaults: dict | None = None
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The file's valid rows in contract types, in input order, and its other rows as text.

    They are held in the block only: what goes on is cut from them there.

    A line that does not have the header's number of fields is refused whole: its violation is
    ``line:`` and the line, and it is not read any further.
    """
    header = spark.read.options(header=True).csv(path).schema
    raw = scan_csv(spark, path, header, input_order=True, broken_lines=True)
    if "IsHoliday_x" in raw.columns and "IsHoliday" not in raw.columns:
        raw = raw.withColumnRenamed("IsHoliday_x", "IsHoliday")
    filled = {c: v for c, v in (defaults or {}).items() if c in raw.columns}
    raw = raw.withColumns(
        {c: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(str(v))) for c, v in filled.items()}
    )
    texts = [c for c in raw.columns if c not in (ORDER, BROKEN)]
    line = F.array(F.concat(F.lit("line:"), F.col(BROKEN)))
    checked = add_violations(raw, contract)
    checked = checked.withColumn(VIOLATIONS, F.when(F.col(BROKEN).isNull(), F.col(VIOLATIONS)).otherwise(line))
    refused = F.size(VIOLATIONS) > 0
    # Read, checked and typed once, for the table, the refused rows and the counts; text stays of the refused rows only.
    packed = checked.withColumn(_TEXT, F.when(refused, F.struct(*texts)))
    rows = coerce(packed, contract, defaults, keep=[ORDER, VIOLATIONS, _TEXT]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows.where(~refused).drop(VIOLATIONS, _TEXT), rows.where(refused).select(f"{_TEXT}.*", VIOLATIONS)
    finally:
        rows.unpersist()


def _empty(spark: SparkSession, contract: Contract) -> DataFrame:
    """No rows, and known as such to the optimizer: a batch is not shuffled to meet them."""
    return spark.createDataFrame([], contract.schema()).where(F.lit(False))


def _into(
    spark: SparkSession,
    target: DataFrame | StoredTable | None,
    batch: DataFrame,
    rejected: DataFrame,
    contract: Contract,
    keep_on_null: tuple[str, ...] = (),
) -> Loaded:
    """A stored table is changed where it lies; a frame gives the changed frame."""
    rejected = cut(rejected, release=True)
    if isinstance(target, StoredTable):
        done = target.merge(batch, [ORDER], keep_on_null)
        counts = spark.range(1).select(
            F.lit(done.inserted).cast("bigint").alias("inserted"), F.lit(done.updated).cast("bigint").alias("updated")
        )
        refused = rejected.agg(F.count(F.lit(1))).scalar().alias("rejected")
        return Loaded(target.read(), rejected, counts.select("*", refused))
    if target is None:
        target = _empty(spark, contract)
    refused = rejected.agg(F.count(F.lit(1))).scalar().alias("rejected")
    table, counts = upserted(target, batch, contract.key, [ORDER], keep_on_null)
    return Loaded(table, rejected, counts.select("*", refused))


def load_stores(spark: SparkSession, path: str, target: DataFrame | StoredTable | None = None) -> Loaded:
    with _checked(spark, path, STORES) as (batch, rejected):
        return _into(spark, target, batch, rejected, STORES)


def load_features(
    spark: SparkSession,
    path: str,
    target: DataFrame | StoredTable | None = None,
    preprocessed: bool = False,
    promotion_start: str = PROMOTION_START,
) -> Loaded:
    """Raw files get flags, and promotion values from before the start become 0."""
    if preprocessed:
        with _checked(spark, path, FEATURES, _PROMOTION_DEFAULTS) as (batch, rejected):
            return _into(spark, target, batch, rejected, FEATURES)
    with _checked(spark, path, RAW_FEATURES) as (batch, rejected):
        batch = clean_promotions(batch, start=promotion_start, zero_before_start=True)
        return _into(spark, target, batch, rejected, FEATURES)


def load_sales(
    spark: SparkSession, path: str, target: DataFrame | StoredTable | None = None, holdout: bool = False
) -> Loaded:
    """A line without a sale leaves the value already there; where there is none it is refused."""
    if holdout:
        with _checked(spark, path, TEST) as (batch, rejected):
            return _into(spark, target, batch, rejected, TEST)
    key, sale = list(TRAIN.key), "Weekly_Sales"
    optional = [replace(f, required=False, nullable=True) if f.name == sale else f for f in TRAIN.fields]
    with _checked(spark, path, replace(TRAIN, fields=tuple(optional))) as (rows, rejected):
        return _into(spark, target, *_sold(rows, rejected, key, sale, target), TRAIN, (sale,))


def _sold(
    rows: DataFrame, rejected: DataFrame, key: list[str], sale: str, target: DataFrame | StoredTable | None
) -> tuple[DataFrame, DataFrame]:
    """The lines of keys that have a sale, here or in the table, and the refused ones with all others."""
    stored = target.read() if isinstance(target, StoredTable) else target
    known = [df.where(F.col(sale).isNotNull()).select(*key) for df in (rows, stored) if df is not None]
    valued = known[0] if len(known) == 1 else known[0].union(known[1])
    bare = rows.where(F.col(sale).isNull()).join(valued, key, "left_anti")
    texts = [
        F.col(c).cast("string").alias(c) if c in bare.columns else F.lit(None).cast("string").alias(c)
        for c in rejected.columns
        if c != VIOLATIONS
    ]
    broken = F.array(F.lit(f"required:{sale}")).alias(VIOLATIONS)
    return rows.join(valued, key, "left_semi"), rejected.unionByName(bare.select(*texts, broken))


def load_merged(spark: SparkSession, path: str, target: DataFrame | StoredTable | None = None) -> Loaded:
    with _checked(spark, path, MERGED, _PROMOTION_DEFAULTS) as (batch, rejected):
        return _into(spark, target, batch, rejected, MERGED)


def load_all(
    spark: SparkSession,
    folder: str,
    preprocessed: bool = False,
    promotion_start: str = PROMOTION_START,
) -> dict[str, Loaded]:
    """All files of a folder, and the merged table; a preprocessed folder has no test sales."""
    base = folder.rstrip("/")
    if preprocessed:
        return {
            "stores": load_stores(spark, f"{base}/stores.csv"),
            "features": load_features(spark, f"{base}/features_cleaned.csv", preprocessed=True),
            "merged_data": load_merged(spark, f"{base}/merged_train.csv"),
        }
    loads = {
        "stores": load_stores(spark, f"{base}/stores.csv"),
        "features": load_features(
            spark, f"{base}/features.csv", promotion_start=promotion_start
        ),
        "train_sales": load_sales(spark, f"{base}/train.csv"),
        "test_sales": load_sales(spark, f"{base}/test.csv", holdout=True),
    }
    wide = merge_tables(*(loads[t].table for t in ("train_sales", "features", "stores")))
    none = wide.limit(0)
    counts = wide.agg(
        F.count(F.lit(1)).alias("inserted"),
        F.lit(0).cast("bigint").alias("updated"),
        F.lit(0).cast("bigint").alias("rejected"),
    )
    return loads | {"merged_data": Loaded(wide, none, counts)}


def summary(loads: dict[str, Loaded]) -> DataFrame:
    """(measure, name, value): rows per table, and mean sales by store type and by holiday."""
    counts = table_counts({name: load.table for name, load in loads.items()})
    parts = [
        counts.select(
            F.lit("rows").alias("measure"),
            F.col("table_name").alias("name"),
            F.col("row_count").cast("double").alias("value"),
        )
    ]
    merged = loads["merged_data"].table
    for by in ("Type", "IsHoliday"):
        means = average_by(merged, [by], name="value")
        parts.append(
            means.select(
                F.lit(f"mean sales by {by}").alias("measure"),
                F.col(by).cast("string").alias("name"),
                "value",
            )
        )
    return parts[0].union(parts[1]).union(parts[2])


def merge_tables(
    train: DataFrame,
    features: DataFrame,
    stores: DataFrame,
    target: DataFrame | StoredTable | None = None,
) -> DataFrame:
    """The wide table, put into ``target`` row by row: matching keys are replaced whole."""
    wide = merge_wide(train, features, stores)
    if isinstance(target, StoredTable):
        target.merge(wide, whole=True)
        return target.read()
    return wide if target is None else replace_by_key(target, wide, MERGED.key)
