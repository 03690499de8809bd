"""The tables a forecast run starts from, by kind of source."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from salesflow.contracts import FEATURES, MERGED, STORES, TEST
from salesflow.operators.cleaning import coerce
from salesflow.sources.readers import scan_csv, scan_documents
from salesflow.sources.zones import Zones


@dataclass(frozen=True)
class ForecastInputs:
    merged: DataFrame
    features: DataFrame
    stores: DataFrame
    test: DataFrame


def _text(spark: SparkSession, path: str) -> DataFrame:
    """The file's own columns as text; the contract then gives them types."""
    return scan_csv(spark, path, spark.read.options(header=True).csv(path).schema)


def from_files(spark: SparkSession, base: str, test_path: str | None = None) -> ForecastInputs:
    """The preprocessed CSV files of a zone base, on any file system Spark reads."""
    zones = Zones(base)
    merged = _text(spark, zones.preprocessed("merged_train.csv"))
    if "IsHoliday_x" in merged.columns:
        merged = merged.withColumnRenamed("IsHoliday_x", "IsHoliday").drop("IsHoliday_y")
    return ForecastInputs(
        coerce(merged, MERGED),
        coerce(_text(spark, zones.preprocessed("features_cleaned.csv")), FEATURES),
        coerce(_text(spark, zones.preprocessed("stores.csv")), STORES),
        coerce(_text(spark, test_path or zones.raw("test.csv")), TEST),
    )


def from_documents(
    spark: SparkSession,
    base: str | None = None,
    test_path: str | None = None,
    fmt: str = "json",
    **options: str,
) -> ForecastInputs:
    """The collections ``merged_data``, ``features`` and ``stores``, and a test CSV.

    With a connector ``fmt`` names it and the collection is passed as an option.
    """

    def collection(name: str, contract) -> DataFrame:
        if base is not None:
            df = scan_documents(spark, f"{base.rstrip('/')}/{name}", fmt, contract.raw_schema())
        else:
            df = scan_documents(spark, None, fmt, None, collection=name, **options)
        return coerce(df, contract)

    path = test_path or (Zones(base).raw("test.csv") if base else None)
    if path is None:
        raise ValueError("test_path is needed when the collections have no base folder")
    return ForecastInputs(
        collection("merged_data", MERGED),
        collection("features", FEATURES),
        collection("stores", STORES),
        coerce(_text(spark, path), TEST),
    )


SOURCES: dict[str, Callable[..., ForecastInputs]] = {
    "files": from_files,
    "hdfs": from_files,
    "documents": from_documents,
    "mongodb": from_documents,
}


def load_tables(spark: SparkSession, source: str = "files", **options) -> ForecastInputs:
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r}, use one of {sorted(SOURCES)}")
    return SOURCES[source](spark, **options)
