"""Feature steps: the report features and the forecast features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions.dates import add_calendar
from salesflow.operators.cleaning import align_columns, cast_columns, fill_numeric, resolve_clash
from salesflow.operators.encode import apply_index, encode, fit_index
from salesflow.operators.joins import join_features, join_stores
from salesflow.operators.selection import (
    MAX_INTER_CORRELATION,
    MIN_TARGET_CORRELATION,
    Verdict,
    judge_features,
    selected,
)
from salesflow.operators.windows import add_sales_features


def report_features(
    train: DataFrame, features: DataFrame, stores: DataFrame, chunk: str | None = None
) -> DataFrame:
    """Inner joins, then previous values and the four-row mean, nulls as 0."""
    joined = join_stores(join_features(train, features, how="inner"), stores, how="inner")
    return add_sales_features(joined, chunk=chunk)


def report_model_rows(engineered: DataFrame) -> DataFrame:
    """The engineered rows with Type by frequency and IsHoliday as numbers."""
    indexed = encode(engineered, "Type", "Type_Index", order="frequencyDesc")
    doubles = dict.fromkeys(("CPI", "Unemployment", "Prev_CPI", "Prev_Unemployment"), "double")
    numbers = indexed.withColumn("IsHoliday_Int", F.col("IsHoliday").cast("int"))
    return fill_numeric(cast_columns(numbers, doubles))


@dataclass(frozen=True)
class ForecastFeatures:
    train: DataFrame
    test: DataFrame | None
    columns: list[str]
    verdicts: list[Verdict]


def forecast_features(
    train: DataFrame,
    test: DataFrame | None = None,
    target: str = "Weekly_Sales",
    minimum: float = MIN_TARGET_CORRELATION,
    redundancy: float = MAX_INTER_CORRELATION,
    types: DataFrame | None = None,
) -> ForecastFeatures:
    """Calendar, Type and IsHoliday as numbers, then the columns the correlations choose.

    Correlations see the values before nulls become 0. Test rows get the same
    columns; one they lack is 0. ``types`` is a small table to learn the store types from,
    such as the stores; without it they are learned from the training rows.
    """
    model = fit_index(train if types is None else types, "Type")

    def numbers(df: DataFrame) -> DataFrame:
        return resolve_clash(
            apply_index(add_calendar(df, extended=True), model, "Type_encoded")
        )

    train = numbers(train)
    verdicts = judge_features(train, target, minimum=minimum, redundancy=redundancy)
    columns = selected(verdicts)
    if columns:
        train = train.fillna(0, columns)
    if test is not None:
        test = align_columns(numbers(test), columns)
        test = test.fillna(0, columns) if columns else test
    return ForecastFeatures(train, test, columns, verdicts)
