"""Category columns to numbers."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MOST_LABELS = 10_000


def fit_index(df: DataFrame, column: str, order: str = "alphabetAsc") -> StringIndexerModel:
    """Learn the categories: ``alphabetAsc``, or ``frequencyDesc`` with ties by name.

    The categories are held on the driver, so the column has to be an
    enumeration, as store types are by contract: more than ``MOST_LABELS`` are refused.
    """
    found = df.select(column).distinct().limit(MOST_LABELS + 1).count()
    if found > MOST_LABELS:
        raise ValueError(f"{column} has more than {MOST_LABELS} categories")
    return StringIndexer(
        inputCol=column,
        outputCol="_index",
        stringOrderType=order,
        handleInvalid="keep",
    ).fit(df)


def apply_index(
    df: DataFrame, model: StringIndexerModel, output: str, unseen: int = 0
) -> DataFrame:
    """The category's number; null and unseen categories become ``unseen``."""
    known = len(model.labelsArray[0])
    index = F.col("_index").cast("int")
    return (
        model.transform(df)
        .withColumn(output, F.when(index < known, index).otherwise(unseen))
        .drop("_index")
    )


def encode(
    df: DataFrame,
    column: str = "Type",
    output: str = "Type_encoded",
    order: str = "alphabetAsc",
    fitted_on: DataFrame | None = None,
) -> DataFrame:
    model = fit_index(fitted_on if fitted_on is not None else df, column, order)
    return apply_index(df, model, output)
