"""The forecast run: features, split, model comparison, scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.operators import models as M
from salesflow.operators.cleaning import features_and_target
from salesflow.operators.joins import scoring_input
from salesflow.operators.reports import best_row
from salesflow.operators.split import split
from salesflow.plans.features import ForecastFeatures, forecast_features
from salesflow.sources.catalog import ForecastInputs
from salesflow.sources.readers import write_csv

KEY = ("Store", "Dept", "Date")


@dataclass(frozen=True)
class ForecastRun:
    features: ForecastFeatures
    models: dict[str, Model]
    comparison: DataFrame
    best: str
    predictions: DataFrame
    fitted: DataFrame
    importances: DataFrame | None


def run(
    inputs: ForecastInputs,
    learners: dict[str, M.Learner] | None = None,
    output: str | None = None,
) -> ForecastRun:
    """Everything from the loaded tables to scored test rows.

    With ``output`` the comparison and the predictions are also written as CSV.
    """
    merged = inputs.merged.persist(StorageLevel.MEMORY_AND_DISK)
    test_rows = scoring_input(inputs.test, inputs.features, inputs.stores)
    made = forecast_features(merged, test_rows, types=inputs.stores)
    train, holdout = split(features_and_target(made.train, made.columns, keep=KEY), key=KEY)
    models, comparison = M.compare(
        M.assemble(train, made.columns), M.assemble(holdout, made.columns), learners
    )
    merged.unpersist()
    best = best_row(comparison).first()["Model"]
    model = models[best]
    fitted = M.predict(model, M.assemble(holdout, made.columns, keep=(*KEY, M.TARGET)))
    predictions = M.score(model, made.test, made.columns)
    explained = None
    if hasattr(model, "featureImportances"):
        explained = M.importances(comparison, model, made.columns, top=20)
    if output:
        write_csv(comparison, f"{output}/model_comparison")
        write_csv(predictions, f"{output}/predictions")
    return ForecastRun(
        made,
        models,
        comparison,
        best,
        predictions,
        fitted.select(*KEY, F.col(M.TARGET).alias("actual"), "prediction"),
        explained,
    )
