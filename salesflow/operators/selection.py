"""Feature selection by correlation thresholds.

Correlations are computed on Spark; what comes to the driver is one number per
column pair, a size the schema sets and the rows do not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.operators.cleaning import numeric_columns
from salesflow.operators.stats import correlation_matrix, target_correlations

# The default thresholds.
MIN_TARGET_CORRELATION = 0.01
MAX_INTER_CORRELATION = 0.95

# Correlations are compared after rounding, so that equal ones tie on every run.
DIGITS = 8


@dataclass(frozen=True)
class Verdict:
    feature: str
    corr: float | None
    status: str  # kept, low or redundant
    redundant_with: str | None = None


def rank_features(
    df: DataFrame, target: str = "Weekly_Sales", columns: Sequence[str] | None = None
) -> DataFrame:
    """Features by absolute target correlation, greatest first, then by name."""
    corr = F.round("corr", DIGITS)
    return (
        target_correlations(df, target, columns)
        .select("feature", corr.alias("corr"))
        .orderBy(F.abs("corr").desc_nulls_last(), "feature")
    )


def related_to_target(
    df: DataFrame,
    target: str = "Weekly_Sales",
    columns: Sequence[str] | None = None,
    minimum: float = MIN_TARGET_CORRELATION,
) -> DataFrame:
    """The features with at least ``minimum`` absolute correlation; null ones drop out."""
    return rank_features(df, target, columns).where(F.abs("corr") >= minimum)


def judge_features(
    df: DataFrame,
    target: str = "Weekly_Sales",
    columns: Sequence[str] | None = None,
    minimum: float = MIN_TARGET_CORRELATION,
    redundancy: float = MAX_INTER_CORRELATION,
) -> list[Verdict]:
    """Walk the features from the strongest on and keep those unlike all kept before.

    Without a numeric target column nothing is judged.
    """
    if target not in numeric_columns(df):
        return []
    columns = list(columns or numeric_columns(df, [target]))
    between: dict[frozenset[str], float | None] = {}
    for row in correlation_matrix(df, [*columns, target]).collect():
        value = None if row["corr"] is None else round(row["corr"], DIGITS)
        between[frozenset((row["f1"], row["f2"]))] = value
    strength = {c: between[frozenset((c, target))] for c in columns}
    by_strength = sorted(
        columns, key=lambda c: (strength[c] is None, -abs(strength[c] or 0.0), c)
    )
    verdicts: list[Verdict] = []
    kept: list[str] = []
    for feature in by_strength:
        corr = strength[feature]
        if corr is None or abs(corr) < minimum:
            verdicts.append(Verdict(feature, corr, "low"))
            continue
        twin = next(
            (k for k in kept if abs(between[frozenset((k, feature))] or 0.0) > redundancy), None
        )
        if twin is None:
            kept.append(feature)
        verdicts.append(Verdict(feature, corr, "redundant" if twin else "kept", twin))
    return verdicts


def selected(verdicts: Sequence[Verdict]) -> list[str]:
    return [v.feature for v in verdicts if v.status == "kept"]


def selection_report(df: DataFrame, **options) -> DataFrame:
    """One row per feature: correlation, verdict and the kept feature it repeats."""
    rows = [
        (place, v.feature, v.corr, v.status, v.redundant_with)
        for place, v in enumerate(judge_features(df, **options), 1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "place int, feature string, corr double, status string, redundant_with string"
    )
