"""Model quality as one-row tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.operators.quantiles import summary
from salesflow.session import cut

# Sales classes end at these percentiles of the hold-out labels.
CLASS_EDGES = {"low_edge": 0.25, "high_edge": 0.75}
_CLASSES = (0, 1, 2)

# The columns of a model comparison.
METRICS = (
    "Train_MAE",
    "Test_MAE",
    "Train_RMSE",
    "Test_RMSE",
    "Train_R2",
    "Test_R2",
    "Test_Accuracy",
    "Test_Precision",
    "Test_Recall",
    "Test_F1",
)


def _scored(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())


def _regression(label: str, prediction: str, prefix: str) -> list[Column]:
    error = F.col(label) - F.col(prediction)
    spread = F.nullif(F.var_pop(label), F.lit(0.0))
    return [
        F.avg(F.abs(error)).alias(f"{prefix}MAE"),
        F.sqrt(F.avg(error * error)).alias(f"{prefix}RMSE"),
        (1 - F.avg(error * error) / spread).alias(f"{prefix}R2"),
    ]


def regression_metrics(
    df: DataFrame, label: str = "Weekly_Sales", prediction: str = "prediction", prefix: str = ""
) -> DataFrame:
    """MAE, RMSE and R2 in one aggregation."""
    return _scored(df, label, prediction).agg(*_regression(label, prediction, prefix))


def class_edges(df: DataFrame, label: str = "Weekly_Sales") -> DataFrame:
    """The two values that part low, medium and high sales; one row."""
    return cut(summary(df, label, CLASS_EDGES))


def sales_class(value: Column, low: Column, high: Column, merge_low: bool = True) -> Column:
    """Class of a value by two edges; a value on an edge belongs to the upper class.

    With ``merge_low`` everything under the high edge is one class.
    """
    if merge_low:
        return F.when(value >= high, 1).otherwise(0)
    return F.when(value >= high, 2).when(value >= low, 1).otherwise(0)


def _counters(
    label: str, prediction: str, edges: DataFrame, merge_low: bool
) -> list[Column]:
    """How often each class is real, said, and both."""
    low, high = edges.select("low_edge").scalar(), edges.select("high_edge").scalar()
    actual = sales_class(F.col(label), low, high, merge_low)
    guess = sales_class(F.col(prediction), low, high, merge_low)
    out = [F.count(F.lit(1)).alias("n")]
    for c in _CLASSES:
        out += [
            F.count_if(actual == c).alias(f"real{c}"),
            F.count_if(guess == c).alias(f"said{c}"),
            F.count_if((actual == c) & (guess == c)).alias(f"hit{c}"),
        ]
    return out


def _total(names: list[str]) -> Column:
    return sum((F.col(n) for n in names[1:]), F.col(names[0]))


def _class_scores(prefix: str) -> list[Column]:
    """Accuracy and support-weighted scores from the counters; x / 0 counts as 0."""

    def weighted(times: int, *totals: str) -> Column:
        parts = [
            F.coalesce(
                F.try_divide(times * F.col(f"hit{c}"), _total([f"{t}{c}" for t in totals])),
                F.lit(0.0),
            )
            * F.col(f"real{c}")
            for c in _CLASSES
        ]
        return F.try_divide(sum(parts[1:], parts[0]), F.col("n"))

    hits = _total([f"hit{c}" for c in _CLASSES])
    return [
        F.try_divide(hits, F.col("n")).alias(f"{prefix}Accuracy"),
        weighted(1, "said").alias(f"{prefix}Precision"),
        weighted(1, "real").alias(f"{prefix}Recall"),
        weighted(2, "said", "real").alias(f"{prefix}F1"),
    ]


def class_metrics(
    df: DataFrame,
    label: str = "Weekly_Sales",
    prediction: str = "prediction",
    prefix: str = "",
    merge_low: bool = True,
    edges: DataFrame | None = None,
) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 over sales classes."""
    rows = _scored(df, label, prediction)
    edges = edges if edges is not None else class_edges(rows, label)
    return rows.agg(*_counters(label, prediction, edges, merge_low)).select(
        *_class_scores(prefix)
    )


def evaluation_row(
    name: str,
    train: DataFrame,
    test: DataFrame,
    label: str = "Weekly_Sales",
    prediction: str = "prediction",
    merge_low: bool = True,
    edges: DataFrame | None = None,
) -> DataFrame:
    """All metrics of one model in one row; each side is scored in one pass."""
    rows = _scored(test, label, prediction)
    edges = edges if edges is not None else class_edges(rows, label)
    on_test = rows.agg(
        *_regression(label, prediction, "Test_"), *_counters(label, prediction, edges, merge_low)
    )
    on_train = regression_metrics(train, label, prediction, "Train_")
    return (
        on_test.withColumn("_train", on_train.select(F.struct("*")).scalar())
        .select("*", "_train.*", *_class_scores("Test_"))
        .select(F.lit(name).alias("Model"), *METRICS)
    )
