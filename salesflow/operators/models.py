"""Regressors: assemble, fit, compare, explain and score. Linear models and first-order
boosting are MLlib's; the deep forest and second-order boosting grow from histograms."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.operators import histogram_trees
from salesflow.operators.evaluate import class_edges, evaluation_row
from salesflow.operators.split import SEED
from salesflow.session import cut, shared_folder

TARGET = "Weekly_Sales"
VECTOR = "features"

# The model inputs of the report notebook, in vector order.
REPORT_FEATURES = (
    "Store",
    "Dept",
    "Size",
    "Type_Index",
    "IsHoliday_Int",
    "Temperature",
    "Fuel_Price",
    "CPI",
    "Unemployment",
    "Prev_CPI",
    "Prev_Unemployment",
    "Avg_Sales_Prev_4Wk",
    "hasMarkDown1",
    "hasMarkDown2",
    "hasMarkDown3",
    "hasMarkDown4",
    "hasMarkDown5",
)

# Thresholds per feature of the compared trees; numbers of stores and departments lie below.
BINS = 256

# The learners' settings.
RIDGE_ALPHA = 1.0
SMALL_FOREST = {"numTrees": 20, "maxDepth": 6}
BOOSTED = {"maxIter": 100, "maxDepth": 6, "maxBins": BINS, "stepSize": 0.1}

# Split statistics of one pass over the rows, per task. Fixed, because it sets the order in
# which nodes draw their features: the same model on any cluster.
TREE_MEMORY_MB = 256
_SHALLOW = 8
# Boosting chains one tree to the next; a checkpoint every few trees keeps the
# chain short enough to rebuild when an executor is lost.
_CHECKPOINT_EVERY = 10

# Training rows per partition: the fewest, the partitions beyond which there are more, and the
# most. By the rows alone, so that bagging draws the same rows on any cluster. Every partition
# is a task of every pass with a result for the driver, so they grow with the rows only where
# each has its fill.
_FEWEST_ROWS = 5_000
_USUAL_PARTITIONS = 96
_MOST_ROWS = 200_000

Learner = Callable[[DataFrame], Estimator]


def linear() -> Learner:
    return lambda train: LinearRegression(featuresCol=VECTOR, labelCol=TARGET)


def ridge(alpha: float = RIDGE_ALPHA) -> Learner:
    """Penalty ``alpha * |w|^2`` on the sum of squared errors, on unscaled features.

    MLlib divides the error by the row count and scales the penalty by the
    label deviation, so both come out of the training rows. The normal equations
    give the exact minimum in one pass, also on features of very unlike size.
    """

    def build(train: DataFrame) -> Estimator:
        stats = train.agg(F.stddev_pop(TARGET).alias("s"), F.count(TARGET).alias("n")).first()
        return LinearRegression(
            featuresCol=VECTOR,
            labelCol=TARGET,
            regParam=alpha * (stats["s"] or 0.0) / max(stats["n"], 1),
            elasticNetParam=0.0,
            standardization=False,
            solver="normal",
        )

    return build


def forest(**settings) -> Learner:
    return lambda train: RandomForestRegressor(
        featuresCol=VECTOR,
        labelCol=TARGET,
        seed=SEED,
        maxMemoryInMB=TREE_MEMORY_MB,
        # Deep trees: remember each row's node instead of walking down again per pass. Of shallow
        # ones the walk is short, and a number per row and tree would be kept twice.
        cacheNodeIds=(settings or SMALL_FOREST).get("maxDepth", 5) > _SHALLOW,
        checkpointInterval=_CHECKPOINT_EVERY,
        **(settings or SMALL_FOREST),
    )


def boosted(**settings) -> Learner:
    return lambda train: GBTRegressor(
        featuresCol=VECTOR,
        labelCol=TARGET,
        seed=SEED,
        maxMemoryInMB=TREE_MEMORY_MB,
        checkpointInterval=_CHECKPOINT_EVERY,
        **(settings or BOOSTED),
    )


class HistogramModel:
    """A histogram model on assembled rows, with what the other models offer."""

    def __init__(self, model: histogram_trees.TreeModel):
        self.model = model

    def transform(self, df: DataFrame) -> DataFrame:
        wide = _unpacked(df, self.model.features)
        return self.model.predict(wide).drop(*self.model.features)

    @property
    def featureImportances(self) -> DenseVector:
        share = dict(self.model.importances())
        return Vectors.dense([share[f] for f in self.model.features])

    @property
    def getNumTrees(self) -> int:
        return len(self.model.trees)


class HistogramLearner:
    def __init__(self, settings: histogram_trees.Settings):
        self.settings = settings

    def fit(self, rows: DataFrame) -> HistogramModel:
        width = rows.schema[VECTOR].metadata["ml_attr"]["num_attrs"]
        names = [f"_h_{i}" for i in range(width)]
        return HistogramModel(histogram_trees.fit(_unpacked(rows, names), names, TARGET, self.settings))


def _unpacked(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The vector's places as columns besides."""
    values = vector_to_array(VECTOR)
    return df.select("*", *[values[i].alias(n) for i, n in enumerate(names)])


def histograms(settings: histogram_trees.Settings) -> Learner:
    return lambda train: HistogramLearner(settings)


def learners() -> dict[str, Learner]:
    """The five compared models."""
    return {
        "LinearRegression": linear(),
        "Ridge": ridge(),
        "RandomForest": histograms(histogram_trees.DEEP_FOREST),
        "GradientBoosting": boosted(**BOOSTED),
        "SampledBoosting": histograms(histogram_trees.SECOND_ORDER),
    }


def assemble(
    df: DataFrame, features: Sequence[str], keep: Iterable[str] = (TARGET,)
) -> DataFrame:
    """Feature columns packed into one vector, next to the columns to keep.

    Without a feature the vector is one constant, so the learners fit what can be learned
    without any: the mean.
    """
    values = [F.col(c).cast("double") for c in features] or [F.lit(0.0)]
    doubles = df.select(*keep, *[v.alias(f"_f_{i}") for i, v in enumerate(values)])
    assembler = VectorAssembler(
        inputCols=[f"_f_{i}" for i in range(len(values))], outputCol=VECTOR
    )
    return assembler.transform(doubles).select(*keep, VECTOR)


def arranged(train: DataFrame) -> DataFrame:
    """Assembled rows in partitions and an order that follow from the rows alone.

    MLlib seeds bagging per partition and draws in row order, so this makes a fitted model
    the same on any number of cores.
    """
    place = F.xxhash64(vector_to_array(VECTOR), TARGET)
    count = train.count()
    each = min(max(_FEWEST_ROWS, -(-count // _USUAL_PARTITIONS)), _MOST_ROWS)
    parts = max(1, -(-count // each))
    return (
        train.withColumn("_place", place)
        .repartition(parts, "_place")
        .sortWithinPartitions("_place", TARGET)
        .drop("_place")
    )


def fit(learner: Learner, train: DataFrame) -> Model:
    """Fit on kept rows, arranged so that the model does not depend on the cluster.

    Every partition sends the split statistics of every tree node, so with deep trees it is
    the number of partitions, not of rows, that fills the shuffle.
    """
    shared_folder(train.sparkSession)
    rows = arranged(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return learner(rows).fit(rows)
    finally:
        rows.unpersist()


def predict(model: Model, df: DataFrame) -> DataFrame:
    return model.transform(df).drop(VECTOR)


def importances(
    df: DataFrame, model: Model, features: Sequence[str], top: int | None = None
) -> DataFrame:
    """Feature and score, the greatest first; the table has one row per feature."""
    scores = [float(x) for x in model.featureImportances.toArray()] if features else []
    table = df.sparkSession.createDataFrame(
        list(zip(features, scores, strict=True)), "feature string, score double"
    ).orderBy(F.col("score").desc(), "feature")
    return table.limit(top) if top else table


def coefficients(df: DataFrame, model: Model, features: Sequence[str]) -> DataFrame:
    """Coefficient per feature and the intercept."""
    values = model.coefficients if features else []
    pairs = [(f, float(c)) for f, c in zip(features, values, strict=True)]
    return df.sparkSession.createDataFrame(
        [*pairs, ("(intercept)", float(model.intercept))], "term string, value double"
    )


def compare(
    train: DataFrame,
    test: DataFrame,
    chosen: dict[str, Learner] | None = None,
) -> tuple[dict[str, Model], DataFrame]:
    """Fit each learner and put its metrics into one table.

    ``train`` and ``test`` are assembled rows. They are read many times, so they are kept, the
    former arranged once for all, while this runs; what does not fit in memory goes to disk.
    The learners are fitted side by side.
    """
    level = StorageLevel.MEMORY_AND_DISK
    shared_folder(train.sparkSession)
    rows, test = arranged(train).persist(level), test.persist(level)
    context = train.sparkSession.sparkContext
    try:
        edges = class_edges(test, TARGET)
        rows.count()

        def one(name: str, learner: Learner) -> tuple[Model, DataFrame]:
            # Where the scheduler is fair, each learner has its share; else they take turns.
            context.setLocalProperty("spark.scheduler.pool", name)
            model = learner(rows).fit(rows)
            row = evaluation_row(name, predict(model, rows), predict(model, test), TARGET, edges=edges)
            return model, cut(row)

        wanted = chosen or learners()
        # Boosting waits for its last tree, which leaves cores to the others.
        with ThreadPoolExecutor(len(wanted)) as pool:
            begun = {n: pool.submit(inheritable_thread_target(train.sparkSession)(one), n, f) for n, f in wanted.items()}
            done = {n: f.result() for n, f in begun.items()}
    finally:
        rows.unpersist()
        test.unpersist()
    return {n: m for n, (m, _) in done.items()}, reduce(DataFrame.unionByName, [r for _, r in done.values()])


def score(
    model: Model,
    df: DataFrame,
    features: Sequence[str],
    key: Sequence[str] = ("Store", "Dept", "Date"),
    name: str = "Predicted_Weekly_Sales",
) -> DataFrame:
    """Key columns and the predicted value; missing feature values count as 0."""
    filled = df.fillna(0, list(features)) if features else df
    rows = assemble(filled, features, keep=key)
    return predict(model, rows).select(*key, F.col("prediction").alias(name))
