"""Descriptive statistics as tables: quartiles, outliers, histograms, boxes, correlations."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.operators.cleaning import numeric_columns
from salesflow.operators.quantiles import small_side, summary
from salesflow.session import cut

# The fence factor, bin count and grid size of the charts.
FENCE = 1.5
HISTOGRAM_BINS = 50
DENSITY_POINTS = 200
# Bins of the density a bandwidth wide, powers kept of a bin, and bins held against the grid at once.
_BINS_A_WIDTH = 4
_POWERS = 10
_GRID_ROWS = 4096

QUARTILES = {"q1": 0.25, "q3": 0.75}


def _fences(factor: float) -> dict[str, Column]:
    iqr = F.col("q3") - F.col("q1")
    return {
        "iqr": iqr,
        "lower_bound": F.col("q1") - factor * iqr,
        "upper_bound": F.col("q3") + factor * iqr,
    }


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """A narrow frame that several passes read, held while they run."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def iqr_bounds(df: DataFrame, value: str = "Weekly_Sales", factor: float = FENCE) -> DataFrame:
    """Quartiles, fences and the number of rows outside them; one row."""
    with kept(df.select(value)) as values:
        bounds = cut(summary(values, value, QUARTILES, held=True).withColumns(_fences(factor)))
        count = values.agg(F.count_if(_outside(value, bounds)).alias("outlier_count")).scalar()
        return cut(bounds.withColumn("outlier_count", count))


def iqr_outliers(df: DataFrame, value: str = "Weekly_Sales", factor: float = FENCE) -> DataFrame:
    """The rows outside the fences."""
    with kept(df.select(value)) as values:
        bounds = cut(summary(values, value, QUARTILES, held=True).withColumns(_fences(factor)))
    return df.where(_outside(value, bounds))


def _outside(value: str, bounds: DataFrame) -> Column:
    """The one-row bounds enter as scalars, so the filter needs no join."""
    low = bounds.select("lower_bound").scalar()
    high = bounds.select("upper_bound").scalar()
    return (F.col(value) < low) | (F.col(value) > high)


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles and max; one row per numeric column.

    Moments come from one pass over the columns as they are; only the quantiles' value
    counts are shuffled per column.
    """
    columns = list(columns or numeric_columns(df))
    moments = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    numbers = [F.col(c).cast("double") for c in columns]
    clean = [F.when(~F.isnan(n), n).alias(c) for n, c in zip(numbers, columns, strict=True)]
    with kept(df.select(clean)) as narrow:
        wide = narrow.agg(
            *[
                F.struct(F.lit(c).alias("column"), *[f(c).alias(n) for n, f in moments.items()]).alias(c)
                for c in columns
            ]
        )
        rows = cut(wide.select(F.inline(F.array(*columns))))
        quartiles = summary(
            narrow.unpivot([], columns, "column", "value"),
            "value",
            {"p25": 0.25, "p50": 0.5, "p75": 0.75},
            ["column"],
            held=True,
        )
        # A column without any value still has its row.
        found = rows.join(quartiles, ["column"], "left")
        return cut(
            found.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")
        )


def _range(df: DataFrame, value: str) -> DataFrame:
    return cut(
        df.agg(
            F.min(value).cast("double").alias("lo"),
            F.max(value).cast("double").alias("hi"),
            F.count(value).alias("n"),
            F.stddev_samp(value).alias("std"),
        )
    )


def histogram(
    df: DataFrame, value: str = "Weekly_Sales", bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Rows per equal-width bin, numbered from 1; the maximum is in the last bin.

    Bins without rows are kept, with count 0.
    """
    span = _range(df, value)
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    place = F.floor((F.col(value) - lo) / F.nullif((hi - lo) / bins, F.lit(0.0))) + 1
    counts = (
        df.where(F.col(value).isNotNull())
        .select(F.least(F.coalesce(place, F.lit(1)), F.lit(bins)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    edges = span.where("n > 0").select(
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "lo", width.alias("width")
    )
    return edges.join(counts, ["bin"], "left").select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * F.col("width")).alias("bin_start"),
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_end"),
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
    )


def density(
    df: DataFrame,
    value: str = "Weekly_Sales",
    points: int = DENSITY_POINTS,
    bandwidth: float | None = None,
    scale_to_bins: int | None = HISTOGRAM_BINS,
) -> DataFrame:
    """Gaussian kernel density on an even grid from minimum to maximum.

    Rows are added up by bins a quarter of the bandwidth wide, as sums of the powers of their
    distance to the bin's middle; the series of the kernel around the middles gives the curve.
    What the series leaves out is below 1e-12 of a row's own peak, so all rows count at all
    points, but only bins meet the grid. Without ``bandwidth`` it is ``std * n ** -0.2``; where that is zero there is no
    density. With ``scale_to_bins`` the curve is scaled to lie over a histogram of that
    many bins.
    """
    with kept(df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))) as rows:
        span = _range(rows, "v").first()
        if not span["n"]:
            return rows.sparkSession.createDataFrame([], "point int, x double, density double")
        lo, hi, n = span["lo"], span["hi"], span["n"]
        h = bandwidth if bandwidth is not None else (span["std"] or 0.0) * n**-0.2
        grid = lo + np.arange(points) * ((hi - lo) / (points - 1))

        def reduce_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(points)
            for batch in batches:
                for at in range(0, len(batch), _GRID_ROWS):
                    part = batch.slice(at, _GRID_ROWS)
                    middle = lo + (part.column(0).to_numpy() + 0.5) * width
                    # Beyond 40 bandwidths the kernel is zero in double precision.
                    z = np.clip((grid[:, None] - middle[None, :]) / h, -40.0, 40.0)
                    before, now = np.zeros_like(z), np.ones_like(z)
                    series = np.zeros_like(z)
                    for k in range(_POWERS):
                        series += now * (part.column(k + 1).to_numpy() / math.factorial(k))
                        before, now = now, z * now - k * before
                    total += (np.exp(-z * z / 2) * series).sum(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(points, dtype=np.int32)), pa.array(grid), pa.array(total)],
                ["point", "x", "_sum"],
            )

        if not h:
            # One value, or one repeated, has no width.
            flat = [(i, float(x), None) for i, x in enumerate(grid)]
            return rows.sparkSession.createDataFrame(flat, "point int, x double, density double")
        width = h / _BINS_A_WIDTH
        place = F.floor((F.col("v") - lo) / width).alias("bin")
        apart = rows.select(place, "v").select("bin", ((F.col("v") - lo) / h - (F.col("bin") + 0.5) / _BINS_A_WIDTH).alias("d"))
        powers = [reduce(mul, [F.col("d")] * k, F.lit(1.0)) for k in range(_POWERS)]
        bins = apart.groupBy("bin").agg(*[F.sum(p).alias(f"p{k}") for k, p in enumerate(powers)])
        norm = 1.0 / (n * h * math.sqrt(2.0 * math.pi))
        if scale_to_bins:
            norm = norm * n * (hi - lo) / scale_to_bins
        sums = bins.mapInArrow(reduce_batches, "point int, x double, _sum double")
        return cut(
            sums.groupBy("point", "x")
            .agg(F.sum("_sum").alias("_sum"))
            .select("point", "x", (F.col("_sum") * norm).alias("density"))
        )


def box_stats(
    df: DataFrame,
    by: str,
    value: str = "Weekly_Sales",
    factor: float = FENCE,
) -> DataFrame:
    """Per group: quartiles, whiskers (last rows inside the fences) and outlier count."""
    v = F.col(value)
    inside = (v >= F.col("lower_bound")) & (v <= F.col("upper_bound"))
    with kept(df.select(by, value).where(v.isNotNull())) as rows:
        quartiles = summary(rows, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by], held=True)
        bounds = cut(quartiles.withColumns(_fences(factor)))
        fences = small_side(bounds.select(by, "lower_bound", "upper_bound"))
        whiskers = (
            rows.join(fences, [by])
            .groupBy(by)
            .agg(
                F.count(F.lit(1)).alias("row_count"),
                F.min(F.when(inside, v)).alias("whisker_low"),
                F.max(F.when(inside, v)).alias("whisker_high"),
                F.count_if(~inside).alias("outlier_count"),
            )
        )
        return cut(
            bounds.join(whiskers, [by]).select(
                by,
                "row_count",
                "q1",
                "median",
                "q3",
                "whisker_low",
                "whisker_high",
                "outlier_count",
            )
        )


def scatter_points(
    df: DataFrame, x: str, y: str, key: Sequence[str] | None = None, fraction: float = 1.0
) -> DataFrame:
    """Pairs for a scatter chart: all of them, or a sample that is the same on every run."""
    pairs = df if fraction >= 1 else df.where(in_fraction(key or df.columns, fraction))
    return pairs.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *[c for c in (key or []) if c not in (x, y)], x, y
    )


def in_fraction(key: Sequence[str], fraction: float) -> Column:
    """True for about ``fraction`` of the keys, by hash: independent of partitioning."""
    if fraction >= 1:
        return F.lit(True)
    limit = f"{int(fraction * 16**8):08x}"
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    return F.substring(F.md5(text), 1, 8) < limit


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Correlation of every column pair, lower triangle, long form (f1, f2, corr).

    Each pair uses the rows where both values are present; a constant column
    gives null.
    """
    columns = list(columns or numeric_columns(df))
    place = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    return _correlations(df, columns, columns).where(
        place[F.col("f1")] > place[F.col("f2")]
    )


def target_correlations(
    df: DataFrame, target: str = "Weekly_Sales", columns: Sequence[str] | None = None
) -> DataFrame:
    """Correlation of every numeric column with the target (feature, corr)."""
    columns = list(columns or numeric_columns(df, [target]))
    return _correlations(df, columns, [target]).select(F.col("f1").alias("feature"), "corr")


_MOMENTS = ("n", "mx", "my", "cxx", "cyy", "cxy")


def _correlations(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """Correlations of all pairs of ``left`` and ``right`` from one pass over the rows.

    As single aggregates 25 columns are 300 pairs with three moments each, too
    many for one generated function. So each task reduces its Arrow batches to moment
    matrices by a few matrix products, relative to means of its own first batch so that
    sums of squares keep their digits, and emits counts, means and central moments per
    pair. Those of all tasks are combined by the parallel variance formula.
    """
    columns = list(dict.fromkeys([*left, *right]))
    narrow = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    a = [columns.index(c) for c in left]
    b = [columns.index(c) for c in right]

    def reduce_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, len(a), len(b)))
        shift = None
        for batch in batches:
            values = np.column_stack(
                [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            ).astype(float)
            present = ~np.isnan(values)
            if shift is None:
                counts = np.maximum(present.sum(0), 1)
                shift = np.where(present, values, 0.0).sum(0) / counts
            values = np.where(present, values - shift, 0.0)
            there = present.astype(float)
            x, y, in_x, in_y = values[:, a], values[:, b], there[:, a], there[:, b]
            total += (
                in_x.T @ in_y,
                x.T @ in_y,
                in_x.T @ y,
                (x * x).T @ in_y,
                in_x.T @ (y * y),
                x.T @ y,
            )
        if shift is None:
            return
        n, sx, sy, sxx, syy, sxy = total
        rows = np.maximum(n, 1)
        central = (
            n,
            shift[a][:, None] + sx / rows,
            shift[b][None, :] + sy / rows,
            sxx - sx * sx / rows,
            syy - sy * sy / rows,
            sxy - sx * sy / rows,
        )
        f1 = np.repeat(np.array(left, dtype=object), len(b))
        f2 = np.tile(np.array(right, dtype=object), len(a))
        yield pa.RecordBatch.from_arrays(
            [pa.array(f1, pa.string()), pa.array(f2, pa.string()), *[pa.array(m.ravel()) for m in central]],
            names=["f1", "f2", *_MOMENTS],
        )

    schema = "f1 string, f2 string, " + ", ".join(f"{m} double" for m in _MOMENTS)
    parts = narrow.mapInArrow(reduce_batches, schema).where(F.col("n") > 0)
    # One row per task and pair: the means of all rows, then what tasks' means add to the moments.
    pair = Window.partitionBy("f1", "f2")
    n = F.col("n")
    dx = F.col("mx") - F.sum(n * F.col("mx")).over(pair) / F.sum("n").over(pair)
    dy = F.col("my") - F.sum(n * F.col("my")).over(pair) / F.sum("n").over(pair)
    sums = (
        parts.withColumns({"dx": dx, "dy": dy})
        .groupBy("f1", "f2")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("cxx") + n * F.col("dx") ** 2).alias("cxx"),
            F.sum(F.col("cyy") + n * F.col("dy") ** 2).alias("cyy"),
            F.sum(F.col("cxy") + n * F.col("dx") * F.col("dy")).alias("cxy"),
            F.max(F.abs("mx")).alias("ax"),
            F.max(F.abs("my")).alias("ay"),
        )
    )
    # What rounding leaves of a constant column's spread is no spread.
    some = (F.col("cxx") > 1e-24 * F.col("n") * F.col("ax") ** 2) & (
        F.col("cyy") > 1e-24 * F.col("n") * F.col("ay") ** 2
    ) & (F.col("cxx") > 0) & (F.col("cyy") > 0)
    corr = F.when(some, F.col("cxy") / F.sqrt(F.col("cxx") * F.col("cyy")))
    pairs = df.sparkSession.createDataFrame([(x, y) for x in left for y in right], "f1 string, f2 string")
    return pairs.join(sums.select("f1", "f2", corr.alias("corr")), ["f1", "f2"], "left")
