"""Scans and sinks: CSV, Parquet and document collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from salesflow.session import releasing
from salesflow.sources.dumps import scan_dump

# Fixed value: how the files spell a missing value.
NULL_TEXT = "NA"

ORDER = "_order"
BROKEN = "_broken"


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    input_order: bool = False,
    broken_lines: bool = False,
) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, at the price of a pass.

    ``broken_lines`` adds ``_broken``: the whole line where it does not have the schema's number
    of fields (too many, too few, a quote that stays open), else null. It needs a schema.

    ``input_order`` adds ``_order``, which sorts rows as they stand in the files:
    by file, by block within the file, by row within the block.
    """
    reader = spark.read.options(header=True, nullValue=NULL_TEXT)
    if broken_lines:
        schema = StructType([*schema, StructField(BROKEN, StringType())])
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN)
    reader = reader.schema(schema) if schema is not None else reader.options(inferSchema=True)
    df = reader.csv(path)
    if not input_order:
        return df
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", place.alias(ORDER))


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_documents(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "json",
    schema: StructType | None = None,
    **options: str,
) -> DataFrame:
    """A document collection without its ``_id``.

    ``fmt`` is ``json`` for JSON lines and ``bson`` for the files of a collection dump; with a
    connector on the class path it is the connector's format name, and ``options`` hold its
    connection settings.
    """
    if fmt == "bson":
        return scan_dump(spark, path, schema).drop("_id")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return (reader.load(path) if path else reader.load()).drop("_id")


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> str:
    """Parquet, with an optional layout for filters on ``partition_by`` and ``sort_by``.

    Rows of one partition value go to the same tasks, so each value has few
    files. The rebalance hint splits a value that holds too much for one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    with releasing(df.sparkSession):
        df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip") -> str:
    """CSV with a header; nulls are written the way ``scan_csv`` reads them.

    Numbers as text take several times their size, so the files are compressed; ``scan_csv`` sees
    that by their names. A file is read by one task then, and holds what one task wrote.
    """
    options = {"header": True, "nullValue": NULL_TEXT, "compression": compression}
    with releasing(df.sparkSession):
        df.write.mode(mode).options(**options).csv(path)
    return path


def write_documents(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip"
) -> str:
    """JSON lines; fields that are null are left out.

    Every line spells all field names, so the files are compressed; ``scan_documents`` sees that
    by their names. A file is read by one task then, and holds what one task wrote.
    """
    df.write.mode(mode).json(path, compression=compression)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at the path; reads no data."""
    try:
        spark.read.format("text").load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
