"""The training data pipeline: language, near duplicates, source mix, packing.

``run`` applies the stages to ``documents``; each stage's rows are written as Parquet in
the shared folder and read again as the next one's documents. Rows repeated in full, nulls
in any column, empty and very long texts and empty tables are handled as the stages state.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from salesflow.llm import language_id, mixing, ngram_join, packing  # noqa: E402
from salesflow.llm.queries import reachable, tokenizer  # noqa: E402
from salesflow.session import cut, scratch_path  # noqa: E402

_OWN = "_pipeline_"


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those without a letter, null text included, go.

    The model learns from the labelled documents of its own input. Without any label there
    is nothing to tell languages by, and only documents without a letter go.
    """
    reachable(spark)
    model = language_id.fit(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    answer = language_id.predict(spark, model, F.col("text"))
    known = docs.withColumn(f"{_OWN}answer", answer)
    return known.where(F.col(f"{_OWN}answer.lang") != language_id.UNKNOWN).select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, null last.

    Rows are told apart by id and text, so those with a null or shared id are compared like
    all others. Documents without words are in no group and stay. Of rows that repeat both id
    and text, one stays.
    """
    reachable(spark)
    key, id = f"{_OWN}key", f"{_OWN}id"
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    classes = ngram_join.join(keyed, id=key).select(key, "class_id")
    # Of rows in a class the least is found by partial minima, so a large class is no large group.
    least = F.min(F.struct(F.col(id).isNull().alias("none"), id, key)).alias("least")
    ids = keyed.select(key, F.col("doc_id").alias(id))
    leaders = cut(classes.join(ids, key).groupBy("class_id").agg(least).select(f"least.{key}"))
    # Rows of one key have the same id and text; the first by the remaining columns stays.
    rest = [F.col(c).asc_nulls_last() for c in docs.columns if c not in ("doc_id", "text")]
    order = Window.partitionBy(key).orderBy(F.col("text").asc_nulls_last(), *rest)
    return (
        keyed.join(leaders, key, "left_semi")
        .withColumn(f"{_OWN}row", F.row_number().over(order))
        .where(F.col(f"{_OWN}row") == 1)
        .select(*docs.columns)
    )


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the mix of sources, each as often as the mix takes it."""
    return mixing.emit(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens, each document followed by id 1."""
    reachable(spark)
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("language_id", languages),
    ("ngram_join", deduplicated),
    ("mix_sources", mixed),
    ("packing", packed),
]

#: Tokens of a tokenizer's file cannot be made in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
