"""One registered query per operator, over its whole table."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm import bit_packing, fingerprints, language_id, lattice, log_bilinear, mixing, ngram_join, packing, phrases, repair, substring, url_filters, warc


def reachable(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies, unless it is installed or shipped."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def crc(id: str = "doc_id") -> Column:
    return F.crc32(F.col(id).cast("string").cast("binary"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(crc() % 3 == 1, F.lit(False))
    model = language_id.fit(docs.where(crc() % 3 != 1))
    answer = language_id.predict(spark, model, F.col("text"))
    return docs.select("doc_id", held_out.alias("held_out"), answer.alias("answer")).select(
        "doc_id",
        "held_out",
        F.col("answer.lang").alias("lang_pred"),
        F.col("answer.score").alias("score"),
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mixing.mixed(docs, keep=("doc_id",)).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(read(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), end_id=1)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages")).drop("url")


def op7_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    number = F.coalesce(crc() % 5, F.lit(0))
    # The other four remainders take turns in the rounds of training.
    scored = log_bilinear.score(
        docs.withColumn("remainder", number).select("doc_id", "text", "remainder"),
        training=F.col("doc_id").isNotNull() & (F.col("remainder") != 1),
        part=F.when(F.col("remainder").isin(0, 2), 0).otherwise(1),
    )
    held_out = F.coalesce(crc() % 5 == 1, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


# The rules of the query.
URL_RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(read(spark, sf_dir, "pages"), URL_RULES).drop("trust", "distrust")


def op9_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = bit_packing.round_trip(
        docs, tokenizer("word_bpe_49k.json"), vocabulary=49_408, end_id=2, drops_space=True
    )
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(read(spark, sf_dir, "embeddings"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = read(spark, sf_dir, "conversations")
    found = repair.repair(repair.damaged(said))
    hashes = repair.digests(found.rows, "conv_id").withColumnRenamed("key", "_key")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    done = found.conversations.withColumnRenamed("conv_id", "_id")
    ids = said.select("conv_id").distinct()
    return (
        ids.join(done, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
        .join(hashes, repair.key("conv_id") == F.col("_key"), "left")
        .select(
            "conv_id",
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring.remove(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_mix_sources": op2_mix_sources,
    "op3_fingerprints": op3_fingerprints,
    "op4_packing": op4_packing,
    "op5_ngram_join": op5_ngram_join,
    "op6_warc": op6_warc,
    "op7_log_bilinear": op7_log_bilinear,
    "op8_url_filters": op8_url_filters,
    "op9_bit_packing": op9_bit_packing,
    "op10_lattice_dedup": op10_lattice_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_collocations": op13_collocations,
}
