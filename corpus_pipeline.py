"""A corpus made ready for training: five stages, each over all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from textlake.llm import byte_bpe, dart_minhash, line_dedup, mixing, passages, toxicity
from textlake.llm.files import materialize
from textlake.llm.queries import toxicity_model

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject, each row by itself."""
    docs = docs.select(*COLUMNS)
    return docs.withColumn("_score", toxicity.score_of(docs, toxicity_model(spark, sf_dir))).filter("_score < 0.5").drop("_score")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates.

    Of rows with one id one stays; rows without an id stay.
    """
    docs = docs.select(*COLUMNS)
    dropped = dart_minhash.near_duplicates(docs).filter("not kept and class_id is not null").select("doc_id").distinct()
    kept = docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)
    if docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        return kept
    return kept.filter("doc_id is not null").dropDuplicates(["doc_id"]).union(kept.filter("doc_id is null"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines and the passages of 50 words or more that an earlier one has."""
    return line_dedup.dedup_lines(docs.select(*COLUMNS), passage_words=passages.LENGTH).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; equal rows share their copies."""
    docs = docs.select(*COLUMNS).withColumn("_hash", F.coalesce(F.xxhash64("text"), F.lit(0)))
    named = docs.withColumn("doc_id", F.struct("doc_id", "_hash"))
    taken = materialize(
        mixing.mix(named).groupBy(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id._hash").alias("_of"))
        .agg(F.sum("copies").cast("int").alias("_copies"), F.count("*").alias("_rows")), "copies")
    if not taken.filter("_rows > 1").isEmpty():
        docs = docs.dropDuplicates(["doc_id", "_hash"])
    wanted = docs.join(taken.filter("_copies > 0"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_of")))
    return wanted.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy, with the digests of ids and decoded bytes."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", clean),
    ("near duplicates", without_near_copies),
    ("repeated lines", without_repeated_lines),
    ("mixing", mixed),
    ("tokens", encoded),
]

#: Neither the classifier nor the Newton iterations can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
