"""Inputs of the queries, derived from whole test tables; the SQL twins are in sql.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textlake.functions.text import surface_tokens
from textlake.operators.lexical import with_tokens
from textlake.sources.tables import read_table, spread
from textlake.specs import CleanConfig, DatasetSpec, reviews_config

CFG = reviews_config(lemmatize=False)
RAW_SPEC = DatasetSpec("raw", "text", "raw_label", {1: 0, 2: 0, 4: 1, 5: 1})

# Everything the cleaning steps look for, put around the real text.
NOISY = (
    "concat('@u', doc_id, ' <b>', lang, '</b> ', text, ' isn''t soooo #', lang, "
    "' won''t you''ll John''s http://x.co/', doc_id, ' www.', source, '.org HTTP://UP.x &amp; !!!')"
)
RAW_LABEL = """
    CASE WHEN quality IS NULL THEN CASE WHEN lang = 'fr' THEN 'x' WHEN lang = 'de' THEN NULL ELSE '3' END
         WHEN quality = 1 AND toxic = 1 THEN '4' WHEN quality = 1 THEN '5.0'
         WHEN toxic = 1 THEN '1' ELSE '2' END
"""
RAW_TEXT = (
    "CASE WHEN source = 'src3' THEN concat(chr(160), ' ') WHEN source = 'src5' THEN NULL ELSE text END"
)
SCORE = "round((n_chars % 97) / 96.0D, 2)"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(read_table(spark, sf, "documents"))


def narrow(spark: SparkSession, sf: str) -> DataFrame:
    """Documents for work that does not touch the text."""
    return read_table(spark, sf, "documents")


def noisy(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", F.expr(NOISY).alias("text"))


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "labels")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, text, label) of the documents that have a quality label."""
    wanted = labels(spark, sf).select("doc_id", F.col("quality").alias("label"))
    return documents(spark, sf).select("doc_id", "text").join(wanted, "doc_id")


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with a raw label code; some texts missing or blank."""
    return documents(spark, sf).join(labels(spark, sf), "doc_id", "left").select(
        "doc_id", F.expr(RAW_TEXT).alias("text"), F.expr(RAW_LABEL).alias("raw_label")
    )


def corpus(spark: SparkSession, sf: str, cfg: CleanConfig = CFG) -> DataFrame:
    """(doc_id, tokens) of every document."""
    return with_tokens(documents(spark, sf).select("doc_id", "text"), cfg).select("doc_id", "tokens")


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as a second corpus."""
    return spread(read_table(spark, sf, "conversations")).select("conv_id", "turn", "text")


def turn_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return turns(spark, sf).select(surface_tokens(F.col("text"), CFG).alias("tokens"))


def search_docs(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, text, sentiment); documents without a label count as positive."""
    quality = labels(spark, sf).select("doc_id", "quality")
    return documents(spark, sf).select("doc_id", "text").join(quality, "doc_id", "left").select(
        "doc_id", "text", F.coalesce("quality", F.lit(1)).cast("tinyint").alias("sentiment")
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with a made score that has many ties."""
    wanted = labels(spark, sf).select("doc_id", F.col("quality").alias("label"))
    return (
        narrow(spark, sf).select("doc_id", F.expr(SCORE).alias("score")).join(wanted, "doc_id")
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def run_table(spark: SparkSession, sf: str) -> DataFrame:
    """A runs table: per language and source, two metrics with ties among sources."""
    base = narrow(spark, sf).groupBy("lang", "source").agg(
        F.expr("(sum(n_chars % 10) div count(*)) / 10.0D").alias("f1"),
        F.expr("(sum(n_chars % 70) div count(*)) / 70.0D").alias("roc_auc"),
    )
    return base.select(
        F.lit("r").alias("run_id"),
        F.col("lang").alias("dataset"),
        F.col("source").alias("vectorizer"),
        F.expr("cast(substring(source, 4) AS int)").alias("method_order"),
        F.lit(0).cast("bigint").alias("n_train"),
        F.lit(0).alias("max_features"),
        F.explode(F.array(F.lit("val"), F.lit("test"))).alias("split"),
        "f1",
        "roc_auc",
    ).unpivot(
        ["run_id", "dataset", "vectorizer", "method_order", "n_train", "max_features", "split"],
        ["f1", "roc_auc"], "metric", "value",
    )
