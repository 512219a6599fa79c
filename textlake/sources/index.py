"""A search index on disk: parquet tables plus one row of settings."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from textlake.operators.search import SearchIndex, bucket_of
from textlake.specs import CleanConfig

SETTINGS_SCHEMA = (
    "n_docs bigint, avgdl double, cfg string, term_buckets int, doc_buckets int, lemmas boolean"
)


def _write_bucketed(df: DataFrame, key: str, bucket: str, buckets: int, path: str) -> None:
    """Folders by hash of the key, files sorted by it. Rebalancing splits a bucket
    that a frequent key has made large and merges small ones."""
    (
        df.withColumn(bucket, bucket_of(F.col(key), buckets))
        .hint("rebalance", bucket)
        .sortWithinPartitions(bucket, key)
        .write.mode("overwrite")
        .partitionBy(bucket)
        .parquet(path)
    )


def default_buckets(n_docs: int) -> int:
    """More folders for larger corpora: enough to prune by, few enough to list."""
    return max(4, min(4096, n_docs // 100_000))


def write_index(
    index: SearchIndex, path: str, term_buckets: int | None = None, doc_buckets: int | None = None
) -> None:
    term_buckets = term_buckets or default_buckets(index.n_docs)
    doc_buckets = doc_buckets or default_buckets(index.n_docs)
    _write_bucketed(index.postings, "term", "term_bucket", term_buckets, f"{path}/postings")
    _write_bucketed(index.docs, "doc_id", "doc_bucket", doc_buckets, f"{path}/docs")
    index.terms.write.mode("overwrite").parquet(f"{path}/terms")
    if index.lemmas is not None:
        index.lemmas.write.mode("overwrite").parquet(f"{path}/lemmas")
    settings = (
        index.n_docs, index.avgdl, index.cfg.to_json(), term_buckets, doc_buckets,
        index.lemmas is not None,
    )
    index.docs.sparkSession.createDataFrame([settings], SETTINGS_SCHEMA).write.mode(
        "overwrite"
    ).parquet(f"{path}/settings")


def read_index(spark: SparkSession, path: str) -> SearchIndex:
    try:
        row = spark.read.schema(SETTINGS_SCHEMA).parquet(f"{path}/settings").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no search index at {path}") from error
    read = spark.read.parquet
    return SearchIndex(
        read(f"{path}/postings"), read(f"{path}/docs"), read(f"{path}/terms"), row.n_docs,
        row.avgdl, CleanConfig.from_json(row.cfg),
        read(f"{path}/lemmas") if row.lemmas else None, row.term_buckets, row.doc_buckets,
    )
