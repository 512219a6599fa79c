"""Table of training runs, one row per metric."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RUNS_SCHEMA = (
    "run_id string, dataset string, vectorizer string, method_order int, n_train bigint, "
    "max_features int, split string, metric string, value double"
)


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(path)
