"""Prepared splits as one parquet dataset partitioned by split."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

SPLITS = ("train", "val", "test")


def write_splits(df: DataFrame, path: str) -> None:
    """One folder per split; written where the rows are, without a shuffle."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Rows of one split; only its folder is listed and read."""
    try:
        return spark.read.parquet(f"{path}/split={split}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no split {split!r} under {path}; prepare the data first") from error
