"""Parquet tables and input parallelism."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use every core when the input arrives in fewer pieces than there are cores.

    A small file with one row group is one task; text work on it would leave the
    other cores idle. A large scan already has enough partitions and is returned
    as it is, so no shuffle is added there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
