"""Shared scratch folder and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may run without that setting: there one machine holds
    driver and executors, so a temporary folder is as good.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    chosen = tempfile.mkdtemp(prefix="textlake-")
    spark.conf.set(CHECKPOINT_CONF, chosen)
    return chosen


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/textlake/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table", by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on the plan that produced it: losing an
    executor costs a re-read, not a recomputation, and several consumers share
    one evaluation. A written table keeps column statistics and pruning, which a
    row checkpoint does not. With ``by``, the last column, each of its values has a folder of its own.
    """
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def locate(url: str) -> tuple[fs.FileSystem, str]:
    local = re.match(r"file:/+(.*)", url)
    if local or "://" not in url:
        return fs.LocalFileSystem(), "/" + local[1] if local else url
    return fs.FileSystem.from_uri(url)


def open_file(url: str):
    """A file of the shared folder, opened inside a task."""
    system, path = locate(url)
    return system.open_input_file(path)


def remove(urls: list[str]) -> None:
    """Delete files of the shared folder that no later step reads."""
    for url in urls:
        system, path = locate(url)
        system.delete_file(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query go as soon as it has ended, for a query that ends in ``materialize``."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP_CONF) if before is None else spark.conf.set(SHUFFLE_CLEANUP_CONF, before)
