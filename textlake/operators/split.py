"""Reproducible stratified train / val / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from textlake.operators.prepare import hash_fraction
from textlake.operators.ranking import hash_cuts, seeded_hash


def _kept(count: Column, total: Column, draws: Column) -> Column:
    """Largest-remainder share of ``draws`` for each class (a window over classes)."""
    ideal = count / total * draws
    base = F.floor(ideal)
    missing = draws - F.sum(base).over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy((ideal - base).desc(), "label"))
    return (base + F.when(place <= missing, 1).otherwise(0)).cast("long")


def split_sizes(
    df: DataFrame, test: float = 0.1, val: float = 0.1, classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """Rows per class and split: (label, n, test_n, val_n).

    Test takes ceil(test * n) rows, then val takes ceil(val / (1 - test) * rest);
    what stays behind is shared among the classes by largest remainder.
    """
    everything = Window.partitionBy()
    counts = df.where(F.col("label").isin(*classes)).groupBy("label").agg(F.count("*").alias("n"))
    first = (
        counts.withColumn("total", F.sum("n").over(everything))
        .withColumn("rest", F.col("total") - F.ceil(F.lit(float(test)) * F.col("total")))
        .withColumn("rest_n", _kept(F.col("n"), F.col("total"), F.col("rest")))
    )
    share = float(val) / (1.0 - float(test))
    second = first.withColumn(
        "train", F.col("rest") - F.ceil(F.lit(share) * F.col("rest"))
    ).withColumn("train_n", _kept(F.col("rest_n"), F.col("rest"), F.col("train")))
    return second.select(
        "label",
        "n",
        (F.col("n") - F.col("rest_n")).alias("test_n"),
        (F.col("rest_n") - F.col("train_n")).alias("val_n"),
    )


def stratified_split(
    df: DataFrame,
    test: float = 0.1,
    val: float = 0.1,
    seed: int = 42,
    mode: str = "exact",
    classes: Sequence[int] = (0, 1),
) -> DataFrame:
    """Add ``split``.

    'hash' puts each row by its own hash: no pass over the table, stable as it
    grows, sizes right on average. 'exact' gives the sizes of ``split_sizes``:
    two counting passes over (doc_id, label), then the same row-wise comparison.
    """
    h = seeded_hash(F.col("doc_id"), seed)
    if mode == "hash":
        u = hash_fraction(h)
        split = F.when(u < test, "test").when(u < test + val, "val").otherwise("train")
        return df.withColumn("split", split)
    if mode != "exact":
        raise ValueError(f"unknown mode {mode!r}; use exact or hash")

    sizes = split_sizes(df, test, val, classes)
    wanted = sizes.select(
        F.col("label").alias("grp"),
        F.col("test_n").alias("test"),
        (F.col("test_n") + F.col("val_n")).alias("val"),
    ).unpivot("grp", ["test", "val"], "cut", "k")
    keyed = df.where(F.col("label").isin(*classes)).select(
        F.col("label").alias("grp"), "doc_id", h.alias("h")
    )
    cuts = (
        hash_cuts(keyed, wanted)
        .groupBy(F.col("grp").alias("label"))
        .agg(
            F.max(F.when(F.col("cut") == "test", F.col("h"))).alias("_test"),
            F.max(F.when(F.col("cut") == "val", F.col("h"))).alias("_val"),
        )
    )
    split = F.when(h <= F.col("_test"), "test").when(h <= F.col("_val"), "val").otherwise("train")
    return (
        df.join(F.broadcast(cuts), "label", "left")  # one row per class in ``classes``
        .withColumn("split", split)
        .select(*df.columns, "split")
    )
