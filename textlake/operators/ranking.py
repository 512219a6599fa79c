"""Ranks, cuts and running totals that never put a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from textlake.session import materialize

HASH_BUCKETS = 16**4


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, spread_by: str, fan: int = 32
) -> DataFrame:
    """The best ``k`` rows of each group with their ``rank``.

    Two ranked cuts: first within ``fan`` slices of a group, then over the
    survivors, so the last task of a group sees at most ``fan * k`` rows.
    """
    slice_ = F.pmod(F.xxhash64(spread_by), F.lit(fan))
    sliced = Window.partitionBy(*group, "_slice").orderBy(*order)
    whole = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_slice", slice_)
        .withColumn("_r", F.row_number().over(sliced))
        .where(F.col("_r") <= k)
        .drop("_slice", "_r")
        .withColumn("rank", F.row_number().over(whole))
        .where(F.col("rank") <= k)
    )


def seeded_hash(key: Column, seed: int) -> Column:
    """A stable pseudo-random order: md5 of seed and key, as hexadecimal text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_cuts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The hash of the ``k``-th smallest row of each group.

    ``keyed`` has (grp, doc_id, h), ``wanted`` has (grp, cut, k); the result is
    (grp, cut, h). Rows are counted per hash prefix, the counts locate the prefix
    that holds the k-th row, and only rows of that prefix are ranked. Callers
    then compare each row's hash with the cut, which moves no rows.
    """
    keyed = keyed.withColumn("bucket", F.conv(F.substring("h", 1, 4), 16, 10).cast("int"))
    upto = Window.partitionBy("grp").orderBy("bucket")
    histogram = (
        keyed.groupBy("grp", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(upto))  # at most HASH_BUCKETS rows a group
    )
    edges = (
        histogram.join(wanted, "grp")
        .where((F.col("k") <= F.col("upto")) & (F.col("k") > F.col("upto") - F.col("n")))
        .select("grp", "cut", "bucket", (F.col("k") - F.col("upto") + F.col("n")).alias("nth"))
    )
    inside = Window.partitionBy("grp", "cut", "bucket").orderBy("h", "doc_id")
    return (
        keyed.join(F.broadcast(edges), ["grp", "bucket"])  # one row per group and cut
        .withColumn("r", F.row_number().over(inside))
        .where(F.col("r") == F.col("nth"))
        .select("grp", "cut", "h")
    )


def running_totals(
    df: DataFrame, order: str, totals: dict[str, str], partitions: int | None = None
) -> DataFrame:
    """Add columns holding the sum of a column over all rows ordered before.

    ``totals`` maps new column -> summed column; ``order`` must be unique. Rows
    are range partitioned and written once, each range is summed, and the few
    range sums become the starting offsets, so no task orders all rows.
    """
    ranged = materialize(
        (df.repartitionByRange(partitions, order) if partitions else df.repartitionByRange(order))
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_{c}") for c in set(totals.values())])
    offsets = sums.select(
        "_range",
        *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_off_{n}") for n, c in totals.items()],
    )
    within = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(F.broadcast(offsets), "_range")  # one row per range
        .select(
            *df.columns,
            *[
                (F.coalesce(F.sum(c).over(within), F.lit(0)) + F.col(f"_off_{n}")).alias(n)
                for n, c in totals.items()
            ],
        )
    )


def kth_smallest(df: DataFrame, key: str, k: int, small: int = 200_000, fan: int = 1024) -> int | None:
    """The k-th smallest value of a unique integer column, exactly.

    Counts per equal-width interval locate the interval of the answer, which is
    then divided again until few rows are left. Each pass reads one column and
    returns at most ``fan`` counts. None when there are fewer than k rows.
    """
    low, high, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if k > n or k < 1:
        return None
    while n > small and high > low:
        width = (high - low) // fan + 1
        slot = F.expr(f"({key} - {low}) div {width}")
        counts = (
            df.where(F.col(key).between(low, high)).groupBy(slot.alias("slot"))
            .agg(F.count("*").alias("n")).orderBy("slot").collect()
        )
        for row in counts:
            if k <= row.n:
                low, n = low + row.slot * width, row.n
                high = min(high, low + width - 1)
                break
            k -= row.n
    rows = df.where(F.col(key).between(low, high)).select(key).orderBy(key).limit(k)
    return rows.agg(F.max(key)).first()[0]
