"""Joins of a large table with a dimension, without trusting it to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAX_BROADCAST_ROWS = 1_000_000


def salted_join(
    large: DataFrame, dim: DataFrame, key: str, spread_by: str, how: str = "inner", salts: int = 32
) -> DataFrame:
    """Equi-join on ``key`` where one key may hold a large share of ``large``.

    Rows of one key go to ``salts`` tasks, chosen by ``spread_by``; the dimension
    is repeated once per salt. Both sides shuffle, nothing is broadcast.
    """
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def small_enough(df: DataFrame) -> int:
    """Rows of ``df``, counted no further than one past the broadcast limit."""
    return df.limit(MAX_BROADCAST_ROWS + 1).count()


def dimension_join(
    large: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    max_rows: int | None = None,
) -> DataFrame:
    """Broadcast ``dim`` when its rows are known to be few, else salt.

    ``max_rows`` states a bound that holds by construction (a limit, a literal
    list, an earlier count). Without one the rows are counted.
    """
    if max_rows is None:
        max_rows = small_enough(dim)
    if max_rows <= MAX_BROADCAST_ROWS:
        return large.join(F.broadcast(dim), key, how)
    return salted_join(large, dim, key, spread_by, how)
