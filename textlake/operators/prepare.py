"""From raw labelled rows to usable, unique ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from textlake.functions.text import is_blank
from textlake.operators.ranking import hash_cuts, kth_smallest, seeded_hash
from textlake.specs import DatasetSpec

MIN_ROWS = 20


def canonicalize(df: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """Keep the key, the text and the raw label under fixed names."""
    return df.select("doc_id", F.col(text_col).alias("text"), F.col(label_col).alias("raw_label"))


def mapped_label(raw: Column, label_map: dict) -> Column:
    """Numeric code -> class; anything not in the map, or not a number, is null."""
    codes = F.create_map(*[F.lit(x) for k, v in label_map.items() for x in (float(k), int(v))])
    return F.try_element_at(codes, raw.try_cast("double"))


def map_labels(df: DataFrame, label_map: dict) -> DataFrame:
    return df.withColumn("label", mapped_label(F.col("raw_label"), label_map))


def _usable() -> Column:
    return F.col("label").isNotNull() & F.col("text").isNotNull() & ~is_blank(F.col("text"))


def drop_unusable(df: DataFrame) -> DataFrame:
    return df.where(_usable()).withColumn("label", F.col("label").cast("int"))


def dedup_text(df: DataFrame, keep: Sequence[str] = ("label",)) -> DataFrame:
    """One row per text: the one with the smallest doc_id.

    Copies of a text are merged before the shuffle, so a text that makes up a
    large part of the table sends one row per task. ``keep`` columns of fixed
    width keep the aggregation hash based.
    """
    first = [F.min_by(name, "doc_id").alias(name) for name in keep]
    return df.groupBy("text").agg(F.min("doc_id").alias("doc_id"), *first).select(
        "doc_id", "text", *keep
    )


def sample_frac(df: DataFrame, frac: float | None, seed: int = 42, approx: bool = False) -> DataFrame:
    """round(frac * n) rows without replacement; other fractions keep all rows.

    ``approx`` compares each row's hash with the fraction instead: no counting
    pass, and the size is right on average only.
    """
    if frac is None or not 0 < frac < 1:
        return df
    h = seeded_hash(F.col("doc_id"), seed)
    if approx:
        return df.where(hash_fraction(h) < frac)
    keyed = df.select(F.lit(0).alias("grp"), "doc_id", h.alias("h"))
    wanted = keyed.groupBy("grp").agg(
        F.rint(F.lit(float(frac)) * F.count("*")).cast("long").alias("k")
    ).withColumn("cut", F.lit("sample"))
    return df.where(h <= hash_cuts(keyed, wanted).select("h").scalar())


def hash_fraction(h: Column) -> Column:
    """Hexadecimal hash -> number in [0, 1)."""
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / float(16**12)


def class_balance(df: DataFrame) -> DataFrame:
    counts = df.groupBy("label").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.select("label", F.bround(F.col("n") / total, 3).alias("share"))


def require_min_rows(df: DataFrame, minimum: int = MIN_ROWS) -> DataFrame:
    found = df.limit(minimum).count()
    if found < minimum:
        raise ValueError(
            f"only {found} usable rows, at least {minimum} are needed: check path, encoding, "
            "columns and sample fraction"
        )
    return df


def union_splits(parts: Sequence[DataFrame], keep: Sequence[str] = ("label",)) -> DataFrame:
    return dedup_text(reduce(DataFrame.unionByName, parts), keep)


def limit_docs(df: DataFrame, max_docs: int | None) -> DataFrame:
    """The first ``max_docs`` rows by doc_id; 0 or None keeps all.

    The last id is found on the id column alone and becomes a plain filter, which
    reaches the scan; texts are neither sorted nor gathered.
    """
    if not max_docs:
        return df
    last = kth_smallest(df.select("doc_id"), "doc_id", max_docs)
    return df if last is None else df.where(F.col("doc_id") <= last)


def drop_report(df: DataFrame) -> DataFrame:
    """Rows read, rows usable, rows unique; one shuffle on the text."""
    per_text = df.groupBy(F.when(_usable(), F.col("text")).alias("text")).agg(
        F.count("*").alias("n")
    )
    totals = per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum(F.when(F.col("text").isNotNull(), F.col("n"))), F.lit(0)).alias("usable"),
        F.count("text").alias("unique"),
    )
    return totals.unpivot([], ["raw", "usable", "unique"], "stage", "rows")


def usable_rows(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Raw table with doc_id -> (doc_id, text, label), duplicates still in."""
    canonical = canonicalize(df, spec.text_col, spec.label_col)
    return drop_unusable(map_labels(canonical, spec.label_map)).select("doc_id", "text", "label")
