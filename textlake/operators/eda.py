"""Exploratory tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textlake.functions.text import NEGATIONS, NON_SPACE, surface_text
from textlake.specs import CleanConfig


def label_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count("*").alias("n")).orderBy("label")


def word_count(text: Column) -> Column:
    """Runs of non-space characters."""
    return F.regexp_count(text, F.lit(f"{NON_SPACE}+"))


def word_counts(df: DataFrame) -> DataFrame:
    return df.select("doc_id", word_count(F.col("text")).alias("words"))


def median_words(df: DataFrame) -> DataFrame:
    """Median word count; documents of one length are counted together first."""
    lengths = df.groupBy(word_count(F.col("text")).alias("words")).agg(F.count("*").alias("n"))
    return lengths.agg(F.percentile("words", 0.5, F.col("n")).alias("median_words"))


def clipped_histogram(df: DataFrame, column: str, upper: float, bins: int) -> DataFrame:
    """(bin, lo, hi, n) with equal widths over [min, max] after clipping above."""
    values = df.select(F.least(F.col(column).cast("double"), F.lit(float(upper))).alias("v"))
    counts = values.groupBy("v").agg(F.count("*").alias("n"))
    ends = counts.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("e")).scalar()
    # A single value still gets a width of one, half on each side.
    pad = F.when(F.col("e.lo") == F.col("e.hi"), 0.5).otherwise(0.0)
    lo, hi = F.col("e.lo") - pad, F.col("e.hi") + pad
    slot = F.least(F.floor((F.col("v") - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    filled = counts.withColumn("e", ends).groupBy(slot.alias("bin")).agg(F.sum("n").alias("n"))
    return (
        df.sparkSession.range(bins)
        .select(F.col("id").cast("int").alias("bin"), ends.alias("e"))
        .join(filled, "bin", "left")
        .select(
            "bin",
            (lo + (hi - lo) * F.col("bin") / bins).alias("lo"),
            (lo + (hi - lo) * (F.col("bin") + 1) / bins).alias("hi"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def peek(df: DataFrame, n: int = 3, width: int = 200) -> DataFrame:
    """The first rows, texts cut for display."""
    return df.orderBy("doc_id").limit(n).select("doc_id", F.substring("text", 1, width).alias("text"))


def compare_cleaning(df: DataFrame, configs: dict[str, CleanConfig]) -> DataFrame:
    """Raw text beside the output of each config (surface forms)."""
    return df.select(
        "doc_id",
        "text",
        *[surface_text(F.col("text"), cfg).alias(name) for name, cfg in configs.items()],
    )


def vocab_contrast(a: DataFrame, b: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Vocabulary sizes of two corpora, shared terms, and the share of each side's
    terms the other lacks. Both sides meet in one grouping by term."""

    def terms(df: DataFrame, side: str) -> DataFrame:
        return (
            df.select(F.explode_outer(F.array_distinct(tokens)).alias("term"))
            .where(F.col("term").isNotNull())
            .withColumn("in_a", F.lit(side == "a"))
        )

    per_term = terms(a, "a").unionByName(terms(b, "b")).groupBy("term").agg(
        F.bool_or("in_a").alias("in_a"), F.bool_or(~F.col("in_a")).alias("in_b")
    )
    sizes = per_term.agg(
        F.count_if("in_a").alias("vocab_a"),
        F.count_if("in_b").alias("vocab_b"),
        F.count_if(F.col("in_a") & F.col("in_b")).alias("shared"),
    )
    return sizes.withColumns(
        {
            "oov_a_in_b": F.try_divide(F.col("vocab_a") - F.col("shared"), F.col("vocab_a")),
            "oov_b_in_a": F.try_divide(F.col("vocab_b") - F.col("shared"), F.col("vocab_b")),
        }
    )


def error_cases(scored: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Misclassified documents with a flag for a negation among their tokens."""
    return scored.where(F.col("predicted") != F.col("label")).select(
        "doc_id",
        "label",
        "predicted",
        F.arrays_overlap(tokens, F.array(*map(F.lit, NEGATIONS))).alias("has_negation"),
    )


def error_summary(scored: DataFrame, tokens: str = "tokens") -> DataFrame:
    return error_cases(scored, tokens).groupBy("label", "predicted", "has_negation").agg(
        F.count("*").alias("n")
    )
