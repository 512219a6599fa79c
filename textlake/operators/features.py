"""Bag of words, TF-IDF and BM25 features in long form.

One row per document and term: (doc_id, term, term_idx, weight). Documents
without a term in the vocabulary have no rows here; they count in ``n_docs``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from textlake.functions.arrays import let, ngram_array
from textlake.functions.grams import gram_counts, gram_totals, row_lengths, slices
from textlake.functions.text import analyze
from textlake.operators.joins import dimension_join
from textlake.operators.ranking import running_totals
from textlake.session import materialize

METHODS = ("bow", "tfidf", "bm25")
MAX_FEATURES = 50_000
CF_STEPS = 32  # steps per doubling in the histogram of corpus counts


def feature_tokens(tokens: Column, letters_only: bool = True) -> Column:
    """Tokens as the feature analyser sees them: two word characters or more.

    Tokens of plain letters only need the length test; others are joined and cut
    again, because an apostrophe ends a feature token.
    """

    def long_enough(ts: Column) -> Column:
        return F.filter(ts, lambda t: F.length(t) >= 2)

    if letters_only:
        return long_enough(tokens)
    # Most rows hold the letters a to z alone, which the analyser would return as they are.
    plain = lambda ts: ~F.array_join(ts, "").rlike("[^a-z]")
    return let(tokens, lambda ts: F.when(plain(ts), long_enough(ts)).otherwise(analyze(F.array_join(ts, " "))))


def ngrams(df: DataFrame, lo: int = 1, hi: int = 2, tokens: str = "tokens") -> DataFrame:
    """(doc_id, ngrams)."""
    return df.select("doc_id", ngram_array(F.col(tokens), lo, hi).alias("ngrams"))


def term_counts(df: DataFrame, lo: int = 1, hi: int = 2, tokens: str = "tokens") -> DataFrame:
    """(doc_id, term, tf), counted inside each row: no shuffle."""
    runs = gram_counts(F.col(tokens), lo, hi)
    # The outer form keeps Spark from testing the array's size below the
    # projection, which would run the whole text chain a second time.
    return df.select("doc_id", F.inline_outer(runs)).where(F.col("term").isNotNull())


def by_document(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Place documents by id once, while they are still compact token lists, so that
    the per-document sums of the weighting need no shuffle of exploded rows."""
    return df.select("doc_id", tokens).repartition("doc_id")


def fit_vocabulary(
    counts: DataFrame, min_df: int = 2, max_features: int | None = MAX_FEATURES
) -> DataFrame:
    """(term, term_idx, df, cf): the most frequent terms, numbered alphabetically.

    A histogram of corpus counts finds how rare a term may be; only terms at
    least that frequent are ordered. Equal counts are taken alphabetically.
    """
    totals = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
    return _numbered(totals, min_df, max_features)


def learn_vocabulary(
    df: DataFrame, lo: int = 1, hi: int = 2, min_df: int = 2,
    max_features: int | None = MAX_FEATURES, tokens: str = "tokens",
) -> DataFrame:
    """The same from token lists; rows are counted together before they leave a task."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            for at, end in slices(row_lengths(lists)):
                yield gram_totals(lists.slice(at, end - at), lo, hi)

    parts = df.select(tokens).mapInArrow(totals, "term string, df long, cf long")
    terms = parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    return _numbered(terms, min_df, max_features)


def _numbered(totals: DataFrame, min_df: int, max_features: int | None) -> DataFrame:
    # Written once: both the histogram (or the ranges) and the choice of terms read them.
    terms = materialize(totals.where(F.col("df") >= min_df), "term-totals")
    if max_features is None:
        numbered = running_totals(terms.withColumn("one", F.lit(1)), "term", {"term_idx": "one"})
        return numbered.select("term", F.col("term_idx").cast("int"), "df", "cf")
    step = F.floor(F.log2("cf") * CF_STEPS)
    above = Window.orderBy(F.col("step").desc())
    floor_step = (
        terms.groupBy(step.alias("step"))
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(above))
        .where(F.col("upto") >= max_features)
        .agg(F.max("step").alias("step"))
        .scalar()
    )
    kept = (
        terms.where(step >= F.coalesce(floor_step, F.lit(-1)))
        .orderBy(F.col("cf").desc(), "term")
        .limit(max_features)
    )
    place = F.row_number().over(Window.orderBy("term")) - 1  # at most max_features rows
    return kept.select("term", place.alias("term_idx"), "df", "cf")


def document_count(docs: DataFrame) -> Column:
    """Number of documents as a scalar subquery."""
    return docs.agg(F.count("*").alias("n")).scalar()


def average_length(vocab: DataFrame, n_docs: Column) -> Column:
    """Mean in-vocabulary count per document: the corpus counts already hold the sum."""
    return vocab.agg(F.coalesce(F.sum("cf"), F.lit(0)).alias("cf")).scalar() / n_docs


def tfidf_idf(df: Column, n_docs: Column) -> Column:
    return F.log((n_docs + 1.0) / (df + 1.0)) + 1.0


def bm25_idf(df: Column, n_docs: Column) -> Column:
    return F.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))


def with_idf(vocab: DataFrame, method: str, n_docs: Column) -> DataFrame:
    rule = {"tfidf": tfidf_idf, "bm25": bm25_idf}[method]
    return vocab.withColumn("idf", rule(F.col("df"), n_docs))


def bow(counts: DataFrame, vocab: DataFrame, max_rows: int | None = MAX_FEATURES) -> DataFrame:
    """(doc_id, term, term_idx, tf) of the terms in the vocabulary.

    ``max_rows`` is the bound the vocabulary was built with; None has it counted.
    """
    terms = vocab.select("term", "term_idx", *[c for c in ("idf",) if c in vocab.columns])
    return dimension_join(counts, terms, "term", "doc_id", max_rows=max_rows)


def per_document(value: Column) -> Column:
    """Sum over the rows of one doc_id."""
    return F.sum(value).over(Window.partitionBy("doc_id"))


def _unit_rows(raw: DataFrame) -> DataFrame:
    norm = F.sqrt(per_document(F.col("raw") * F.col("raw")))
    weight = F.when(norm > 0, F.col("raw") / norm).otherwise(F.col("raw"))
    return raw.select("doc_id", "term", "term_idx", weight.alias("weight"))


def tfidf(
    counts: DataFrame, vocab: DataFrame, n_docs: Column, max_rows: int | None = MAX_FEATURES
) -> DataFrame:
    """(1 + ln tf) * idf, each document scaled to unit length."""
    rows = bow(counts, with_idf(vocab, "tfidf", n_docs), max_rows)
    return _unit_rows(rows.withColumn("raw", (1.0 + F.log("tf")) * F.col("idf")))


def bm25(
    counts: DataFrame,
    vocab: DataFrame,
    n_docs: Column,
    avgdl: Column | None = None,
    k1: float = 1.5,
    b: float = 0.75,
    max_rows: int | None = MAX_FEATURES,
) -> DataFrame:
    """BM25 weight of each term, each document scaled to unit length."""
    avgdl = average_length(vocab, n_docs) if avgdl is None else avgdl
    rows = bow(counts, with_idf(vocab, "bm25", n_docs), max_rows).withColumn(
        "dl", per_document(F.col("tf"))
    )
    pull = k1 * (1.0 - b + b * (F.col("dl") / (avgdl + 1e-9)))
    raw = F.col("idf") * (F.col("tf") * (k1 + 1.0) / (F.col("tf") + pull))
    return _unit_rows(rows.withColumn("raw", raw))


def feature_names(vocab: DataFrame) -> DataFrame:
    return vocab.select("term_idx", "term").orderBy("term_idx")

