"""BM25 retrieval over a postings table.

A search is an equi-join of postings with query terms, a grouped sum and a top-k.
Postings carry document length and sentiment, so scoring and filtering read no
other table; texts are fetched for the final hits only.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from textlake.functions.arrays import run_lengths
from textlake.operators import joins
from textlake.operators.lexical import corpus_terms, noun_lemmas, with_tokens
from textlake.operators.ranking import top_per_group
from textlake.session import materialize
from textlake.specs import CleanConfig

K1, B, EPSILON = 1.5, 0.75, 0.25
HITS_SCHEMA = "query_id bigint, rank int, doc_id bigint, score double, text string, sentiment tinyint"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def tokenized(docs: DataFrame, cfg: CleanConfig, lemmas: DataFrame | None = None) -> DataFrame:
    """(doc_id, text, sentiment) -> with tokens and document length."""
    return with_tokens(docs, cfg, lemmas=lemmas).withColumn("dl", F.size("tokens"))


def postings_of(docs: DataFrame) -> DataFrame:
    """Tokenized documents -> (term, doc_id, tf, dl, sentiment), without a shuffle."""
    return docs.select(
        "doc_id", "dl", "sentiment", F.inline_outer(run_lengths(F.col("tokens")))
    ).where(F.col("term").isNotNull()).select("term", "doc_id", "tf", "dl", "sentiment")


def build_postings(
    docs: DataFrame, cfg: CleanConfig, lemmas: DataFrame | None = None
) -> DataFrame:
    return postings_of(tokenized(docs, cfg, lemmas))


def okapi_idf(postings: DataFrame, n_docs: Column, eps: float = EPSILON) -> DataFrame:
    """(term, df, idf); a negative idf becomes ``eps`` times the mean raw idf."""
    raw = F.log(n_docs - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    terms = postings.groupBy("term").agg(F.count("*").alias("df")).withColumn("raw", raw)
    mean = terms.agg(F.avg("raw").alias("mean")).scalar()
    return terms.select(
        "term", "df", F.when(F.col("raw") < 0, eps * mean).otherwise(F.col("raw")).alias("idf")
    )


@dataclass(frozen=True)
class SearchIndex:
    """Tables of an index and the numbers and switches they were built with.

    ``postings`` (term, doc_id, tf, dl, sentiment), ``docs`` (doc_id, text,
    sentiment), ``terms`` (term, df, idf), ``lemmas`` (term, lemma) or None. A
    stored index also has term_bucket and doc_bucket columns to prune by.
    """

    postings: DataFrame
    docs: DataFrame
    terms: DataFrame
    n_docs: int
    avgdl: float
    cfg: CleanConfig
    lemmas: DataFrame | None = None
    term_buckets: int = 0
    doc_buckets: int = 0


def build_search_index(
    docs: DataFrame, cfg: CleanConfig, lexicon: DataFrame | None = None
) -> SearchIndex:
    """Index (doc_id, text, sentiment); tokens are worked out once and kept."""
    docs = docs.select("doc_id", "text", F.col("sentiment").cast("tinyint").alias("sentiment"))
    lemmas = None
    if cfg.reduction == "lemma":
        surface = replace(cfg, lemmatize=False)
        terms = materialize(corpus_terms(with_tokens(docs, surface)), "terms")
        words = terms.select(F.col("term").alias("lemma")) if lexicon is None else lexicon
        lemmas = materialize(noun_lemmas(terms, words), "lemmas")
    rows = materialize(tokenized(docs, cfg, lemmas).drop("text"), "tokens")
    n_docs, avgdl = rows.agg(F.count("*"), F.avg("dl")).first()
    postings = postings_of(rows)
    terms = materialize(okapi_idf(postings, F.lit(n_docs)), "term-idf")
    return SearchIndex(postings, docs, terms, n_docs, avgdl or 0.0, cfg, lemmas)


def query_terms(
    queries: DataFrame, cfg: CleanConfig, lemmas: DataFrame | None = None
) -> DataFrame:
    """(query_id, text) -> (query_id, term, qtf)."""
    rows = with_tokens(queries.select("query_id", "text"), cfg, lemmas=lemmas)
    return rows.select("query_id", F.inline_outer(run_lengths(F.col("tokens")))).where(
        F.col("term").isNotNull()
    ).withColumnRenamed("tf", "qtf")


def bm25_scores(
    wanted: DataFrame,
    postings: DataFrame,
    terms: DataFrame,
    avgdl: Column,
    k1: float = K1,
    b: float = B,
    max_rows: int | None = None,
) -> DataFrame:
    """(query_id, doc_id, score, sentiment): sum over query tokens, repeats count.

    ``wanted`` has (query_id, term, qtf). The term table is cut to the query terms
    first, then the postings; ``max_rows`` bounds ``wanted`` if known.
    """
    if max_rows is None:
        max_rows = joins.small_enough(wanted)
    idf = terms.select("term", "idf")
    if max_rows <= joins.MAX_BROADCAST_ROWS:
        weighted = idf.join(F.broadcast(wanted), "term")
    else:
        asked = idf.join(wanted.select("term").distinct(), "term", "left_semi")
        weighted = joins.dimension_join(wanted, asked, "term", "query_id")
    # A term has one idf, so ``weighted`` has no more rows than ``wanted``.
    rows = joins.dimension_join(postings, weighted, "term", "doc_id", max_rows=max_rows)
    pull = k1 * (1.0 - b + b * F.col("dl") / avgdl)
    gain = F.col("qtf") * F.col("idf") * (F.col("tf") * (k1 + 1.0) / (F.col("tf") + pull))
    return rows.groupBy("query_id", "doc_id").agg(
        # Rounding makes the order independent of the order of summation.
        F.round(F.sum(gain), 9).alias("score"),
        F.max("sentiment").alias("sentiment"),
    )


def _best() -> tuple[Column, Column]:
    return F.col("score").desc(), F.col("doc_id")


def rank_hits(
    scores: DataFrame, requests: DataFrame, candidate_pool: int = 1000, prefilter: bool = False
) -> DataFrame:
    """(query_id, rank, doc_id, score, sentiment): pool, filter by sentiment, cut.

    ``requests`` has (query_id, top_k, want). The pool is cut before the sentiment
    filter, so a rare class may leave fewer than top_k hits; ``prefilter`` filters
    first and fills them.
    """
    asked = F.col("want").isNull() | (F.col("want") == F.col("sentiment"))
    scores = scores.where(F.col("score") > 0)
    if prefilter:
        scores = joins.dimension_join(scores, requests, "query_id", "doc_id").where(asked)
        scores = scores.drop("top_k", "want")
    pool = top_per_group(scores, ["query_id"], _best(), candidate_pool, "doc_id").drop("rank")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(*_best()))
    return (
        pool.join(requests, "query_id")
        .where(asked)
        .withColumn("rank", place)
        .where(F.col("rank") <= F.col("top_k"))
        .select("query_id", "rank", "doc_id", "score", "sentiment")
    )


def with_texts(hits: DataFrame, index: SearchIndex, max_rows: int | None = None) -> DataFrame:
    """Fetch texts of the hits; a stored index reads only the buckets they lie in.

    Few hits are broadcast to the texts. Many are cut to distinct documents first,
    and the join that repeats a text per query is salted, because one document may
    answer a large share of the queries.
    """
    keys = ["doc_id"]
    if index.doc_buckets:
        keys = ["doc_bucket", "doc_id"]
        hits = hits.withColumn("doc_bucket", bucket_of(F.col("doc_id"), index.doc_buckets))
    texts = index.docs.select(*keys, "text")
    if max_rows is not None and max_rows <= joins.MAX_BROADCAST_ROWS:
        found = texts.join(F.broadcast(hits), keys)
    else:
        needed = texts.join(hits.select(*keys).distinct(), keys, "left_semi")
        found = joins.salted_join(
            hits, needed.select("doc_id", "text"), "doc_id", "query_id"
        )
    return found.select("query_id", "rank", "doc_id", "score", "text", "sentiment")


def requests_of(queries: DataFrame, top_k: int, sentiment: int | None) -> DataFrame:
    """Per-query limits: own columns where the table has them, else the defaults."""
    if top_k < 1:
        raise ValueError("top_k must be at least 1")
    have = set(queries.columns)
    limit = F.coalesce("top_k", F.lit(top_k)) if "top_k" in have else F.lit(top_k)
    default = F.lit(sentiment).cast("int")
    want = F.coalesce("sentiment", default) if "sentiment" in have else default
    return queries.select("query_id", limit.alias("top_k"), want.alias("want"))


def search_many(
    queries: DataFrame,
    index: SearchIndex,
    top_k: int = 10,
    sentiment: int | None = None,
    candidate_pool: int = 1000,
    prefilter: bool = False,
) -> DataFrame:
    """Hits of every query in (query_id, text[, top_k, sentiment])."""
    wanted = query_terms(queries, index.cfg, index.lemmas)
    scores = bm25_scores(wanted, index.postings, index.terms, F.lit(index.avgdl))
    requests = requests_of(queries, top_k, sentiment)
    hits = rank_hits(scores, requests, candidate_pool, prefilter)
    asked = requests.agg(F.coalesce(F.sum("top_k"), F.lit(0))).first()[0]
    return with_texts(hits, index, max_rows=asked)


def search(
    query: str,
    index: SearchIndex,
    top_k: int = 10,
    sentiment: int | None = None,
    candidate_pool: int = 1000,
    prefilter: bool = False,
) -> DataFrame:
    """Hits of one query. Its terms are few and known before the scan, so they are
    pushed to it as literals: bucket folders and row groups without them are skipped."""
    spark: SparkSession = index.docs.sparkSession
    queries = spark.createDataFrame([(0, query)], "query_id bigint, text string")
    made = query_terms(queries, index.cfg, index.lemmas)
    found = made.collect()  # no more rows than the query has tokens
    if not found:
        return spark.createDataFrame([], HITS_SCHEMA)
    words = [row.term for row in found]
    postings = index.postings.where(F.col("term").isin(words))
    if index.term_buckets:
        buckets = spark.range(1).select(
            F.explode(F.lit(words)).alias("term")
        ).select(bucket_of(F.col("term"), index.term_buckets)).distinct()
        postings = postings.where(F.col("term_bucket").isin([row[0] for row in buckets.collect()]))
    wanted = spark.createDataFrame(found, made.schema)
    scores = bm25_scores(
        wanted, postings, index.terms.where(F.col("term").isin(words)), F.lit(index.avgdl),
        max_rows=len(found),
    )
    hits = rank_hits(scores, requests_of(queries, top_k, sentiment), candidate_pool, prefilter)
    return with_texts(hits, index, max_rows=top_k)
