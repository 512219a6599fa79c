"""Search, embeddings, exploration and streams: Q1-Q7, E1-E5, N1-N8, P1-P2."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import sql
from suite.inputs import (
    CFG, RAW_SPEC, corpus, documents, labelled, labels, narrow, raw, scored, search_docs,
    turn_tokens, turns,
)
from textlake.operators import eda, embeddings as em, search as se
from textlake.plans.index import index_corpus
from textlake.plans.prepare import prepare
from textlake.plans.train import text_classifier
from textlake.session import materialize, scratch_path
from textlake.sources.index import read_index, write_index
from textlake.sources.tables import read_table
from textlake.specs import reviews_config, tweets_config
from textlake.streaming.requests import score_stream, search_stream

QUERIES, ORACLES = {}, {}
QUERY = "not that thinly eresan, the not"
BATCH = "(SELECT item_id AS query_id, text FROM benchmark)"
ONE = f"(SELECT CAST(0 AS BIGINT) AS query_id, '{QUERY}' AS text)"
POSTINGS = sql.postings_cte(sql.SEARCH_DOCS, CFG)


def _index(spark, sf):
    return se.build_search_index(search_docs(spark, sf), CFG)


def _score6(df):
    return df.withColumn("score", F.round("score", 6))


def _batch(spark, sf):
    return read_table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


QUERIES["q1_build_postings"] = lambda spark, sf: se.build_postings(search_docs(spark, sf), CFG)
ORACLES["q1_build_postings"] = f"WITH {POSTINGS} SELECT term, doc_id, tf, dl, sentiment FROM postings"
QUERIES["q2_okapi_idf"] = lambda spark, sf: se.okapi_idf(
    se.build_postings(search_docs(spark, sf), CFG), narrow(spark, sf).agg(F.count("*").alias("n")).scalar()
).withColumn("idf", F.round("idf", 6))
ORACLES["q2_okapi_idf"] = f"WITH {POSTINGS} SELECT term, df, round(idf, 6) AS idf FROM terms"


def _scores(spark, sf):
    index = _index(spark, sf)
    wanted = se.query_terms(_batch(spark, sf), index.cfg)
    return _score6(se.bm25_scores(wanted, index.postings, index.terms, F.lit(index.avgdl)))


QUERIES["q3_bm25_scores"] = _scores
ORACLES["q3_bm25_scores"] = (
    f"WITH {POSTINGS}, {sql.scores_cte(BATCH, CFG)} "
    "SELECT query_id, doc_id, round(score, 6) AS score, sentiment FROM scores"
)
QUERIES["q4_search"] = lambda spark, sf: _score6(se.search(QUERY, _index(spark, sf), 10))
ORACLES["q4_search"] = f"WITH {POSTINGS}, {sql.scores_cte(ONE, CFG)} {sql.hits(10, 1000)}"
QUERIES["q4_search_filtered"] = lambda spark, sf: _score6(
    se.search(QUERY, _index(spark, sf), 10, sentiment=0, candidate_pool=60)
)
ORACLES["q4_search_filtered"] = (
    f"WITH {POSTINGS}, {sql.scores_cte(ONE, CFG)} {sql.hits(10, 60, sentiment=0)}"
)
QUERIES["q4_search_prefiltered"] = lambda spark, sf: _score6(
    se.search(QUERY, _index(spark, sf), 10, sentiment=0, candidate_pool=60, prefilter=True)
)
ORACLES["q4_search_prefiltered"] = (
    f"WITH {POSTINGS}, {sql.scores_cte(ONE, CFG)} {sql.hits(10, 60, sentiment=0, pre=True)}"
)
QUERIES["q5_search_many"] = lambda spark, sf: _score6(
    se.search_many(_batch(spark, sf), _index(spark, sf), 10)
)
ORACLES["q5_search_many"] = f"WITH {POSTINGS}, {sql.scores_cte(BATCH, CFG)} {sql.hits(10, 1000)}"


def _built(spark, sf):
    """Prepared splits -> unique corpus -> stored index -> batch search."""
    rows = materialize(prepare(raw(spark, sf), RAW_SPEC), "prepared")
    parts = [rows.where(F.col("split") == name) for name in ("train", "val", "test")]
    path = scratch_path(spark, "index")
    write_index(se.build_search_index(index_corpus(parts, true_labels=True), CFG), path)
    return _score6(se.search_many(_batch(spark, sf), read_index(spark, path), 5))


_CORPUS = (
    f"(SELECT doc_id, text, CAST(label AS TINYINT) AS sentiment FROM {sql.unique(sql.usable(sql.RAW))})"
)
QUERIES["q7_build_index"] = _built
ORACLES["q7_build_index"] = (
    f"WITH {sql.postings_cte(_CORPUS, CFG)}, {sql.scores_cte(BATCH, CFG)} {sql.hits(5, 1000)}"
)


def _word2vec(spark, sf):
    model = em.fit_word2vec(materialize(corpus(spark, sf), "tokens"))
    return em.word_vectors(model)


def _probe_vectors(spark, sf):
    return read_table(spark, sf, "embeddings").select(
        F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


PROBES = [f"w{i}" for i in range(0, 40, 5)] + ["unknown"]
QUERIES["e1_fit_word2vec"] = lambda spark, sf: _word2vec(spark, sf).select(
    "word", F.size("vector").alias("size")
)
ORACLES["e1_fit_word2vec"] = f"""
    SELECT token AS word, 100 AS size FROM {sql.token_table('documents', CFG)}
    GROUP BY token HAVING count(*) >= 5"""
QUERIES["e2_most_similar"] = lambda spark, sf: em.most_similar(
    _probe_vectors(spark, sf), PROBES
).withColumn("similarity", F.round("similarity", 6))
ORACLES["e2_most_similar"] = f"""
    WITH v AS (SELECT concat('w', vec_id) AS word, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings),
    pairs AS (SELECT p.word AS probe, v.word, round(list_cosine_similarity(p.vector, v.vector), 9) AS s
              FROM v JOIN v p ON p.word <> v.word WHERE p.word IN ({sql.quoted(PROBES)}))
    SELECT probe, CAST(rank AS INT) AS rank, word, round(s, 6) AS similarity FROM (
        SELECT *, row_number() OVER (PARTITION BY probe ORDER BY s DESC, word) AS rank FROM pairs)
    WHERE rank <= 8"""
QUERIES["e3_project_2d"] = lambda spark, sf: em.project_2d(_probe_vectors(spark, sf))
QUERIES["e4_frequent_words"] = lambda spark, sf: em.frequent_words(corpus(spark, sf))
ORACLES["e4_frequent_words"] = f"""
    SELECT token AS word, count(*) AS cf FROM {sql.token_table('documents', CFG)}
    GROUP BY token HAVING count(*) >= 5 ORDER BY cf DESC, word LIMIT 200"""


def _scatter(spark, sf):
    docs = materialize(corpus(spark, sf), "tokens")
    vectors = em.word_vectors(em.fit_word2vec(docs))
    return em.embedding_scatter(materialize(vectors, "vectors"), em.frequent_words(docs))


QUERIES["e5_embedding_scatter"] = _scatter

QUERIES["n1_label_counts"] = lambda spark, sf: eda.label_counts(
    labels(spark, sf).select(F.col("quality").alias("label"))
)
ORACLES["n1_label_counts"] = "SELECT quality AS label, count(*) AS n FROM labels GROUP BY quality"
_WORDS = f"len(regexp_extract_all(text, '{sql.NON_SPACE}+'))"
QUERIES["n2_word_counts"] = lambda spark, sf: eda.word_counts(documents(spark, sf))
ORACLES["n2_word_counts"] = f"SELECT doc_id, CAST({_WORDS} AS INT) AS words FROM documents"
QUERIES["n2_median_words"] = lambda spark, sf: eda.median_words(documents(spark, sf))
ORACLES["n2_median_words"] = f"SELECT median({_WORDS}) AS median_words FROM documents"
QUERIES["n3_clipped_histogram"] = lambda spark, sf: eda.clipped_histogram(
    eda.word_counts(documents(spark, sf)), "words", 300, 50
)
ORACLES["n3_clipped_histogram"] = f"""
    WITH v AS (SELECT least({_WORDS}, 300)::DOUBLE AS v FROM documents),
    e AS (SELECT min(v) AS a, max(v) AS z FROM v),
    c AS (SELECT least(CAST(floor((v - a) * 50 / (z - a)) AS INT), 49) AS bin, count(*) AS n FROM v, e GROUP BY 1)
    SELECT CAST(b.bin AS INT) AS bin, a + (z - a) * b.bin / 50 AS lo, a + (z - a) * (b.bin + 1) / 50 AS hi,
           coalesce(n, 0) AS n
    FROM (SELECT unnest(range(50)) AS bin) b CROSS JOIN e LEFT JOIN c USING (bin)"""
QUERIES["n4_peek"] = lambda spark, sf: eda.peek(narrow(spark, sf), 5, 160)
ORACLES["n4_peek"] = "SELECT doc_id, substr(text, 1, 160) AS text FROM documents ORDER BY doc_id LIMIT 5"
PRESETS = {"reviews": reviews_config(lemmatize=False), "tweets": tweets_config(lemmatize=False)}
QUERIES["n5_compare_cleaning"] = lambda spark, sf: eda.compare_cleaning(
    turns(spark, sf).withColumn("doc_id", F.expr("conv_id * 1000 + turn")), PRESETS
)
ORACLES["n5_compare_cleaning"] = "SELECT conv_id * 1000 + turn AS doc_id, text, {} FROM conversations".format(
    ", ".join(f"{sql.clean('text', cfg)} AS {name}" for name, cfg in PRESETS.items())
)
QUERIES["n7_vocab_contrast"] = lambda spark, sf: eda.vocab_contrast(
    corpus(spark, sf), turn_tokens(spark, sf)
)
ORACLES["n7_vocab_contrast"] = f"""
    WITH a AS (SELECT DISTINCT token FROM {sql.token_table('documents', CFG)}),
    b AS (SELECT DISTINCT token FROM {sql.token_table('conversations', CFG, 'conv_id')}),
    s AS (SELECT (SELECT count(*) FROM a) AS vocab_a, (SELECT count(*) FROM b) AS vocab_b,
                 (SELECT count(*) FROM a SEMI JOIN b USING (token)) AS shared)
    SELECT *, (vocab_a - shared) / vocab_a::DOUBLE AS oov_a_in_b, (vocab_b - shared) / vocab_b::DOUBLE AS oov_b_in_a
    FROM s"""


def _scored_tokens(spark, sf):
    return corpus(spark, sf).join(scored(spark, sf), "doc_id")


QUERIES["n8_error_cases"] = lambda spark, sf: eda.error_cases(_scored_tokens(spark, sf))
_ERRORS = f"""(SELECT doc_id, label, predicted,
    list_has_any({sql.tokens('text', CFG)}, ['not', 'no', 'nor', 'never', 'none', 'cannot']) AS has_negation
    FROM {sql.SCORED} JOIN documents USING (doc_id) WHERE predicted <> label)"""
ORACLES["n8_error_cases"] = f"SELECT doc_id, label, predicted, has_negation FROM {_ERRORS}"
QUERIES["n8_error_summary"] = lambda spark, sf: eda.error_summary(_scored_tokens(spark, sf))
ORACLES["n8_error_summary"] = f"""
    SELECT label, predicted, has_negation, count(*) AS n FROM {_ERRORS} GROUP BY label, predicted, has_negation"""


def _arriving(spark, sf, name):
    """A table as a stream of files."""
    schema = read_table(spark, sf, name).schema
    # As a pattern, the path may be one file or a folder of parts.
    return spark.readStream.schema(schema).parquet(f"{sf}/{{{name}.parquet}}")


def _score_stream(spark, sf):
    model = text_classifier(CFG, "tfidf").fit(materialize(labelled(spark, sf), "labelled"))
    out = scratch_path(spark, "scores")
    requests = _arriving(spark, sf, "conversations").select("conv_id", "turn", "text")
    answers = score_stream(requests, model, "documents")
    query = (
        answers.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", scratch_path(spark, "stream"))
        .format("parquet").start(out)
    )
    query.awaitTermination()
    return spark.read.schema(answers.schema).parquet(out)


QUERIES["p1_score_stream"] = _score_stream


def _search_stream(spark, sf):
    out = scratch_path(spark, "hits")
    requests = _arriving(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    query = search_stream(requests, _index(spark, sf), out, scratch_path(spark, "stream")).trigger(
        availableNow=True
    ).start()
    query.awaitTermination()
    return _score6(spark.read.parquet(out).drop("batch"))


QUERIES["p2_search_stream"] = _search_stream
ORACLES["p2_search_stream"] = ORACLES["q5_search_many"]
