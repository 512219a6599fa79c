"""Vectorizers and classifiers: V1-V10, C1-C11, S8."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import sql
from suite.inputs import CFG, corpus, documents, labelled, labels, narrow, run_table, scored
from textlake.operators import features as ft, metrics as mt
from textlake.operators.estimators import (
    BalancedLogisticRegression, TextCleaner, balanced_weight, decide, label_corpus, score, vectorize,
)
from textlake.operators.split import stratified_split
from textlake.plans.train import sweep, text_classifier
from textlake.session import materialize, scratch_path
from textlake.sources.models import load_model, save_model

QUERIES, ORACLES = {}, {}
TERMS = ft.MAX_FEATURES
COUNTS = sql.counts_cte("documents", CFG)
VOCAB = sql.vocab_cte(max_features=TERMS)


def _fitted(spark, sf, placed=True):
    """Counts, vocabulary and corpus size; tokens and vocabulary are written once."""
    docs = materialize(corpus(spark, sf), "tokens")
    # Terms are summed over all documents: only the weights need a document's rows in one place.
    vocab = materialize(ft.fit_vocabulary(ft.term_counts(docs), 2, TERMS), "vocab")
    return ft.term_counts(ft.by_document(docs) if placed else docs), vocab, ft.document_count(narrow(spark, sf))


def _rounded(df):
    return df.withColumn("weight", F.round("weight", 6))


QUERIES["v1_ngrams"] = lambda spark, sf: ft.ngrams(corpus(spark, sf)).select(
    "doc_id", F.array_join(F.sort_array("ngrams"), "|").alias("grams")
)
ORACLES["v1_ngrams"] = f"""WITH {COUNTS}
    SELECT d.doc_id, coalesce(g.grams, '') AS grams FROM documents d LEFT JOIN (
        SELECT doc_id, string_agg(term, '|' ORDER BY term) AS grams FROM grams GROUP BY doc_id) g USING (doc_id)"""
QUERIES["v2_term_counts"] = lambda spark, sf: ft.term_counts(corpus(spark, sf))
ORACLES["v2_term_counts"] = f"WITH {COUNTS} SELECT doc_id, term, tf FROM counts"
QUERIES["v3_fit_vocabulary"] = lambda spark, sf: ft.fit_vocabulary(
    ft.term_counts(corpus(spark, sf)), 2, TERMS
)
ORACLES["v3_fit_vocabulary"] = f"WITH {COUNTS}, {VOCAB} SELECT term, term_idx, df, cf FROM vocab"
QUERIES["v3_full_vocabulary"] = lambda spark, sf: ft.fit_vocabulary(
    ft.term_counts(corpus(spark, sf)), 2, None
)
ORACLES["v3_full_vocabulary"] = (
    f"WITH {COUNTS}, {sql.vocab_cte(max_features=2_000_000_000)} SELECT term, term_idx, df, cf FROM vocab"
)


def _bow(spark, sf):
    counts, vocab, _ = _fitted(spark, sf, placed=False)
    return ft.bow(counts, vocab).select("doc_id", "term", "term_idx", "tf")


QUERIES["v4_bow"] = _bow
ORACLES["v4_bow"] = (
    f"WITH {COUNTS}, {VOCAB} SELECT doc_id, term, term_idx, tf FROM counts JOIN vocab USING (term)"
)
QUERIES["v5_tfidf"] = lambda spark, sf: _rounded(ft.tfidf(*_fitted(spark, sf)))
ORACLES["v5_tfidf"] = f"WITH {COUNTS}, {VOCAB} {sql.unit_rows(sql.TFIDF_RAW)}"


def _bm25_fit(spark, sf):
    _, vocab, n_docs = _fitted(spark, sf)
    fitted = ft.with_idf(vocab, "bm25", n_docs)
    return fitted.select(
        "term", "term_idx", F.round("idf", 6).alias("idf"),
        F.round(ft.average_length(vocab, n_docs), 6).alias("avgdl"),
    )


QUERIES["v6_bm25_fit"] = _bm25_fit
ORACLES["v6_bm25_fit"] = f"""WITH {COUNTS}, {VOCAB}
    SELECT term, term_idx, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf,
           round((SELECT sum(cf) FROM vocab) / n, 6) AS avgdl FROM vocab, corpus"""
QUERIES["v7_bm25_transform"] = lambda spark, sf: _rounded(ft.bm25(*_fitted(spark, sf)))
ORACLES["v7_bm25_transform"] = f"WITH {COUNTS}, {VOCAB} {sql.unit_rows(sql.BM25_RAW)}"


def _vectorize(spark, sf):
    docs = materialize(corpus(spark, sf), "tokens")
    return _rounded(vectorize("BM25", maxFeatures=TERMS).fit(docs).weights(docs))


QUERIES["v8_vectorize"] = _vectorize
ORACLES["v8_vectorize"] = ORACLES["v7_bm25_transform"]
QUERIES["v9_feature_names"] = lambda spark, sf: ft.feature_names(
    ft.fit_vocabulary(ft.term_counts(corpus(spark, sf)), 2, TERMS)
)
ORACLES["v9_feature_names"] = f"WITH {COUNTS}, {VOCAB} SELECT term_idx, term FROM vocab"


def _vectors(spark, sf):
    docs = materialize(corpus(spark, sf), "tokens")
    made = vectorize("tfidf", maxFeatures=TERMS).fit(docs).transform(docs)
    return made.select("doc_id", _summary()("features").alias("s")).select(
        "doc_id", "s.nonzero", F.round("s.total", 6).alias("total")
    )


def _summary():
    @F.udf("nonzero int, total double", useArrow=True)
    def summary(vector):
        return {"nonzero": vector.numNonzeros(), "total": float(vector.values.sum())}

    return summary


QUERIES["v10_to_ml_vectors"] = _vectors
ORACLES["v10_to_ml_vectors"] = f"""WITH {COUNTS}, {VOCAB},
    w AS (SELECT doc_id, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM ({sql.TFIDF_RAW}))
    SELECT d.doc_id, CAST(count(weight) AS INT) AS nonzero, round(coalesce(sum(weight), 0), 6) AS total
    FROM documents d LEFT JOIN w USING (doc_id) GROUP BY d.doc_id"""


def _weights(spark, sf):
    rows = labels(spark, sf).select("doc_id", F.col("quality").alias("label"))
    return rows.select("doc_id", "label", F.round(balanced_weight(rows), 6).alias("weight"))


QUERIES["c1_balanced_weights"] = _weights
ORACLES["c1_balanced_weights"] = """
    SELECT doc_id, quality AS label, round((SELECT count(*) FROM labels)
           / (2.0::DOUBLE * count(*) OVER (PARTITION BY quality)), 6) AS weight FROM labels"""


def _tokens(spark, sf):
    return materialize(TextCleaner.of(CFG).transform(labelled(spark, sf)), "tokens")


def _fit(spark, sf):
    docs = _tokens(spark, sf)
    vectors = materialize(vectorize("tfidf", maxFeatures=TERMS).fit(docs).transform(docs), "vectors")
    model = BalancedLogisticRegression().fit(vectors)
    return score(vectors, model).select("doc_id", "label", "predicted", "score")


QUERIES["c2_fit_logreg"] = _fit


def _chain(spark, sf):
    docs = materialize(labelled(spark, sf), "labelled")
    model = text_classifier(CFG, "bow", maxFeatures=TERMS).fit(docs)
    return score(docs, model).select("doc_id", "label", "predicted", "sentiment", "confidence")


QUERIES["c3_text_classifier"] = _chain


def _saved(spark, sf):
    docs = materialize(labelled(spark, sf), "labelled")
    path = scratch_path(spark, "model")
    save_model(text_classifier(CFG, "bm25", maxFeatures=TERMS).fit(docs), path)
    return score(docs, load_model(path)).select("doc_id", "predicted", "confidence")


QUERIES["s8_save_load_model"] = _saved


def _decided(spark, sf):
    rows = scored(spark, sf).select("doc_id", "score")
    names = ("label", "sentiment", "confidence")
    return rows.select("doc_id", *[c.alias(n) for n, c in zip(names, decide(F.col("score")))])


QUERIES["c4_score_rule"] = _decided
ORACLES["c4_score_rule"] = f"""
    SELECT doc_id, CAST(score >= 0.5 AS INT) AS label,
           CASE WHEN score >= 0.5 THEN 'positive' ELSE 'negative' END AS sentiment,
           CASE WHEN score >= 0.5 THEN score ELSE 1 - score END AS confidence FROM {sql.SCORED}"""
QUERIES["c5_label_corpus"] = lambda spark, sf: label_corpus(labelled(spark, sf))
ORACLES["c5_label_corpus"] = (
    f"SELECT doc_id, text, label, CAST(label AS TINYINT) AS sentiment FROM {sql.LABELLED}"
)


def _predicted_corpus(spark, sf):
    docs = materialize(labelled(spark, sf), "labelled")
    model = text_classifier(CFG, "tfidf", maxFeatures=TERMS).fit(docs)
    every = documents(spark, sf).select("doc_id", "text")
    return label_corpus(every, model).select("doc_id", "sentiment")


QUERIES["c5_label_corpus_predicted"] = _predicted_corpus

_TP = "count(*) FILTER (predicted = 1 AND label = 1)"
_WRONG = "count(*) FILTER (predicted <> label)"
_ACC = "avg(CAST(predicted = label AS DOUBLE))"
_F1 = f"CASE WHEN 2 * {_TP} + {_WRONG} = 0 THEN 0.0 ELSE 2.0::DOUBLE * {_TP} / (2 * {_TP} + {_WRONG}) END"
# Brute force over all positive-negative pairs.
_AUC = f"""(SELECT avg(CASE WHEN p.score > n.score THEN 1.0::DOUBLE WHEN p.score = n.score THEN 0.5 ELSE 0 END)
    FROM {sql.SCORED} p JOIN {sql.SCORED} n ON p.label = 1 AND n.label = 0)"""


def _round_all(df):
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


QUERIES["c6_accuracy"] = lambda spark, sf: _round_all(mt.accuracy(scored(spark, sf)))
ORACLES["c6_accuracy"] = f"SELECT round({_ACC}, 6) AS accuracy FROM {sql.SCORED}"
QUERIES["c7_f1"] = lambda spark, sf: _round_all(mt.f1(scored(spark, sf)))
ORACLES["c7_f1"] = f"SELECT round({_F1}, 6) AS f1 FROM {sql.SCORED}"
QUERIES["c8_roc_auc"] = lambda spark, sf: _round_all(mt.roc_auc(scored(spark, sf)))
ORACLES["c8_roc_auc"] = f"SELECT round({_AUC}, 6) AS roc_auc"
QUERIES["c9_evaluate"] = lambda spark, sf: _round_all(mt.evaluate(scored(spark, sf)))
ORACLES["c9_evaluate"] = f"""
    SELECT round({_ACC}, 6) AS accuracy, round({_F1}, 6) AS f1, round({_AUC}, 6) AS roc_auc FROM {sql.SCORED}"""


def _sweep(spark, sf):
    rows = materialize(stratified_split(materialize(labelled(spark, sf), "labelled")), "split")
    parts = [rows.where(F.col("split") == name).drop("split") for name in ("train", "val", "test")]
    runs, _ = sweep(*parts, CFG, "documents", max_features=TERMS)
    return runs


QUERIES["c10_sweep"] = _sweep
QUERIES["c11_best_run"] = lambda spark, sf: mt.best_run(run_table(spark, sf))
ORACLES["c11_best_run"] = f"""
    SELECT dataset, vectorizer AS best_method, value AS best_val_f1 FROM {sql.RUNS}
    WHERE split = 'val' AND metric = 'f1'
    QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY value DESC, method_order) = 1"""
QUERIES["n6_comparison_table"] = lambda spark, sf: mt.comparison_table(run_table(spark, sf))
ORACLES["n6_comparison_table"] = f"""
    SELECT dataset, vectorizer, round_even(max(value) FILTER (metric = 'f1'), 4) AS f1,
           round_even(max(value) FILTER (metric = 'roc_auc'), 4) AS roc_auc
    FROM {sql.RUNS} WHERE split = 'val' GROUP BY dataset, vectorizer"""
