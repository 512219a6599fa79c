"""Classifier objective, scoring rule, metrics, runs and training from splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlake.operators.estimators import (
    BalancedLogisticRegression, balanced_weight, decide, label_corpus, score, vectorize,
)
from textlake.operators.metrics import best_run, comparison_table, evaluate
from textlake.plans.train import text_classifier, train_dataset
from textlake.sources.models import load_model, save_model
from textlake.sources.runs import RUNS_SCHEMA, read_runs
from textlake.sources.splits import write_splits
from textlake.specs import default_config

GOOD, BAD = "great lovely excellent amazing love".split(), "awful broken terrible poor hate".split()


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for i in range(120):
        words = GOOD if i % 4 else BAD
        rows.append((i, f"{words[i % 5]} {words[(i * 3) % 5]} thing number{chr(97 + i % 7)} not", int(i % 4 > 0)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, label int")


def test_gradient_vanishes(spark, docs):
    tokens = docs.withColumn("tokens", F.split("text", " "))
    rows = vectorize("tfidf").fit(tokens).transform(tokens)
    model = BalancedLogisticRegression(tol=1e-12).fit(rows)
    data = rows.collect()
    x = np.array([r.features.toArray() for r in data])
    y = np.array([r.label for r in data])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    assert np.abs(x.T @ (weight * (p - y)) + model.coefficients.toArray()).max() < 1e-3
    assert abs((weight * (p - y)).sum()) < 1e-3


def test_balanced_weights(docs):
    got = {(r.label, round(r.w, 9)) for r in docs.select("label", balanced_weight(docs).alias("w")).collect()}
    assert got == {(1, round(120 / 180, 9)), (0, 2.0)}


def test_decision_at_one_half(spark):
    df = spark.createDataFrame([(0.5,), (0.49,), (0.966,)], "p double")
    got = [tuple(r) for r in df.select(*decide(F.col("p"))).collect()]
    assert got == [(1, "positive", 0.5), (0, "negative", 0.51), (1, "positive", 0.966)]


def metrics(spark, rows):
    df = spark.createDataFrame(rows, "label int, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return evaluate(df).first().asDict()


def test_metrics_with_ties_and_without_positives(spark):
    assert metrics(spark, [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)]) == {"accuracy": 0.75, "f1": 0.8, "roc_auc": 0.875}
    assert metrics(spark, [(0, 0.2), (1, 0.2)]) == {"accuracy": 0.5, "f1": 0.0, "roc_auc": 0.5}
    assert metrics(spark, [(0, 0.1), (0, 0.2)]) == {"accuracy": 1.0, "f1": 0.0, "roc_auc": None}


def test_auc_with_one_score_holding_most_rows(spark):
    rows = [(i % 2, 1.0) for i in range(600)] + [(i % 3 % 2, i / 300) for i in range(300)]
    wins = [1.0 if a > b else 0.5 if a == b else 0.0 for la, a in rows if la for lb, b in rows if not lb]
    assert abs(metrics(spark, rows)["roc_auc"] - sum(wins) / len(wins)) < 1e-12


def test_chain_saves_loads_and_scores(spark, docs, tmp_path):
    model = text_classifier(default_config(lemmatize=False), "bm25").fit(docs)
    before = score(docs, model).orderBy("doc_id").collect()
    assert sum(r.predicted == r.label for r in before) >= 118
    assert before[0].sentiment == "negative" and before[1].sentiment == "positive"
    save_model(model, str(tmp_path / "m"))
    after = score(docs, load_model(str(tmp_path / "m"))).orderBy("doc_id").collect()
    assert [r.confidence for r in before] == [r.confidence for r in after]
    labelled = label_corpus(docs, model).collect()
    assert {r.sentiment for r in labelled} == {0, 1}
    assert [r.sentiment for r in label_corpus(docs, model, True).collect()] == [r.label for r in docs.collect()]


def test_best_run_and_comparison(spark):
    rows = [("r", "d", m, i, 1, 1, s, k, v) for i, (m, s, k, v) in enumerate([
        ("bow", "val", "f1", 0.8), ("tfidf", "val", "f1", 0.9), ("bm25", "val", "f1", 0.9),
        ("bow", "test", "f1", 1.0), ("bow", "val", "roc_auc", 0.123456)])]
    runs = spark.createDataFrame(rows, RUNS_SCHEMA)
    assert best_run(runs).first().best_method == "tfidf"
    table = {r.vectorizer: (r.f1, r.roc_auc) for r in comparison_table(runs).collect()}
    assert table == {"bow": (0.8, 0.1235), "tfidf": (0.9, None), "bm25": (0.9, None)}


def test_training_from_splits(spark, docs, tmp_path):
    tenth = F.floor(F.col("doc_id") / 4) % 10
    split = F.when(tenth == 0, "val").when(tenth == 1, "test").otherwise("train")
    write_splits(docs.withColumn("split", split), str(tmp_path / "s"))
    lexicon = spark.createDataFrame([("thing",)], "lemma string")
    best = train_dataset(
        spark, "amazon_fine_food", str(tmp_path / "s"), str(tmp_path / "m"), str(tmp_path / "runs"),
        methods=("bow", "bm25"), lexicon=lexicon,
    ).first()
    assert best.best_method in ("bow", "bm25") and best.best_val_f1 > 0.9
    assert read_runs(spark, str(tmp_path / "runs")).count() == 12
    scored = score(docs, load_model(str(tmp_path / "m")))
    assert scored.where("predicted = label").count() >= 115
