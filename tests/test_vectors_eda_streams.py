"""Word vectors, exploratory tables, and streams against their batch forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from suite.retrieval import QUERIES
from textlake.operators import eda, embeddings as em
from textlake.operators.estimators import score
from textlake.operators.search import build_search_index, search_many
from textlake.plans.train import text_classifier
from textlake.specs import default_config
from textlake.streaming.requests import score_stream, search_stream

CFG = default_config(lemmatize=False)


def vectors(spark, matrix):
    rows = [(f"w{i}", [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "word string, vector array<double>").repartition(3)


def test_neighbours_with_equal_vectors(spark, monkeypatch):
    rng = np.random.default_rng(0)
    matrix = rng.normal(size=(60, 5))
    matrix[10:40] = matrix[10]  # half of the words share one vector
    matrix[59] = 0
    unit = matrix / np.where(np.linalg.norm(matrix, axis=1, keepdims=True) == 0, 1, np.linalg.norm(matrix, axis=1, keepdims=True))
    probes = ["w10", "w3", "w59", "nope"]
    monkeypatch.setattr(em, "PROBE_BLOCK", 2)
    got = {}
    for r in em.most_similar(vectors(spark, matrix), probes, 6).collect():
        got.setdefault(r.probe, {})[r["rank"]] = r.word
    assert set(got) == {"w10", "w3", "w59"}
    for probe in got:
        i = int(probe[1:])
        order = sorted((j for j in range(60) if j != i), key=lambda j: (-round(float(unit[j] @ unit[i]), 9), f"w{j}"))
        assert [got[probe][k] for k in range(1, 7)] == [f"w{j}" for j in order[:6]]


def test_projection_equals_svd(spark):
    matrix = np.random.default_rng(1).normal(size=(40, 6)) * [5, 3, 1, 1, 1, 1] + 7
    centred = matrix - matrix.mean(axis=0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    axes = axes[:2] * np.sign(axes[:2][np.arange(2), np.abs(axes[:2]).argmax(axis=1)])[:, None]
    want = centred @ axes.T
    got = {r.word: (r.x, r.y) for r in em.project_2d(vectors(spark, matrix)).collect()}
    assert np.allclose([got[f"w{i}"] for i in range(40)], want, atol=1e-8)


def test_word2vec_and_scatter(spark):
    docs = spark.createDataFrame(
        [(i, ["good", "great", "nice"] if i % 2 else ["bad", "poor", "rare" if i == 0 else "ugly"]) for i in range(40)],
        "doc_id bigint, tokens array<string>",
    )
    found = em.word_vectors(em.fit_word2vec(docs, 8, epochs=1))
    assert {r.word for r in found.collect()} == {"good", "great", "nice", "bad", "poor", "ugly"}
    top = em.frequent_words(docs, 3)
    assert [r.word for r in top.collect()] == ["bad", "good", "great"]
    assert em.embedding_scatter(found, top).count() == 3


def test_histogram_edges(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0, 1, 5, 10, 99])], "doc_id bigint, words int")
    got = [r.n for r in eda.clipped_histogram(df, "words", 10, 5).orderBy("bin").collect()]
    assert got == np.histogram([0, 1, 5, 10, 10], bins=5)[0].tolist()
    flat = spark.createDataFrame([(0, 3), (1, 3)], "doc_id bigint, words int")
    rows = eda.clipped_histogram(flat, "words", 10, 4).orderBy("bin").collect()
    counts, edges = np.histogram([3, 3], bins=4)
    assert [r.n for r in rows] == counts.tolist() and [r.lo for r in rows] == edges[:-1].tolist()


def test_word_counts_and_contrast(spark):
    df = spark.createDataFrame([(0, " a b c "), (1, ""), (2, "x\n y")], "doc_id bigint, text string")
    assert [r.words for r in eda.word_counts(df).orderBy("doc_id").collect()] == [3, 0, 2]
    assert eda.median_words(df).first()[0] == 2.0
    a = spark.createDataFrame([(["x", "y", "x"],), (["z"],)], "tokens array<string>")
    b = spark.createDataFrame([(["x"],), (["q"],)], "tokens array<string>")
    got = eda.vocab_contrast(a, b).first()
    assert tuple(got) == (3, 2, 1, 2 / 3, 1 / 2)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"{'great fine' if i % 3 else 'awful poor'} item{chr(97 + i % 5)}", int(i % 3 > 0)) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, label int")


def test_scoring_stream_equals_batch(spark, docs, tmp_path):
    model = text_classifier(CFG, "tfidf").fit(docs)
    requests = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(99, "")], "doc_id bigint, text string"))
    requests.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(requests.schema).parquet(str(tmp_path / "in"))
    query = (
        score_stream(stream, model, "d").writeStream.trigger(availableNow=True).format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp")).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    got = {r.doc_id: (r.label, r.confidence) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r.doc_id: (r.predicted, r.confidence) for r in score(docs, model).collect()}
    assert got == want


def test_search_stream_equals_batch(spark, docs, tmp_path):
    index = build_search_index(docs.withColumnRenamed("label", "sentiment"), CFG)
    queries = spark.createDataFrame([(0, "great itema"), (1, ""), (2, "awful")], "query_id bigint, text string")
    queries.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(queries.schema).parquet(str(tmp_path / "in"))
    query = search_stream(stream, index, str(tmp_path / "out"), str(tmp_path / "cp"), 4).trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("query_id", "rank", "doc_id", "score")
    want = search_many(queries, index, 4).select("query_id", "rank", "doc_id", "score")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError):
        search_stream(stream, index, "x", "y", 101)


def test_error_cases(spark):
    df = spark.createDataFrame(
        [(0, 1, 0, ["not", "good"]), (1, 1, 1, ["good"]), (2, 0, 1, ["fine"])],
        "doc_id bigint, label int, predicted int, tokens array<string>",
    )
    assert [tuple(r) for r in eda.error_cases(df).orderBy("doc_id").collect()] == [(0, 1, 0, True), (2, 0, 1, False)]
    assert eda.error_summary(df).agg(F.sum("n")).first()[0] == 2


@pytest.mark.parametrize("parts", [1, 3])
def test_tables_in_folders_of_parts_arrive_as_streams(spark, tmp_path, parts):
    words = ["great fine day", "awful poor day"]
    texts = spark.createDataFrame([(i, words[i % 2]) for i in range(12)], "doc_id bigint, text string")
    texts.repartition(parts).write.parquet(str(tmp_path / "documents.parquet"))
    quality = spark.createDataFrame([(i, 1 - i % 2) for i in range(12)], "doc_id bigint, quality int")
    quality.repartition(parts).write.parquet(str(tmp_path / "labels.parquet"))
    turns = [(i, 0, None if i == 5 else "" if i == 4 else words[i % 2]) for i in range(6)]
    turns = spark.createDataFrame(turns, "conv_id bigint, turn int, text string")
    turns.repartition(parts).write.parquet(str(tmp_path / "conversations.parquet"))
    got = QUERIES["p1_score_stream"](spark, str(tmp_path)).collect()
    assert sorted((r.conv_id, r.label) for r in got) == [(0, 1), (1, 0), (2, 1), (3, 0)]
