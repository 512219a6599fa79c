"""Search against a plain restatement, with hot terms and stored indexes."""

import math

import pytest
from pyspark.sql import functions as F

from textlake.functions.text import stoplist
from textlake.operators import joins
from textlake.operators.search import build_search_index, search, search_many
from textlake.plans.index import build_index
from textlake.sources.index import default_buckets, read_index, write_index
from textlake.sources.splits import write_splits
from textlake.specs import default_config

CFG = default_config(lemmatize=False)
DOCS = [
    (0, "quiet house, and breakfast is served until noon", 1),
    (1, "cold breakfast, nobody at the desk, we left early", 0),
    (2, "large garden with old trees and clean rooms", 1),
    (3, "paint fell from the wall, damp rooms everywhere", 0),
    (4, "we came by train and would come again", 1),
]
SCHEMA = "doc_id bigint, text string, sentiment tinyint"


def plain_words(text):
    stop = set(stoplist())
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return [w for w in words if len(w) > 1 and w not in stop]


def plain_scores(docs, query):
    words = {i: plain_words(t) for i, t, _ in docs}
    n, avgdl = len(docs), sum(map(len, words.values())) / len(docs)
    df = {}
    for ws in words.values():
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(n - k + 0.5) - math.log(k + 0.5) for w, k in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: 0.25 * mean if v < 0 else v for w, v in idf.items()}
    out = {}
    for i, ws in words.items():
        out[i] = sum(
            idf.get(q, 0) * ws.count(q) * 2.5 / (ws.count(q) + 1.5 * (0.25 + 0.75 * len(ws) / avgdl))
            for q in plain_words(query)
        )
    return out


def ids(df):
    return [r.doc_id for r in df.orderBy("query_id", "rank").collect()]


@pytest.fixture(scope="module")
def index(spark):
    return build_search_index(spark.createDataFrame(DOCS, SCHEMA), CFG)


def test_relevance_filter_and_empty_query(index):
    assert set(ids(search("breakfast", index, 5))) == {0, 1}
    assert ids(search("breakfast", index, 5, sentiment=0)) == [1]
    assert ids(search("", index, 5)) == [] and ids(search("the of", index, 5)) == []
    assert ids(search("absent", index, 5)) == []
    with pytest.raises(ValueError):
        search("breakfast", index, 0)


@pytest.mark.parametrize("query", ["breakfast", "rooms rooms garden", "quiet breakfast rooms absent"])
def test_scores_equal_formula(index, query):
    want = {i: round(s, 9) for i, s in plain_scores(DOCS, query).items() if s > 0}
    assert {r.doc_id: r.score for r in search(query, index).collect()} == pytest.approx(want)


@pytest.fixture(scope="module")
def skewed():
    """A word in most documents (negative idf), one in exactly half, an empty text, equal texts."""
    docs = []
    for i in range(60):
        words = ["common"] * (i % 3 + 1) if i % 5 else []
        words += ["half"] if i % 2 else []
        words += ["rare"] if i % 17 == 3 else []
        docs.append((i, " ".join(words + [f"w{chr(97 + i % 20)}x"]) if i != 30 else "", int(i % 6 > 0)))
    return docs


def test_skewed_corpus(spark, skewed):
    index = build_search_index(spark.createDataFrame(skewed, SCHEMA), CFG)
    for query in ("common rare", "half", "common common half rare"):
        scores = {i: round(s, 9) for i, s in plain_scores(skewed, query).items()}
        order = sorted((i for i in scores if scores[i] > 0), key=lambda i: (-scores[i], i))
        assert ids(search(query, index, 100)) == order
        pool = order[:8]
        assert ids(search(query, index, 4, sentiment=0, candidate_pool=8)) == [i for i in pool if i % 6 == 0][:4]
        assert ids(search(query, index, 4, sentiment=0, candidate_pool=8, prefilter=True)) == [
            i for i in order if i % 6 == 0
        ][:4]


def test_batch_equals_single_in_every_way(spark, skewed, tmp_path, monkeypatch):
    docs = spark.createDataFrame(skewed, SCHEMA)
    index = build_search_index(docs, CFG)
    texts = ["common rare", "half", "", "common common", "absent"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id bigint, text string")
    want = [(q, i) for q, text in enumerate(texts) for i in ids(search(text, index, 7))]

    def got(ix):
        rows = search_many(queries, ix, 7).orderBy("query_id", "rank").collect()
        return [(r.query_id, r.doc_id) for r in rows]

    assert got(index) == want
    write_index(index, str(tmp_path / "ix"), 4, 4)
    stored = read_index(spark, str(tmp_path / "ix"))
    assert got(stored) == want
    assert ids(search("common rare", stored, 7)) == ids(search("common rare", index, 7))
    assert got(build_search_index(docs.repartition(3), CFG)) == want
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 1)  # the salted way
    assert got(index) == want


def test_limits_per_query(spark, index):
    queries = spark.createDataFrame(
        [(0, "breakfast", 1, None), (1, "breakfast", None, 0), (2, "rooms", None, None)],
        "query_id bigint, text string, top_k int, sentiment int",
    )
    rows = search_many(queries, index, 5).orderBy("query_id", "rank").collect()
    assert [r.query_id for r in rows] == [0, 1, 2, 2]
    assert rows[1].doc_id == 1


def test_lemmas_travel_with_the_index(spark, tmp_path):
    docs = spark.createDataFrame([(0, "two batteries", 1), (1, "one battery", 0), (2, "no", 1), (3, "x y", 1), (4, "xx", 1)], SCHEMA)
    index = build_search_index(docs, default_config())
    write_index(index, str(tmp_path / "ix"), 2, 2)
    stored = read_index(spark, str(tmp_path / "ix"))
    assert stored.cfg == default_config()
    assert set(ids(search("battery", stored))) == set(ids(search("batteries", stored))) == {0, 1}
    with pytest.raises(FileNotFoundError):
        read_index(spark, str(tmp_path / "none"))


def test_stored_search_prunes(spark, index, tmp_path):
    write_index(index, str(tmp_path / "ix"), 8, 8)
    stored = read_index(spark, str(tmp_path / "ix"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")  # whole locations, however long
    plan = search("garden", stored)._jdf.queryExecution().executedPlan().toString()
    postings = next(line for line in plan.splitlines() if "FileScan" in line and "postings" in line)
    assert "PartitionFilters: [isnotnull(term_bucket" in postings or "(term_bucket" in postings.split("PartitionFilters")[1]
    texts = next(line for line in plan.splitlines() if "FileScan" in line and "text#" in line)
    assert "dynamicpruning" in texts
    assert ids(search("garden", stored, 3)) == [2]


def test_bucket_count_follows_size():
    assert [default_buckets(n) for n in (5, 10**7, 10**11)] == [4, 100, 4096]


def test_build_index_from_splits(spark, tmp_path):
    rows = [(i, t, s, ("train", "val", "test")[i % 3]) for i, t, s in DOCS] + [(9, DOCS[0][1], 0, "test")]
    write_splits(
        spark.createDataFrame(rows, "doc_id bigint, text string, label int, split string"), str(tmp_path / "s")
    )
    build_index(spark, "amazon_fine_food", str(tmp_path / "s"), str(tmp_path / "ix"), max_docs=5, lemmatize=False)
    stored = read_index(spark, str(tmp_path / "ix"))
    assert stored.n_docs == 5
    hits = search("breakfast", stored).collect()
    assert {(r.doc_id, r.sentiment) for r in hits} == {(0, 1), (1, 0)}
    assert stored.docs.where(F.col("doc_id") == 9).isEmpty()
