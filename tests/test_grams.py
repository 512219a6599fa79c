"""Counting in Arrow slices against plain Python, and the memory of a lemma lookup."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from textlake.functions import grams
from textlake.operators.lexical import dictionary_lookup
from textlake.plans import train
from textlake.specs import default_config


def brute(rows, lo, hi):
    out = {}
    for i, words in enumerate(rows):
        for n in range(lo, hi + 1):
            for k in range(len(words or []) - n + 1):
                if None not in words[k : k + n]:
                    key = i, " ".join(words[k : k + n])
                    out[key] = out.get(key, 0) + 1
    return out


@pytest.mark.parametrize("lo, hi", [(1, 1), (1, 2), (2, 2), (1, 3)])
def test_counts_equal_plain_python(lo, hi, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [[f"w{j}" for j in rng.integers(0, 6, n)] for n in rng.integers(0, 30, 40)]
    rows += [None, [], ["w1"], ["a b", "c", "a", "b c"], ["w1", None, "w2", "w1"]]
    lists, want = pa.array(rows, pa.list_(pa.string())), brute(rows, lo, hi)
    row, terms, tf = grams.count_grams(lists, lo, hi)
    assert dict(zip(zip(row.tolist(), terms.to_pylist()), tf.tolist())) == want and len(row) == len(want)
    totals = grams.gram_totals(lists, lo, hi).to_pydict()
    assert dict(zip(totals["term"], totals["cf"])) == {t: sum(c for (_, u), c in want.items() if u == t) for t in totals["term"]}
    assert dict(zip(totals["term"], totals["df"])) == {t: sum(u == t for _, u in want) for t in totals["term"]}
    plain = brute(rows[:-2], lo, hi)
    known = sorted({t for _, t in plain})[::2]
    row, index, tf = grams.Vocabulary(known).counts(lists.slice(0, len(rows) - 2), lo, hi)
    assert {(r, known[k]): n for r, k, n in zip(row.tolist(), index.tolist(), tf.tolist())} == {
        key: n for key, n in plain.items() if key[1] in known
    }
    monkeypatch.setattr(grams, "SLICE_TOKENS", 7)
    cut = list(grams.slices(grams.row_lengths(lists)))
    assert [a for a, _ in cut[1:]] == [b for _, b in cut[:-1]] and cut[-1][1] == len(rows) and len(cut) > 10


def test_lemma_lookup_makes_no_python_string_per_token(spark):
    mapping = spark.createDataFrame([("cats", "cat"), ("men", "man")], "term string, lemma string")
    replace = dictionary_lookup(mapping)
    df = spark.createDataFrame([(["cats", None, "dog", "men"],), ([],), (None,)], "tokens array<string>")
    assert [r.t for r in df.select(replace("tokens").alias("t")).collect()] == [["cat", None, "dog", "man"], [], None]
    many = pa.array([["cats", "dog", "men", "x"] * 50_000] * 10, pa.list_(pa.string()))
    tracemalloc.start()
    out = replace.func(many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out[9].values.slice(0, 4).to_pylist() == ["cat", "dog", "man", "x"] and peak < 40e6


def test_classifier_learns_from_tokens_written_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(train, "materialize", lambda df, name, f=train.materialize: calls.append(df.columns) or f(df, name))
    rows = [(i, ["great fine day", "awful poor day"][i % 2], 1 - i % 2) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = train.text_classifier(default_config(lemmatize=False), "tfidf").fit(docs)
    assert calls == [["label", "tokens"]]
    assert {(r.label, r.prediction) for r in model.transform(docs).collect()} == {(0, 0.0), (1, 1.0)}
