"""Word vectors: the tree, a trainer's steps pair by pair, and what whole fits learn."""

import heapq
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import feature

from textlake.operators import embeddings as em, skipgram as sg
from textlake.session import SHUFFLE_CLEANUP_CONF, locate, shared_dir


@pytest.mark.parametrize("counts", [[1], [5, 5], [9, 4, 4, 3, 1, 1, 1], [2**k for k in range(20, 0, -1)]])
def test_huffman_tree_is_shortest(counts):
    heap, best = [*counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        joined = heapq.heappop(heap) + heapq.heappop(heap)
        best += joined
        heapq.heappush(heap, joined)
    offsets, nodes, labels = sg.paths(*sg.huffman(np.array(counts)))
    assert int(np.diff(offsets) @ np.array(counts)) == best
    codes = {
        tuple(zip(nodes[a:b].tolist()[::-1], labels[a:b].tolist()[::-1], strict=True))
        for a, b in zip(offsets[:-1], offsets[1:], strict=True)
    }
    assert len(codes) == len(counts)
    assert not any(one != other and other[: len(one)] == one for one in codes for other in codes)


def stepped(inputs, nodes, tree, window, ids, first, end, rate, rng):
    """The trainer's steps, pair by pair and node by node."""
    offsets, points, labels = sg.paths(*tree)
    centres = [p for p in range(first, end) if ids[p] >= 0]
    reach = dict(zip(centres, rng.integers(1, window + 1, len(centres)).tolist(), strict=True))
    pairs = 0
    for start in range(first, end, sg.RUN):
        X, U = inputs.astype(float), nodes.astype(float)
        dx, du, zx, zu = np.zeros_like(X), np.zeros_like(U), np.zeros(len(X)), np.zeros(len(U))
        for p in range(start, min(start + sg.RUN, end)):
            for q in range(max(p - reach.get(p, 0), 0), min(p + reach.get(p, 0), len(ids) - 1) + 1):
                if q == p or ids[p] < 0 or (ids[min(p, q) : max(p, q) + 1] < 0).any():
                    continue
                pairs += 1
                for k in range(offsets[ids[p]], offsets[ids[p] + 1]):
                    x, u = ids[q], points[k]
                    error = labels[k] - 1 / (1 + np.exp(-X[x] @ U[u]))
                    dx[x] += error * U[u]
                    du[u] += error * X[x]
                    zx[x] += U[u] @ U[u]
                    zu[u] += X[x] @ X[x]
        inputs += (rate / (1 + rate / 8 * zx))[:, None] * dx
        nodes += (rate / (1 + rate / 8 * zu))[:, None] * du
    return pairs


def test_trainer_steps_over_every_pair():
    rng = np.random.default_rng(5)
    counts = np.array([40, 30, 20, 9, 5, 4, 3, 2, 1])
    ids = rng.choice(len(counts), 333, p=counts / counts.sum()).astype(np.int32)
    ids[[7, 8, 50, 64, 200]] = sg.SENTENCE_END
    ids[100:140] = 4  # one word over and over
    tree = sg.huffman(counts)
    inputs = rng.normal(size=(len(counts) + 1, 6)).astype(np.float32)
    nodes = rng.normal(size=(len(counts) - 1, 6)).astype(np.float32)
    want_inputs, want_nodes = inputs.astype(float), nodes.astype(float)
    trainer = sg.Trainer(inputs, nodes, tree, 3)
    pieces = [ids[:5], ids[5:120], ids[120:121], ids[121:]]
    ours, theirs, centres, pairs = np.random.default_rng(1), np.random.default_rng(1), 0, 0
    for seen, first, end in sg.stretches(pieces, 3, 2 * sg.RUN):
        centres += trainer.train(seen, first, end, 0.3, ours)
        pairs += stepped(want_inputs, want_nodes, tree, 3, seen, first, end, 0.3, theirs)
    assert centres == (ids >= 0).sum() and pairs > 3 * centres
    assert np.allclose(trainer.inputs, want_inputs, atol=1e-4) and np.allclose(trainer.nodes, want_nodes, atol=1e-4)
    assert trainer.moved[0][: len(counts)].all() and trainer.moved[1].all() and not trainer.moved[0][len(counts)]


def test_stretches_hold_every_centre_and_its_window():
    ids = np.arange(1000, dtype=np.int32)
    for cuts in ([], [1, 2, 3, 500], list(range(0, 1000, 7))):
        got = []
        for seen, first, end in sg.stretches(np.split(ids, cuts), 5, 64):
            at = int(seen[first])
            assert seen[: end + 5].tolist()[max(first - 5, 0) :] == ids[max(at - 5, 0) : at + end - first + 5].tolist()
            got += seen[first:end].tolist()
        assert got == ids.tolist()


def test_one_word_over_and_over_does_not_overshoot():
    counts = np.array([3000, 20, 10])
    ids = np.zeros(3000, np.int32)
    ids[::150], ids[75::300] = 1, 2
    inputs = em.first_vectors(0, 4, 100, 42) * 300
    trainer = sg.Trainer(inputs, np.zeros((2, 100), np.float32), sg.huffman(counts), 5)
    for _ in range(3):
        for seen, first, end in sg.stretches([ids], 5, sg.STRETCH):
            trainer.train(seen, first, end, sg.RATE, np.random.default_rng(0))
    assert np.abs(trainer.inputs).max() < 5 and np.abs(trainer.nodes).max() < 5


def topics(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [f"{'ab'[i % 2]}{k}" for k in rng.integers(0, 12, 40)]) for i in range(400)]
    return spark.createDataFrame(rows, "doc_id bigint, tokens array<string>").repartition(3, "doc_id")


def test_fit_learns_and_repeats(spark):
    docs = topics(spark)
    found = em.word_vectors(em.fit_word2vec(docs, 16, epochs=4, partitions=3))
    probes = [f"{t}{k}" for t in "ab" for k in range(12)]
    near = em.most_similar(found, probes, 5).collect()
    assert len(near) == 120
    assert sum(r.probe[0] == r.word[0] for r in near) >= 114
    again = em.word_vectors(em.fit_word2vec(docs, 16, epochs=4, partitions=3))
    assert {(r.word, *r.vector) for r in found.collect()} == {(r.word, *r.vector) for r in again.collect()}


def no_driver_model(monkeypatch):
    def never(*args, **kwargs):
        raise AssertionError("MLlib's model holds all vectors on the driver")

    monkeypatch.setattr(feature.Word2Vec, "fit", never)


def test_vectors_do_not_pass_through_the_driver(spark, monkeypatch):
    no_driver_model(monkeypatch)
    names = [f"w{k:04}" for k in range(em.BLOCK + 500)]
    rows = [(i, names[i % 5 :: 5] + names[: 40 * (i % 2)]) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>")
    found = {r.word: np.array(r.vector) for r in em.word_vectors(em.fit_word2vec(docs, 8, epochs=2)).collect()}
    assert sorted(found) == names and {len(v) for v in found.values()} == {8}
    order = sorted(names, key=lambda w: (-sum(r[1].count(w) for r in rows), w))
    began = np.concatenate([em.first_vectors(0, em.BLOCK, 8, 42), em.first_vectors(1, 500, 8, 42)])
    moved = [np.abs(found[w] - began[k]).max() for k, w in enumerate(order)]
    assert np.isfinite(moved).all() and min(moved) > 0 and max(moved) < 5


def test_scatter_sets_topics_apart(spark, monkeypatch):
    no_driver_model(monkeypatch)
    docs = topics(spark)
    vectors = em.word_vectors(em.fit_word2vec(docs, 16, epochs=4, partitions=3))
    at = {r.word: r.x for r in em.embedding_scatter(vectors, em.frequent_words(docs, 20)).collect()}
    assert set(at) == {r.word for r in em.frequent_words(docs, 20).collect()} and len(at) == 20
    a, b = ([x for word, x in at.items() if word[0] == t] for t in "ab")
    assert max(a) < min(b) or max(b) < min(a)


def test_finished_shuffles_and_older_vectors_go(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    kept = Path(locate(shared_dir(spark))[1], "textlake")
    old = set(kept.glob("*/part-*")) if kept.exists() else set()
    found = em.word_vectors(em.fit_word2vec(topics(spark), 8, epochs=3))
    left = {path.parent.name.split("-")[0] for path in set(kept.glob("*/part-*")) - old}
    assert left == {"vectors"} and found.count() == 24
    assert len({path.parent for path in set(kept.glob("*/part-*")) - old}) == 1
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF, None) == before


def test_documents_of_odd_kinds(spark):
    rows = [(0, None), (1, []), (2, ["lone"] * 1), (3, ["x", None, "y"]), (4, ["x", "y"] * 1200)] + [(5, ["lone"])] * 4
    docs = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>")
    found = {r.word: r.vector for r in em.word_vectors(em.fit_word2vec(docs, 4, epochs=2)).collect()}
    assert set(found) == {"lone", "x", "y"}
    assert np.allclose(found["lone"], em.first_vectors(0, 3, 4, 42)[2])  # no neighbours: as it began
    one = em.word_vectors(em.fit_word2vec(docs.where("doc_id in (2, 5)"), 4)).collect()
    assert [r.word for r in one] == ["lone"]
    with pytest.raises(ValueError):
        em.fit_word2vec(docs.where("doc_id < 2"), 4)
