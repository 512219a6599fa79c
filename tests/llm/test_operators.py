"""Operators for training data against brute force on small tables."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from textlake.llm import (
    attention, byte_bpe, dart_minhash, line_dedup, lm_scoring, mixing, passages, pivot_search, simple8b, token_files, toxicity,
    vector_graph, warc,
)

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PASSAGE = " ".join(f"w{i}" for i in range(60))
LONG = " ".join(f"term{i % 97}x{i}" for i in range(4000))
TEXTS = [
    (0, f"First line of it\n{PASSAGE}\n" + " ".join(f"end{i}" for i in range(40)), "a"), (1, PASSAGE + "\nsomething of its own, here", "b"),
    (2, None, "a"), (3, "", None), (4, "  \t\n ", None), (5, "Tie text one two three four", "b"),
    (6, "Tie text one two three four", "b"), (6, "Tie text one two three four", "b"), (7, LONG, "c"),
    (8, LONG.replace("term5x", "changed"), "c"), (9, "é x ́ 世界 don't 12", "d"), (None, "a row without an id at all", "d"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", s, len(t or ""), 1, "x", 2, 3, 4) for i, t, s in TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id long, size string, copies int, "
        "removed int, component int").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def test_byte_bpe(docs, none):
    ranks = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=byte_bpe.codec(RANKS, public_tokenizers.PATTERN)._encoding._mergeable_ranks)
    got = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, chunk=500, overlap=40).collect()
    expected = []
    for key, text, _ in TEXTS:
        ids = ranks.encode_ordinary(text or "")
        expected.append((key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert byte_bpe.encode_documents(none, RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("text", ["a" * 300, "ab  cd\n\n  ef " * 20, "x's  y've 12 " * 15, " " * 90, "世 é's\t\n" * 25])
@pytest.mark.parametrize("chunk,overlap", [(7, 3), (16, 16), (5, 1)])
def test_chunks_are_stitched_to_the_pieces_of_the_whole(text, chunk, overlap):
    model = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    n = -(-len(text) // chunk)
    parts = [text[k * chunk : (k + 1) * chunk + overlap] for k in range(n)]
    chunks = [(k * chunk, p, byte_bpe.boundaries(model.pieces(p), k * chunk, k == n - 1)) for k, p in enumerate(parts)]
    assert [p for pieces in byte_bpe.stitch(chunks, model) for p in pieces] == model.pieces(text)


def test_simple8b_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 59, 1024, 1025, 5000):
        for most in (1, 2, 50_000, 2**40, 2**64 - 1):
            values = rng.integers(0, most, n, dtype=np.uint64, endpoint=True)
            words, offsets = simple8b.encode(values)
            assert (simple8b.decode(words, offsets, n) == values).all()


def test_word_ids_equal_the_whole_tokenizer():
    whole, by_word, rng = Tokenizer.from_file(WORDS), token_files.WordIds(WORDS), random.Random(1)
    letters = "abcXYZ'''stdlmrev 019.,;|<>-_éÉ×İıǅǆŉɏſßÿµ’\t\n\x01\u0301中"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["DON'T we'Re 'ſs x<|endoftext|>y <|startoftext|> ΣΑΣ Ⅷ ²½", *(f"a{chr(c)}b" for c in range(33, 0x250))]
    want = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert by_word.encode(texts) == want


def test_token_files(docs, none):
    tokenizer = Tokenizer.from_file(WORDS)
    got = sorted(map(tuple, token_files.read(token_files.write(docs, WORDS)).collect()), key=lambda r: r[1])
    start, expected = 0, []
    for key, text, _ in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        expected.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == expected
    assert token_files.read(token_files.write(none, WORDS)).count() == 0


def test_warc(spark):
    big = "<p>" + "word " * 3000
    rows = [(1, "http://a/ b", big), (2, None, big), (3, "u\n", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""),
            (1, "http://a/ b", big), (None, "u", big), (9, "u", "é" * 90)]
    pages = spark.createDataFrame([(*r, 7) for r in rows], "page_id long, url string, html string, refers_to int").repartition(2)
    table = warc.read(warc.write(warc.record_chunks(pages, chunk=1000)), chunk=700).cache()
    last = [tuple(r) for r in table.filter("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        later = len(data) >= 100 and page is not None and page > min(same)
        expected.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if later else "response", min(same) if later else None))
    assert sorted(last, key=str) == sorted(expected, key=str)
    joined = table.filter("page_id = 9").orderBy("chunk").collect()
    assert b"".join(r["bytes"] for r in joined) == ("é" * 90).encode()
    assert table.filter("last and record_type = 'response' and not intact").count() == 0
    assert warc.read(warc.write(warc.record_chunks(pages.filter("false")))).count() == 0


def test_mixing(docs, none, spark):
    got = mixing.mix(docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(k) for k, _, _ in TEXTS)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    rows = [(i, "w " * (1 + i * 7 % 90), f"s{i % 5}") for i in range(900)]
    many = spark.createDataFrame(rows, "doc_id long, text string, source string")
    result = mixing.mix(many).toPandas()
    for _, part in result.groupby("source"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) < 100
    assert (mixing.mix(many.repartition(5)).toPandas().set_index("doc_id")["taken"].sort_index() == result.set_index("doc_id")["taken"].sort_index()).all()
    total, sizes = result["size"].sum(), result.groupby("source")["size"].sum()
    weight, capped = dict(zip(sorted(sizes.index), [1, 2, 3, 1, 2])), {}
    while True:
        level = (total - sum(capped.values())) / sum(w for s, w in weight.items() if s not in capped)
        over = {s: 3.0 * sizes[s] for s in weight if s not in capped and level * weight[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    for source, part in result.groupby("source"):
        assert part["target"].iloc[0] == pytest.approx(capped.get(source, level * weight[source]))
    assert mixing.mix(none).count() == 0


def test_line_dedup(docs, none):
    got = {(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert (0, TEXTS[0][1]) in got and (1, "something of its own, here") in got
    assert (2, None) in got and (3, "") in got and (5, TEXTS[5][1]) in got and (6, "") in got
    assert line_dedup.dedup_lines(docs).filter("doc_id = 1").first()["removed"][0].asDict() == {"start": 0, "end": len(PASSAGE) + 1}
    assert line_dedup.dedup_lines(none).count() == 0


def _shingles(text):
    words = (text or "").lower().encode().split()
    n, seen, out = min(5, len(words)), Counter(), set()
    for i in range(len(words) - n + 1 if words else 0):
        key = tuple(words[i : i + n])
        out.add((key, seen[key]))
        seen[key] += 1
    return out


def test_near_duplicates(docs, none, spark):
    got = {(r["doc_id"], r["class_id"]) for r in dart_minhash.near_duplicates(docs).collect()}
    assert {(2, 2), (3, 2), (4, 2), (5, 5), (6, 5), (7, 7), (0, 0), (1, 1), (9, 9), (None, None)} <= got
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(12):
        base = [f"v{x}" for x in rng.integers(0, 500, 120)]
        for k in range(25):
            words = list(base)
            for place in rng.integers(0, len(words), k % 9):
                words[place] = f"new{rng.integers(0, 10**9)}"
            texts.append(" ".join(words))
    sets, low = [_shingles(t) for t in texts], list(range(len(texts)))
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    names = vector_graph.forest(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]), len(low))
    found = dart_minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == dict(enumerate(names.tolist()))
    assert dart_minhash.near_duplicates(none).count() == 0


def test_blocks_of_a_pool_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(dart_minhash, "BLOCK", 4)
    base = [f"v{i}" for i in range(200)]
    texts = [" ".join(base[: i * 3] + [f"c{i}"] + base[i * 3 + 1 :]) for i in range(30)]
    found = dart_minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["class_id"] for r in found.collect()} == {0}


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    names = rng.integers(0, 2**63, 90, dtype=np.uint64)
    a, b = np.repeat(names[:70], rng.integers(1, 9, 70)), np.repeat(names[20:], rng.integers(1, 9, 70))
    ca, cb = Counter(a.tolist()), Counter(b.tolist())
    real = sum((ca & cb).values()) / sum((ca | cb).values())
    one, two = dart_minhash.signatures([a, b], 3000)
    assert abs((one == two).mean() - real) < 0.04


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    rows = []
    for label in (1, 2):
        for _ in range(40):
            base = rng.normal(size=16)
            for _ in range(rng.integers(1, 12)):
                rows.append(([float(x) for x in base + rng.normal(size=16) * 0.12], label))
    rows += [(rows[0][0], 1), ([0.0] * 16, 1), (None, 1), ([1.0, None] + [0.0] * 14, 1), ([float("nan")] * 16, 2), (rows[3][0], None), ([1.0], 1), ([], 1)]
    rows = [(i, v, label, "x") for i, (v, label) in enumerate(rows)]
    rows.append((None, rows[1][1], 1, "x"))
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, unit string")


def test_vector_graph(vectors, monkeypatch):
    monkeypatch.setattr(vector_graph, "CELL", 60)
    rows = [r for r in vectors.collect() if r["vec_id"] is not None]
    usable = [r for r in rows if r["label"] is not None and r["embedding"] and None not in r["embedding"]
              and np.isfinite(r["embedding"]).all() and any(r["embedding"])]
    links = [(a["vec_id"], b["vec_id"]) for a in usable for b in usable
             if a["vec_id"] != b["vec_id"] and a["label"] == b["label"] and len(a["embedding"]) == len(b["embedding"])
             and np.dot(a["embedding"], b["embedding"]) / np.linalg.norm(a["embedding"]) / np.linalg.norm(b["embedding"]) >= 0.93]
    low = vector_graph.forest(np.array([a for a, _ in links]), np.array([b for _, b in links]), len(rows))
    count = Counter(a for a, _ in links)
    # The row without an id is no vector to link with, though another has its components.
    got = {r["vec_id"]: r for r in vector_graph.near_vectors(vectors).collect() if r["vec_id"] is not None}
    right = sum(got[r["vec_id"]]["n_links"] == count[r["vec_id"]] and got[r["vec_id"]]["component_id"] == low[r["vec_id"]] for r in rows)
    found = sum(min(got[k]["n_links"], n) for k, n in count.items())
    assert found >= 0.98 * sum(count.values()) and right >= 0.97 * len(rows)
    assert all(got[k]["n_links"] <= count[k] for k in got)
    assert vector_graph.near_vectors(vectors.filter("false")).count() == 0


def test_pivot_search(vectors, spark):
    rows = [(r["vec_id"], np.floor(1024 * np.array(r["embedding"] + [0.0] * (16 - len(r["embedding"])))).astype(int)) for r in vectors.collect()
            if r["vec_id"] is not None and r["embedding"] is not None and None not in r["embedding"] and np.isfinite(r["embedding"]).all()]
    expected = []
    for key, q in rows:
        if key % 100 == 0:
            best = sorted(((-int(q @ v), other) for other, v in rows if other != key))[:10]
            expected += [(key, i + 1, other, -s) for i, (s, other) in enumerate(best)]
    assert sorted(map(tuple, pivot_search.top_k(vectors).collect())) == sorted(expected)
    assert pivot_search.top_k(vectors.filter("vec_id = 3")).count() == 0


def test_toxicity(spark, docs, none):
    rng = np.random.default_rng(6)
    plain = ["ball", "tree", "house", "river", "cloud", "stone", "light", "paper", "green", "music"]
    rows = []
    for i in range(300):
        words = [str(w) for w in rng.choice(plain, 30)]
        if i % 3 == 0:
            words[int(rng.integers(0, 30))] = str(rng.choice(["scumbag", "moronic", "idiotic"]))
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    bad = ["the tree scumbag house", "green paper id-iotic cloud", "a moroniic stone", "such an idiotiic river"]
    good = ["tree house river", "", "   ", None, "cloud cloud cloud stone", "music in green light"]
    assert (model.score(bad) >= 0.5).all() and (model.score(good) < 0.5).all()
    scored = toxicity.score(docs, model)
    assert scored.count() == len(TEXTS) and scored.filter("score between 0 and 1").count() == len(TEXTS)
    assert toxicity.score(none, model).count() == 0
    assert toxicity.fit(none.select("doc_id", "text", F.lit(1).alias("toxic"))).score(["x"])[0] == pytest.approx(0.5)


def test_attention_scores_like_a_plain_loop():
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 40, n) for n in (50, 3, 80, 120)]
    count = np.bincount(np.concatenate(texts), minlength=60).astype(float)
    model = attention.train(texts, 59, count, steps=30)
    ids = np.concatenate([np.concatenate([[59], t]) for t in texts])
    goals = np.concatenate([np.append(t, 59) for t in texts])
    owner = np.repeat(np.arange(4), [len(t) + 1 for t in texts])
    fast = model.score(ids, goals, owner)
    for at in rng.integers(0, len(ids), 40):
        low = max(0, at // 16 * 16 - 16)
        keys = [k for k in range(low, at + 1) if owner[k] == owner[at]]
        s = np.array([model.query[ids[at]] @ model.key[ids[k]] + model.position[at - k] for k in keys])
        p = np.exp(s - s.max())
        context = (p / p.sum()) @ model.value[ids[keys]]
        logits = model.direct[ids[at]] + context @ model.output
        expected = logits[model.class_of[goals[at]]] - np.log(np.exp(logits).sum()) + model.log_in_class[goals[at]]
        assert fast[at] == pytest.approx(expected / np.log(10), abs=1e-4)
    # All that can follow adds up to one.
    total = sum(10 ** model.score(np.array([59, 5]), np.array([5, g]), np.zeros(2, int))[1] for g in range(60))
    assert total == pytest.approx(1, abs=1e-3)


def test_lm_scoring(docs, none):
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = lm_scoring.score_documents(docs, held, RANKS, public_tokenizers.PATTERN).collect()
    split = [(k, (t or "").encode().lower().split()) for k, t, _ in TEXTS]
    taught = [w for k, w in split if k is None or zlib.crc32(str(k).encode()) % 7 != 2]
    count = Counter(x for w in taught for x in [*w, None])
    n, v = sum(count.values()), len(count)
    expected = sorted((str(k), len(w) + 1, sum(count[x] > 0 for x in [*w, None]), n,
                       round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in [*w, None]), 6)) for k, w in split)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == expected
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert lm_scoring.score_documents(none, held, RANKS, public_tokenizers.PATTERN).count() == 0


def test_pipeline_stages(docs, none, spark, sf_dir):
    kept = corpus_pipeline.without_near_copies(spark, docs, sf_dir)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["0", "1", "2", "5", "7", "9", "None"] + (["8"] if kept.filter("doc_id = 8").count() else []))
    lines = corpus_pipeline.without_repeated_lines(spark, docs, sf_dir)
    assert lines.columns == list(corpus_pipeline.COLUMNS) and lines.count() == len(TEXTS)
    mix = corpus_pipeline.mixed(spark, docs, sf_dir)
    assert mix.columns == list(corpus_pipeline.COLUMNS) and mix.count() > 0
    clean = corpus_pipeline.clean(spark, docs, sf_dir)
    assert clean.count() == len(TEXTS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0


def test_pipeline_runs(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_language_model_learns_from_all_training_texts(spark, monkeypatch):
    # Texts that a bounded sample of short ones would not hold: over 20,000 characters, and many.
    first = "river stone cloud paper music light house green table water money night story world".split()
    second = "tree bird wind fire road door hand book game city food game king ship".split()
    rng = np.random.default_rng(12)
    rows = [(i, " ".join(f"{first[j]} {second[j]}" for j in rng.integers(0, 14, 2500)), 0) for i in range(6)]
    rows += [(i, "one plain short text", 0) for i in range(6, 30)] + [(90, " ".join(map(" ".join, zip(first, second))), 1)]
    docs, seen = spark.createDataFrame(rows, "doc_id long, text string, held int"), []
    monkeypatch.setattr(attention, "start", lambda f, c, *a, start=attention.start: seen.append((f, c)) or start(f, c, *a))
    got = lm_scoring.score_documents(docs, F.col("held") == 1, RANKS, public_tokenizers.PATTERN)
    row = got.filter("doc_id = 90").first()
    features, count = seen[0]
    assert len(rows[0][1]) > 20_000 and count.sum() > 6 * 5000 and (np.abs(features[count > 0]).sum(1) > 0).all()
    assert row["score"] > row["base_score"]


def test_averaged_rounds_of_several_tasks_learn(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "TURN", 60)
    rng = np.random.default_rng(13)
    rows = [(i, " ".join(f"a{j} b{j}" for j in rng.integers(0, 30, 200)), int(i % 5 == 0)) for i in range(60)]
    docs, calls = spark.createDataFrame(rows, "doc_id long, text string, held int"), []
    monkeypatch.setattr(lm_scoring, "trained", lambda *a, f=lm_scoring.trained: calls.append(a[1:3]) or f(*a))
    runs = [lm_scoring.score_documents(docs.repartition(n), F.col("held") == 1, RANKS, public_tokenizers.PATTERN)
            .toPandas().set_index("doc_id").sort_index() for n in (2, 7)]
    assert min(calls[0]) > 1
    assert np.allclose(runs[0]["score"], runs[1]["score"], rtol=1e-3)
    held = runs[0][runs[0]["held_out"]]
    assert held["score"].sum() > 0.75 * held["base_score"].sum()


def test_windows_hold_each_target_once():
    rng = np.random.default_rng(14)
    texts = [np.append(rng.integers(0, 50, n), 99) for n in (0, 15, 16, 17, 100)]
    text, block, found = attention.windows(np.concatenate(texts), np.array([len(t) for t in texts]), 99)
    for i, t in enumerate(texts):
        own = found[text == i][np.argsort(block[text == i])]
        targets = own[:, attention.STRIDE + 1 :].ravel()
        assert (targets[targets >= 0] == t).all()
        assert own[0, attention.STRIDE] == 99 and (own[0, : attention.STRIDE] == -1).all()


def test_toxicity_survives_mislabelled_clean_texts():
    rng = np.random.default_rng(15)
    plain, insults = [f"{a}{b}" for a in ("ba", "ri", "clo", "sto") for b in ("ll", "ver", "ud", "ne")], ["scumbag", "moronic", "idiotic"]
    texts, toxic = [], []
    for i in range(600):
        words = [str(w) for w in rng.choice(plain, 30)]
        if i % 3 == 0 or i < 40 and i % 3 == 1:  # clean by label, but for its insult
            words[int(rng.integers(0, 30))] = insults[i // 3 % 3]
        texts.append(" ".join(words))
        toxic.append(int(i % 3 == 0))
    model = toxicity.fit_texts(texts, np.array(toxic), 1 / 3)
    assert (model.score([f"the ball {w} river" for w in insults]) >= 0.5).all()
    assert (model.score(["ball river", "clone stone cloud", ""]) < 0.5).all()


def test_toxicity_learns_clean_words_from_whole_texts(monkeypatch):
    taught = set()
    monkeypatch.setattr(toxicity, "_kernel", lambda words, *a, f=toxicity._kernel: taught.update(words) or f(words, *a))
    texts = [" ".join(f"word{i}x{k}" for k in range(600)) for i in range(8)] + [f"a scumbag word{i}x1" for i in range(8)]
    toxicity.fit_texts(texts, np.repeat([0, 1], 8), 0.5)
    late = {f"word{i}x{k}" for i in range(8) for k in range(400, 600)}
    assert late <= taught


def test_words_of_texts_encoded_together_are_learnt_once(monkeypatch):
    model, learnt = token_files.WordIds(WORDS), []
    monkeypatch.setattr(model, "_ids_of_words", lambda words, f=model._ids_of_words: learnt.append(words) or f(words))
    texts = ["Oneday, the (old) don't 12 x1.", "  the oneday,\n", "", " \t", "the İ ẞ 中文 oneday, <x> É", "é! 'S a's"] * 40
    whole = Tokenizer.from_file(WORDS)
    for part in (texts, texts[::-1]):
        got = [np.frombuffer(x, "<u4").tolist() for x in model.encode(part)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in part]
    assert [len(set(x) - {""}) for x in learnt] == [len(set(" ".join(texts).split()))] * 2 and model.encode([]) == []
    monkeypatch.setattr(token_files, "TOGETHER", 10)
    assert list(token_files.runs_of(np.array([4, 6, 1, 30, 0, 0]))) == [(0, 2), (2, 3), (3, 4), (4, 6)]


def test_language_model_is_trained_on_every_window(spark, monkeypatch):
    # A corpus that counts as large: 16 windows to each of 40 texts, held out ones aside.
    monkeypatch.setattr(lm_scoring, "FULL_BYTES", 100, raising=False)
    rows = [(i, " ".join(["stone"] * (16 * attention.STRIDE - 1)), int(i % 4 == 0)) for i in range(40)]
    docs, seen = spark.createDataFrame(rows, "doc_id long, text string, held int"), []

    def trained(drawn, tasks, rounds, p, class_of, end):
        width = (attention.WIDTH + 1) * np.dtype(lm_scoring.stored_type(end)).itemsize
        seen.extend((r["n"], len(r["windows"]) // width) for r in drawn.collect())
        return p

    monkeypatch.setattr(lm_scoring, "trained", trained)
    lm_scoring.score_documents(docs, F.col("held") == 1, RANKS, public_tokenizers.PATTERN).count()
    assert sum(n for n, _ in seen) == 30 * 16 and all(n == stored for n, stored in seen)


def test_passages_inside_lines_go_where_an_earlier_document_has_them(spark, sf_dir):
    rng = random.Random(16)
    word = lambda: rng.choice("ab éé İx ẞ c, d. E 世界".split()) + str(rng.randrange(400))
    shared = [[word() for _ in range(n)] for n in (49, 50, 51, 120)]
    rows, blanks = [], [" ", "\n", "\t ", "\n\n"]
    for i in range(24):
        words = [word() for _ in range(rng.randrange(90))]
        for part in rng.sample(shared, 2):
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() if i % 2 and w.upper().lower() == w.lower() else w for w in part]
        rows.append((i % 23 if i < 23 else None, "".join(w + rng.choice(blanks) for w in words)))
    rows += [(30, "x " * 200), (31, None), (32, ""), (33, rows[4][1]), (33, rows[4][1])]
    split = [(k, (t or "").lower().encode().split()) for k, t in rows]
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0))
    seen, expected = {}, {}
    for r in order:
        key, words = split[r]
        own = [tuple(words[p : p + 50]) for p in range(len(words) - 49)]
        if gone := {p for p, w in enumerate(own) if seen.get(w, key) != key}:
            expected[key] = gone
        for w in own:
            seen.setdefault(w, key)
    docs = spark.createDataFrame([(k, t, None, None, 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["id"]: set(r["places"]) for r in passages.repeated_windows(docs.repartition(5)).collect()}
    assert found == expected and len(found) > 10
    kept = corpus_pipeline.without_repeated_lines(spark, docs, sf_dir)
    assert kept.count() == len(rows)
    before = {k: len(words) for k, words in split}
    left = {r["doc_id"]: len((r["text"] or "").split()) for r in kept.collect()}
    assert all(left[k] <= before[k] - 50 for k in expected)


def test_cut_passages_leave_the_lines_around_them():
    text = "a b c d\n e f\n\ng h\ni"
    places = passages.spans(text, [2, 3], 4)
    assert [text[s:e] for s, e in places] == ["c d\n e f\n\ng "] and not passages.spans(text, [], 4)
    rest, removed = line_dedup.remove_units(text, {4}, "\n", places)
    assert rest == "a b \nh" and [text[s:e] for s, e in removed] == ["c d", " e f\n", "\n", "g ", "i"]


def test_segments_hold_the_windows_of_their_blocks():
    rng = np.random.default_rng(17)
    for end in (50_256, 70_000):
        length = np.array([1, 15, 16, 17, 256, 257, 1000, 3])
        ids = np.concatenate([np.append(rng.integers(0, end, n - 1), end) for n in length])
        _, _, size, stream = attention.segments(ids, length, end)
        assert len(stream) < 1.5 * len(ids) + 17 * len(length)
        packed = lm_scoring.pack(size, stream, end)
        assert (attention.windows_of(*lm_scoring.unpack(packed, end)) == attention.windows(ids, length, end)[2]).all()
        assert attention.blocks_of(size).sum() == (-(-length // attention.STRIDE)).sum()


def test_first_embeddings_do_not_depend_on_ids_that_no_text_has():
    rng = np.random.default_rng(18)
    count, class_of = np.append(np.ones(30), np.zeros(5000)), np.zeros(5030, int)
    features = np.concatenate([rng.normal(size=(30, attention.DIM)), np.zeros((5000, attention.DIM))])
    got = attention.start(features, count, class_of)["embed"][:30]
    assert np.allclose(got, attention.start(features[:30], count[:30], class_of[:30])["embed"])


def test_score_of_a_text_depends_on_no_other():
    rng = np.random.default_rng(19)
    texts = [rng.integers(0, 40, n) for n in (5, 70, 33, 1, 48)]
    count = np.bincount(np.concatenate(texts), minlength=41) + 1
    model = attention.train(texts, 40, count, steps=60)

    def scores(order):
        goal = [np.append(texts[k], 40) for k in order]
        flat = np.concatenate(goal)
        of = np.repeat(order, [len(g) for g in goal])
        out = lm_scoring.apart(model, np.concatenate([[40], flat[:-1]]), flat, of)
        return np.bincount(of, out, len(texts))
    assert np.allclose(scores([0, 1, 2, 3, 4]), scores([3, 1, 4, 0, 2]), rtol=1e-6)
