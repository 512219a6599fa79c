"""Periodic runs against an exhaustive scan of every lag."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlake.llm import periodic_runs


def smallest_period(seq):
    fail, k = [0] * len(seq), 0
    for i in range(1, len(seq)):
        while k and seq[i] != seq[k]:
            k = fail[k - 1]
        k += seq[i] == seq[k]
        fail[i] = k
    return len(seq) - fail[-1]


def brute_runs(words):
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j - i + q
            if length >= max(6, 4 * q) and smallest_period(words[start : start + length]) == q:
                found.add((start, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    if best is not None:  # exact comparison of ratios
        top = [r for r in runs if r[1] * best[2] == best[1] * r[2]]
        best = min(top, key=lambda r: (r[0], r[2]))
    return (
        doc_id, len(runs), *(best if best else (None, None, None)), best[1] * 1000 // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_an_exhaustive_scan(seed):
    rng = random.Random(seed)
    for _ in range(40):
        alphabet = rng.choice([2, 3, 5, 40])
        words = [str(rng.randrange(alphabet)) for _ in range(rng.randrange(0, 300))]
        for _ in range(rng.randrange(0, 4)):  # planted repeats of any period
            q, at = rng.randrange(1, 40), rng.randrange(0, len(words) + 1)
            block = [str(rng.randrange(alphabet + 3)) for _ in range(q)]
            words[at:at] = block * rng.randrange(2, 7) + block[: rng.randrange(q)]
        runs, kept = periodic_runs.detect_words(words)
        assert runs == brute_runs(words), (seed, words)


def test_long_runs_of_short_periods_stay_linear():
    words = ["ha"] * 20000 + ["x", "y"] * 5000
    runs, kept = periodic_runs.detect_words(words)
    assert runs == [(0, 20000, 1), (20000, 10000, 2)]
    assert kept == ["ha", "x", "y"]


def test_codes_from_a_doubling_table_find_long_periods():
    rng = np.random.default_rng(5)
    block = rng.integers(0, 10**6, 997)
    codes = np.concatenate([rng.integers(0, 10**6, 50), np.tile(block, 5), rng.integers(0, 10**6, 20)])
    runs = periodic_runs.find_runs(codes)
    assert (50, 997 * 5, 997) in runs


TEXTS = [
    (1, "a b a b a b a b c"), (2, None), (3, ""), (4, "  \n "), (10, " ".join("w%d" % (i % 3) for i in range(40))),
    (7, "x " * 3000 + "tail"), (7, "x " * 3000 + "tail"), (None, "z z z z z z z"),
] + [(i, " ".join(f"t{(i * j) % 17}" for j in range(60 + i))) for i in range(20, 60)]


def test_query_columns_equal_brute_force(spark):
    docs = spark.createDataFrame(
        [(i, t, 5, "clash") for i, t in TEXTS], "doc_id long, text string, runs int, collapsed string").repartition(3)
    found = periodic_runs.detect(docs, plant=True).select(
        "doc_id", "runs", "collapsed", periodic_runs.best_run(F.col("runs")).alias("best"))
    got = found.select(
        "doc_id", F.size("runs").cast("long"), "best.start", "best.length", "best.period",
        F.expr("(best.length * 1000) div best.period"), periodic_runs.runs_digest(F.col("runs")),
        F.sha2(F.col("collapsed"), 256)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute(i, t) for i, t in TEXTS), key=repr)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in TEXTS if i is not None)
    assert periodic_runs.detect(docs.filter("false"), plant=True).count() == 0
