"""Periodic runs of words, found by minimizers at several scales.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) and length at least max(6, 4q), that no neighbouring word extends
with period q. A word is dropped when some run holds it after that run's first q
words; what stays is the collapsed text.

Method. Words become integer codes (equal words, equal codes). Periods below
``2 ** SHORT_SCALE`` are found by direct lag scans: for each such lag the
stretches of equal words that far apart. Longer periods go by scale: at scale s
every window of ``2 ** s`` words picks its minimizer, the position of the word
with the smallest hash (leftmost on ties); the windows come from a doubling
table of minima, one vectorised pass per scale. Inside a run of period q >= 2 ** s
the windows at i and i + q hold the same words, so their minimizers are equal
words exactly q apart. Pairs of selected positions with equal words whose distance
lies in [2 ** s, 2 ** (s + 1)) therefore name every period of that scale; each
named lag is verified by comparing the words that far apart, which also gives
the run's exact bounds. A stretch is kept only if no proper divisor of its lag
is a period of it, so every run is reported once, with its smallest period.
A pair that lies inside an already found run of a shorter period p is skipped
when p divides its lag: q + 1 words of period p | q inside a run of period q
would give that run period p, so no pair of a true run is ever skipped. This
keeps long runs of short periods from naming every multiple of their period.
Nothing is capped; the result is exact.

Defined results: a null or empty text has no words, no runs and an empty
collapsed text; a text without runs keeps all its words; repeated rows give
equal results; an empty table gives an empty result. With ``plant`` (the
contract's test rule) the words of a document whose unsigned crc32 of the
decimal id h has h % 10 == 0 are first made periodic from word a = g % n on,
with period 1 + (n - a) // (3 + g % 8), g = h // 10; a null id plants nothing.
Columns of the input pass through; those named like an output are replaced.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHORT_SCALE = 3
MIN_LENGTH, MIN_EXPONENT = 6, 4

RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])
RESULT = StructType([
    StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType()),
])
OUTPUTS = tuple(field.name for field in RESULT.fields)


def planted(words: list[str], doc_id: str | None) -> list[str]:
    """The contract's test rule: a periodic tail for one id (decimal text) in ten."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(doc_id.encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _prime_factors(d: int) -> list[int]:
    out, f = [], 2
    while f * f <= d:
        if d % f == 0:
            out.append(f)
            while d % f == 0:
                d //= f
        f += 1
    return out + ([d] if d > 1 else [])


def _runs_at_lag(codes: np.ndarray, d: int) -> list[tuple[int, int, int]]:
    """Maximal stretches of period d, long enough, whose smallest period is d."""
    n = len(codes)
    if d <= 0 or n - d <= 0:
        return []
    eq = np.concatenate(([False], codes[:-d] == codes[d:], [False]))
    edges = np.flatnonzero(eq[1:] != eq[:-1])
    starts, ends = edges[0::2], edges[1::2]  # eq[start:end] all true
    need = max(MIN_LENGTH, MIN_EXPONENT * d) - d
    found = []
    for a, b in zip(starts[ends - starts >= need].tolist(), ends[ends - starts >= need].tolist()):
        length = b - a + d
        part = codes[a : a + length]
        if not any(np.array_equal(part[: length - d // r], part[d // r :]) for r in _prime_factors(d)):
            found.append((a, length, d))
    return found


def _cover(codes: np.ndarray, runs: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per position, of the found runs starting there or before, the one reaching furthest:
    its end, its period, and whether the words of its period are all different."""
    n = len(codes)
    end, period, plain = np.zeros(n, np.int64), np.ones(n, np.int64), np.zeros(n, bool)
    for start, length, q in sorted(runs):
        later = np.flatnonzero(end[start : start + length] < start + length) + start
        end[later], period[later] = start + length, q
        plain[later] = len(np.unique(codes[start : start + q])) == q
    return end, period, plain


def find_runs(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs of a code sequence as (start, length, period), by start, then period."""
    n = len(codes)
    runs: list[tuple[int, int, int]] = []
    for d in range(1, min(2**SHORT_SCALE, n // MIN_EXPONENT + 1)):
        runs += _runs_at_lag(codes, d)
    if n < MIN_EXPONENT * 2**SHORT_SCALE:
        return sorted(runs, key=lambda r: (r[0], r[2]))
    hashed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    low = np.arange(n, dtype=np.uint64)
    minima = (hashed << np.uint64(32)) | low
    for s in range(1, SHORT_SCALE + 1):  # windows of 2 ** s words
        half = 1 << (s - 1)
        minima = np.minimum(minima[:-half], minima[half:])
    s = SHORT_SCALE
    while (1 << s) * MIN_EXPONENT <= n:
        width = 1 << s
        end, period, plain = _cover(codes, runs)
        chosen = np.unique((minima & np.uint64(0xFFFFFFFF)).astype(np.int64))
        chosen = chosen[~((end[chosen] >= chosen + 2 * width) & plain[chosen])]
        order = np.lexsort((chosen, codes[chosen]))
        pos, word = chosen[order], codes[chosen][order]
        key = word * np.int64(2 * n + 2) + pos
        lo = np.searchsorted(key, key + width)
        hi = np.searchsorted(key, key + 2 * width)
        lags: set[int] = set()
        for at in np.flatnonzero(hi > lo).tolist():
            m = int(pos[at])
            d = pos[lo[at] : hi[at]] - m
            lags.update(d[~((end[m] > m + d) & (d % period[m] == 0))].tolist())
        for d in sorted(lags):
            runs += _runs_at_lag(codes, d)
        s += 1
        if (1 << s) * MIN_EXPONENT <= n:
            minima = np.minimum(minima[: -(1 << (s - 1))], minima[1 << (s - 1) :])
    return sorted(set(runs), key=lambda r: (r[0], r[2]))


def detect_words(words: list[str]) -> tuple[list[tuple[int, int, int]], list[str]]:
    """Runs of a word list and the words that stay."""
    if not words:
        return [], []
    codes = pd.factorize(pd.Series(words, dtype=object))[0].astype(np.int64)
    runs = find_runs(codes)
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    gone = np.cumsum(drop[:-1]) > 0
    return runs, [w for w, g in zip(words, gone.tolist()) if not g]


def _detect(plant: bool):
    @pandas_udf(RESULT)
    def run(keys: pd.Series, texts: pd.Series) -> pd.DataFrame:
        out = []
        for key, text in zip(keys, texts):
            words = WORD.findall(text) if isinstance(text, str) else []
            if plant:
                words = planted(words, key if isinstance(key, str) else None)
            runs, kept = detect_words(words)
            out.append((len(words), [dict(start=a, length=b, period=c) for a, b, c in runs], " ".join(kept)))
        return pd.DataFrame(out, columns=list(OUTPUTS))

    return run


def detect(docs: DataFrame, text: str = "text", key: str = "doc_id", plant: bool = False) -> DataFrame:
    """``docs`` with n_words, runs (start, length, period by start, then period) and collapsed text."""
    found = _detect(plant)(F.col(key).cast("string"), F.col(text))
    return (docs.withColumn("_periodic", found).drop(*OUTPUTS)
            .select("*", *[F.col("_periodic")[name].alias(name) for name in OUTPUTS]).drop("_periodic"))


def best_run(runs: Column) -> Column:
    """The run with the greatest length / period; ties to the smaller start, then period."""
    ordered = F.array_sort(runs, lambda a, b: F.when(
        a["length"] * b["period"] != b["length"] * a["period"],
        F.when(a["length"] * b["period"] > b["length"] * a["period"], -1).otherwise(1),
    ).when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
        .otherwise(F.signum(a["period"] - b["period"]).cast("int")))
    return F.get(ordered, 0)


def runs_digest(runs: Column) -> Column:
    """sha256 of every run's ``start,length,period`` and a line feed, by start, then period."""
    ordered = F.array_sort(runs, lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"]))
                           .otherwise(F.signum(a["period"] - b["period"])).cast("int"))
    lines = F.transform(ordered, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise("")), 256)

