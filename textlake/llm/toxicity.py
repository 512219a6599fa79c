"""Toxicity by a support vector machine on a subsequence string kernel.

The kernel of two words counts the three-letter subsequences they share, gaps
allowed within a span of five letters and each gap letter at a discount, so that
an insult with letters dropped in or left out still resembles itself. Word ends
count as letters. Landmark words give Nyström features for a linear machine with
squared hinge loss. Single words are classified, not sentences: a document speaks
through its most suspicious word, and the machine is trained in rounds on those
words of toxic documents against words of clean ones, the worst of each among
them. Insults gapped by blanks, and sentences that are toxic although each of
their words is harmless, are not found. As the kernel is a sum over subsequences, landmarks and machine fold
into one weight per subsequence, and scoring reads a text once.

A document's score is the calibrated score of its worst word.

The classifier is fitted in the driver on a bounded sample: at most
``per_label`` documents of each label of at most ``longest`` characters, and on at
most ``CLEAN_WORDS`` words of all clean ones besides the worst.

Defined results: a null, empty or blank text scores like a text without any
suspicious word; repeated rows score alike; an empty table gives no rows; without
documents of both labels the score is the share of the label that there is,
with one pseudo-document of each; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

PER_LABEL, LONGEST = 2500, 20_000
#: Hashed subsequences, landmarks, and letters of a word that are looked at together.
BITS, LANDMARKS, WINDOW = 18, 300, 32
DISCOUNT = 0.6
#: A word of clean texts may stand for toxic ones if these have it so many times as often.
RATIO = 4.0
#: Different words of clean texts that train besides their worst ones.
CLEAN_WORDS = 6000
#: Distances between the three letters.
GAPS = ((1, 1), (1, 2), (2, 1), (1, 3), (3, 1), (2, 2))
_M = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]
_WHITE = np.array([9, 10, 11, 12, 13, 32], np.uint32)


@dataclass
class Letters:
    """Letters of several texts, their words, and the words' texts."""

    codes: np.ndarray
    word: np.ndarray  # of each letter; ends belong to no word of their own
    size: np.ndarray  # letters of each word with its ends
    first: np.ndarray  # where each word begins
    text: np.ndarray  # of each word


def letters(texts: list[str | None]) -> Letters:
    joined = "".join(f" {(t or '').lower()} " for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).copy()
    white = np.isin(codes, _WHITE) if codes.max(initial=0) < 33 else (codes <= 32) & np.isin(codes, _WHITE)
    codes[white] = 32
    inside = ~white
    begin = inside & np.concatenate([[True], white[:-1]])
    place = np.arange(len(codes)) - np.maximum.accumulate(np.where(begin, np.arange(len(codes)), 0))
    begin |= inside & (place % WINDOW == 0)
    first = np.flatnonzero(begin)
    word = np.where(inside, np.cumsum(begin) - 1, -1)
    size = np.bincount(word[inside], minlength=len(first)) + 2
    edges = np.cumsum([len((t or "").lower()) + 2 for t in texts])
    return Letters(codes, word, size, first, np.searchsorted(edges, first, side="right"))


def subsequences(x: Letters) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(word, hashed subsequence, weight) for each pair of gaps."""
    n = len(x.codes)
    white = np.concatenate([[0], np.cumsum(x.codes == 32)])
    parts = [x.codes * m for m in _M]
    for a, b in GAPS:
        if n <= a + b:
            continue
        # No white space between the first and the last letter; the ends themselves may be.
        whole = white[a + b : n] == white[1 : n - a - b + 1]
        key = (parts[0][: n - a - b] + parts[1][a : n - b] + parts[2][a + b :]) >> np.uint32(32 - BITS)
        yield x.word[a : n - b][whole], key[whole], DISCOUNT ** (a + b - 2)


def norms(size: np.ndarray) -> np.ndarray:
    """Length of the feature vector of a word of so many different letters."""
    total = sum(np.maximum(0, size - a - b) * DISCOUNT ** (2 * (a + b - 2)) for a, b in GAPS)
    return np.sqrt(np.maximum(total, 1e-9))


@dataclass
class Model:
    table: np.ndarray | None  # weight of each hashed subsequence
    bias: float
    slope: float
    offset: float

    def words(self, x: Letters) -> np.ndarray:
        total = np.zeros(len(x.size))
        if self.table is not None:
            for word, key, weight in subsequences(x):
                total += weight * np.bincount(word, self.table[key], len(x.size))
        return total / norms(x.size) + self.bias

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """Score of the worst word of each text; that of an unremarkable word where there is none."""
        x = letters(texts)
        out = np.full(len(texts), self.bias)
        if len(x.size):
            np.maximum.at(out, x.text, self.words(x))
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.worst(texts) + self.offset, -60, 60)))


def _features(words: list[str], columns: np.ndarray, n: int) -> np.ndarray:
    """Kernel features of words on the subsequences that ``columns`` numbers."""
    x = letters(words)
    out = np.zeros((len(words), n), np.float32)
    for word, key, weight in subsequences(x):
        column = columns[key]
        use = column >= 0
        np.add.at(out, (x.text[word[use]], column[use]), np.float32(weight))
    longest = np.zeros(len(words))
    np.maximum.at(longest, x.text, x.size)
    return out / norms(longest)[:, None].astype(np.float32)


def _kernel(words: list[str], landmarks: np.ndarray, columns: np.ndarray) -> np.ndarray:
    n = landmarks.shape[1]
    return np.vstack([np.zeros((0, len(landmarks)))] + [
        _features(words[at : at + 1000], columns, n) @ landmarks.T for at in range(0, len(words), 1000)])


def _squared_hinge(z: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float) -> np.ndarray:
    """Weights, the last one the bias, by Newton steps."""
    z = np.hstack([z, np.ones((len(z), 1))])
    w, ridge = np.zeros(z.shape[1]), np.ones(z.shape[1])
    ridge[-1] = 1e-3
    for _ in range(25):
        active = y * (z @ w) < 1
        za, ca = z[active], c * weight[active]
        gradient = ridge * w - za.T @ (ca * (y[active] - za @ w))
        step = np.linalg.solve(np.diag(ridge) + za.T @ (za * ca[:, None]), gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _logistic(g: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the calibration."""
    z, t = np.stack([g, np.ones(len(g))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ t, -30, 30)))
        hessian = z.T @ (z * (weight * p * (1 - p))[:, None]) + np.diag([1e-2, 1e-4])
        step = np.linalg.solve(hessian, z.T @ (weight * (p - y)) + np.array([1e-2, 1e-4]) * t)
        t = t - step
        if np.abs(step).max() < 1e-8:
            break
    return float(t[0]), float(t[1])


def fit_texts(texts: list[str], toxic: np.ndarray, prior: float, rounds: int = 4, seed: int = 7, clean_words: int = CLEAN_WORDS) -> Model:
    """The model of labelled texts; ``prior`` is the share of toxic ones they stand for.

    Besides the worst words of clean texts, ``clean_words`` of all their words, those
    with the smallest hashes, teach what is clean.
    """
    rng = np.random.default_rng(seed)
    part = np.arange(len(texts)) % 4 == 3  # a quarter calibrates
    if toxic[part].sum() < 5 or toxic[~part].sum() < 5:
        part = np.zeros(len(texts), bool)
    own = np.flatnonzero(~part)
    pos, neg = own[toxic[own] == 1], own[toxic[own] == 0]
    # How much more often a subsequence is met in toxic texts.
    met = np.zeros((2, 1 << BITS))
    for i in own:
        keys = np.unique(np.concatenate([k for _, k, _ in subsequences(letters([texts[i]]))] or [np.zeros(0, np.uint32)]))
        met[int(toxic[i]), keys] += 1
    odds = np.log((met[1] + 0.5) / (len(pos) + 1)) - np.log((met[0] + 0.5) / (len(neg) + 1))
    rare = met.sum(0) < 2
    table = np.where(rare, np.minimum(odds, 0), odds)
    model = Model(table.astype(np.float32), 0.0, 1.0, 0.0)

    in_toxic, in_clean = (
        Counter(p for i in side for p in {w[at : at + WINDOW] for w in (texts[i] or "").lower().split() for at in range(0, len(w), WINDOW)})
        for side in (pos, neg))

    def innocent(word: str) -> bool:
        """Whether clean texts have a word about as often as toxic ones; a few of them may be mislabelled or quote it."""
        n = in_clean[word]
        return n > 0 and (in_toxic[word] + 0.5) / (len(pos) + 1) < RATIO * (n + 0.5) / (len(neg) + 1)

    def worst_words(which: np.ndarray, most: int, new: bool = False) -> list[list[str]]:
        """The worst words of each text; ``new``: of those that are not ``innocent``."""
        out = []
        for i in which:
            x = letters([texts[i]])
            value = model.words(x)
            chars, found = (texts[i] or "").lower(), []
            for k in np.argsort(-value, kind="stable"):
                word = chars[x.first[k] - 1 : x.first[k] + x.size[k] - 3]
                if not (new and innocent(word)):
                    found.append(word)
                if len(found) == most:
                    break
            out.append(found)
        return out

    clean = [w for w in in_clean if innocent(w)]
    clean = sorted(clean, key=lambda w: (zlib.crc32(w.encode("utf-8", "replace")), w))[:clean_words]
    hard: list[str] = []
    for _ in range(rounds):
        found = [ws[0] for ws in worst_words(pos, 1, new=True) if ws]
        hard += [w for ws in worst_words(neg, 2) for w in ws]
        names, counts = np.unique(np.array(found, dtype=object).astype(str), return_counts=True)
        order = np.argsort(-counts, kind="stable")
        marks = [*names[order][: LANDMARKS * 2 // 3], *rng.permutation(np.array(hard + clean[:200], dtype=object).astype(str))[: LANDMARKS // 3]]
        marks = list(dict.fromkeys(marks))
        x = letters(marks)
        keys = np.unique(np.concatenate([k for _, k, _ in subsequences(x)]))
        columns = np.full(1 << BITS, -1)
        columns[keys] = np.arange(len(keys))
        landmarks = _features(marks, columns, len(keys))
        value, vector = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
        good = value > 1e-6 * value.max()
        root = vector[:, good] / np.sqrt(value[good])
        bad, often = np.unique(np.array(hard, dtype=object).astype(str), return_counts=True)
        words = [*names, *bad, *clean]
        z = _kernel(words, landmarks, columns) @ root
        y = np.concatenate([np.ones(len(names)), -np.ones(len(bad) + len(clean))])
        weight = np.concatenate([counts / counts.sum(), 2 * often / often.sum(), np.full(len(clean), 1 / max(1, len(clean)))]) * len(own)
        w = _squared_hinge(z, y, weight, 1.0)
        table = np.zeros(1 << BITS, np.float32)
        table[keys] = landmarks.T @ (root @ w[:-1])
        model = Model(table, float(w[-1]), 1.0, 0.0)
    held = np.flatnonzero(part) if part.any() else own
    g, y = model.worst([texts[i] for i in held]), toxic[held].astype(float)
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    slope, offset = _logistic(g, y, weight)
    return Model(table, model.bias, max(slope, 0.0), offset)


def fit(
    labelled: DataFrame, texts: DataFrame | None = None, per_label: int = PER_LABEL, longest: int = LONGEST,
) -> Model:
    """Fit on a sample of (doc_id, text, toxic), the ids with the smallest hashes.

    Texts of the sample are looked up in ``texts`` (doc_id, text) if given, so that
    no join moves the others.
    """
    usable = labelled.filter("doc_id is not null and toxic in (0, 1)")
    counts = {int(r["toxic"]): r["count"] for r in usable.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    prior = (counts.get(1, 0) + 1) / (total + 2)
    short = usable.filter(F.length("text") <= longest).select("doc_id", "toxic")
    drawn = None
    for label in (0, 1):
        one = short.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        drawn = one if drawn is None else drawn.union(one)
    ids = {(r["doc_id"], int(r["toxic"])) for r in drawn.collect()}
    if not {0, 1} <= {label for _, label in ids}:
        return Model(None, 0.0, 0.0, float(np.log(prior / (1 - prior))))
    spark = labelled.sparkSession
    label_of = {i: label for i, label in sorted(ids)}
    wanted = F.broadcast(spark.createDataFrame([(i,) for i in label_of], labelled.select("doc_id").schema))
    found = (labelled if texts is None else texts).select("doc_id", "text").join(wanted, "doc_id")
    rows = found.filter(F.length("text") <= longest).dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: (hash(r["doc_id"]) * 2654435761 % 2**32, r["doc_id"]))
    return fit_texts([r["text"] for r in rows], np.array([label_of[r["doc_id"]] for r in rows]), prior)


def score_of(docs: DataFrame, model: Model) -> Column:
    """The score of ``text``, row by row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        texts = text.tolist()
        parts = [shared.value.score(texts[at : at + 32]) for at in range(0, len(texts), 32)]
        return pd.Series(np.concatenate([np.zeros(0), *parts]))

    return scored("text")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    texts = docs.select("doc_id", "text")
    return texts.select("doc_id", score_of(texts, model).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
