"""Passages of many words that an earlier document has too, wherever they lie in a line.

A window is ``length`` words in a row, compared in lower case with white space collapsed.
A window goes if a document that ranks before (by id, then hash of the text) has the same
words; repeats inside one document alone stay.

Windows are many, so they meet in two steps. Each window has a key: the smallest hash of
the shingles of half its length in it. Equal windows have equal keys, and neighbours
mostly share theirs, so a document has about one key to a dozen words. Keys are counted
over all documents first. Only windows whose own key more than one document has are
compared by their 128-bit digests.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from textlake.llm.dart_minhash import _SPACE, _powers, mix, word_hashes
from textlake.llm.files import materialize

LENGTH = 50
#: Characters hashed together.
SLICE_CHARS = 1_000_000
_BASES = (0x5851F42D4C957F2D, 0xD1342543DE82EF95, 0x2545F4914F6CDD1D)
_WORD = re.compile(r"[^\t\n\x0b\x0c\r ]+")


def _slices(texts: list[str]) -> Iterator[slice]:
    at, size = 0, 0
    for k, text in enumerate(texts):
        if k > at and size + len(text) > SLICE_CHARS:
            yield slice(at, k)
            at, size = k, 0
        size += len(text)
    if texts:
        yield slice(at, len(texts))


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of the texts, number of its text)."""
    data = [t.lower().encode() for t in texts]
    begin = np.cumsum([0, *[len(d) + 1 for d in data[:-1]]])
    joined = b" ".join(data)
    space = _SPACE[np.frombuffer(b" " + joined, np.uint8)]
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    return word_hashes(joined), np.searchsorted(begin, starts, "right") - 1


def _rolled(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """One hash for each ``width`` words in a row."""
    n = len(words) - width + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(len(words), base), dtype=np.uint64)])
    return mix((sums[width:] - sums[:-width]) * _powers(n, pow(base, -1, 1 << 64)))


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    n, reach = len(x) - width + 1, 1
    while 2 * reach <= width:
        x, reach = np.minimum(x[:-reach], x[reach:]), 2 * reach
    return np.minimum(x[:n], x[width - reach :])


def windows(texts: list[str], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, number of the first word, key, two halves of the digest) of all windows, in order."""
    words, of = _words(texts)
    if len(words) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    half = max(1, length // 2)
    key = _smallest(_rolled(words, half, _BASES[0]), length - half + 1)
    whole = np.flatnonzero(of[: len(words) - length + 1] == of[length - 1 :])
    place = np.arange(len(words)) - np.searchsorted(of, of)
    high, low = _rolled(words, length, _BASES[1]), _rolled(mix(words + np.uint64(_BASES[0])), length, _BASES[2])
    return of[whole], place[whole], *[x[whole].view(np.int64) for x in (key, high, low)]


def spans(text: str, places: list[int], length: int) -> list[tuple[int, int]]:
    """(start, end) in characters of what windows at these places cover, with the blanks behind it."""
    starts = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out: list[tuple[int, int]] = []
    for place in sorted(places):
        start, end = starts[place], starts[place + length]
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, text_hash, places): per document the first words of its windows that go."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"), "text").filter("text is not null")

    def keys_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in _slices(batch["text"].tolist()):
                part = batch.iloc[at]
                of, _, key, _, _ = windows(part["text"].tolist(), length)
                if not len(of):
                    continue
                run = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (key[1:] != key[:-1])]))
                of, key = of[run], key[run]
                first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
                out = part.iloc[of[first]][["id", "text_hash"]]
                yield out.assign(keys=np.split(key, first[1:]))

    def windows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in _slices(batch["text"].tolist()):
                part = batch.iloc[at]
                of, place, key, high, low = windows(part["text"].tolist(), length)
                edge = np.searchsorted(of, np.arange(len(part) + 1))
                shared = np.zeros(len(of), bool)
                for k, keys in enumerate(part["keys"]):
                    shared[edge[k] : edge[k + 1]] = np.isin(key[edge[k] : edge[k + 1]], keys)
                out = part.iloc[of[shared]][["id", "text_hash"]]
                yield out.assign(place=place[shared].astype(np.int32), high=high[shared], low=low[shared])

    keyed = materialize(texts.mapInPandas(keys_of, f"id {kind}, text_hash long, keys array<long>"), "passage-keys")
    each = keyed.select("id", "text_hash", F.explode("keys").alias("key"))
    code = F.xxhash64("id", "text_hash")
    shared = materialize(
        each.groupBy("key").agg(F.min(code).alias("one"), F.max(code).alias("other")).filter("one != other").select("key"),
        "shared-keys")
    wanted = materialize(
        each.join(shared, "key").groupBy("id", "text_hash").agg(F.collect_set("key").alias("keys")), "documents-with-shared-keys"
    ).toDF("_id", "_hash", "keys")
    with_keys = texts.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    placed = materialize(
        with_keys.select("id", "text_hash", "text", "keys").mapInPandas(
            windows_of, f"id {kind}, text_hash long, place int, high long, low long"), "passages")
    first = materialize(
        placed.groupBy("high", "low").agg(
            F.min(F.struct("id", "text_hash")).alias("first"), F.min(code).alias("one"), F.max(code).alias("other"))
        .filter("one != other").select("high", "low", "first"), "repeated-passages")
    later = placed.join(first, ["high", "low"]).filter(F.struct("id", "text_hash") != F.col("first"))
    return later.groupBy("id", "text_hash").agg(F.collect_set("place").alias("places"))
