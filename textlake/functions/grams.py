"""Counting n-grams in Arrow batches: tokens as integer codes, no Python object per token.

Every function takes the tokens of a few rows as an Arrow list array and works on
slices of at most ``SLICE_TOKENS`` tokens (one longer row is a slice of its own), so
memory follows the slice, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

SLICE_TOKENS = 262_144


def row_lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """(begin, end) of rows with about SLICE_TOKENS tokens together."""
    total, at = np.cumsum(lengths), 0
    while at < len(lengths):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + SLICE_TOKENS, "right")))
        yield at, end
        at = end


def _windows(codes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Places at which n tokens of one row without a null begin."""
    if len(codes) < n:
        return np.empty(0, np.int64)
    whole = (row[: len(row) - n + 1] == row[n - 1 :]) if n > 1 else np.ones(len(row), bool)
    for k in range(n):
        whole &= codes[k : len(codes) - n + 1 + k] >= 0
    return np.flatnonzero(whole)


def _coded(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Token codes (-1: null), their rows, and the tokens by code."""
    lengths = row_lengths(lists)
    flat = lists.flatten().dictionary_encode()
    codes = pc.fill_null(flat.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, np.repeat(np.arange(len(lists)), lengths), flat.dictionary


def count_grams(lists: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(row, term, tf) of every distinct n-gram of each row, for the rows of one slice."""
    codes, row, words = _coded(lists)
    rows, grams, names, base = [], [], [], 0
    for n in range(lo, hi + 1):
        at = _windows(codes, row, n)
        if not len(at):
            continue
        gram, first = codes[at], None
        for k in range(1, n):
            # Codes stay dense: each step numbers the distinct beginnings anew.
            _, gram = np.unique(gram * len(words) + codes[at + k], return_inverse=True)
        _, first, gram = np.unique(gram, return_index=True, return_inverse=True)
        parts = [words.take(pa.array(codes[at[first] + k])) for k in range(n)]
        names.append(parts[0] if n == 1 else pc.binary_join_element_wise(*parts, " "))
        rows.append(row[at])
        grams.append(gram + base)
        base += len(first)
    if not rows:
        return np.empty(0, np.int64), pa.array([], pa.string()), np.empty(0, np.int64)
    row, gram, named = np.concatenate(rows), np.concatenate(grams), pa.concat_arrays(names)
    if hi > 1 and pc.any(pc.match_substring(words, " ")).as_py():
        # A token that holds a space may spell a longer gram; equal terms count together.
        merged = named.dictionary_encode()
        named, gram = merged.dictionary, merged.indices.to_numpy(zero_copy_only=False).astype(np.int64)[gram]
    keys, tf = np.unique(row * len(named) + gram, return_counts=True)
    return keys // len(named), named.take(pa.array(keys % len(named))), tf


def gram_totals(lists: pa.Array, lo: int, hi: int) -> pa.RecordBatch:
    """(term, df, cf) over the rows of one slice."""
    _, terms, tf = count_grams(lists, lo, hi)
    coded = terms.dictionary_encode()
    number, size = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
    df, cf = np.bincount(number, minlength=size), np.bincount(number, tf, size).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [coded.dictionary, pa.array(df, pa.int64()), pa.array(cf, pa.int64())], names=["term", "df", "cf"]
    )


class Vocabulary:
    """Numbered terms, looked up by token codes: a tree of sorted integers over the terms' tokens."""

    def __init__(self, terms: list[str]):
        paths = [term.split(" ") for term in terms]
        self.words = pa.array(sorted({word for path in paths for word in path}), pa.string())
        code = {word: k for k, word in enumerate(self.words.to_pylist())}
        self.size, self.levels = len(terms), []
        nodes = np.zeros(len(paths), np.int64)
        for depth in range(max(map(len, paths), default=0)):
            deep = [k for k, path in enumerate(paths) if len(path) > depth]
            key = nodes[deep] * len(code) + np.array([code[paths[k][depth]] for k in deep], np.int64)
            known, nodes[deep] = np.unique(key, return_inverse=True)
            index = np.full(len(known), -1, np.int64)
            ends = [k for k in deep if len(paths[k]) == depth + 1]
            index[nodes[ends]] = ends
            self.levels.append((known, index))

    def counts(self, lists: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, index, tf) of the vocabulary's terms in each row, ascending, for the rows of one slice."""
        codes, row, words = _coded(lists)
        own = pc.fill_null(pc.index_in(words, self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = np.where(codes >= 0, np.append(own, -1)[codes], -1)
        found = []
        for n in range(lo, min(hi, len(self.levels)) + 1):
            at = _windows(codes, row, n)
            node = np.zeros(len(at), np.int64)
            for k, (known, index) in enumerate(self.levels[:n]):
                key = node * len(self.words) + codes[at + k]
                node = np.minimum(np.searchsorted(known, key), len(known) - 1)
                hit = known[node] == key
                at, node = at[hit], node[hit]
            hit = index[node] >= 0
            found.append(row[at[hit]] * self.size + index[node[hit]])
        keys, tf = np.unique(np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True)
        return keys // max(self.size, 1), keys % max(self.size, 1), tf


def list_array(row: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    """Lists of ``values``, given the ascending row of each, for n rows."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def by_slices(make, lists: pa.Array) -> pa.Array:
    """``make`` applied to slices of the rows, put together again."""
    parts = [make(lists.slice(at, end - at)) for at, end in slices(row_lengths(lists))]
    return pa.concat_arrays(parts or [make(lists)])


def gram_counts(tokens: Column, lo: int = 1, hi: int = 2) -> Column:
    """Array of tokens -> array of (term, tf), one entry per distinct n-gram of lo..hi tokens."""
    if not 1 <= lo <= hi:
        raise ValueError(f"bad n-gram range ({lo}, {hi})")

    def counted(lists: pa.Array) -> pa.Array:
        row, terms, tf = count_grams(lists, lo, hi)
        runs = pa.StructArray.from_arrays([terms, pa.array(tf, pa.int32())], names=["term", "tf"])
        return list_array(row, len(lists), runs)

    @F.arrow_udf("array<struct<term:string,tf:int>>")
    def counts(lists: pa.Array) -> pa.Array:
        return by_slices(counted, lists)

    return counts(tokens)
