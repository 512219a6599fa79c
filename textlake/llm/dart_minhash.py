"""Near duplicates by DartMinHash signatures of weighted word shingles.

A document is the weighted set of its five-word shingles, the weight being how
often one occurs. Darts are thrown by hashing: each shingle has, for each region
of weights [2^n - 1, 2^(n+1) - 1), a stream of darts whose ranks are the arrivals
of a Poisson process of the region's width, each with a weight inside the region.
A document takes the darts below its weights with a rank under a bound chosen so
that some ``k (ln k + 3)`` are expected; of those that fall on one coordinate the
earliest stays. Documents with a coordinate left empty double their bound. Two
signatures agree in a coordinate with the weighted Jaccard similarity.

Signatures are cut into bands. What hangs together by shared bands is a pool of
candidates, found from one row for each document and band. Inside a pool every
pair is checked by its exact shingles, in blocks: a task holds two blocks of a
pool, compares them by a product of their incidence tables, and returns only the
links of a spanning forest. So no link between classes is lost and no pair of
documents becomes a row.

Words are lower-cased and separated by ASCII white space. Equal word sequences
are one text from the start.

Defined results: texts of one to four words are one shingle; texts without words,
null included, are copies of each other; rows with one ``doc_id`` count as one
document; a row with a null ``doc_id`` belongs to the class of its copies, and to
none if all of them have a null; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from textlake.llm.components import components
from textlake.llm.files import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5  # a pair at similarity 0.8 is missed with 0.007 %
K = BANDS * ROWS
#: Documents of a block, and shingles of two blocks that are compared by one product.
BLOCK, WIDEST = 256, 32_768
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int, base: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    if n:
        steps[0] = 1
    return np.multiply.accumulate(steps) if n else steps


def word_hashes(data: bytes) -> np.ndarray:
    """One hash for each word of a text, over all its bytes."""
    raw = np.frombuffer(data + b" ", np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    # Prefix sums of byte * base^place; dividing by base^start makes a word's value its own.
    sums = np.concatenate([[_U(0)], np.cumsum(_BYTE[raw] * _powers(len(raw), _BASE), dtype=np.uint64)])
    back = _powers(len(raw), pow(_BASE, -1, 1 << 64))
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


def shingles(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of the whole text if it is shorter."""
    n = len(words)
    if n == 0:
        return words
    width = min(width, n)
    total = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        total = total * _U(0x9FB21C651E98DF25) + words[j : n - width + 1 + j]
    return mix(total + _U(width))


def normal(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode().split())


def weighted(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, element, weight) of several documents."""
    each = [np.unique(h, return_counts=True) for h in hashes]
    doc = np.repeat(np.arange(len(each)), [len(u) for u, _ in each])
    return doc, np.concatenate([u for u, _ in each]), np.concatenate([c for _, c in each]).astype(np.float64)


def signatures(hashes: list[np.ndarray], k: int = K) -> np.ndarray:
    """(documents, k) dart names; every document needs an element."""
    n = len(hashes)
    doc, element, weight = weighted(hashes)
    bound = k * (np.log(k) + 3) / np.bincount(doc, weight, n)
    out = np.zeros((n, k), np.uint64)
    open_docs = np.arange(n)
    while len(open_docs):
        rank, name = _throw(doc, element, weight, bound, n, k)
        full = np.isfinite(rank).all(axis=1)
        done = open_docs[full[open_docs]]
        out[done] = name[done]
        open_docs = open_docs[~full[open_docs]]
        bound[open_docs] *= 2
        keep = np.isin(doc, open_docs)
        doc, element, weight = doc[keep], element[keep], weight[keep]
    return out


def _throw(doc, element, weight, bound, n, k) -> tuple[np.ndarray, np.ndarray]:
    """Earliest dart (rank, name) of each document and coordinate under the rank bounds."""
    best, name = np.full(n * k, np.inf), np.zeros(n * k, np.uint64)
    region = 0
    while len(doc):
        low, width = 2.0**region - 1, 2.0**region
        seed = mix(element + _U((region + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1))
        rank, at, d, w, limit = np.zeros(len(doc)), seed, doc, weight, bound[doc]
        while len(d):
            at = mix(at + _U(0x9E3779B97F4A7C15))
            rank = rank - np.log(((at >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
            near = rank <= limit
            rank, at, d, w, limit = rank[near], at[near], d[near], w[near], limit[near]
            place = mix(at ^ _U(0xA0761D6478BD642F))
            hit = low + (place >> _U(11)).astype(np.float64) * 2.0**-53 * width <= w
            dart = mix(at[hit] ^ _U(0xE7037ED1A0B428DB))
            key, r = d[hit] * k + (dart % _U(k)).astype(np.int64), rank[hit]
            np.minimum.at(best, key, r)
            won = best[key] == r
            name[key[won]] = dart[won]
        more = weight > 2 * width - 1
        doc, element, weight = doc[more], element[more], weight[more]
        region += 1
    return best.reshape(n, k), name.reshape(n, k)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band; the number of the band is part of it."""
    key = np.arange(1, bands + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    parts = signature.reshape(len(signature), bands, rows)
    for j in range(rows):
        key = mix(key + parts[:, :, j])
    return key.view(np.int64)


def _signed(docs: DataFrame, bands: int, rows: int, width: int) -> DataFrame:
    """(doc_id, digest, size, bands) of every row."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                texts = [normal(t) for t in part["text"]]
                sets = [shingles(word_hashes(t), width) for t in texts]
                filled = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(part)
                if filled:
                    for i, row in zip(filled, band_keys(signatures([sets[i] for i in filled], bands * rows), bands, rows)):
                        keys[i] = row
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "size": np.array([len(s) for s in sets], np.int64),
                    "digest": [hashlib.blake2b(t, digest_size=16).digest() for t in texts], "bands": keys})

    return docs.select("doc_id", "text").mapInPandas(sign, f"doc_id {key}, size long, digest binary, bands array<long>")


def _shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """(id, elements): shingles as sorted 32-bit hashes, the n-th occurrence of one being an element of its own."""
    key = texts.schema["id"].dataType.simpleString()

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                found = []
                for text in part["text"]:
                    s = np.sort(shingles(word_hashes(normal(text)), width))
                    first = np.searchsorted(s, s)
                    found.append(np.unique((mix(s + np.arange(len(s), dtype=np.uint64) - first.astype(np.uint64)) >> _U(32)).astype(np.uint32).view(np.int32)))
                yield pd.DataFrame({"id": part["id"].to_numpy(), "elements": found})

    return texts.mapInPandas(sets, f"id {key}, elements array<int>")


def _intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray | None:
    """Common elements of each pair by one matrix product; None where that would be too wide."""
    names = np.unique(np.concatenate([*a, *b]))
    if len(names) > WIDEST:
        return None
    tables = []
    for sets in (a, b):
        table = np.zeros((len(sets), len(names)), np.float32)
        table[np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.searchsorted(names, np.concatenate(sets))] = 1
        tables.append(table)
    return tables[0] @ tables[1].T


def _joined(a: list[np.ndarray], b: list[np.ndarray], same: bool, similarity: float) -> list[tuple[int, int]]:
    """Links of a spanning forest of all similar pairs between two lists of sets (or within one)."""
    above = list(range(len(a) + (0 if same else len(b))))

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    size_a, size_b = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    fits = (size_a[:, None] >= similarity * size_b) & (size_b >= similarity * size_a[:, None])
    if same:
        fits = np.triu(fits, 1)
    common = _intersections(a, b) if len(a) * len(b) > 64 else None
    if common is not None:
        fits &= common >= similarity * (size_a[:, None] + size_b - common) - 1e-6
    links = []
    for i, j in zip(*np.nonzero(fits)):
        x, y = top(i), top(j if same else len(a) + j)
        if x == y:
            continue
        if common is None:
            n = len(np.intersect1d(a[i], b[j], assume_unique=True))
            if n < similarity * (len(a[i]) + len(b[j]) - n):
                continue
        above[max(x, y)] = min(x, y)
        links.append((i, j))
    return links


def _links(placed: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join what is similar inside each ``pool`` of (pool, blocks, id, elements).

    A pool is cut into blocks, and each pair of blocks is one group: no task holds
    a large pool, and no pair of documents is ever a row.
    """
    kind = placed.schema["id"].dataType.simpleString()
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    own = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = own.withColumn("other", other).select(
        "pool", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "elements")

    def join(group: pd.DataFrame) -> pd.DataFrame:
        low, high = group["low"].iloc[0], group["high"].iloc[0]
        group = group.sort_values("id")
        left, right = group[group["block"] == low], group[group["block"] == high]
        found = _joined(list(left["elements"]), list(right["elements"]), low == high, similarity) if len(left) and len(right) else []
        a, b = left["id"].to_numpy(), right["id"].to_numpy()
        return pd.DataFrame({"a": a[[i for i, _ in found]], "b": b[[j for _, j in found]]})

    return dealt.groupBy("pool", "low", "high").applyInPandas(join, f"a {kind}, b {kind}")


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE,
) -> DataFrame:
    """(doc_id, class_id, kept) of every row; class_id is the smallest doc_id of the class."""
    signed = materialize(_signed(docs, bands, rows, width), "signed")
    texts = materialize(
        signed.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "texts")
    exploded = texts.filter("id is not null and bands is not null").select("id", F.explode("bands").alias("band"))
    # The first of each band stands for it; what hangs together by bands is a pool of candidates.
    first = materialize(
        exploded.groupBy("band").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").drop("last"), "bands")
    shared = materialize(exploded.join(first, "band").select(F.col("first").alias("a"), F.col("id").alias("b")).filter("a <> b").distinct(), "shared")
    result = signed.select("doc_id", "digest").join(texts.select("digest", "id"), "digest")
    if not shared.isEmpty():
        pools = materialize(components(shared).withColumnRenamed("component", "pool"), "pools")
        sized = pools.groupBy("pool").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        known = materialize(pools.join(sized, "pool"), "sized-pools")
        # One merge join whatever the number of candidates: texts move once, those of candidates alone go on.
        wanted = docs.select(F.col("doc_id").alias("id"), "text").join(known.select("id").hint("merge"), "id", "left_semi")
        sets = _shingle_sets(wanted, width).dropDuplicates(["id"])
        placed = materialize(sets.join(known, "id"), "shingles")
        classes = components(materialize(_links(placed, similarity), "links"))
        result = result.join(classes.withColumnRenamed("component", "found"), "id", "left").withColumn("id", F.coalesce("found", "id"))
    return result.select("doc_id", F.col("id").alias("class_id"), F.coalesce(F.col("doc_id") == F.col("id"), F.lit(False)).alias("kept"))
