"""Exact top-k inner products by a pivot-distance index.

Vectors become integers, floor(1024 x). A further coordinate, the square root of
what their squared length lacks of the greatest, turns the largest inner product
into the smallest Euclidean distance. Each vector is keyed by its nearest pivot
and the distance from it; runs of 1,024 vectors in the order of this key are the
annuli. A query starts with the k-th best score among a bounded sample, which no
result can fall below, then takes the annuli in the order of their least possible
distance, and stops when the triangle inequality shows that none of the others
holds anything better. Scores are exact integers.

Queries are compared with all annuli in blocks: a group of annuli and a block of
queries meet in a task, and each brings back k rows for each query at most.

Defined results: null vectors, and vectors with null or non-finite components,
take no part; missing components count as 0; of rows with one query id the one
with the smallest vector asks; rows with the query's id are no candidates; rows
with a null id are neither; ties go to the smaller id; an empty table, or one
without queries, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from textlake.llm.files import materialize

SCALE = 1024
PIVOTS = 48
#: Rows, chosen by a hash of their id, for pivots and first bounds.
SAMPLE = 4096
ANNULUS = 1024
#: Vectors of one group of annuli, and queries of one block.
GROUP = 16_384
QUERY_BLOCK = 2048


def finite(embedding) -> F.Column:
    """True for vectors without null or non-finite components."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    return vectors.select("vec_id", v.alias("embedding")).filter(F.col("vec_id").isNotNull() & finite(F.col("embedding"))).select(
        F.col("vec_id").cast("long"), F.transform("embedding", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def matrix(rows, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point only where that is exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Rows of the sample, each the farthest from those before it."""
    chosen = [0]
    gap = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def extended(v: np.ndarray, greatest: float) -> np.ndarray:
    x = v.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(0.0, greatest - (x * x).sum(1)))[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T))


def _annuli(index: DataFrame) -> DataFrame:
    """(pivot, low, high, ids, data) of runs of vectors in the order of (pivot, distance)."""
    n = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = index.repartitionByRange(n, "pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for pivot, part in batch.groupby("pivot", sort=False):
                for at in range(0, len(part), ANNULUS):
                    run = part.iloc[at : at + ANNULUS]
                    data = np.stack(run["v"].to_list()).astype("<i8") if len(run) else np.zeros((0, 0), "<i8")
                    rows.append((pivot, run["distance"].iloc[0], run["distance"].iloc[-1],
                                 run["vec_id"].to_numpy(), data.tobytes()))
            yield pd.DataFrame(rows, columns=["pivot", "low", "high", "ids", "data"])

    return ordered.mapInPandas(cut, "pivot int, low double, high double, ids array<long>, data binary")


def best_of_groups(k: int, dims: int, greatest: float, pivots: np.ndarray):
    """The search of one block of queries in one group of annuli."""

    def search(key, annuli: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
        if not len(annuli) or not len(queries):
            return none
        asked = queries["vec_id"].to_numpy(np.int64)
        q = matrix(queries["v"].to_list(), dims)
        flat = np.hstack([q.astype(np.float64), np.zeros((len(q), 1))])
        to_pivot = distances(flat, pivots)
        bound = queries["bound"].to_numpy(np.float64)  # -inf: no bound yet
        spread = (flat * flat).sum(1) + greatest
        low, high, home = (annuli[c].to_numpy() for c in ("low", "high", "pivot"))
        near = np.maximum(0.0, np.maximum(to_pivot[:, home] - high, low - to_pivot[:, home]))
        found: list[tuple] = []
        for group in np.unique(to_pivot.argmin(1)):
            at = np.flatnonzero(to_pivot.argmin(1) == group)
            order = near[at].min(0).argsort(kind="stable")
            rows, ids, scores = (np.zeros(0, np.int64) for _ in range(3))
            for a in order:
                # A score of at least the bound needs a distance of at most this; a little room for rounding.
                reach = np.sqrt(np.maximum(0.0, spread[at] - 2 * bound[at])) * (1 + 1e-9) + 1e-6
                if not (near[at].min(0)[a] <= reach.max()):
                    break
                open_rows = np.flatnonzero(near[at, a] <= reach)
                if not len(open_rows):
                    continue
                members = np.asarray(annuli["ids"].iloc[a], np.int64)
                data = np.frombuffer(annuli["data"].iloc[a], "<i8").reshape(len(members), dims)
                s = products(q[at[open_rows]], data)
                hit = (s >= bound[at[open_rows], None]) & (members[None] != asked[at[open_rows], None])
                r, c = np.nonzero(hit)
                rows = np.concatenate([rows, open_rows[r]])
                ids, scores = np.concatenate([ids, members[c]]), np.concatenate([scores, s[r, c]])
                order_ = np.lexsort((ids, -scores, rows))
                rows, ids, scores = rows[order_], ids[order_], scores[order_]
                place = np.arange(len(rows)) - np.searchsorted(rows, rows)
                keep = place < k
                last = place == k - 1
                bound[at[rows[last]]] = np.maximum(bound[at[rows[last]]], scores[last])
                rows, ids, scores = rows[keep], ids[keep], scores[keep]
            found.append((asked[at[rows]], ids, scores))
        if not found:
            return none
        return pd.DataFrame({n: np.concatenate(x) for n, x in zip(("query_id", "vec_id", "score"), zip(*found))})

    return search


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each row whose id ``every`` divides."""
    spark = vectors.sparkSession
    ints = materialize(quantized(vectors, scale), "ints")
    dims, longest, n, n_queries = ints.agg(
        F.max(F.size("v")),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))),
        F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    if not n or not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    drawn = ints.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    sample, sample_ids = matrix(drawn["v"].to_list(), dims), drawn["vec_id"].to_numpy()
    greatest = float(longest)
    pivots = choose_pivots(extended(sample, greatest), PIVOTS)

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            v = matrix(batch["v"].to_list(), dims)
            away = distances(extended(v, greatest), pivots)
            home = away.argmin(1)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "v": list(v), "pivot": home.astype(np.int32),
                                "distance": away[np.arange(len(v)), home]})

    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            asked = batch["vec_id"].to_numpy()
            s = products(matrix(batch["v"].to_list(), dims), sample).astype(np.float64)
            s[asked[:, None] == sample_ids[None]] = -np.inf
            enough = s.shape[1] > k
            kth = np.partition(s, -k, axis=1)[:, -k] if enough else np.full(len(s), -np.inf)
            yield batch.assign(bound=kth)

    annuli = materialize(_annuli(ints.mapInPandas(keyed, "vec_id long, v array<long>, pivot int, distance double")), "annuli")
    groups = max(spark.sparkContext.defaultParallelism, math.ceil(n / GROUP))
    blocks = math.ceil(n_queries / QUERY_BLOCK)
    queries = materialize(
        ints.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
        .mapInPandas(bounded, "vec_id long, v array<long>, bound double"), "queries")
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt = annuli.withColumn("part", F.pmod(F.xxhash64("pivot", "low", "ids"), F.lit(groups)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    partial = dealt.groupBy("part", "block").cogroup(asked.groupBy("part", "block")).applyInPandas(
        best_of_groups(k, dims, greatest, pivots), "query_id long, vec_id long, score long")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
