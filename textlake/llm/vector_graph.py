"""Near-duplicate vectors by a flat, robust-pruned neighbour graph.

Equal vectors of one label are merged first. Vectors are dealt to the three
nearest of their label's cluster centres; each overlapping shard gets a graph of
its own, built by doubling batches of inserts with robust pruning. The neighbour
lists of a vector from its shards are united. A vector is then searched in the
shard of its nearest centre: a greedy beam search from the medoid finds where it
lies, and the search goes on over everything within range until nothing new
appears. Every hit is verified by its cosine in double precision.

A shard that is too large for a task is split into blocks with a graph each, and
its vectors are searched in all of them. Tasks report numbers of links and the
links of a spanning forest, never all pairs of a group. A sample is compared with
brute force; where too few of its links were found, the search is repeated wider.

Defined results: vectors that are null, zero or hold null or non-finite components,
rows without a label or id, and vectors of other dimensions link with nothing;
equal vectors link with each other (repeated rows too); a row without links is
its own component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from textlake.llm.components import components
from textlake.llm.files import materialize
from textlake.llm.pivot_search import finite

COSINE = 0.93
CELL, BLOCK = 1000, 4096
#: Sampled vectors for centres, and for the audit.
SAMPLE, AUDIT = 8192, 512
DEGREE, BEAM, ALPHA, OVERLAP = 24, 32, 1.2, 3
RECALL = 0.98


class Graph:
    """Neighbour lists over unit vectors; -1 fills the lists up."""

    def __init__(self, units: np.ndarray, adjacency: np.ndarray | None = None):
        self.units = units
        self.adjacency = np.full((len(units), DEGREE), -1, np.int64) if adjacency is None else adjacency
        self._edges: tuple[np.ndarray, np.ndarray] | None = None
        self.medoid = int((units @ units.mean(0)).argmax()) if len(units) else 0

    def beam(self, queries: np.ndarray, width: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best nodes met from the medoid, and their cosines, for all queries at once."""
        n, step = len(queries), 4
        ids = np.full((n, width), -1, np.int64)
        ids[:, 0] = self.medoid
        sims = np.full((n, width), -np.inf)
        sims[:, 0] = queries @ self.units[self.medoid]
        opened = np.ones((n, width), bool)
        opened[:, 0] = False
        seen = np.zeros((n, len(self.units) + 1), bool)  # the last column stands for -1
        seen[:, [self.medoid, -1]] = True
        going = np.arange(n)
        while len(going):
            rank = np.where(opened[going], np.inf, np.arange(width)[None])
            pick = np.argpartition(rank, min(step, width - 1), axis=1)[:, :step]
            fresh = np.take_along_axis(rank, pick, 1) < np.inf
            nodes = np.where(fresh, np.take_along_axis(ids[going], pick, 1), -1)
            opened[going[:, None], pick] = True
            near = np.where(nodes[:, :, None] >= 0, self.adjacency[nodes], -1).reshape(len(going), -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            new = ~seen[going[:, None], near]
            near = np.where(new, near, -1)
            seen[going[:, None], near] = True
            s = np.where(near >= 0, np.einsum("qd,qrd->qr", queries[going], self.units[near], optimize=True), -np.inf)
            all_ids = np.hstack([ids[going], near])
            all_sims = np.hstack([sims[going], s])
            all_open = np.hstack([opened[going], near < 0])
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            ids[going] = np.take_along_axis(all_ids, order, 1)
            sims[going] = np.take_along_axis(all_sims, order, 1)
            opened[going] = np.take_along_axis(all_open, order, 1)
            going = going[(~opened[going]).any(1)]
        return ids, sims

    def prune(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Robust pruning of each node's candidates to at most DEGREE neighbours."""
        candidates = np.where(candidates == nodes[:, None], -1, np.sort(candidates, axis=1))
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        points = self.units[candidates]
        gap = np.where(candidates >= 0, 2 - 2 * np.einsum("nd,ncd->nc", self.units[nodes], points, optimize=True), np.inf)
        out = np.full((len(nodes), DEGREE), -1, np.int64)
        rows = np.arange(len(nodes))
        for place in range(DEGREE):
            best = gap.argmin(1)
            alive = np.isfinite(gap[rows, best])
            if not alive.any():
                break
            out[alive, place] = candidates[alive, best[alive]]
            between = 2 - 2 * np.einsum("nd,ncd->nc", points[rows, best], points, optimize=True)
            gap = np.where(ALPHA**2 * np.maximum(between, 0) <= gap, np.inf, gap)
            gap[rows, best] = np.inf
        return out

    def build(self) -> "Graph":
        n = len(self.units)
        order = np.random.default_rng(n).permutation(n)
        order = np.concatenate([[self.medoid], order[order != self.medoid]]).astype(np.int64) if n else order
        done = 1
        while done < n:
            batch = order[done : min(2 * done, n, done + 1024)]
            for at in range(0, len(batch), 256):
                self._insert(batch[at : at + 256], batch)
            done += len(batch)
        return self

    def _insert(self, nodes: np.ndarray, batch: np.ndarray) -> None:
        met, _ = self.beam(self.units[nodes])
        close = self.units[nodes] @ self.units[batch].T
        most = min(12, len(batch))
        fellows = batch[np.argpartition(-close, most - 1, axis=1)[:, :most]]
        self.adjacency[nodes] = self.prune(nodes, np.hstack([met, fellows, self.adjacency[nodes]]))
        source = np.repeat(nodes, DEGREE)
        target = self.adjacency[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        gap = -np.einsum("nd,nd->n", self.units[source], self.units[target])
        by = np.lexsort((gap, target))
        source, target = source[by], target[by]
        place = np.arange(len(target)) - np.searchsorted(target, target)
        keep = place < 2 * DEGREE
        touched, row = np.unique(target[keep], return_inverse=True)
        incoming = np.full((len(touched), 2 * DEGREE), -1, np.int64)
        incoming[row, place[keep]] = source[keep]
        self.adjacency[touched] = self.prune(touched, np.hstack([self.adjacency[touched], incoming]))

    def _both_ways(self) -> tuple[np.ndarray, np.ndarray]:
        """Edges and their reverses: where each node's begin, and what they lead to."""
        if self._edges is None:
            a, place = np.nonzero(self.adjacency >= 0)
            b = self.adjacency[a, place]
            source, target = np.concatenate([a, b]), np.concatenate([b, a])
            count = np.bincount(source, minlength=len(self.units))
            self._edges = np.concatenate([[0], np.cumsum(count)]), target[np.argsort(source, kind="stable")]
        return self._edges

    def in_range(self, queries: np.ndarray, bound: float, width: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all nodes within range that the search reaches."""
        ids, sims = self.beam(queries, width)
        rows, places = np.nonzero((ids >= 0) & (sims >= bound))
        nodes = ids[rows, places]
        seen = np.zeros((len(queries), len(self.units)), bool)
        r, c = np.nonzero(ids >= 0)
        seen[r, ids[r, c]] = True
        found_rows, found_nodes = [rows], [nodes]
        # Here edges count both ways: pruning may leave a member of a tight group without one that leads to it.
        start, target = self._both_ways()
        while len(rows):
            n = start[nodes + 1] - start[nodes]
            r = np.repeat(rows, n)
            c = target[np.arange(n.sum()) + np.repeat(start[nodes] - np.cumsum(n) + n, n)]
            new = ~seen[r, c]
            flat = np.unique(r[new] * len(self.units) + c[new])
            r, c = np.divmod(flat, len(self.units))
            seen[r, c] = True
            hit = np.einsum("nd,nd->n", queries[r], self.units[c]) >= bound
            rows, nodes = r[hit], c[hit]
            found_rows.append(rows)
            found_nodes.append(nodes)
        return np.concatenate(found_rows), np.concatenate(found_nodes)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the smallest node it is joined with by the links (a, b)."""
    low = np.arange(n)
    while True:
        before = low.copy()
        np.minimum.at(low, a, low[b])
        np.minimum.at(low, b, low[a])
        low = low[low]
        if (low == before).all():
            return low


def cluster_centres(units: np.ndarray, n: int) -> np.ndarray:
    """Spherical k-means on a sample, started from its first rows."""
    centres = units[:n].copy()
    for _ in range(5):
        home = (units @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, units)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-300), centres)
    return centres


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(group, id, copies, unit): distinct comparable vectors; group is label and dimension."""
    v = F.col("embedding").cast("array<double>")
    usable = vectors.select("vec_id", "label", v.alias("embedding")).filter(
        "vec_id is not null and label is not null").filter(finite(F.col("embedding")))
    greatest = F.array_max(F.transform("embedding", F.abs))
    scaled = usable.withColumn("greatest", greatest).filter("greatest > 0").withColumn(
        "u", F.transform("embedding", lambda x: x / F.col("greatest")))
    length = F.sqrt(F.aggregate("u", F.lit(0.0), lambda s, x: s + x * x))
    return scaled.groupBy(
        F.concat_ws("/", F.col("label").cast("string"), F.size("embedding")).alias("group"), "embedding", "u"
    ).agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")).withColumn("length", length).select(
        "group", "id", "copies", F.transform("u", lambda x: x / F.col("length")).alias("unit"), "embedding")


def _stack(column) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column])


def _search(units: DataFrame, centres: dict, cosine: float, width: int, overlap: int) -> tuple[DataFrame, DataFrame]:
    """(counts, links): per id the copies it links with, and links that join what is linked."""
    id_type = units.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for group, part in batch.groupby("group", sort=False):
                own = centres.get(group)
                if own is None:
                    parts.append(part.assign(cells=[[0]] * len(part)))
                    continue
                near = np.argsort(-(_stack(part["unit"]) @ own.T), axis=1, kind="stable")[:, :overlap]
                parts.append(part.assign(cells=list(near)))
            if parts:
                yield pd.concat(parts)

    dealt = materialize(units.select("group", "id", "copies", "unit").mapInPandas(
        assign, f"group string, id {id_type}, copies long, unit array<double>, cells array<int>"), "cells")
    members = dealt.withColumn("cell", F.explode("cells"))
    sizes = members.groupBy("group", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sized = materialize(sizes, "cell-sizes")
    placed = materialize(
        members.join(sized, ["group", "cell"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("home", F.col("cells")[0] == F.col("cell")).drop("cells"), "shards")

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        ids = rows["id"].to_numpy()
        graph = Graph(_stack(rows["unit"])).build()
        return pd.DataFrame({"id": ids, "near": [ids[x[x >= 0]] for x in graph.adjacency]})

    lists = placed.select("group", "cell", "block", "id", "unit").groupBy("group", "cell", "block").applyInPandas(
        build, f"id {id_type}, near array<{id_type}>")
    united = materialize(
        lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "lists")
    # Of a shard, each block of the graph meets each block of the vectors at home there.
    graphs = placed.join(united, "id").select(
        "group", "cell", "block", "id", "copies", "unit", "near", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("asking"))
    queries = placed.filter("home").select(
        "group", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "unit", F.col("block").alias("asking"))
    queries = queries.toDF(*queries.columns)  # columns of their own, as both sides come from one table

    def search(key, nodes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(nodes) or not len(asked):
            return pd.DataFrame({"id": asked["id"].iloc[:0], "n": [], "low": asked["id"].iloc[:0]})
        ids, copies = nodes["id"].to_numpy(), nodes["copies"].to_numpy()
        order = np.argsort(ids)
        longest = max(1, max(len(x) for x in nodes["near"]))
        adjacency = np.full((len(ids), longest), -1, np.int64)
        for i, near in enumerate(nodes["near"]):
            at = np.searchsorted(ids, near, sorter=order)
            at = order[np.minimum(at, len(ids) - 1)]
            inside = at[ids[at] == near]
            adjacency[i, : len(inside)] = inside
        graph = Graph(_stack(nodes["unit"]), adjacency)
        asking, units_ = asked["id"].to_numpy(), _stack(asked["unit"])
        rows, hits = [], []
        for at in range(0, len(asking), 256):
            r, c = graph.in_range(units_[at : at + 256], cosine, width)
            rows.append(r + at)
            hits.append(c)
        row, hit = np.concatenate(rows), np.concatenate(hits)
        other = asking[row] != ids[hit]
        row, hit = row[other], hit[other]
        n = np.bincount(row, copies[hit], len(asking)).astype(np.int64)
        # Names of both sides, numbered by size, for the spanning forest.
        names = np.unique(np.concatenate([asking, ids]))
        low = forest(np.searchsorted(names, asking[row]), np.searchsorted(names, ids[hit]), len(names))
        linked = np.unique(np.concatenate([asking[row], ids[hit]]))
        lone = np.setdiff1d(linked, asking)
        counts = pd.DataFrame({"id": asking, "n": n, "low": names[low[np.searchsorted(names, asking)]]})
        return pd.concat([counts, pd.DataFrame({"id": lone, "n": 0, "low": names[low[np.searchsorted(names, lone)]]})])

    found = materialize(
        graphs.groupBy("group", "cell", "block", "asking").cogroup(queries.groupBy("group", "cell", "block", "asking"))
        .applyInPandas(search, f"id {id_type}, n long, low {id_type}"), "found")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    return counts, found.filter("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b")).distinct()


def audit(units: DataFrame, counts: DataFrame, cosine: float = COSINE, n: int = AUDIT) -> float:
    """Share of the links of ``n`` sampled vectors, by brute force, that the search found."""
    id_type = units.schema["id"].dataType.simpleString()
    drawn = units.orderBy(F.xxhash64("id", "group"), "id").limit(n).select("group", "id", "unit").toPandas()
    by_group = {g: (p["id"].to_numpy(), _stack(p["unit"])) for g, p in drawn.groupby("group")}

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group, part in batch.groupby("group", sort=False):
                if group in by_group:
                    ids, probes = by_group[group]
                    near = (probes @ _stack(part["unit"]).T >= cosine) & (ids[:, None] != part["id"].to_numpy()[None])
                    yield pd.DataFrame({"id": ids, "real": (near * part["copies"].to_numpy()).sum(1)})

    real = units.select("group", "id", "copies", "unit").mapInPandas(brute, f"id {id_type}, real long").groupBy("id").agg(F.sum("real").alias("real"))
    kept, total = real.join(counts, "id", "left").agg(
        F.sum(F.least("real", F.coalesce("n", F.lit(0)))), F.sum("real")).first()
    return 1.0 if not total else kept / total


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    units = materialize(unit_vectors(vectors), "units")
    totals = units.groupBy("group").agg(F.count("*").alias("n")).filter(F.col("n") > CELL)
    total = units.count()
    share = max(1, total // SAMPLE)
    drawn = units.filter(F.pmod(F.xxhash64("id", "group"), F.lit(share)) == 0).join(totals, "group").select(
        "group", "n", "unit").limit(4 * SAMPLE).toPandas()
    centres = {
        group: cluster_centres(_stack(part["unit"]), min(math.ceil(part["n"].iloc[0] / CELL), max(1, len(part) // 4)))
        for group, part in drawn.groupby("group")
    }
    width, overlap = BEAM, OVERLAP
    for _ in range(3):
        counts, links = _search(units, centres, cosine, width, overlap)
        if audit(units, counts, cosine) >= recall:
            break
        width, overlap = 2 * width, overlap + 2
    classes = components(links)
    label = F.concat_ws("/", F.col("label").cast("string"), F.size("embedding"))
    kept = units.select("group", "embedding", "id", "copies").join(counts, "id", "left").join(classes, "id", "left").select(
        "group", F.col("embedding").alias("v"), "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "id").alias("component"))
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).withColumn(
        "key", F.when(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull(), label))
    joined = rows.join(kept, (F.col("key") == F.col("group")) & (F.col("embedding") == F.col("v")), "left")
    return joined.select(
        "vec_id", F.coalesce(F.col("n") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept"))
