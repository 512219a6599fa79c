"""Word vectors, neighbours and 2-D coordinates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.ml.feature import PCA, StandardScaler, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from textlake.functions.arrays import run_lengths
from textlake.operators import skipgram
from textlake.operators.ranking import top_per_group
from textlake.session import materialize, open_file, remove, shuffles_dropped

PROBE_BLOCK = 1024
BLOCK = 2048  # vectors per stored row
SENTENCE = 1000  # words; windows do not reach across, as in MLlib
BLOCKS = "block int, ids binary, vectors binary"
TASK_BLOCKS = pa.schema([("task", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])


class WordVectorModel:
    """Trained word vectors, kept as blocks in the shared folder; the driver holds the words only."""

    def __init__(self, words: pa.Array, vector_size: int, seed: int, blocks: DataFrame):
        self._words, self._size, self._seed, self._blocks = words, vector_size, seed, blocks

    def getVectors(self) -> DataFrame:  # noqa: N802, named as in MLlib's model
        """(word, vector), one row per word of the vocabulary."""
        spark, size, seed = self._blocks.sparkSession, self._size, self._seed
        shared = spark.sparkContext.broadcast(self._words)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    words = shared.value[row["block"] * BLOCK : (row["block"] + 1) * BLOCK]
                    vectors = first_vectors(row["block"], len(words), size, seed)
                    if row["ids"] is not None:  # a word without neighbours keeps its first vector
                        _place(vectors, row)
                    flat = pa.array(vectors.ravel().astype(np.float64))
                    offsets = pa.array(np.arange(0, len(flat) + 1, size, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [words, pa.ListArray.from_arrays(offsets, flat)], ["word", "vector"]
                    )

        count = -(-len(self._words) // BLOCK)
        every = spark.range(0, count, 1, min(count, spark.sparkContext.defaultParallelism))
        blocks = every.select(F.col("id").cast("int").alias("block")).join(self._blocks, "block", "left")
        made = blocks.select("block", "ids", "vectors").mapInArrow(rows, "word string, vector array<double>")
        return made.select("word", array_to_vector("vector").alias("vector"))


def fit_word2vec(
    docs: DataFrame,
    vector_size: int = 100,
    window: int = 5,
    min_count: int = 5,
    epochs: int = 5,
    seed: int = 42,
    partitions: int | None = None,
    tokens: str = "tokens",
) -> WordVectorModel:
    """Word vectors from token lists: skip-gram with a hierarchical softmax, as MLlib's Word2Vec.

    The texts are cut into ``partitions`` slices, as many as the session has cores by
    default. In each epoch one task per slice trains vectors of its own on every pair
    of its slice, then each vector is averaged over the tasks that moved it. Slices and
    vectors pass through the shared folder; the driver holds words and counts only.
    """
    spark = docs.sparkSession
    tasks = partitions or spark.sparkContext.defaultParallelism
    known = (
        _word_counts(docs, tokens).where(F.col("cf") >= min_count)
        .orderBy(F.col("cf").desc(), "word").toArrow().combine_chunks()
    )
    if not len(known):
        raise ValueError("the vocabulary is empty: lower min_count or give more texts")
    words, counts = known["word"].combine_chunks(), known["cf"].to_numpy()
    slices = _slices(docs.select(tokens), words, tasks)
    state = spark.createDataFrame([], BLOCKS)
    for epoch in range(epochs):
        moved = _trained(spark, slices, counts, state, vector_size, window, epoch, epochs, seed)
        if epoch + 1 == epochs:
            moved = moved.where(F.col("block") >= 0)  # node vectors are not asked for
        with shuffles_dropped(spark):
            later = materialize(moved.groupBy("block").applyInArrow(_averaged, BLOCKS), "vectors")
        state, _ = later, remove(state.inputFiles())  # the epoch before is not read again
    remove(slices)
    return WordVectorModel(words, vector_size, seed, state)


def first_vectors(block: int, rows: int, size: int, seed: int) -> np.ndarray:
    return (np.random.default_rng([seed, block]).random((rows, size), dtype=np.float32) - 0.5) / size


def _place(vectors: np.ndarray, row: dict) -> None:
    """Put the vectors of a stored block at their places in it."""
    ids = np.frombuffer(row["ids"], np.int32)
    vectors[ids] = np.frombuffer(row["vectors"], np.float32).reshape(len(ids), -1)


def _slices(docs: DataFrame, words: pa.Array, tasks: int) -> list[str]:
    """Files of (ids) rows, one file per task: word numbers of at most SENTENCE words of a document."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ids = pc.index_in(lists.flatten(), shared.value)
            document = pc.list_parent_indices(lists).filter(ids.is_valid()).to_numpy()
            ids = ids.drop_null()
            begins = np.searchsorted(document, np.arange(len(lists) + 1))
            cuts = np.concatenate(
                [np.arange(a, b, SENTENCE) for a, b in zip(begins[:-1], begins[1:], strict=True)] + [begins[-1:]]
            )
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), ids)], ["ids"])

    # Dealt in turn after a sort, so the same texts come to the same slices in the same order.
    sentences = docs.mapInArrow(numbered, "ids array<int>").repartition(tasks)
    with shuffles_dropped(docs.sparkSession):
        return sorted(materialize(sentences.sortWithinPartitions(F.xxhash64("ids")), "slices").inputFiles())


def _trained(
    spark, slices: list[str], counts: np.ndarray, state: DataFrame,
    size: int, window: int, epoch: int, epochs: int, seed: int,
) -> DataFrame:
    """(task, block, ids, vectors) moved by one epoch: input vectors in blocks 0, 1, ...,
    node vectors in blocks -1, -2, ..."""
    tasks, total, stored = len(slices), int(counts.sum()), state.inputFiles()
    shared = spark.sparkContext.broadcast(counts)

    def epoch_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in [t for batch in batches for t in batch.column(0).to_pylist()]:
            first_state = _state(len(shared.value), size, seed, stored)
            trainer = skipgram.Trainer(*first_state, skipgram.huffman(shared.value), window)
            rng, seen = np.random.default_rng([seed, epoch, task]), 0
            with np.errstate(over="ignore"):
                for ids, first, end in skipgram.stretches(_pieces(slices[task]), window, skipgram.STRETCH):
                    done = (epoch + min(1.0, seen * tasks / total)) / epochs
                    seen += trainer.train(ids, first, end, max(skipgram.RATE * (1 - done), skipgram.LEAST_RATE), rng)
            for sign, table, moved in zip((1, -1), (trainer.inputs, trainer.nodes), trainer.moved, strict=True):
                for at in range(0, len(table), BLOCK):
                    ids = np.flatnonzero(moved[at : at + BLOCK]).astype(np.int32)
                    if len(ids):
                        yield pa.RecordBatch.from_pylist([{
                            "task": task, "block": at // BLOCK if sign > 0 else -1 - at // BLOCK,
                            "ids": ids.tobytes(), "vectors": table[at + ids].tobytes(),
                        }], TASK_BLOCKS)

    return spark.range(0, tasks, 1, tasks).mapInArrow(epoch_of, "task int, " + BLOCKS)


def _state(count: int, size: int, seed: int, stored: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Input vectors, with one more row, and node vectors as the last epoch left them."""
    inputs, nodes = np.zeros((count + 1, size), np.float32), np.zeros((count - 1, size), np.float32)
    for at in range(0, count, BLOCK):
        inputs[at : min(at + BLOCK, count)] = first_vectors(at // BLOCK, min(BLOCK, count - at), size, seed)
    for path in stored:
        with open_file(path) as file:
            for batch in pq.ParquetFile(file).iter_batches(16):
                for row in batch.to_pylist():
                    table, at = (inputs, row["block"]) if row["block"] >= 0 else (nodes, -1 - row["block"])
                    _place(table[at * BLOCK : (at + 1) * BLOCK], row)
    return inputs, nodes


def _pieces(path: str) -> Iterator[np.ndarray]:
    """The ids of a slice, an end after each sentence."""
    with open_file(path) as file:
        for batch in pq.ParquetFile(file).iter_batches(1024):
            lists = batch.column(0)
            ends = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
            yield np.insert(lists.flatten().to_numpy(), ends, skipgram.SENTENCE_END)


def _averaged(group: pa.Table) -> pa.Table:
    """One row of a block: each vector's mean over the tasks that moved it."""
    rows = group.sort_by("task").to_pylist()
    ids = np.unique(np.concatenate([np.frombuffer(row["ids"], np.int32) for row in rows]))
    total = times = None
    for row in rows:
        at = np.searchsorted(ids, np.frombuffer(row["ids"], np.int32))
        vectors = np.frombuffer(row["vectors"], np.float32).reshape(len(at), -1)
        if total is None:
            total, times = np.zeros((len(ids), vectors.shape[1]), np.float32), np.zeros((len(ids), 1), np.float32)
        total[at] += vectors
        times[at] += 1
    mean = total / times
    return pa.table(
        {"block": pa.array([rows[0]["block"]], pa.int32()), "ids": [ids.tobytes()], "vectors": [mean.tobytes()]}
    )


def word_vectors(model: WordVectorModel | Word2VecModel) -> DataFrame:
    """(word, vector array<double>)."""
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def most_similar(vectors: DataFrame, probes: Sequence[str], topn: int = 8) -> DataFrame:
    """(probe, rank, word, similarity): nearest by cosine, without the probe itself.

    Probes that have no vector are left out. The table is read in Arrow batches;
    each batch is multiplied with the probe vectors and hands on only its own best
    ``topn`` per probe, so pairs are never shuffled. Many probes take several
    passes of PROBE_BLOCK each.
    """
    wanted = sorted(set(probes))
    passes = [
        _similar_block(vectors, wanted[at : at + PROBE_BLOCK], topn)
        for at in range(0, max(len(wanted), 1), PROBE_BLOCK)
    ]
    best = passes[0]
    for more in passes[1:]:
        best = best.unionByName(more)
    order = (F.col("similarity").desc(), F.col("word"))
    return top_per_group(best, ["probe"], order, topn, "word").select(
        "probe", "rank", "word", "similarity"
    )


def _similar_block(vectors: DataFrame, probes: list[str], topn: int) -> DataFrame:
    rows = vectors.where(F.col("word").isin(probes)).select("word", "vector").collect()
    names = [row.word for row in rows]  # at most PROBE_BLOCK rows
    schema = "probe string, word string, similarity double"
    if not names:
        return vectors.sparkSession.createDataFrame([], schema)
    shared = vectors.sparkSession.sparkContext.broadcast(_unit(np.array([r.vector for r in rows])))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield _best_of_batch(batch, names, shared.value, topn)

    return vectors.select("word", "vector").mapInPandas(nearest, schema)


def _unit(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix.astype(np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _best_of_batch(
    batch: pd.DataFrame, names: list[str], probes: np.ndarray, topn: int
) -> pd.DataFrame:
    words = batch["word"].to_numpy()
    # Rounded so that equal vectors tie whatever their place in the batch.
    scores = np.round(_unit(np.stack(batch["vector"].to_numpy())) @ probes.T, 9)
    parts = []
    for j, name in enumerate(names):
        column = np.where(words == name, -np.inf, scores[:, j])
        floor = np.partition(column, -topn)[-topn] if len(column) > topn else -np.inf
        near = np.flatnonzero((column >= floor) & (column > -np.inf))
        near = near[np.lexsort((words[near].astype(str), -column[near]))][:topn]
        parts.append(pd.DataFrame({"probe": name, "word": words[near], "similarity": column[near]}))
    return pd.concat(parts, ignore_index=True)


def frequent_words(
    docs: DataFrame, n: int = 200, min_count: int = 5, tokens: str = "tokens"
) -> DataFrame:
    """(word, cf): the ``n`` most frequent words that a model would keep."""
    return (
        _word_counts(docs, tokens).where(F.col("cf") >= min_count)
        .orderBy(F.col("cf").desc(), "word")
        .limit(n)
    )


def _word_counts(docs: DataFrame, tokens: str) -> DataFrame:
    return (
        docs.select(F.inline_outer(run_lengths(F.col(tokens))))
        .where(F.col("term").isNotNull())
        .groupBy(F.col("term").alias("word"))
        .agg(F.sum("tf").alias("cf"))
    )


def project_2d(vectors: DataFrame) -> DataFrame:
    """(word, x, y): first two principal components of the centred vectors, each
    oriented so that its largest loading is positive."""
    rows = vectors.select("word", array_to_vector(F.col("vector").cast("array<double>")).alias("v"))
    centred = StandardScaler(inputCol="v", outputCol="c", withMean=True, withStd=False).fit(rows)
    rows = centred.transform(rows)
    model = PCA(k=2, inputCol="c", outputCol="p").fit(rows)
    loadings = model.pc.toArray()
    signs = [float(np.sign(axis[np.argmax(np.abs(axis))])) for axis in loadings.T]
    at = vector_to_array("p")
    return model.transform(rows).select(
        "word", (at[0] * signs[0]).alias("x"), (at[1] * signs[1]).alias("y")
    )


def embedding_scatter(vectors: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """Coordinates of the chosen words (word), or of all."""
    if words is not None:
        vectors = vectors.join(words.select("word").distinct(), "word", "left_semi")
    return project_2d(vectors)
