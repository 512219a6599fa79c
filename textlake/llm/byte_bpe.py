"""Byte-level BPE over whole texts, by overlapping chunks.

A text is cut into chunks that overlap on the right. Each chunk is pre-tokenised
on its own, in parallel. What the split pattern matches from a place on depends
only on the text from there on, so once two neighbouring chunks have a boundary
in common inside their overlap, they agree from there: the left chunk counts up
to that place, the right one from it. Where an overlap holds no common boundary
(one pre-token longer than the overlap) the left chunk is continued over the
text of the right one until they meet. Then the pieces are encoded, each by
itself, and decoding joins the raw bytes of the ids.

Texts of one chunk stay where they are; only longer texts are dealt over tasks
and stitched by their key.

Defined results: a null or empty text has no ids, and the digests of nothing;
repeated rows give repeated rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

CHUNK = 32_768
OVERLAP = 2_048
#: One more than the characters of the longest fixed alternative of a split pattern.
REACH = 4
#: Pieces whose ids a worker keeps; it starts anew beyond that.
KEPT_PIECES = 200_000


class Codec:
    """Split pattern, ranks and both directions; ids of frequent pieces are kept."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._piece = self._encoding._core_bpe.encode_single_piece
        self._match = regex.compile(pattern)
        self._bytes: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._bytes[rank] = token
        self._names = [str(i) for i in range(len(self._bytes))]
        self._kept: dict[str, list[int]] = {}

    def pieces(self, text: str, start: int = 0) -> list[str]:
        return self._match.findall(text, start)

    def encode_pieces(self, pieces: list[str]) -> list[int]:
        kept = self._kept
        if len(kept) > KEPT_PIECES:
            kept.clear()
        for piece in set(pieces):
            if piece not in kept:
                kept[piece] = self._piece(piece.encode())
        return [i for piece in pieces for i in kept[piece]]

    def encode(self, text: str) -> list[int]:
        return self._encoding.encode_ordinary(text)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids))

    def joined(self, ids: list[int]) -> bytes:
        return ",".join(map(self._names.__getitem__, ids)).encode()


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process."""
    return Codec(path, pattern)


def boundaries(pieces: list[str], start: int, last: bool) -> np.ndarray:
    """Starts of the pieces and, after the last one, its end.

    Unless the chunk ends the text, what is cut off there could change the last
    piece, and a match within reach of the pattern's fixed endings: these do not count.
    """
    ends = start + np.cumsum([len(p) for p in pieces], dtype=np.int64)
    found = np.concatenate([[start], ends]).astype(np.int64)
    return found if last else found[found <= max(start, int(found[-1]) - REACH)]


def stitch(chunks: list[tuple[int, str, np.ndarray]], model: Codec) -> Iterator[list[str]]:
    """Pieces of a whole text from its chunks (start, text, boundaries) in order.

    The pattern matches every character, so boundaries give back the pieces.
    """
    at = 0
    for k, (start, text, marks) in enumerate(chunks):
        end = start + len(text)
        if at >= end:
            continue
        place = np.searchsorted(marks, at)
        synced = place < len(marks) and marks[place] == at
        following = chunks[k + 1 :]
        if synced and not following:
            stop = end
        elif synced:
            common = np.intersect1d(marks[place:], following[0][2], assume_unique=True)
            stop = int(common[0]) if len(common) else -1
        else:
            stop = -1
        if stop >= 0:
            used = marks[place : np.searchsorted(marks, stop) + 1]
            yield [text[a - start : b - start] for a, b in zip(used[:-1], used[1:])]
            at = stop
            continue
        # No common boundary: go on over the next chunks until one of them agrees.
        joined, upto = text[at - start :], end
        for n, (s, more, theirs) in enumerate(following):
            joined, upto = joined + more[upto - s :], s + len(more)
            own = boundaries(model.pieces(joined), at, last=n == len(following) - 1)
            common = np.intersect1d(own, theirs, assume_unique=True)
            common = common[common > at]
            if len(common) or n == len(following) - 1:
                stop = int(common[0]) if len(common) else upto
                used = own[: np.searchsorted(own, stop) + 1]
                yield [joined[a - at : b - at] for a, b in zip(used[:-1], used[1:])]
                at = stop
                break
        else:
            yield model.pieces(joined)
            at = end


def _digests(model: Codec, ids: list[int]) -> tuple[int, str, str]:
    return (
        len(ids), hashlib.sha256(model.joined(ids)).hexdigest(),
        hashlib.sha256(model.decode(ids)).hexdigest(),
    )


def _chunks(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, doc_id, k, last, begin, text): the chunks of the longer texts."""
    long = docs.filter(F.length("text") > chunk).withColumn(
        "row", F.struct(F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id())
    )
    parts = long.withColumn(
        "k", F.explode(F.expr(f"sequence(0L, (length(text) - 1) div {chunk})"))
    )
    return parts.select(
        "row", "doc_id", "k", (F.col("k") * chunk).alias("begin"),
        (F.col("k") == F.floor((F.length("text") - 1) / chunk)).alias("last"),
        F.substring("text", (F.col("k") * chunk + 1).cast("int"), F.lit(chunk + overlap)).alias("text"),
    )


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of every text."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    key = docs.schema["doc_id"].dataType.simpleString()
    digest_type = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<int>" if with_ids else "")

    def result(model: Codec, keys: list, ids_of: list[list[int]]) -> pd.DataFrame:
        rows = [_digests(model, ids) for ids in ids_of]
        out = pd.DataFrame({"doc_id": pd.Series(keys)})
        out["n_tokens"] = np.array([r[0] for r in rows], np.int64)
        out["ids_sha256"], out["decoded_sha256"] = [r[1] for r in rows], [r[2] for r in rows]
        if with_ids:
            out["ids"] = pd.Series(ids_of, dtype=object)
        return out

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = codec(ranks_path, pattern)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                yield result(model, part["doc_id"].tolist(), [model.encode(t) for t in part["text"]])

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = codec(ranks_path, pattern)
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.iloc[at : at + 64].copy()
                part["marks"] = [
                    boundaries(model.pieces(t), b, last).tolist()
                    for t, b, last in zip(part["text"], part["begin"], part["last"])
                ]
                yield part.drop(columns="last")

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        model = codec(ranks_path, pattern)
        group = group.sort_values("k")
        chunks = [(int(b), t, np.asarray(m, np.int64)) for b, t, m in zip(group["begin"], group["text"], group["marks"])]
        ids = [i for pieces in stitch(chunks, model) for i in model.encode_pieces(pieces)]
        return result(model, [group["doc_id"].iloc[0]], [ids])

    whole = texts.filter(F.length("text") <= chunk).mapInPandas(short, f"doc_id {key}, {digest_type}")
    row_type = f"struct<doc_id:{key},hash:bigint,place:bigint>"
    cut = _chunks(texts, chunk, overlap).withColumn("row", F.col("row").cast(row_type))
    # Chunks are as large as a text allows; dealing them evenly spreads the work.
    marked_chunks = cut.withColumn("row", F.to_json("row")).mapInPandas(
        marked, f"row string, doc_id {key}, k long, begin long, text string, marks array<long>"
    )
    stitched = marked_chunks.groupBy("row").applyInPandas(joined, f"doc_id {key}, {digest_type}")
    return whole.unionByName(stitched)
