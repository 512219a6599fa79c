"""Token ids in binary files of Simple-8b words, in ascending document order.

A file holds, little-endian: a magic number; the words of its blocks; then per
document its id, whether the id is null, and its number of ids; the block offsets
in words; and a trailer with the counts. Blocks run over document borders.

Documents are dealt to tasks by ranges of ``doc_id`` and sorted there; each task
streams its ids to one file, a slab at a time, and reports the file in a manifest.
Positions over the whole corpus follow from the manifest alone.

Defined results: a null or empty text has only the end id; a null ``doc_id``
comes first; rows of one ``doc_id`` are ordered by text; an empty table gives no
documents; other columns are ignored. ``doc_id`` is an integer.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from textlake.llm import simple8b
from textlake.llm.files import create, materialize, one_each, open_file, scratch_path

MAGIC = b"TLS8B001"
TRAILER = "<qqqqq8s"
TRAILER_BYTES = struct.calcsize(TRAILER)
#: Ids encoded, and read, at a time.
SLAB = simple8b.BLOCK * 1024
#: Characters of texts encoded together; a longer text is by itself.
TOGETHER = 4_000_000
#: Words whose ids a worker keeps; it starts anew beyond that.
KEPT_WORDS = 300_000
#: Visible ASCII and composed Latin letters.
PLAIN = re.compile("[!-~\u00c0-\u024f]*")
PLAIN_LINES = re.compile("[\n!-~\u00c0-\u024f]*")
#: The tokenizer's own pattern of pre-tokens.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MANIFEST = "file string, first long, first_null boolean, n_docs long, n_ids long"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level models write for each byte: itself if visible in Latin-1, else one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def flat(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids in turn, number of each one's)."""
    return np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


def picked(ids: np.ndarray, size: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for the lists numbered in ``order``."""
    begin, n = np.cumsum(size) - size, size[order]
    return ids[np.arange(n.sum()) + np.repeat(begin[order] - np.cumsum(n) + n, n)], n


def ids_of_texts(texts: pa.Array, ids_of_words) -> tuple[np.ndarray, np.ndarray]:
    """(all ids in turn, number of each text's), ``ids_of_words`` giving those of distinct words."""
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    ids, n = picked(*ids_of_words(coded.dictionary.to_numpy(zero_copy_only=False).tolist()),
                    coded.indices.to_numpy(zero_copy_only=False))
    words = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))
    return ids, np.diff(np.append(0, np.append(0, np.cumsum(n))[words]))


class WordIds:
    """Ids of whole texts from a tokenizer that drops white space.

    Its pre-tokens never span white space, so texts are split into words and their
    words numbered in Arrow, and each distinct word is encoded once. Words of visible ASCII and Latin letters
    are composed already, and lower-casing them is the same everywhere: they are
    split into pre-tokens here by the tokenizer's own pattern, each distinct
    pre-token going to its model. All other words, and those of a tokenizer with
    other steps, go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        steps = json.loads(self._tokenizer.to_str())
        self._plain = self._is_plain(steps)
        # Added tokens are found anywhere in a text, before all other steps.
        self._added = re.compile("|".join(re.escape(t["content"]) for t in steps["added_tokens"]) or "(?!)")
        self._letters = _byte_letters()
        self._kept: dict[bytes, bytes] = {}
        self._pieces: dict[str, bytes] = {}

    @staticmethod
    def _is_plain(steps: dict) -> bool:
        """Whether composing, blanks, lower case and the pattern of ``PIECES`` are all that happens before the model."""
        normal = (steps["normalizer"] or {}).get("normalizers", [])
        before = (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
        if [n["type"] for n in normal] != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in before] != ["Split", "ByteLevel"]:
            return False
        split, letters = before
        blanks = normal[1]["pattern"] == {"Regex": r"\s+"} and normal[1]["content"] == " "
        kept = split["behavior"] == "Removed" and split["invert"] and not letters["add_prefix_space"] and not letters["use_regex"]
        return blanks and kept and split["pattern"] == {"Regex": PIECES} and not any(t["normalized"] for t in steps["added_tokens"])

    def _ids_of_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        held = self._pieces
        for piece in [x for x in pieces if x not in held]:
            written = piece if piece.isascii() else "".join(map(self._letters.__getitem__, piece.encode()))
            found = [t.id for t in self._model.tokenize(written)]
            held[piece] = struct.pack(f"<{len(found)}I", *found)
        return flat([held[x] for x in pieces])

    def _parted(self, words: list[str]) -> tuple[np.ndarray, list[str]]:
        """Which words are plain, and these in lower case; one look at all together mostly tells."""
        if not self._plain:
            return np.zeros(len(words), bool), []
        joined = "\n".join(words)
        lowered = joined.lower()
        if PLAIN_LINES.fullmatch(joined) and PLAIN_LINES.fullmatch(lowered) and not self._added.search(joined):
            return np.ones(len(words), bool), lowered.split("\n") if words else []
        lower = [w.lower() for w in words]
        plain = [bool(PLAIN.fullmatch(w) and PLAIN.fullmatch(x)) and not self._added.search(w) for w, x in zip(words, lower)]
        return np.array(plain, bool), [x for x, is_plain in zip(lower, plain) if is_plain]

    def _ids_of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain, lower = self._parted(words)
        marked = pc.replace_substring_regex(pa.array(lower, pa.large_string()), pattern=PIECES, replacement=r"\0 ")
        ids, size = ids_of_texts(marked, self._ids_of_pieces)
        if plain.all():
            return ids, size
        others = [w for w, is_plain in zip(words, plain) if not is_plain]
        new = [w for w in others if w not in self._kept]
        for word, coded in zip(new, self._tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self._kept[word] = np.array(coded.ids, "<u4").tobytes()
        more, more_size = flat([self._kept[w] for w in others])
        order = np.where(plain, np.cumsum(plain) - 1, len(lower) + np.cumsum(~plain) - 1)
        return picked(np.append(ids, more), np.append(size, more_size), order)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        for held in (self._kept, self._pieces):
            if len(held) > KEPT_WORDS:
                held.clear()
        ids, size = ids_of_texts(pa.array(texts, pa.large_string()), self._ids_of_words)
        ends = np.cumsum(size)
        return [ids[a:b].tobytes() for a, b in zip(ends - size, ends)]


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def runs_of(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(begin, end) of consecutive texts that are encoded together."""
    upto, at = np.cumsum(sizes), 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] - sizes[at] + TOGETHER, "right")))
        yield at, end
        at = end


class Writer:
    """One file; ids are encoded whenever a slab is full."""

    def __init__(self, folder: str):
        self.url, self._out = create(folder, ".s8b")
        self._out.write(MAGIC)
        self._waiting: list[np.ndarray] = []
        self._held = self.n_ids = self._words = 0
        self._offsets = [np.zeros(1, np.int64)]
        self._keys: list[np.ndarray] = []
        self._nulls: list[np.ndarray] = []
        self._sizes: list[np.ndarray] = []

    def add(self, keys: np.ndarray, nulls: np.ndarray, ids: list[bytes]) -> None:
        self._keys.append(keys.astype("<i8"))
        self._nulls.append(nulls.astype("u1"))
        self._sizes.append(np.array([len(x) // 4 for x in ids], "<i8"))
        joined = np.frombuffer(b"".join(ids), "<u4")
        self._waiting.append(joined)
        self._held += len(joined)
        self.n_ids += len(joined)
        if self._held >= SLAB:
            self._flush(self._held - self._held % SLAB)

    def _flush(self, n: int) -> None:
        ids = np.concatenate([*self._waiting, np.zeros(0, "<u4")])
        self._waiting, self._held = [ids[n:]], len(ids) - n
        words, offsets = simple8b.encode(ids[:n])
        self._out.write(words.astype("<u8").tobytes())
        self._offsets.append(offsets[1:] + self._words)
        self._words += len(words)

    def close(self) -> tuple[int, int]:
        self._flush(self._held)
        tables = [np.concatenate(x) for x in (
            [*self._keys, np.zeros(0, "<i8")], [*self._nulls, np.zeros(0, "u1")],
            [*self._sizes, np.zeros(0, "<i8")], self._offsets)]
        for table in tables:
            self._out.write(table.tobytes())
        n_docs = len(tables[0])
        self._out.write(struct.pack(TRAILER, n_docs, self.n_ids, len(tables[3]), self._words, simple8b.BLOCK, MAGIC))
        self._out.close()
        return n_docs, self.n_ids


def write(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = 1) -> DataFrame:
    """Write all ids and return the manifest, one row per file."""
    spark = docs.sparkSession
    target = folder or scratch_path(spark, "tokens")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    last = np.array([end_id], "<u4").tobytes()
    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(n, F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
        .select(F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "text")
    )

    def to_file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, writer, first, first_null = word_ids(tokenizer_path), None, 0, False
        for batch in batches:
            for at, end in runs_of(batch["text"].str.len().to_numpy(np.int64)):
                part = batch.iloc[at:end]
                if writer is None:
                    writer = Writer(target)
                    first, first_null = int(part["doc_id"].iloc[0]), bool(part["no_id"].iloc[0])
                ids = [x + last for x in model.encode(part["text"].tolist())]
                writer.add(part["doc_id"].to_numpy(), part["no_id"].to_numpy(), ids)
        if writer is not None:
            n_docs, n_ids = writer.close()
            yield pd.DataFrame([(writer.url, first, first_null, n_docs, n_ids)],
                               columns=["file", "first", "first_null", "n_docs", "n_ids"])

    return materialize(ordered.mapInPandas(to_file, MANIFEST), "manifest")


def _ids_by_document(source, sizes: np.ndarray, offsets: np.ndarray, block: int) -> Iterator[np.ndarray]:
    """Ids of each document in turn, holding one slab and one document at most."""
    total, per_slab = int(sizes.sum()), SLAB // block
    left, at = np.zeros(0, "<u4"), 0

    def slabs() -> Iterator[np.ndarray]:
        for k in range(0, len(offsets) - 1, per_slab):
            part = offsets[k : k + per_slab + 1]
            source.seek(len(MAGIC) + 8 * int(part[0]))
            words = np.frombuffer(source.read(8 * int(part[-1] - part[0])), "<u8")
            length = min(per_slab * block, total - k * block)
            yield simple8b.decode(words, part - part[0], length, block).astype("<u4")

    more = slabs()
    for n in sizes.tolist():
        while len(left) - at < n:
            left, at = np.concatenate([left[at:], next(more)]), 0
        yield left[at : at + n]
        at += n


def read(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document of the files."""
    # One row per file: their order gives where each begins.
    before = Window.orderBy(F.desc("first_null"), "first", "file").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def from_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for url, base in zip(batch["file"], batch["base"]):
                with open_file(url) as source:
                    size = source.size()
                    source.seek(size - TRAILER_BYTES)
                    n_docs, n_ids, n_offsets, n_words, block, magic = struct.unpack(TRAILER, source.read(TRAILER_BYTES))
                    if magic != MAGIC:
                        raise ValueError(f"{url} is no token file")
                    source.seek(len(MAGIC) + 8 * n_words)
                    keys = np.frombuffer(source.read(8 * n_docs), "<i8")
                    nulls = np.frombuffer(source.read(n_docs), "u1").astype(bool)
                    sizes = np.frombuffer(source.read(8 * n_docs), "<i8")
                    offsets = np.frombuffer(source.read(8 * n_offsets), "<i8")
                    starts = int(base) + np.cumsum(sizes) - sizes
                    each = _ids_by_document(source, sizes, offsets, block)
                    for at in range(0, n_docs, 1024):
                        rows = slice(at, at + 1024)
                        ids = [next(each) for _ in range(len(sizes[rows]))] if with_ids else None
                        crc = [zlib.crc32(x.tobytes()) for x in (ids or (next(each) for _ in range(len(sizes[rows]))))]
                        out = pd.DataFrame({
                            "doc_id": pd.Series(keys[rows], dtype="Int64").mask(nulls[rows]), "start": starts[rows],
                            "n_tokens": sizes[rows], "ids_crc32": np.array(crc, np.int64)})
                        if with_ids:
                            out["ids"] = [x.astype(np.int64) for x in ids]
                        yield out

    return one_each(placed).mapInPandas(from_files, schema)
