"""Removing repeated lines, keeping the earliest occurrence of each.

A unit is a line (or, with another separator, a paragraph). Units are compared
by the digest of their normal form: lower case, white space collapsed. Digests
are grouped over the whole corpus; of each that occurs more than once, the
occurrence that ranks first by document id and place stays. What goes is returned
with its offsets in the original text. If asked for, passages inside lines go too, of
at least so many words, where an earlier document has them (see ``passages``).

Defined results: a null or empty text stays as it is; units of fewer words than
``min_words`` always stay; a document may lose all its units, and then has an
empty text; rows with the same id and text are one document to the ranking, so
they lose the same units; a null ``doc_id`` ranks first; an empty table gives an
empty result; other columns pass through unchanged, but for one called ``removed``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from textlake.llm import passages
from textlake.llm.files import materialize

MIN_WORDS = 4


def unit_digest(unit: str, min_words: int) -> bytes | None:
    words = unit.lower().encode().split()
    if len(words) < min_words:
        return None
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def remove_units(
    text: str, gone: set[int], separator: str, passages: list[tuple[int, int]] = (),
) -> tuple[str, list[tuple[int, int]]]:
    """The rest of a text and the (start, end) of what was removed, each with the separator behind it.

    ``passages`` are cut out of units that stay; a unit left blank by that goes whole.
    """
    units, at, kept, spans, next_ = text.split(separator), 0, [], [], 0
    for k, unit in enumerate(units):
        stop = at + len(unit)
        end = min(len(text), stop + len(separator))
        while next_ < len(passages) and passages[next_][1] <= at:
            next_ += 1
        inside, rest, last = [], [], at
        for start, behind in passages[next_:]:
            if start >= stop:
                break
            inside.append((max(start, at), min(behind, stop)))
            rest.append(text[last : inside[-1][0]])
            last = inside[-1][1]
        left = "".join([*rest, text[last:stop]])
        if k in gone or inside and not left.strip():
            spans.append((at, end))
        else:
            kept.append(left)
            spans.extend(inside)
        at = stop + len(separator)
    return separator.join(kept), spans


def repeated_units(docs: DataFrame, separator: str = "\n", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, text_hash, gone): per document the places of the units that go."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                rows = [
                    (doc, text_hash, k, digest)
                    for doc, text_hash, text in batch.iloc[at : at + 512].itertuples(index=False)
                    for k, unit in enumerate(text.split(separator))
                    if (digest := unit_digest(unit, min_words)) is not None
                ]
                yield pd.DataFrame(rows, columns=["id", "text_hash", "unit", "digest"])

    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"), "text").filter("text is not null")
    place = materialize(
        texts.mapInPandas(units, f"id {key}, text_hash long, unit int, digest binary"), "units")
    # Counts by digest come before the shuffle; a very common line is one row of each task.
    first = materialize(
        place.groupBy("digest").agg(F.min(F.struct("id", "text_hash", "unit")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "first"), "repeated")
    later = place.join(first, "digest").filter(F.struct("id", "text_hash", "unit") != F.col("first"))
    return later.groupBy("id", "text_hash").agg(F.collect_set("unit").alias("gone"))


def dedup_lines(
    docs: DataFrame, separator: str = "\n", min_words: int = MIN_WORDS, passage_words: int | None = None,
) -> DataFrame:
    """All columns and rows of ``docs``, ``text`` without its repeated units, and ``removed``.

    ``removed`` holds (start, end) in characters of the original text. With
    ``passage_words``, passages of at least so many words that an earlier document has go too.
    """
    gone = repeated_units(docs, separator, min_words).withColumn("places", F.array().cast("array<int>"))
    if passage_words:
        also = passages.repeated_windows(docs, passage_words).withColumn("gone", F.array().cast("array<int>"))
        gone = gone.unionByName(also).groupBy("id", "text_hash").agg(
            F.flatten(F.collect_list("gone")).alias("gone"), F.flatten(F.collect_list("places")).alias("places"))
    gone = materialize(gone, "gone").toDF("_gone_id", "_gone_hash", "_gone", "_places")
    docs = docs.drop("removed")
    names = docs.columns
    marked = docs.withColumn("_hash", F.xxhash64("text")).join(
        gone, F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (F.col("_hash") == F.col("_gone_hash")), "left")

    @F.pandas_udf("text string, removed array<struct<start:int,end:int>>")
    def cut(text: pd.Series, units: pd.Series, places: pd.Series) -> pd.DataFrame:
        done = [
            (t, []) if u is None or t is None else remove_units(
                t, set(u), separator, passages.spans(t, p, passage_words) if len(p) else [])
            for t, u, p in zip(text, units, places)
        ]
        return pd.DataFrame({"text": [d[0] for d in done],
                             "removed": [[{"start": a, "end": b} for a, b in d[1]] for d in done]})

    touched = marked.filter("_gone is not null").withColumn("_cut", cut("text", "_gone", "_places"))
    untouched = marked.filter("_gone is null")
    none = F.lit(None).cast("array<struct<start:int,end:int>>")
    return touched.select(
        *[F.col("_cut.text").alias("text") if n == "text" else docs[n] for n in names], F.col("_cut.removed").alias("removed")
    ).unionByName(untouched.select(*[docs[n] for n in names], F.coalesce(none, F.array().cast("array<struct<start:int,end:int>>")).alias("removed")))
