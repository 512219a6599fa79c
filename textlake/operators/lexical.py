"""Stems, lemmas and the full token chain over a document table."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from textlake.functions.grams import by_slices, row_lengths
from textlake.functions.porter import stem
from textlake.functions.text import STOPWORDS, surface_tokens
from textlake.operators.joins import MAX_BROADCAST_ROWS, salted_join
from textlake.session import materialize
from textlake.specs import CleanConfig

MAX_DICTIONARY_BYTES = 64 * 1024 * 1024

# Noun endings and what they become.
NOUN_ENDINGS = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"),
    ("shes", "sh"), ("men", "man"), ("ies", "y"),
)


def stem_tokens(tokens: Column, extended: bool = True) -> Column:
    """Porter stem of every token.

    Runs in Arrow batches and remembers stems per worker, so each distinct token
    is worked out once. Joining a table of stems back instead would explode and
    shuffle the whole corpus twice.
    """

    @F.pandas_udf("array<string>")
    def stems(batch: pd.Series) -> pd.Series:
        return batch.map(lambda ts: None if ts is None else [stem(t, extended) for t in ts])

    return stems(tokens)


def corpus_terms(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Distinct tokens of a corpus, as ``term``."""
    return (
        df.select(F.explode_outer(F.array_distinct(tokens)).alias("term"))
        .where(F.col("term").isNotNull())
        .distinct()
    )


def _detach(form: Column) -> Column:
    """Forms left after one ending is replaced: array of (form, rule number)."""
    options = [
        F.when(
            F.endswith(form, F.lit(ending)),
            F.struct(
                F.concat(
                    F.substring(form, F.lit(1), F.length(form) - len(ending)), F.lit(replacement)
                ).alias("form"),
                F.lit(number).alias("rule"),
            ),
        )
        for number, (ending, replacement) in enumerate(NOUN_ENDINGS, start=1)
    ]
    return F.filter(F.array(*options), lambda option: option.isNotNull())


def _live(term: Column) -> Column:
    """One character for each place, from the end, that detaching can reach; 's' or 'm' where it goes on.

    An ending is taken from a form in ``s``; what is left ends in ``s`` again only by
    ``ss`` or ``ses``, so all forms that go on are beginnings of the term, up to
    each ``s`` of its last run of ``s`` with single ``e`` between. A beginning in
    ``men`` before that run goes on too.
    """
    tail = F.reverse(F.substr(term, F.length(F.rtrim(term, F.lit("es"))) + 1))
    doubled = F.instr(tail, "ee")
    run = F.rtrim(F.when(doubled > 0, F.substr(tail, F.lit(1), doubled - 1)).otherwise(tail), F.lit("e"))
    run = F.when(F.endswith(term, F.lit("s")), run).otherwise("")
    base = F.substr(term, F.lit(1), F.length(term) - F.length(run))
    return F.concat(run, F.when(F.endswith(base, F.lit("men")), "m").otherwise(""))


def noun_lemmas(
    terms: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None
) -> DataFrame:
    """(term, lemma) for the terms whose noun lemma differs from themselves.

    ``terms`` has (term), ``lexicon`` (lemma), ``exceptions`` (form, lemma). The
    term itself and its detached forms are looked up in the lexicon, the shortest
    hit wins. Terms without a hit have their forms detached again, as long as any
    are left. A term with an exception is looked up by that alone.

    All forms of a term come from one expression, however often an ending can be
    detached; forms longer than any lemma are never made.
    """
    known = lexicon.select(F.col("lemma").alias("form")).distinct()
    rank = F.struct("cut", F.length("form").alias("n"), "rule", "form")
    found = []

    def best(forms: DataFrame) -> DataFrame:
        return forms.join(known, "form", "left_semi").groupBy("term").agg(F.min(rank).alias("best"))

    if exceptions is not None:
        irregular = terms.join(
            exceptions.select(F.col("form").alias("term"), "lemma"), "term"
        )
        own = irregular.select("term", F.col("term").alias("form"), F.lit(0).alias("rule"))
        other = irregular.select("term", F.col("lemma").alias("form"), F.lit(1).alias("rule"))
        found.append(best(own.unionByName(other).withColumn("cut", F.lit(0))))
        terms = terms.join(irregular.select("term"), "term", "left_anti")
    # Only these endings can change a term.
    terms = terms.where(F.endswith("term", F.lit("s")) | F.endswith("term", F.lit("men")))
    own = terms.select("term", F.col("term").alias("form"), F.lit(0).alias("rule"))
    once = terms.select("term", F.inline(_detach(F.col("term")))).select("term", "form", "rule")
    hits = materialize(best(own.unionByName(once).withColumn("cut", F.lit(0))), "lemmas")
    found.append(hits)
    longest = lexicon.agg(F.max(F.length("lemma"))).first()[0] or 0
    places = (
        terms.where(F.length(_live(F.col("term"))) > 1)
        .join(hits, "term", "left_anti")
        .select("term", F.posexplode(F.split(_live(F.col("term")), "")).alias("cut", "goes_on"))
        # The longest ending takes off three letters more than it puts in place.
        .where(F.col("goes_on").isin("s", "m") & (F.length("term") - F.col("cut") <= longest + 3))
    )
    shorter = F.substr("term", F.lit(1), F.length("term") - F.col("cut"))
    again = places.select("term", "cut", F.inline(_detach(shorter))).select("term", "form", "rule", "cut")
    found.append(best(again.where("cut > 0")))
    merged = found[0]
    for more in found[1:]:
        merged = merged.unionByName(more)
    return merged.select("term", F.col("best.form").alias("lemma")).where("lemma <> term")


def replace_tokens(df: DataFrame, mapping: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Replace the tokens found in ``mapping`` (term, lemma); others stay.

    A mapping of checked size becomes a dictionary on every worker and no row
    moves. A larger one is joined, with the same result: every row gets an id of its own,
    which is written with it; tokens are exploded with their positions, the join is salted against
    frequent tokens, and the lists are put together again. Rows may repeat in all
    their columns. A stream with a mapping that large needs ``foreachBatch``.
    """
    rows, size = mapping.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length("term") + F.octet_length("lemma")), F.lit(0))
    ).first()
    if rows <= MAX_BROADCAST_ROWS and size <= MAX_DICTIONARY_BYTES:
        return df.withColumn(tokens, dictionary_lookup(mapping)(F.col(tokens)))
    if df.isStreaming:
        raise ValueError(f"{rows} lemmas are too many to hold in a task; transform each batch in foreachBatch")
    numbered = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    exploded = numbered.select("_row", F.posexplode(tokens).alias("pos", "term"))
    joined = salted_join(exploded, mapping, "term", "_row", "left")
    lists = joined.groupBy("_row").agg(
        F.sort_array(
            F.collect_list(F.struct("pos", F.coalesce("lemma", "term").alias("token")))
        ).alias("pairs")
    )
    replaced = lists.select("_row", F.col("pairs.token").alias("_replaced"))
    return (
        numbered.join(replaced, "_row", "left")
        .withColumn(tokens, F.coalesce("_replaced", tokens))
        .select(df.columns)
    )


def dictionary_lookup(mapping: DataFrame):
    """Arrow function array -> array over a small (term, lemma) table.

    The table stays in two Arrow arrays, and a slice of rows looks up its distinct
    tokens alone, so a worker holds neither a dictionary nor a Python string per token.
    """
    spark = mapping.sparkSession
    # Of several lemmas of a term the last one counts, as in a dictionary.
    table = {row.term: row.lemma for row in mapping.select("term", "lemma").collect()}
    terms, lemmas = pa.array(table.keys(), pa.string()), pa.array(table.values(), pa.string())
    shared = spark.sparkContext.broadcast((terms, lemmas))

    def replace(lists: pa.Array) -> pa.Array:
        known, lemma = shared.value
        coded = lists.flatten().dictionary_encode()
        at = pc.index_in(known, coded.dictionary)  # hashes the slice's tokens, not the table
        hits = pc.is_valid(at)
        place = at.filter(hits)
        names = pc.replace_with_mask(
            coded.dictionary, *_scattered(place, lemma.filter(hits), len(coded.dictionary))
        )
        flat = names.take(coded.indices)
        offsets = np.concatenate([[0], np.cumsum(row_lengths(lists))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pc.is_null(lists))

    @F.arrow_udf("array<string>")
    def replaced(lists: pa.Array) -> pa.Array:
        return by_slices(replace, lists)

    return replaced


def _scattered(place: pa.Array, values: pa.Array, n: int) -> tuple[pa.Array, pa.Array]:
    """(mask of n places, values in the order of their places)."""
    mask = np.zeros(n, bool)
    mask[place.to_numpy()] = True
    return pa.array(mask), values.take(pc.sort_indices(place))


def lemmatize_tokens(
    df: DataFrame,
    lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None,
    tokens: str = "tokens",
) -> DataFrame:
    """Noun lemma of every token; without a lexicon the corpus' own terms serve."""
    terms = corpus_terms(df, tokens)
    if lexicon is None:
        terms = materialize(terms, "terms")
        lexicon = terms.select(F.col("term").alias("lemma"))
    mapping = materialize(noun_lemmas(terms, lexicon, exceptions), "lemma-map")
    return replace_tokens(df, mapping, tokens)


def with_tokens(
    df: DataFrame,
    cfg: CleanConfig,
    text: str = "text",
    lemmas: DataFrame | None = None,
    stopwords=STOPWORDS,
) -> DataFrame:
    """Add ``tokens``: the whole chain, with stem or lemma if the config asks.

    ``lemmas`` is a ready (term, lemma) table, as an index or model keeps it;
    without it lemmas are worked out from the corpus itself.
    """
    out = df.withColumn("tokens", surface_tokens(F.col(text), cfg, stopwords))
    if cfg.reduction == "stem":
        return out.withColumn("tokens", stem_tokens(F.col("tokens")))
    if cfg.reduction == "lemma":
        if lemmas is None:
            return lemmatize_tokens(out)
        return replace_tokens(out, lemmas)
    return out


def clean_text(df: DataFrame, cfg: CleanConfig, text: str = "text", **options) -> DataFrame:
    """Add ``clean``: the tokens joined by one space."""
    return with_tokens(df, cfg, text, **options).withColumn("clean", F.array_join("tokens", " "))
