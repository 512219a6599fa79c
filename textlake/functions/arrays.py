"""Helpers on array columns that stay in the JVM and within one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    Writing the column twice would make Spark evaluate it twice (and once per
    element inside a lambda); binding it as a lambda variable does not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_lengths(items: Column) -> Column:
    """Array of strings -> array of (term, tf), one entry per distinct string.

    The array is sorted and equal neighbours are counted, so a document's term
    counts never leave its row: no shuffle, n log n in the document's length.
    """

    def count_runs(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
        )
        runs = let(
            starts,
            lambda at: F.transform(
                at,
                lambda begin, k: F.struct(
                    F.get(s, begin).alias("term"),
                    (F.coalesce(F.get(at, k + 1), F.size(s)) - begin).alias("tf"),
                ),
            ),
        )
        return F.when(F.size(s) > 0, runs).otherwise(
            F.array().cast("array<struct<term:string,tf:int>>")
        )

    return let(F.sort_array(items), count_runs)


def ngram_array(tokens: Column, lo: int = 1, hi: int = 2) -> Column:
    """All n-grams of lo..hi tokens, joined by one space."""
    if not 1 <= lo <= hi:
        raise ValueError(f"bad n-gram range ({lo}, {hi})")

    def grams(t: Column) -> Column:
        parts = []
        for n in range(lo, hi + 1):
            part = t
            for offset in range(1, n):
                kept = F.greatest(F.size(t) - offset, F.lit(0))
                part = F.zip_with(
                    F.slice(part, F.lit(1), kept),
                    F.slice(t, F.lit(offset + 1), kept),
                    lambda a, b: F.concat(a, F.lit(" "), b),
                )
            parts.append(part)
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    return grams(tokens) if (lo, hi) == (1, 1) else let(tokens, grams)
