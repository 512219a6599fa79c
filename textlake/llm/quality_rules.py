"""Quality rules with cutoffs whose false rejection of good documents is bounded.

Every document gets base counts over its words (``[^\\x20\\x09-\\x0D]+``):

* ``word_chars``: code points in words;
* ``n_symbols``: characters of ``[#*$%&|<>]``;
* ``n_dup_lines``: ``\\n``-separated lines holding a word that equal an earlier line;
* ``n_repeat_words``: words covered by a 3-word window that occurs twice or more
  in the text (its first occurrence included).

``base_failed`` holds when a text has fewer than 50 words or more than half of
its words are repeated. The method then judges the rest by rules, each a ratio
where more is worse: symbols per word, repeated lines per line, repeated words
per word, mean word length, and shortness (minus the mean word length).

Cutoffs are risk-controlled. Labelled documents with quality 1 that pass the
base rules form the holdout, per stratum (default: ``lang``). For a rule with
per-rule rate a = ``alpha`` / rules and n holdout documents of a stratum, k is
the largest count with P(Binomial(n, a) <= k) <= ``delta`` / (strata x rules),
the exact binomial tail (Clopper-Pearson). The cutoff is the (k + 1)-th largest
holdout value, and a document is rejected by the rule when its value is above
it; so at most k good holdout documents are rejected, and with probability at
least 1 - ``delta``, jointly for all strata and rules (Bonferroni), no stratum
rejects more than ``alpha`` of its good documents (union bound over rules).
When k would be negative, because the stratum has too few labelled documents,
the rule rejects nothing there.

Everything is a column expression or a DataFrame operation: counts are array
functions inside the row (the 3-word windows are sorted, so repeats are
neighbours), the binomial tail is an ``aggregate`` over counts in log space,
cutoffs ranks in a histogram of the holdout. No Python runs on the rows.
The holdout is every good labelled document. Equal values are counted together; a
histogram per stratum and rule finds the step that holds the cutoff, and only the
distinct values of that step are ordered, so no task ranks a whole stratum.
``judge`` counts every document once and writes the counts to the shared folder;
fit and verdict read them there, not the texts.

Defined results: a null text has no words (base_failed, not kept); ratios are
null when there are no words or lines; a null stratum is a stratum of its own;
a document with labels of both qualities is not in the holdout; repeated rows
count once per row; an empty table or one without labelled documents gives
base verdicts only; columns of the input pass through, those named like an
output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from textlake.session import materialize

# Fixed values of the rules.
WORD_SPLIT = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

ALPHA = 0.05
DELTA = 0.05
STEPS = 4096  # steps of a rule value in the histogram that locates its cutoff
BROADCAST_ROWS = 100_000
RULES = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "word_length", "shortness")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
OUTPUTS = COUNTS + ("base_failed",) + RULES + ("kept", "rejected_by")


def _chars(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once: bound as a lambda variable, so that
    the optimizer cannot copy its expression into the per-element lambdas of ``use``."""
    return F.transform(F.array(value), use)[0]


def _repeated_words(words: Column) -> Column:
    """Words covered by a 3-word window found twice or more; sorted windows put repeats side by side."""
    starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0))), lambda i: i + 2 < F.size(words))
    windows = F.array_sort(F.transform(starts, lambda i: F.struct(
        F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("g"), i.alias("p"))))

    def covered(tri: Column) -> Column:
        firsts = F.transform(tri, lambda x, j: F.when(
            (F.get(tri, j - 1)["g"] == x["g"]) | (F.get(tri, j + 1)["g"] == x["g"]), x["p"]).otherwise(-1))
        kept = F.filter(firsts, lambda p: p >= 0)
        return F.size(F.array_distinct(F.flatten(F.transform(kept, lambda p: F.array(p, p + 1, p + 2)))))

    return _once(windows, covered)


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Base counts, base verdict and rule values of every document."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, WORD_SPLIT), lambda w: w != "")
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(HAS_WORD))
    counted = docs.drop(*OUTPUTS).select(
        "*",
        F.size(words).cast("long").alias("n_words"),
        (F.length(body) - _chars(body, WORD_SPLIT)).cast("long").alias("word_chars"),
        _chars(body, SYMBOLS).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        _once(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        _once(words, _repeated_words).cast("long").alias("n_repeat_words"),
    )
    words, lines = F.col("n_words"), F.col("n_lines")
    ratio = lambda a, b: F.when(b > 0, a / b)
    return counted.select(
        *[c for c in counted.columns if c not in COUNTS], *COUNTS,
        ((words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * words)).alias("base_failed"),
        ratio(F.col("n_symbols"), words).alias("symbol_ratio"),
        ratio(F.col("n_dup_lines"), lines).alias("dup_line_ratio"),
        ratio(F.col("n_repeat_words"), words).alias("repeat_ratio"),
        ratio(F.col("word_chars"), words).alias("word_length"),
        (-ratio(F.col("word_chars"), words)).alias("shortness"),
    )


def allowed_rejections(n: Column, rate: float, level: Column) -> Column:
    """Largest k with P(Binomial(n, rate) <= k) <= level, -1 if none: the exact tail, summed in log space."""
    top = F.least(n - 1, F.floor(n * rate) + 1).cast("long")
    step = F.lit(math.log(rate / (1 - rate)))
    return F.aggregate(
        F.sequence(F.lit(0).cast("long"), top),
        F.struct((n * F.log(F.lit(1 - rate))).cast("double").alias("lp"), F.lit(0.0).alias("cdf"),
                 F.lit(-1).cast("long").alias("k")),
        lambda acc, k: F.struct(
            (acc["lp"] + F.log((n - k) / (k + 1)) + step).alias("lp"),
            (acc["cdf"] + F.exp(acc["lp"])).alias("cdf"),
            F.when(acc["cdf"] + F.exp(acc["lp"]) <= level, k).otherwise(acc["k"]).alias("k"),
        ),
        lambda acc: acc["k"],
    )


def _join_small(big: DataFrame, small: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """Broadcast ``small`` when its row count is proven below ``BROADCAST_ROWS``, else a shuffle join."""
    side = F.broadcast(small) if small.count() <= BROADCAST_ROWS else small
    return big.join(side, on, how)


def fit_cutoffs(scored: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id",
                alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, n, k, cutoff) from the good labelled documents of ``scored`` (output of ``features``)."""
    verdicts = labels.groupBy(F.col(key).alias("_key")).agg(
        F.min("quality").alias("_low"), F.max("quality").alias("_high"))
    good = verdicts.filter((F.col("_low") == 1) & (F.col("_high") == 1)).select("_key")
    held = materialize(scored.filter(~F.col("base_failed"))
                       .select(F.col(stratum).alias("stratum"), F.col(key).alias("_id"), *RULES)
                       .join(good, F.col("_id") == good["_key"], "left_semi"), "quality-holdout")
    long = held.select("stratum", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(rule).cast("double").alias("value")) for rule in RULES])).alias("r"),
    ).select("stratum", "r.rule", "r.value").filter(F.col("value").isNotNull())
    values = materialize(long.groupBy("stratum", "rule", "value").agg(F.count("*").alias("rows")), "quality-values")
    tests = values.groupBy("stratum", "rule").agg(F.sum("rows").alias("n"))
    tests = tests.withColumn("_tests", F.count("*").over(Window.partitionBy()))
    rate = alpha / len(RULES)
    tests = tests.withColumn("k", allowed_rejections(F.col("n"), rate, F.lit(delta) / F.col("_tests"))).drop("_tests")
    open_ = tests.filter("k >= 0").select(F.col("stratum").alias("_s"), F.col("rule").alias("_r"), "k")
    steps = (values.groupBy("stratum", "rule", F.floor(F.col("value") * STEPS).alias("step"))
             .agg(F.sum("rows").alias("rows")))
    down = Window.partitionBy("stratum", "rule").orderBy(F.col("step").desc())
    upto = steps.withColumn("_upto", F.sum("rows").over(down))
    at = (_join_small(upto, open_, upto["stratum"].eqNullSafe(open_["_s"]) & (upto["rule"] == open_["_r"]))
          .filter((F.col("_upto") > F.col("k")) & (F.col("_upto") - F.col("rows") <= F.col("k")))
          .select("_s", "_r", F.col("step").alias("_step"), (F.col("k") - F.col("_upto") + F.col("rows")).alias("_left")))
    inside = _join_small(values, at, values["stratum"].eqNullSafe(at["_s"]) & (values["rule"] == at["_r"])
                         & (F.floor(values["value"] * STEPS) == at["_step"]))
    down = Window.partitionBy("_s", "_r").orderBy(F.col("value").desc())
    cuts = (inside.withColumn("_upto", F.sum("rows").over(down))
            .filter((F.col("_upto") > F.col("_left")) & (F.col("_upto") - F.col("rows") <= F.col("_left")))
            .select("_s", "_r", F.col("value").alias("cutoff")))
    on = tests["stratum"].eqNullSafe(cuts["_s"]) & (tests["rule"] == cuts["_r"])
    return tests.join(cuts, on, "left").select("stratum", "rule", "n", "k", "cutoff")


def apply(scored: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``scored`` with ``kept`` and ``rejected_by`` (the rules a document fails, base first)."""
    wide = cutoffs.groupBy(F.col("stratum").alias("_stratum")).agg(
        *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"_cut_{rule}") for rule in RULES])
    joined = _join_small(scored, wide, scored[stratum].eqNullSafe(wide["_stratum"]), "left")
    fails = [F.when(F.col("base_failed"), F.lit("base"))] + [
        F.when(F.col(rule) > F.col(f"_cut_{rule}"), F.lit(rule)) for rule in RULES]
    rejected = F.filter(F.array(*fails), lambda r: r.isNotNull())
    return joined.withColumn("rejected_by", rejected).withColumn("kept", F.size("rejected_by") == 0).drop(
        "_stratum", *[f"_cut_{rule}" for rule in RULES])


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", columns: Sequence[str] | None = None,
          **fit) -> DataFrame:
    """Counts, base verdict, rule values and the final ``kept`` of every document.

    ``columns`` are those of the input to pass through, all by default; the key and the
    stratum must be among them. They are written with the counts, so leave out long
    ones that nobody needs.
    """
    counted = features(docs)
    if columns is not None:
        counted = counted.select(*[c for c in columns if c not in OUTPUTS], *COUNTS, "base_failed", *RULES)
    scored = materialize(counted, "quality-counts")
    return apply(scored, fit_cutoffs(scored, labels, stratum, **fit), stratum)
