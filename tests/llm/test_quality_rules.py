"""Quality rules: counts by a second construction, cutoffs by exact binomial sums."""

import math
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from textlake.llm import quality_rules as q


def brute_counts(text):
    text = text or ""
    words = re.split(r"[\x20\x09-\x0D]+", text)
    words = [w for w in words if w]
    lines, earlier, dup = 0, [], 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += 1
            dup += line in earlier
            earlier.append(line)
    starts = [i for i in range(len(words) - 2)
              if sum(words[i : i + 3] == words[j : j + 3] for j in range(len(words) - 2)) > 1]
    covered = {i + k for i in starts for k in range(3)}
    return (len(words), sum(len(w) for w in words), sum(text.count(c) for c in "#*$%&|<>"), lines, dup, len(covered))


def brute_k(n, rate, level):
    rate, level, cdf, best = Fraction(rate).limit_denominator(10**9), Fraction(level), Fraction(0), -1
    for k in range(n + 1):
        cdf += math.comb(n, k) * rate**k * (1 - rate) ** (n - k)
        if cdf > level:
            break
        best = k
    return best


GOOD = " ".join(f"word{i} common" for i in range(40))
TEXTS = [
    "", None, "a b c a b c a b c", "x\ny\nx\n\n \nx z", "é# $x|<y>& * %% ", "one two three one two three four",
    GOOD, GOOD + "\n" + GOOD, ("rep " * 200).strip(), "\t\n\r\x0b\x0c",
]


def test_counts_equal_a_second_construction(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in q.features(docs).select("doc_id", *q.COUNTS).collect()}
    assert got == {i: brute_counts(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("n", [1, 2, 10, 37, 200, 1973, 5000])
def test_allowed_rejections_equal_exact_binomial_sums(spark, n):
    level = 0.05 / 20
    got = spark.range(1).select(q.allowed_rejections(F.lit(n).cast("long"), 0.01, F.lit(level)).alias("k")).first().k
    assert got == brute_k(n, 0.01, level)


def test_cutoffs_and_verdicts(spark):
    rows = []
    for i in range(400):
        junk = "#" * (i % 7)
        text = " ".join(f"w{i}x{j}{junk if j == 0 else ''}" for j in range(60 + i % 5))
        rows.append((i, text, "en" if i % 4 else None, "clash"))
    rows += [(1000, None, "en", "x"), (1001, "", "en", "x"), (1002, GOOD, "de", "x"), (1002, GOOD, "de", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in range(0, 400, 1)] + [(3, 0), (1002, 1)], "doc_id long, quality int")
    cutoffs = {(r.stratum, r.rule): r for r in q.fit_cutoffs(q.features(docs), labels).collect()}
    good = [(i, t, lang) for i, t, lang, _ in rows[:400] if i != 3]
    for stratum in ("en", None):
        values = sorted((t.count("#") / (60 + i % 5) for i, t, lang in good if lang == stratum), reverse=True)
        tests = len(cutoffs)
        k = brute_k(len(values), 0.01, 0.05 / tests)
        row = cutoffs[(stratum, "symbol_ratio")]
        assert (row.n, row.k) == (len(values), k)
        assert row.cutoff == (values[k] if k >= 0 else None)
    judged = {r.doc_id: r for r in q.judge(docs, labels).collect()}
    assert len(judged) == 403
    assert judged[1000].base_failed and not judged[1000].kept and not judged[1001].kept
    assert judged[1002].kept and judged[1002].rejected_by == []
    for i, _, lang, _ in rows[:400]:
        r = judged[i]
        fails = [rule for rule in q.RULES if cutoffs[(lang, rule)].cutoff is not None
                 and getattr(r, rule) is not None and getattr(r, rule) > cutoffs[(lang, rule)].cutoff]
        assert r.kept == (not r.base_failed and not fails)
    assert q.judge(docs.filter("false"), labels).count() == 0
    unlabelled = q.judge(docs, labels.filter("false")).collect()
    assert len(unlabelled) == len(rows)
    assert all(r.kept == (not r.base_failed) for r in unlabelled)


def test_cutoffs_come_from_every_good_document(spark):
    n = 260_000
    values = {rule: ((F.col("doc_id") * 7919 + k) % n / n) for k, rule in enumerate(q.RULES)}
    scored = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit(False).alias("base_failed"))
    scored = scored.withColumns(values)
    labels = scored.select("doc_id", F.lit(1).alias("quality"))
    rows = q.fit_cutoffs(scored, labels).collect()
    assert {r.n for r in rows} == {n} and len(rows) == len(q.RULES)
    assert all(r.cutoff == (n - 1 - r.k) / n for r in rows)


def test_judge_counts_every_text_once(spark):
    counted = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        counted.add(1)
        return text

    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "en") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("text", seen("text"))
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    assert q.judge(docs, labels).filter("kept").count() == 50
    assert counted.value == 50
    judged = q.judge(docs, labels, columns=["doc_id", "lang"])
    assert judged.columns == ["doc_id", "lang", *q.COUNTS, "base_failed", *q.RULES, "rejected_by", "kept"]
