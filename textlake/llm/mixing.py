"""Mixing sources to target weights by entropy balancing, with DataFrame operations only.

Every source gets a target number of words. Among all document rates that meet
the targets, entropy balancing takes those nearest to "each document once" in
Kullback-Leibler distance: ``rate = min(3, exp(lambda * size / mean size))`` with
one dual variable per source. Newton steps on the convex dual find the variables;
each step is one aggregate over the (source, size) histogram. The rates are then
rounded into whole copies so that the words of a source stay near its target.

Defined results: a null text has size 0; a null source is a source of its own,
ordered last; documents of size 0 are taken 0 times; an empty table gives an
empty result; repeated rows are separate documents; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from textlake.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3.0
#: Documents of a source that are rounded together.
TOGETHER = 256
MAX_STEPS = 60
#: Largest relative gap between the words a source's rates give and its target.
TOLERANCE = 1e-7
#: Sources up to this number are broadcast; beyond it the joins shuffle.
MAX_BROADCAST_SOURCES = 10_000


def with_size(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) with the number of words of each text."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Per source: number, documents, words and target.

    Weights repeat over the sources in code point order. A target above three
    times its source's words stops there and the excess goes to the others by
    weight: in the order of words per weight, a source is at its limit when the
    level shared by all that follow it would exceed the limit.
    """
    stats = sizes.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum("size").alias("source_size")
    )
    # One row per source from here on.
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    numbered = stats.withColumn("sid", F.row_number().over(by_name) - 1)
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    limited = numbered.withColumn("weight", pick.cast("double")).withColumn(
        "limit", MOST * F.col("source_size")
    )
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("limit") / F.col("weight"), "sid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    zero = F.lit(0.0)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), zero)
    shared = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)
    marked = limited.withColumn("full", F.col("limit") <= F.col("weight") * left / shared)
    used = F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(everything)
    rest = F.sum("source_size").over(everything) - used
    level = F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * rest / open_weight)
    return marked.select("sid", "source", "n_docs", "source_size", level.alias("target"), "full")


def _rate(lam, size, mean):
    return F.round(F.least(F.lit(MOST), F.exp(F.least(F.lit(50.0), lam * size / mean))), 9)


def solve_dual(histogram: DataFrame, targets: DataFrame) -> DataFrame:
    """(sid, lam) by Newton steps on ``log(words of the rates) = log(target)``.

    A step that would leave the bracket found so far is replaced by its middle.
    Sums are decimal, so that they do not depend on the order of rows.
    """
    state = materialize(
        targets.filter("not full and source_size > 0").select(
            "sid", "target", (F.col("source_size") / F.col("n_docs")).alias("mean"),
            F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("lo"),
            F.lit(None).cast("double").alias("hi"), F.lit(1.0).alias("gap"),
        ).coalesce(1), "dual")
    for _ in range(MAX_STEPS):
        rate = _rate(F.col("lam"), F.col("size"), F.col("mean"))
        words = F.col("n") * F.col("size") * rate.cast("decimal(20,9)")
        slope = F.when(
            rate < MOST, F.round(F.col("size") / F.col("mean") * F.col("size") * F.col("n") * rate, 6)
        ).otherwise(0.0)
        sums = histogram.join(F.broadcast(state.select("sid", "lam", "mean")), "sid").groupBy("sid").agg(
            F.sum(words).cast("double").alias("words"),
            F.sum(slope.cast("decimal(38,6)")).cast("double").alias("slope"),
        )
        found = state.join(sums, "sid")
        below = F.col("words") < F.col("target")
        lo, hi = F.when(below, F.col("lam")).otherwise(F.col("lo")), F.when(~below, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.log(F.col("words") / F.col("target")) * F.col("words") / F.col("slope")
        outward = F.when(below, F.abs("lam") * 2 + 1).otherwise(-F.abs("lam") * 2 - 1)
        stepped = found.withColumns({"lo": lo, "hi": hi, "newton": newton}).withColumn(
            "next",
            F.when((F.col("slope") > 0)
                   & (F.col("lo").isNull() | (F.col("newton") > F.col("lo")))
                   & (F.col("hi").isNull() | (F.col("newton") < F.col("hi"))), F.col("newton"))
            .when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), (F.col("lo") + F.col("hi")) / 2)
            .otherwise(outward),
        )
        gap = F.abs(F.col("words") / F.col("target") - 1)
        done = gap <= TOLERANCE
        state = materialize(
            stepped.select("sid", "target", "mean", F.when(done, F.col("lam")).otherwise(F.col("next")).alias("lam"),
                           "lo", "hi", gap.alias("gap")).coalesce(1), "dual")
        if state.filter(F.col("gap") > TOLERANCE).isEmpty():
            break
    return state.select("sid", "lam")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) of every row.

    Rounding works on groups of about 256 documents of one source, chosen by a
    hash: from the longest to the shortest, a document gets its extra copy when
    the words owed reach half of it, and what is left over passes to the next.
    """
    sizes = materialize(with_size(docs), "sizes")
    targets = materialize(source_targets(sizes, weights).coalesce(1), "targets")
    few = targets.count() <= MAX_BROADCAST_SOURCES
    side = F.broadcast(targets) if few else targets
    keyed = sizes.withColumnRenamed("source", "own").join(side, F.col("own").eqNullSafe(F.col("source")))
    histogram = materialize(
        keyed.filter("size > 0").groupBy("sid", "size").agg(F.count("*").alias("n")), "histogram")
    lam = solve_dual(histogram, targets)
    rate = (
        F.when(F.col("size") == 0, 0.0).when(F.col("full"), MOST)
        .otherwise(_rate(F.col("lam"), F.col("size"), F.col("source_size") / F.col("n_docs")))
    )
    rated = keyed.join(F.broadcast(lam) if few else lam, "sid", "left").withColumn("rate", rate)
    group = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n_docs") / TOGETHER))
    grouped = rated.groupBy("sid", group.alias("part"), "source", "source_size", "target").agg(
        F.sort_array(F.collect_list(F.struct("size", "rate", "doc_id")), asc=False).alias("members")
    )
    rounded = F.expr("""
        aggregate(
          members,
          named_struct('owed', 0.0D, 'copies', cast(array() AS array<int>)),
          (s, m) -> named_struct(
            'owed', s.owed + (m.rate - floor(m.rate)) * m.size
              - CASE WHEN m.rate > floor(m.rate) AND s.owed + (m.rate - floor(m.rate)) * m.size >= m.size / 2.0D
                     THEN m.size ELSE 0 END,
            'copies', concat(s.copies, array(cast(floor(m.rate) AS int)
              + CASE WHEN m.rate > floor(m.rate) AND s.owed + (m.rate - floor(m.rate)) * m.size >= m.size / 2.0D
                     THEN 1 ELSE 0 END)))).copies""")
    each = grouped.select(
        "source", "source_size", "target",
        F.explode(F.arrays_zip(F.col("members").alias("m"), rounded.alias("copies"))).alias("x"),
    )
    return each.select(
        F.col("x.m.doc_id").alias("doc_id"), "source", F.col("x.m.size").alias("size"), "source_size",
        "target", F.col("x.m.rate").alias("rate"), F.col("x.copies").alias("copies"),
        (F.col("x.m.size") * F.col("x.copies")).alias("taken"),
    )
