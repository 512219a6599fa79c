"""Sources, preparation and splits: S1-S9, R1-R12."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import sql
from suite.inputs import (
    CFG, RAW_SPEC, documents, labelled, labels, narrow, raw, run_table, search_docs,
)
from textlake.operators import prepare as pr
from textlake.operators.search import build_search_index, search
from textlake.operators.split import split_sizes, stratified_split
from textlake.plans.prepare import prepare
from textlake.session import materialize, scratch_path
from textlake.sources.index import read_index, write_index
from textlake.sources.raw_csv import missing_marker_to_null, read_reviews, read_tweets
from textlake.sources.runs import append_runs, read_runs
from textlake.sources.splits import SPLITS, read_split, write_splits

QUERIES, ORACLES = {}, {}
SEARCH_TEXT = "not that thinly eresan, the not"


def _reviews(spark, sf):
    """Write labelled documents as a quoted CSV, then read it as raw reviews."""
    path = scratch_path(spark, "reviews-csv")
    labelled(spark, sf).select("doc_id", F.col("text").alias("Text"), F.col("label").alias("Score")).write.csv(
        path, header=True, quote='"', escape='"', encoding="UTF-8", lineSep="\n",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return read_reviews(spark, path).select(
        F.col("Text").alias("text"), F.col("Score").cast("int").alias("score")
    )


QUERIES["s1_read_reviews"] = _reviews
ORACLES["s1_read_reviews"] = f"SELECT text, CAST(label AS INT) AS score FROM {sql.LABELLED}"

_ONE_LINE = "regexp_replace(regexp_replace(text, '[\\\\r\\\\n]+', ' '), '[^ -~¡-ÿ]', '?')"


def _tweets(spark, sf):
    """Write documents as a headerless latin-1 CSV of six columns, then read it."""
    path = scratch_path(spark, "tweets-csv")
    documents(spark, sf).select(
        F.expr("CASE WHEN lang = 'en' THEN 4 ELSE 0 END").alias("target"),
        "doc_id", F.lit("date"), F.lit("flag"), "source", F.expr(_ONE_LINE).alias("text"),
    ).write.csv(
        path, quote='"', escape='"', encoding="ISO-8859-1",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return read_tweets(spark, path).select(F.col("target").cast("int").alias("target"), "ids", "user", "text")


QUERIES["s2_read_tweets"] = _tweets
ORACLES["s2_read_tweets"] = """
    SELECT CAST(CASE WHEN lang = 'en' THEN 4 ELSE 0 END AS INT) AS target, CAST(doc_id AS VARCHAR) AS ids,
           source AS "user",
           regexp_replace(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), '[^ -~¡-ÿ]', '?', 'g') AS text
    FROM documents"""

_MARKED = "CASE lang WHEN 'fr' THEN 'NA' WHEN 'de' THEN 'nan' WHEN 'es' THEN '' ELSE text END"
QUERIES["s3_missing_marker_to_null"] = lambda spark, sf: narrow(spark, sf).select(
    "doc_id", missing_marker_to_null(F.expr(_MARKED)).alias("text")
)
ORACLES["s3_missing_marker_to_null"] = """
    SELECT doc_id, CASE WHEN lang IN ('fr', 'de', 'es') OR text IN
        ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>',
         'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN NULL ELSE text END AS text
    FROM documents"""


def _split_path(spark, sf):
    path = scratch_path(spark, "splits")
    write_splits(stratified_split(materialize(labelled(spark, sf), "labelled")), path)
    return path


QUERIES["s5_write_splits"] = lambda spark, sf: spark.read.parquet(_split_path(spark, sf)).select(
    "doc_id", "text", "label", F.col("split").cast("string").alias("split")
)
ORACLES["s5_write_splits"] = f"SELECT doc_id, text, label, split FROM {sql.split_of(sql.LABELLED)}"
QUERIES["s6_read_split"] = lambda spark, sf: read_split(spark, _split_path(spark, sf), "val").select(
    "doc_id", "text", "label"
)
ORACLES["s6_read_split"] = (
    f"SELECT doc_id, text, label FROM {sql.split_of(sql.LABELLED)} WHERE split = 'val'"
)


def _index_roundtrip(spark, sf):
    path = scratch_path(spark, "index")
    write_index(build_search_index(search_docs(spark, sf), CFG), path)
    return search(SEARCH_TEXT, read_index(spark, path), top_k=25, sentiment=0, candidate_pool=200).withColumn(
        "score", F.round("score", 6)
    )


QUERIES["s7_write_read_index"] = _index_roundtrip
ORACLES["s7_write_read_index"] = (
    f"WITH {sql.postings_cte(sql.SEARCH_DOCS, CFG)}, "
    f"{sql.scores_cte(f'(SELECT CAST(0 AS BIGINT) AS query_id, {chr(39)}{SEARCH_TEXT}{chr(39)} AS text)', CFG)} "
    + sql.hits(25, 200, sentiment=0)
)


def _appended(spark, sf):
    path, runs = scratch_path(spark, "runs"), run_table(spark, sf)
    append_runs(runs.where("split = 'val'"), path)
    append_runs(runs.where("split = 'test'"), path)
    return read_runs(spark, path)


QUERIES["s9_append_runs"] = _appended
ORACLES["s9_append_runs"] = f"SELECT * FROM {sql.RUNS}"

QUERIES["r1_canonicalize"] = lambda spark, sf: pr.canonicalize(raw(spark, sf), "text", "raw_label")
ORACLES["r1_canonicalize"] = f"SELECT doc_id, text, raw_label FROM {sql.RAW}"
QUERIES["r2_map_labels"] = lambda spark, sf: pr.map_labels(
    raw(spark, sf), RAW_SPEC.label_map
).select("doc_id", "raw_label", "label")
ORACLES["r2_map_labels"] = f"""
    SELECT doc_id, raw_label, CAST(CASE TRY_CAST(raw_label AS DOUBLE) WHEN 1 THEN 0 WHEN 2 THEN 0
           WHEN 4 THEN 1 WHEN 5 THEN 1 END AS INT) AS label FROM {sql.RAW}"""
QUERIES["r3_drop_unusable"] = lambda spark, sf: pr.usable_rows(raw(spark, sf), RAW_SPEC)
ORACLES["r3_drop_unusable"] = f"SELECT doc_id, text, label FROM {sql.usable(sql.RAW)}"
QUERIES["r4_dedup_text"] = lambda spark, sf: pr.dedup_text(
    pr.usable_rows(raw(spark, sf), RAW_SPEC)
)
ORACLES["r4_dedup_text"] = f"SELECT doc_id, text, label FROM {sql.unique(sql.usable(sql.RAW))}"

# Language and source as the text: many rows per text, with both labels.
QUERIES["r4_dedup_conflicting"] = lambda spark, sf: pr.dedup_text(
    narrow(spark, sf).select("doc_id", F.expr("concat(lang, source)").alias("text"))
    .join(labels(spark, sf).select("doc_id", F.col("quality").alias("label")), "doc_id")
)
ORACLES["r4_dedup_conflicting"] = f"""SELECT doc_id, text, label FROM {sql.unique(
    "(SELECT doc_id, concat(lang, source) AS text, quality AS label FROM documents JOIN labels USING (doc_id))")}"""

QUERIES["r5_sample_frac"] = lambda spark, sf: pr.sample_frac(
    narrow(spark, sf).select("doc_id", "text"), 0.3, seed=7
)
ORACLES["r5_sample_frac"] = """
    SELECT doc_id, text FROM documents
    QUALIFY row_number() OVER (ORDER BY md5(concat('7:', doc_id)))
            <= round_even(0.3::DOUBLE * (SELECT count(*) FROM documents), 0)"""
QUERIES["r5_sample_frac_approx"] = lambda spark, sf: pr.sample_frac(
    narrow(spark, sf).select("doc_id", "text"), 0.3, seed=7, approx=True
)
ORACLES["r5_sample_frac_approx"] = """
    SELECT doc_id, text FROM documents
    WHERE CAST(concat('0x', substr(md5(concat('7:', doc_id)), 1, 12)) AS BIGINT) / pow(16, 12) < 0.3"""
QUERIES["r6_class_balance"] = lambda spark, sf: pr.class_balance(
    labels(spark, sf).select(F.col("quality").alias("label"))
)
ORACLES["r6_class_balance"] = """
    SELECT quality AS label, round_even(count(*) / (SELECT count(*) FROM labels)::DOUBLE, 3) AS share
    FROM labels GROUP BY quality"""
QUERIES["r7_require_min_rows"] = lambda spark, sf: pr.require_min_rows(labelled(spark, sf)).select("doc_id", "label")
ORACLES["r7_require_min_rows"] = f"SELECT doc_id, label FROM {sql.LABELLED}"

QUERIES["r8_split_sizes"] = lambda spark, sf: split_sizes(
    labels(spark, sf).select("doc_id", F.col("quality").alias("label"))
)
ORACLES["r8_split_sizes"] = f"SELECT DISTINCT label, n, test_n, val_n FROM {sql.split_of(sql.LABELLED)}"
QUERIES["r8_stratified_split"] = lambda spark, sf: stratified_split(
    materialize(labelled(spark, sf), "labelled")
).select("doc_id", "label", "split")
ORACLES["r8_stratified_split"] = f"SELECT doc_id, label, split FROM {sql.split_of(sql.LABELLED)}"
QUERIES["r8_hash_split"] = lambda spark, sf: stratified_split(
    labels(spark, sf).select("doc_id", F.col("quality").alias("label")), mode="hash"
)
_U = "CAST(concat('0x', substr(md5(concat('42:', doc_id)), 1, 12)) AS BIGINT) / pow(16, 12)"
ORACLES["r8_hash_split"] = f"""
    SELECT doc_id, quality AS label,
           CASE WHEN {_U} < 0.1::DOUBLE THEN 'test' WHEN {_U} < 0.2::DOUBLE THEN 'val' ELSE 'train' END AS split
    FROM labels"""


def _unioned(spark, sf):
    path = _split_path(spark, sf)
    return pr.union_splits(
        [read_split(spark, path, name).select("doc_id", "text", "label") for name in SPLITS]
    )


QUERIES["r9_union_splits"] = _unioned
ORACLES["r9_union_splits"] = f"SELECT doc_id, text, label FROM {sql.unique(sql.LABELLED)}"
QUERIES["r10_limit_docs"] = lambda spark, sf: pr.limit_docs(
    labelled(spark, sf), 50
)
ORACLES["r10_limit_docs"] = f"SELECT doc_id, text, label FROM {sql.LABELLED} ORDER BY doc_id LIMIT 50"
QUERIES["r11_drop_report"] = lambda spark, sf: pr.drop_report(
    pr.map_labels(raw(spark, sf), RAW_SPEC.label_map)
)
ORACLES["r11_drop_report"] = f"""
    SELECT 'raw' AS stage, count(*) AS rows FROM {sql.RAW}
    UNION ALL SELECT 'usable', count(*) FROM {sql.usable(sql.RAW)}
    UNION ALL SELECT 'unique', count(*) FROM {sql.unique(sql.usable(sql.RAW))}"""
QUERIES["r12_prepare"] = lambda spark, sf: prepare(raw(spark, sf), RAW_SPEC).select(
    "doc_id", "text", "label", "split"
)
ORACLES["r12_prepare"] = (
    f"SELECT doc_id, text, label, split FROM {sql.split_of(sql.unique(sql.usable(sql.RAW)))}"
)
