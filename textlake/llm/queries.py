"""One query for each operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from textlake.llm import (
    byte_bpe, dart_minhash, fim, line_dedup, lm_scoring, mixing, periodic_runs, pivot_search, quality_rules, token_files,
    toxicity, vector_graph, warc,
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def residue(doc_id: str, n: int) -> F.Column:
    """The remainder that deals documents to training and held-out parts."""
    return F.crc32(F.col(doc_id).cast("string")) % n


def toxicity_model(spark: SparkSession, sf: str) -> toxicity.Model:
    """Learnt from the labelled documents that are not held out."""
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "toxic").filter(residue("id", 5) != 0)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return toxicity.fit(docs.join(labels, F.col("doc_id") == F.col("id")).drop("id"), docs)


def op1_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return lm_scoring.score_documents(
        table(spark, sf, "documents"), residue("doc_id", 7) == 2, path, public_tokenizers.PATTERN)


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf, "documents"), toxicity_model(spark, sf))
    return scored.withColumn("held_out", F.coalesce(residue("doc_id", 5) == 0, F.lit(False))).select(
        "doc_id", "held_out", "score", "predicted")


def op7_vector_graph(spark: SparkSession, sf: str) -> DataFrame:
    return vector_graph.near_vectors(table(spark, sf, "embeddings"))


def op9_pivot_search(spark: SparkSession, sf: str) -> DataFrame:
    return pivot_search.top_k(table(spark, sf, "embeddings"))


def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    manifest = warc.write(warc.record_chunks(table(spark, sf, "pages")))
    return warc.read(manifest, with_bytes=False).filter("last").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_dart_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, sf, "documents"))


def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode_documents(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    spans = F.array_join(F.transform("removed", lambda x: F.concat(x["start"], F.lit("-"), x["end"])), ",")
    return line_dedup.dedup_lines(table(spark, sf, "documents")).select(
        "doc_id", F.size("removed").alias("n_removed"), spans.alias("removed"), "text")


def op10_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.read(token_files.write(table(spark, sf, "documents"), path))


def op11_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules.judge(
        table(spark, sf, "documents"), table(spark, sf, "labels"), columns=("doc_id", "lang"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_fim(spark: SparkSession, sf: str) -> DataFrame:
    out = fim.transform(table(spark, sf, "documents"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic_runs.detect(table(spark, sf, "documents"), plant=True)
    best = found.select(
        "doc_id", "runs", "collapsed", periodic_runs.best_run(F.col("runs")).alias("best"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(best.length * 1000) div best.period").alias("exponent_milli"),
        periodic_runs.runs_digest(F.col("runs")).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_warc": op2_warc,
    "op3_dart_minhash": op3_dart_minhash,
    "op4_toxicity": op4_toxicity,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_mixing": op6_mixing,
    "op7_vector_graph": op7_vector_graph,
    "op8_line_dedup": op8_line_dedup,
    "op9_pivot_search": op9_pivot_search,
    "op10_token_files": op10_token_files,
    "op11_quality_rules": op11_quality_rules,
    "op12_fim": op12_fim,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES = {
    "op11_quality_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
        w AS (
          SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
            list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
        tri AS (
          SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
          FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
        rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM tri) WHERE c > 1),
        cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) v(k) GROUP BY rid),
        c AS (
          SELECT w.rid, doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
            CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
            CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
            CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
          FROM w LEFT JOIN cov ON w.rid = cov.rid),
        s AS (
          SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            CASE WHEN n_words > 0 THEN n_symbols / n_words END AS symbol_ratio,
            CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines END AS dup_line_ratio,
            CASE WHEN n_words > 0 THEN n_repeat_words / n_words END AS repeat_ratio,
            CASE WHEN n_words > 0 THEN word_chars / n_words END AS word_length,
            CASE WHEN n_words > 0 THEN -(word_chars / n_words) END AS shortness
          FROM c),
        good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1),
        held AS (SELECT * FROM s WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)),
        long AS (
          SELECT lang, rule, value FROM (
            UNPIVOT held ON symbol_ratio, dup_line_ratio, repeat_ratio, word_length, shortness
            INTO NAME rule VALUE value) WHERE value IS NOT NULL),
        tests AS (SELECT lang, rule, count(*) AS n, count(*) OVER () AS m FROM long GROUP BY lang, rule),
        tail AS (
          SELECT lang, rule, n, j, sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
                 + j * ln(0.01) + (n - j) * ln(0.99))) OVER (PARTITION BY lang, rule ORDER BY j) AS cdf, 0.05 / m AS level
          FROM (SELECT *, unnest(range(0, n + 1)) AS j FROM tests)),
        ks AS (SELECT lang, rule, coalesce(max(j) FILTER (WHERE cdf <= level), -1) AS k FROM tail GROUP BY lang, rule),
        ranked AS (
          SELECT l.lang, l.rule, value, k, row_number() OVER (PARTITION BY l.lang, l.rule ORDER BY value DESC) AS r
          FROM long l JOIN ks ON l.lang IS NOT DISTINCT FROM ks.lang AND l.rule = ks.rule),
        cut AS (SELECT lang, rule, value AS cutoff FROM ranked WHERE r = k + 1),
        fails AS (
          SELECT DISTINCT s.rid FROM s JOIN cut ON s.lang IS NOT DISTINCT FROM cut.lang
          WHERE (cut.rule = 'symbol_ratio' AND s.symbol_ratio > cutoff)
             OR (cut.rule = 'dup_line_ratio' AND s.dup_line_ratio > cutoff)
             OR (cut.rule = 'repeat_ratio' AND s.repeat_ratio > cutoff)
             OR (cut.rule = 'word_length' AND s.word_length > cutoff)
             OR (cut.rule = 'shortness' AND s.shortness > cutoff))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
          NOT base_failed AND rid NOT IN (SELECT rid FROM fails) AS kept
        FROM s""",
    "op12_fim": r"""
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hx
          FROM documents),
        u AS (
          SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units,
            ('0x' || substr(hx, 1, 8))::UBIGINT AS h1, ('0x' || substr(hx, 9, 8))::UBIGINT AS h2,
            ('0x' || substr(hx, 17, 8))::UBIGINT AS h3, ('0x' || substr(hx, 25, 8))::UBIGINT AS h4 FROM d),
        c AS (
          SELECT *, len(units) AS n,
            least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS k1,
            greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS k2,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100
                 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
          FROM u),
        p AS (
          SELECT *, array_to_string(units[1:k1], '') AS pre, array_to_string(units[k1 + 1:k2], '') AS mid,
            array_to_string(units[k2 + 1:n], '') AS suf FROM c)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
          CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
          CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
          sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                           WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
          sha256(t) AS restored_sha256
        FROM p""",
    "op9_pivot_search": """
        WITH v AS (
          SELECT vec_id, unnest(embedding) AS x, unnest(range(0, len(embedding))) AS k FROM embeddings
          WHERE list_bool_and([x IS NOT NULL AND isfinite(x) for x in embedding])),
        i AS (SELECT vec_id, k, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM v),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
          FROM i q JOIN i c ON q.k = c.k AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op7_vector_graph": """
        WITH RECURSIVE u AS (
          SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL),
        l AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        reach(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)
        SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links,
               least(e.vec_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = e.vec_id), e.vec_id)) AS component_id,
               e.vec_id <= coalesce((SELECT min(b) FROM reach WHERE reach.a = e.vec_id), e.vec_id) AS kept
        FROM embeddings e""",
    "op2_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                          sha256(coalesce(html, '')) AS payload_digest FROM pages),
             q AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
        FROM q""",
    "op8_line_dedup": r"""
        WITH u AS (
          SELECT doc_id, unnest(string_split(text, chr(10))) AS unit,
                 unnest(range(0, len(string_split(text, chr(10))))) AS k, length(text) AS n
          FROM documents WHERE text IS NOT NULL),
        p AS (
          SELECT *, regexp_replace(trim(lower(unit), chr(9) || chr(11) || chr(12) || chr(13) || ' '), '[\t\x0B\f\r ]+', ' ', 'g') AS norm,
                 coalesce(sum(length(unit) + 1) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
          FROM u),
        r AS (
          SELECT *, len(string_split(norm, ' ')) >= 4 AND row_number() OVER (PARTITION BY norm ORDER BY doc_id, k) > 1 AS gone
          FROM p)
        SELECT doc_id, CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS n_removed,
               coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(least(n, start + length(unit) + 1) AS BIGINT), ',' ORDER BY k) FILTER (WHERE gone), '') AS removed,
               coalesce(string_agg(unit, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS text
        FROM r GROUP BY doc_id
        UNION ALL SELECT doc_id, 0, '', NULL FROM documents WHERE text IS NULL""",
}
