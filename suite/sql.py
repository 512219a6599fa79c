"""SQL fragments for DuckDB that say the same as the operators."""

from __future__ import annotations

from suite.inputs import NOISY, RAW_LABEL, RAW_TEXT
from textlake.functions.text import CONTRACTIONS, NEGATIONS, stoplist
from textlake.specs import CleanConfig

_SPACE_SET = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
NON_SPACE = f"[^{_SPACE_SET}]"
WORD = r"[\p{L}\p{N}_]"
TOKEN = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_'']*[\p{L}\p{N}_])?"


def quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def unescape(e: str) -> str:
    for name, char in (("&quot;", "chr(34)"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&amp;", "chr(38)")):
        e = f"replace({e}, '{name}', {char})"
    return e


def sub(e: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({e}, '{pattern}', '{by}', 'g')"


def strip_html(e):
    return sub(e, "<[^>]+>")


def strip_urls(e):
    return sub(e, rf"https?://{NON_SPACE}+|www\.{NON_SPACE}+")


def strip_mentions(e):
    return sub(e, f"@{WORD}+")


def keep_hashtag_text(e):
    return sub(e, f"#({WORD}+)", r"\1")


def expand_contractions(e):
    for short, full in CONTRACTIONS:
        short = short.replace("'", "''")
        e = f"replace({e}, '{short}', '{full}')"
    return e


def reduce_repeats(e):
    """Keep a character unless it equals the two before it; line feeds always stay."""
    chars = f"string_split({e}, '')"
    return (
        f"(SELECT array_to_string(list_filter(cs, lambda c, i: c = chr(10) OR i <= 2 OR c <> cs[i - 1] "
        f"OR c <> cs[i - 2]), '') FROM (SELECT {chars} AS cs))"
    )


def squeeze(e):
    return f"trim({sub(e, f'[{_SPACE_SET}]+')}, ' ')"


def remove_non_alpha(e):
    return sub(e, f"[^a-z{_SPACE_SET}]")


def normalize(e: str, cfg: CleanConfig) -> str:
    e = f"coalesce(CAST({e} AS VARCHAR), '')"
    if cfg.unescape:
        e = unescape(e)
    if cfg.strip_html:
        e = strip_html(e)
    if cfg.strip_urls:
        e = strip_urls(e)
    if cfg.strip_mentions:
        e = strip_mentions(e)
    if cfg.keep_hashtag_text:
        e = keep_hashtag_text(e)
    if cfg.lowercase:
        e = f"lower({e})"
    if cfg.expand_contractions:
        e = expand_contractions(e)
    if cfg.reduce_repeats:
        e = reduce_repeats(e)
    if cfg.remove_non_alpha:
        e = remove_non_alpha(e)
    return squeeze(e)


def tokenize(e):
    return f"regexp_extract_all({e}, '{TOKEN}')"


def filter_short(e, n):
    return f"list_filter({e}, lambda t: length(t) >= {n} OR t IN ({quoted(NEGATIONS)}))"


def remove_stopwords(e, extra=(), keep_negations=True):
    return f"list_filter({e}, lambda t: t NOT IN ({quoted(stoplist(extra=extra, keep_negations=keep_negations))}))"


def tokens(e: str, cfg: CleanConfig) -> str:
    e = filter_short(tokenize(normalize(e, cfg)), cfg.min_token_len)
    if cfg.remove_stopwords:
        e = remove_stopwords(e, cfg.extra_stopwords, cfg.keep_negations)
    return e


def clean(e: str, cfg: CleanConfig) -> str:
    return f"array_to_string({tokens(e, cfg)}, ' ')"


NOISY_DOCS = f"(SELECT doc_id, {NOISY} AS text FROM documents)"
LABELLED = "(SELECT doc_id, text, quality AS label FROM documents JOIN labels USING (doc_id))"
RAW = (
    f"(SELECT doc_id, {RAW_TEXT} AS text, {RAW_LABEL} AS raw_label "
    "FROM documents LEFT JOIN labels USING (doc_id))"
)
SEARCH_DOCS = (
    "(SELECT doc_id, text, CAST(coalesce(quality, 1) AS TINYINT) AS sentiment "
    "FROM documents LEFT JOIN labels USING (doc_id))"
)
SCORED = (
    "(SELECT doc_id, quality AS label, round((n_chars % 97) / 96.0::DOUBLE, 2) AS score, "
    "CAST(round((n_chars % 97) / 96.0::DOUBLE, 2) >= 0.5 AS INT) AS predicted "
    "FROM documents JOIN labels USING (doc_id))"
)
RUNS = """(
    WITH base AS (
        SELECT lang, source, (CAST(sum(n_chars % 10) AS BIGINT) // count(*)) / 10.0::DOUBLE AS f1,
               (CAST(sum(n_chars % 70) AS BIGINT) // count(*)) / 70.0::DOUBLE AS roc_auc
        FROM documents GROUP BY lang, source)
    SELECT 'r' AS run_id, lang AS dataset, source AS vectorizer,
           CAST(substr(source, 4) AS INT) AS method_order, CAST(0 AS BIGINT) AS n_train,
           CAST(0 AS INT) AS max_features, split, metric, CASE metric WHEN 'f1' THEN f1 ELSE roc_auc END AS value
    FROM base, (VALUES ('val'), ('test')) s(split), (VALUES ('f1'), ('roc_auc')) m(metric))"""


def usable(source: str) -> str:
    return (
        f"(SELECT doc_id, text, CAST(label AS INT) AS label FROM (SELECT *, CASE "
        "TRY_CAST(raw_label AS DOUBLE) WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 4 THEN 1 WHEN 5 THEN 1 END AS label "
        f"FROM {source}) WHERE label IS NOT NULL AND text IS NOT NULL "
        f"AND regexp_matches(text, '{NON_SPACE}'))"
    )


def unique(source: str) -> str:
    return (
        "(SELECT min(doc_id) AS doc_id, text, arg_min(label, doc_id) AS label "
        f"FROM {source} GROUP BY text)"
    )


def split_of(source: str, test: float = 0.1, val: float = 0.1, seed: int = 42) -> str:
    """Rows of ``source`` with their split: plain windows over whole classes."""

    def kept(count, total, draws):
        ideal = f"({count} / {total}::DOUBLE * {draws})"
        return (
            f"CAST(floor({ideal}) AS BIGINT) + CASE WHEN row_number() OVER (ORDER BY "
            f"{ideal} - floor({ideal}) DESC, label) <= {draws} - sum(floor({ideal})) OVER () THEN 1 ELSE 0 END"
        )

    share = float(val) / (1.0 - float(test))
    return f"""(
    WITH src AS (SELECT * FROM {source}),
    c0 AS (SELECT label, count(*) AS n FROM src GROUP BY label),
    c1 AS (SELECT *, sum(n) OVER () AS total FROM c0),
    c2 AS (SELECT *, CAST(total - ceil({test}::DOUBLE * total) AS BIGINT) AS rest FROM c1),
    c3 AS (SELECT *, {kept('n', 'total', 'rest')} AS rest_n FROM c2),
    c4 AS (SELECT *, CAST(rest - ceil({share!r}::DOUBLE * rest) AS BIGINT) AS train FROM c3),
    c5 AS (SELECT *, {kept('rest_n', 'rest', 'train')} AS train_n FROM c4),
    sizes AS (SELECT label, n, CAST(n - rest_n AS BIGINT) AS test_n, CAST(rest_n - train_n AS BIGINT) AS val_n FROM c5),
    ranked AS (SELECT src.*, row_number() OVER (PARTITION BY label ORDER BY md5(concat('{seed}:', doc_id)), doc_id) AS r
               FROM src)
    SELECT ranked.doc_id, ranked.text, ranked.label,
           CASE WHEN r <= test_n THEN 'test' WHEN r <= test_n + val_n THEN 'val' ELSE 'train' END AS split,
           n, test_n, val_n
    FROM ranked JOIN sizes USING (label))"""


def token_table(source: str, cfg: CleanConfig, key: str = "doc_id", more: str = "") -> str:
    """(doc_id, pos, token) of a source with text."""
    return (
        f"(SELECT {key}{more}, unnest(ts) AS token, generate_subscripts(ts, 1) AS pos FROM "
        f"(SELECT {key}{more}, {tokens('text', cfg)} AS ts FROM {source}))"
    )


def counts_cte(source: str, cfg: CleanConfig) -> str:
    """CTEs ending in counts(doc_id, term, tf) over one- and two-word terms."""
    return f"""
    tok AS (SELECT * FROM {token_table(source, cfg)} WHERE length(token) >= 2),
    grams AS (
        SELECT doc_id, token AS term FROM tok
        UNION ALL
        SELECT doc_id, concat(token, ' ', lead(token) OVER (PARTITION BY doc_id ORDER BY pos))
        FROM tok QUALIFY lead(token) OVER (PARTITION BY doc_id ORDER BY pos) IS NOT NULL),
    counts AS (SELECT doc_id, term, CAST(count(*) AS INT) AS tf FROM grams GROUP BY doc_id, term)"""


def vocab_cte(min_df: int = 2, max_features: int = 50_000) -> str:
    return f"""
    ranked_terms AS (
        SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM counts GROUP BY term
        HAVING count(*) >= {min_df} ORDER BY cf DESC, term LIMIT {max_features}),
    vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INT) AS term_idx, df, cf
              FROM ranked_terms),
    corpus AS (SELECT count(*)::DOUBLE AS n FROM documents)"""


def unit_rows(raw: str) -> str:
    return (
        "SELECT doc_id, term, term_idx, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) "
        f"AS weight FROM ({raw})"
    )


TFIDF_RAW = (
    "SELECT doc_id, term, term_idx, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS raw "
    "FROM counts JOIN vocab USING (term), corpus"
)
BM25_RAW = """
    SELECT doc_id, term, term_idx,
           ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5
           / (tf + 1.5 * (0.25 + 0.75 * dl / (avgdl + 1e-9))) AS raw
    FROM (SELECT *, sum(tf) OVER (PARTITION BY doc_id) AS dl FROM counts JOIN vocab USING (term)),
         corpus, (SELECT sum(cf) / (SELECT n FROM corpus) AS avgdl FROM vocab)"""


def postings_cte(source: str, cfg: CleanConfig) -> str:
    return f"""
    docs AS (SELECT doc_id, text, sentiment, {tokens('text', cfg)} AS ts FROM {source}),
    postings AS (SELECT term, doc_id, CAST(count(*) AS INT) AS tf, CAST(any_value(dl) AS INT) AS dl,
                        any_value(sentiment) AS sentiment
                 FROM (SELECT doc_id, sentiment, len(ts) AS dl, unnest(ts) AS term FROM docs)
                 GROUP BY term, doc_id),
    stats AS (SELECT count(*)::DOUBLE AS n, avg(len(ts)) AS avgdl FROM docs),
    raw_terms AS (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw
                  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), stats),
    terms AS (SELECT term, df, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM raw_terms) ELSE raw END AS idf
              FROM raw_terms)"""


def scores_cte(queries: str, cfg: CleanConfig) -> str:
    """queries: source of (query_id, text)."""
    return f"""
    wanted AS (SELECT query_id, term, count(*) AS qtf
               FROM (SELECT query_id, unnest({tokens('text', cfg)}) AS term FROM {queries})
               GROUP BY query_id, term),
    scores AS (SELECT query_id, doc_id, any_value(sentiment) AS sentiment,
                      round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 9) AS score
               FROM wanted JOIN terms USING (term) JOIN postings USING (term), stats
               GROUP BY query_id, doc_id)"""


def hits(top_k: int, pool: int, sentiment: int | None = None, pre: bool = False) -> str:
    want = "TRUE" if sentiment is None else f"sentiment = {sentiment}"
    before, after = (want, "TRUE") if pre else ("TRUE", want)
    return f"""
    SELECT query_id, CAST(rank AS INT) AS rank, doc_id, round(score, 6) AS score, text, sentiment FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
            SELECT * FROM scores WHERE score > 0 AND {before}
            QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= {pool})
        WHERE {after}) JOIN (SELECT doc_id, text FROM docs) USING (doc_id)
    WHERE rank <= {top_k}"""
