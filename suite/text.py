"""Text functions: T1-T21."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import sql
from suite.inputs import CFG, corpus, documents, noisy
from textlake.functions import entities, text as tx
from textlake.operators.estimators import TextCleaner
from textlake.operators.lexical import (
    clean_text, corpus_terms, noun_lemmas, replace_tokens, stem_tokens,
)
from textlake.session import materialize
from textlake.sources.tables import read_table, spread
from textlake.specs import default_config, reviews_config, tweets_config

QUERIES, ORACLES = {}, {}
PLAIN = {"lemmatize": False}
DEFAULT, REVIEWS, TWEETS = default_config(**PLAIN), reviews_config(**PLAIN), tweets_config(**PLAIN)


def _on_noise(name, spark_fn, sql_fn, before=None):
    """One function over the noisy text column of all documents."""
    first = before or (lambda c: c)
    QUERIES[name] = lambda spark, sf: noisy(spark, sf).select(
        "doc_id", spark_fn(first(F.col("text"))).alias("out")
    )
    inner = "lower(text)" if before else "text"
    ORACLES[name] = f"SELECT doc_id, {sql_fn(inner)} AS out FROM {sql.NOISY_DOCS}"


QUERIES["t1_coerce_text"] = lambda spark, sf: documents(spark, sf).select(
    "doc_id",
    tx.coerce_text(F.expr("CASE WHEN lang <> 'fr' THEN text END")).alias("out"),
    tx.coerce_text(F.col("n_chars")).alias("number"),
)
ORACLES["t1_coerce_text"] = """
    SELECT doc_id, coalesce(CASE WHEN lang <> 'fr' THEN text END, '') AS out,
           CAST(n_chars AS VARCHAR) AS number FROM documents"""

QUERIES["t2_html_unescape"] = lambda spark, sf: spread(read_table(spark, sf, "pages")).select(
    "page_id", entities.html_unescape(F.col("html")).alias("out")
)
ORACLES["t2_html_unescape"] = f"SELECT page_id, {sql.unescape('html')} AS out FROM pages"

_on_noise("t3_strip_html", tx.strip_html, sql.strip_html)
_on_noise("t4_strip_urls", tx.strip_urls, sql.strip_urls)
_on_noise("t5_strip_mentions", tx.strip_mentions, sql.strip_mentions)
_on_noise("t6_keep_hashtag_text", tx.keep_hashtag_text, sql.keep_hashtag_text)
_on_noise("t7_lowercase", tx.lowercase, lambda e: f"lower({e})")
_on_noise("t8_expand_contractions", tx.expand_contractions, sql.expand_contractions)
_on_noise("t9_reduce_repeats", tx.reduce_repeats, sql.reduce_repeats)
_on_noise("t10_remove_non_alpha", tx.remove_non_alpha, sql.remove_non_alpha, before=F.lower)
_on_noise("t11_squeeze_whitespace", tx.squeeze_whitespace, sql.squeeze)


def _bars(c):
    return F.array_join(c, "|")


def _sql_bars(e):
    return f"array_to_string({e}, '|')"


_on_noise("t13_tokenize", lambda c: _bars(tx.tokenize(c)), lambda e: _sql_bars(sql.tokenize(e)))
_on_noise(
    "t14_filter_short",
    lambda c: _bars(tx.filter_short(tx.tokenize(c), 4)),
    lambda e: _sql_bars(sql.filter_short(sql.tokenize(e), 4)),
)
_on_noise(
    "t15_remove_stopwords",
    lambda c: _bars(tx.remove_stopwords(tx.tokenize(c), extra=("soooo", "not", "que"))),
    lambda e: _sql_bars(sql.remove_stopwords(sql.tokenize(e), ("soooo", "not", "que"))),
    before=F.lower,
)


def _presets(make):
    return {"reviews": make(REVIEWS), "tweets": make(TWEETS)}


QUERIES["t12_normalize"] = lambda spark, sf: noisy(spark, sf).select(
    "doc_id", *[c.alias(n) for n, c in _presets(lambda g: tx.normalize(F.col("text"), g)).items()]
)
ORACLES["t12_normalize"] = "SELECT doc_id, {} FROM {}".format(
    ", ".join(f"{e} AS {n}" for n, e in _presets(lambda g: sql.normalize("text", g)).items()),
    sql.NOISY_DOCS,
)
QUERIES["t18_tokens"] = lambda spark, sf: noisy(spark, sf).select(
    "doc_id", *[c.alias(n) for n, c in _presets(lambda g: _bars(tx.surface_tokens(F.col("text"), g))).items()]
)
ORACLES["t18_tokens"] = "SELECT doc_id, {} FROM {}".format(
    ", ".join(f"{e} AS {n}" for n, e in _presets(lambda g: _sql_bars(sql.tokens("text", g))).items()),
    sql.NOISY_DOCS,
)
QUERIES["t19_clean_text"] = lambda spark, sf: clean_text(noisy(spark, sf), DEFAULT).select(
    "doc_id", "clean"
)
ORACLES["t19_clean_text"] = (
    f"SELECT doc_id, {sql.clean('text', DEFAULT)} AS clean FROM {sql.NOISY_DOCS}"
)

# A preset with changed switches: apostrophes and digits stay, two stopwords more.
CUSTOM = tweets_config(
    lemmatize=False, remove_non_alpha=False, expand_contractions=False, min_token_len=3,
    extra_stopwords=frozenset({"soooo", "www"}), keep_negations=False, unescape=False,
)
QUERIES["t20_preset_configs"] = lambda spark, sf: noisy(spark, sf).select(
    "doc_id",
    *[
        tx.surface_text(F.col("text"), cfg).alias(name)
        for name, cfg in (("default_", DEFAULT), ("tweets", TWEETS), ("custom", CUSTOM))
    ],
)
ORACLES["t20_preset_configs"] = "SELECT doc_id, {} FROM {}".format(
    ", ".join(
        f"{sql.clean('text', cfg)} AS {name}"
        for name, cfg in (("default_", DEFAULT), ("tweets", TWEETS), ("custom", CUSTOM))
    ),
    sql.NOISY_DOCS,
)
QUERIES["t21_text_cleaner"] = lambda spark, sf: TextCleaner.of(REVIEWS, outputCol="tokens").transform(
    noisy(spark, sf)
).select("doc_id", _bars("tokens").alias("out"))
ORACLES["t21_text_cleaner"] = (
    f"SELECT doc_id, {_sql_bars(sql.tokens('text', REVIEWS))} AS out FROM {sql.NOISY_DOCS}"
)


# --- stems: the oracle restates the rules over the distinct tokens --------------------------

_SHAPE = (
    # Marking every y that counts as a vowel first makes c and v plain character classes:
    # a y after a consonant is a vowel, and in yy the second one follows that vowel.
    r"regexp_replace(regexp_replace({e}, '([^aeiouyY])y', '\1Y', 'g'), '(^|[aeiouY])yy', '\1yY', 'g')"
)
_V, _C = "[aeiouY]", "[^aeiouY]"


def _marked(e):
    return _SHAPE.format(e=e)


def _m(e, least):
    """At least ``least`` vowel runs followed by a consonant."""
    return f"regexp_matches({_marked(e)}, '" + f"{_V}{_C}.*" * (least - 1) + f"{_V}{_C}')"


def _exact_one(e):
    return f"({_m(e, 1)} AND NOT {_m(e, 2)})"


def _cvc(e):
    return (
        f"(regexp_matches({_marked(e)}, '{_C}{_V}[^aeiouYwxy]$') "
        f"OR (length({e}) = 2 AND regexp_matches({_marked(e)}, '^{_V}{_C}$')))"
    )


def _stem_of(e, n):
    return f"left({e}, length({e}) - {n})"


def _rules(e, rules, allowed):
    """First fitting suffix decides."""
    cases = "".join(
        f" WHEN {e} LIKE '%{s}' THEN CASE WHEN {allowed(_stem_of(e, len(s)), s)} "
        f"THEN concat({_stem_of(e, len(s))}, '{r}') ELSE {e} END"
        for s, r in rules
    )
    return f"CASE{cases} ELSE {e} END"


def _stem_ctes(source: str) -> str:
    """CTEs from (w) to stems(term, stem), one rule step each."""
    from textlake.functions import porter as p

    positive = lambda s, _suffix: _m(s, 1)
    doubled = "regexp_matches(b, '(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$')"
    past = (
        "CASE WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN left(w, 3) ELSE left(w, length(w) - 2) END "
        f"WHEN w LIKE '%eed' THEN CASE WHEN {_m(_stem_of('w', 3), 1)} THEN left(w, length(w) - 1) ELSE w END "
        "ELSE w END"
    )
    vowel = lambda s: f"regexp_matches({_marked(s)}, '{_V}')"
    base = (
        "CASE WHEN w LIKE '%ied' OR w LIKE '%eed' THEN NULL "
        f"WHEN w LIKE '%ed' AND {vowel(_stem_of('w', 2))} THEN {_stem_of('w', 2)} "
        f"WHEN w LIKE '%ing' AND {vowel(_stem_of('w', 3))} THEN {_stem_of('w', 3)} END"
    )
    repaired = (
        f"CASE WHEN b IS NULL THEN w WHEN regexp_matches(b, '(at|bl|iz)$') THEN concat(b, 'e') "
        f"WHEN {doubled} THEN left(b, length(b) - 1) WHEN regexp_matches(b, '(ll|ss|zz)$') THEN b "
        f"WHEN {_exact_one('b')} AND {_cvc('b')} THEN concat(b, 'e') ELSE b END"
    )
    y_stem = _stem_of("w", 1)
    final_y = (
        f"CASE WHEN w LIKE '%y' AND length(w) > 2 AND regexp_matches({_marked(y_stem)}, '{_C}$') "
        f"THEN concat({y_stem}, 'i') ELSE w END"
    )
    step2 = _rules(
        "w", p.STEP2_EXTENDED,
        lambda s, suffix: _m(f"concat({s}, 'l')" if suffix == "logi" else s, 1),
    )
    step4 = _rules(
        "w", [(s, "") for s in p.STEP4],
        lambda s, suffix: _m(s, 2) + (f" AND regexp_matches({s}, '[st]$')" if suffix == "ion" else ""),
    )
    e_stem = _stem_of("w", 1)
    final_e = (
        f"CASE WHEN w LIKE '%e' AND ({_m(e_stem, 2)} OR ({_exact_one(e_stem)} AND NOT {_cvc(e_stem)})) "
        f"THEN {e_stem} ELSE w END"
    )
    irregular = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in p.IRREGULAR.items())
    steps = [
        "CASE WHEN length(w) = 4 AND w LIKE '%ies' THEN left(w, 3) ELSE "
        + _rules("w", p.STEP1A, lambda *_: "TRUE") + " END",
    ]
    ctes = [f"s0 AS (SELECT DISTINCT token AS term, token AS w FROM ({source}))"]
    ctes.append(f"s1 AS (SELECT term, {steps[0]} AS w FROM s0)")
    ctes.append(f"s2a AS (SELECT term, {past} AS w, {base} AS b FROM s1)")
    ctes.append(f"s2 AS (SELECT term, {repaired} AS w FROM s2a)")
    ctes.append(f"s3 AS (SELECT term, {final_y} AS w FROM s2)")
    ctes.append(
        f"s4a AS (SELECT term, CASE WHEN w LIKE '%alli' AND {_m(_stem_of('w', 4), 1)} "
        f"THEN {_stem_of('w', 2)} ELSE w END AS w FROM s3)"
    )
    ctes.append(f"s4 AS (SELECT term, {step2} AS w FROM s4a)")
    ctes.append(f"s5 AS (SELECT term, {_rules('w', p.STEP3, positive)} AS w FROM s4)")
    ctes.append(f"s6 AS (SELECT term, {step4} AS w FROM s5)")
    ctes.append(f"s7 AS (SELECT term, {final_e} AS w FROM s6)")
    ctes.append(
        f"s8 AS (SELECT term, CASE WHEN w LIKE '%ll' AND {_m(_stem_of('w', 1), 2)} "
        f"THEN {_stem_of('w', 1)} ELSE w END AS w FROM s7)"
    )
    ctes.append(
        f"stems AS (SELECT term, CASE term {irregular} ELSE CASE WHEN length(term) <= 2 THEN term "
        "ELSE w END END AS stem FROM s8)"
    )
    return ",\n".join(ctes)


def _rejoin(mapping: str, column: str) -> str:
    """Replace each token by ``mapping`` and put documents together again."""
    return f"""
    SELECT d.doc_id, coalesce(j.out, '') AS out FROM documents d LEFT JOIN (
        SELECT doc_id, string_agg(coalesce({column}, token), ' ' ORDER BY pos) AS out
        FROM tok LEFT JOIN {mapping} m ON tok.token = m.term GROUP BY doc_id) j USING (doc_id)"""


QUERIES["t16_stem_tokens"] = lambda spark, sf: corpus(spark, sf).select(
    "doc_id", F.array_join(stem_tokens(F.col("tokens")), " ").alias("out")
)
ORACLES["t16_stem_tokens"] = (
    f"WITH tok AS (SELECT * FROM {sql.token_table('documents', CFG)}),\n"
    + _stem_ctes("SELECT token FROM tok") + _rejoin("stems", "m.stem")
)


def _lemmatized(spark, sf):
    """Lexicon: the corpus' own terms of at least four letters."""
    docs = materialize(corpus(spark, sf), "tokens")
    terms = materialize(corpus_terms(docs), "terms")
    lexicon = terms.where(F.length("term") >= 4).select(F.col("term").alias("lemma"))
    mapping = materialize(noun_lemmas(terms, lexicon), "mapping")
    return replace_tokens(docs, mapping).select(
        "doc_id", F.array_join("tokens", " ").alias("out")
    )


def _lemma_ctes() -> str:
    from textlake.operators.lexical import NOUN_ENDINGS

    ends = ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(NOUN_ENDINGS, 1))
    return f"""
    endings(rule, ending, repl) AS (VALUES {ends}),
    lex AS (SELECT DISTINCT token AS form FROM tok WHERE length(token) >= 4),
    terms AS (SELECT DISTINCT token AS term FROM tok),
    forms AS (
        SELECT term, term AS form, 0 AS round, CAST(0 AS BIGINT) AS place FROM terms
        UNION ALL
        SELECT term, concat(left(form, length(form) - length(ending)), repl), round + 1, place * 16 + rule
        FROM forms JOIN endings ON suffix(form, ending)),
    hits AS (SELECT *, min(greatest(round, 1)) OVER (PARTITION BY term) AS first_round
             FROM forms SEMI JOIN lex USING (form)),
    lemmas AS (SELECT term, arg_min(form, (length(form), place)) AS lemma FROM hits
               WHERE greatest(round, 1) = first_round GROUP BY term)"""


QUERIES["t17_lemmatize_tokens"] = _lemmatized
ORACLES["t17_lemmatize_tokens"] = (
    f"WITH RECURSIVE tok AS (SELECT * FROM {sql.token_table('documents', CFG)}),\n"
    + _lemma_ctes() + _rejoin("lemmas", "m.lemma")
)
