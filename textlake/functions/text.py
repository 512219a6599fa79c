"""Cleaning and tokenising as native column expressions.

Nothing here calls Python per row. The character classes are spelled out because
Java's ``\\s`` and ``\\w`` are ASCII by default and differ from Unicode text
matching.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from textlake.functions.arrays import let
from textlake.functions.entities import html_unescape
from textlake.specs import CleanConfig

# Unicode white space and word characters.
_SPACE_SET = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Plain ASCII is tested first, so most characters are settled by one comparison.
SPACE = f"[[^!-~]&&[{_SPACE_SET}]]"
NON_SPACE = f"[!-~[^{_SPACE_SET}]]"
_WORD_SET = r"a-zA-Z0-9_\p{L}\p{N}"
WORD = f"[{_WORD_SET}]"

# What each cleaning step matches.
HTML_TAG = "<[^>]+>"
URL = f"https?://{NON_SPACE}+|www\\.{NON_SPACE}+"
MENTION = f"@{WORD}+"
HASHTAG = f"#({WORD}+)"
REPEAT = r"(?d)(.)\1{2,}"
NON_ALPHA = f"[[^a-z]&&{NON_SPACE}]"
TOKEN = f"{WORD}(?:[{_WORD_SET}']*{WORD})?"
FEATURE_TOKEN = f"{WORD}{{2,}}"

# Contraction endings, applied in this order.
CONTRACTIONS = (
    ("won't", "will not"),
    ("can't", "can not"),
    ("n't", " not"),
    ("'re", " are"),
    ("'s", " is"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'ve", " have"),
    ("'m", " am"),
)

# Negations, kept through stopword and length filters.
NEGATIONS = ("not", "no", "nor", "never", "none", "cannot")

# The default English stoplist.
STOPWORDS = tuple(
    """
    a an and are as at be by for from has he in is it its of on that the to was were
    will with this these those i you they we she but or if then so than too very can
    just have had do does did am been being would could should there their them what
    which who when where while about into over after before again here
    """.split()
)


def coerce_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _where_present(c: Column, needles: tuple[str, ...], step) -> Column:
    """Run a pattern only on rows holding a character it needs. The byte search is
    far cheaper than a regex pass, which copies the text even without a match."""

    def guarded(x: Column) -> Column:
        hit = F.contains(x, F.lit(needles[0]))
        for needle in needles[1:]:
            hit = hit | F.contains(x, F.lit(needle))
        return F.when(hit, step(x)).otherwise(x)

    return let(c, guarded)


def strip_html(c: Column) -> Column:
    return _where_present(c, ("<",), lambda x: F.regexp_replace(x, HTML_TAG, " "))


def strip_urls(c: Column) -> Column:
    return _where_present(c, ("://", "www."), lambda x: F.regexp_replace(x, URL, " "))


def strip_mentions(c: Column) -> Column:
    return _where_present(c, ("@",), lambda x: F.regexp_replace(x, MENTION, " "))


def keep_hashtag_text(c: Column) -> Column:
    return _where_present(c, ("#",), lambda x: F.regexp_replace(x, HASHTAG, "$1"))


def lowercase(c: Column) -> Column:
    return F.lower(c)


def expand_contractions(c: Column) -> Column:
    def expand(x: Column) -> Column:
        for short, full in CONTRACTIONS:
            x = F.replace(x, F.lit(short), F.lit(full))
        return x

    return _where_present(c, ("'",), expand)


def reduce_repeats(c: Column) -> Column:
    """Three or more of a character become two."""
    return F.regexp_replace(c, REPEAT, "$1$1")


def remove_non_alpha(c: Column) -> Column:
    return F.regexp_replace(c, NON_ALPHA, " ")


def squeeze_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def is_blank(c: Column) -> Column:
    return ~c.rlike(NON_SPACE)


def normalize(c: Column, cfg: CleanConfig) -> Column:
    """The cleaning chain; the order of the steps is part of the result."""
    c = coerce_text(c)
    if cfg.unescape:
        c = html_unescape(c)
    if cfg.strip_html:
        c = strip_html(c)
    if cfg.strip_urls:
        c = strip_urls(c)
    if cfg.strip_mentions:
        c = strip_mentions(c)
    if cfg.keep_hashtag_text:
        c = keep_hashtag_text(c)
    if cfg.lowercase:
        c = lowercase(c)
    if cfg.expand_contractions:
        c = expand_contractions(c)
    if cfg.reduce_repeats:
        c = reduce_repeats(c)
    if cfg.remove_non_alpha:
        # One pass for "not a-z -> space" and "squeeze spaces": any run of either
        # kind ends up as one space.
        return F.trim(F.regexp_replace(c, "[^a-z]+", " "))
    return squeeze_whitespace(c)


def tokenize(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0))




def _long_enough(t: Column, n: int) -> Column:
    return (F.length(t) >= n) | t.isin(*NEGATIONS)


def filter_short(tokens: Column, n: int) -> Column:
    return F.filter(tokens, lambda t: _long_enough(t, n))


def stoplist(base=STOPWORDS, extra=(), keep_negations: bool = True) -> list[str]:
    words = set(base) | set(extra)
    return sorted(words - set(NEGATIONS) if keep_negations else words)


def remove_stopwords(
    tokens: Column, base=STOPWORDS, extra=(), keep_negations: bool = True
) -> Column:
    words = stoplist(base, extra, keep_negations)
    return F.filter(tokens, lambda t: ~t.isin(*words)) if words else tokens


def surface_tokens(c: Column, cfg: CleanConfig, base=STOPWORDS) -> Column:
    """Normalise, tokenise, drop short tokens and stopwords; no stem or lemma."""
    words = stoplist(base, cfg.extra_stopwords, cfg.keep_negations)
    drop = cfg.remove_stopwords and bool(words)

    def keep(t: Column) -> Column:
        ok = _long_enough(t, cfg.min_token_len)
        return ok & ~t.isin(*words) if drop else ok

    if not cfg.remove_non_alpha:
        return F.filter(tokenize(normalize(c, cfg)), keep)
    return F.filter(
        F.split(normalize(c, cfg), " "), lambda t: (t != "") & keep(t)
    )


def surface_text(c: Column, cfg: CleanConfig, base=STOPWORDS) -> Column:
    return F.array_join(surface_tokens(c, cfg, base), " ")


def analyze(clean: Column) -> Column:
    """Cleaned text -> feature tokens: lower case, two word characters or more."""
    return F.regexp_extract_all(F.lower(clean), F.lit(FEATURE_TOKEN), F.lit(0))
