"""Suffix stripping after M. F. Porter, "An algorithm for suffix stripping" (1980).

A small word-level helper: rule tables plus four shape tests. ``extended`` adds
the widely used departures from the paper (short words unchanged, a few irregular
words, dies -> die, y -> i only after a consonant, -bli, -fulli, -logi).
"""

from __future__ import annotations

from functools import lru_cache


def _shape(stem: str) -> str:
    """One letter per character, v or c; a y after a consonant counts as a vowel."""
    out = ""
    for ch in stem:
        out += "v" if ch in "aeiou" or (ch == "y" and out.endswith("c")) else "c"
    return out


def _measure(stem: str) -> int:
    """How many vowel runs are followed by a consonant run."""
    return _shape(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _ends_cvc(stem: str, extended: bool) -> bool:
    shape = _shape(stem)
    if extended and shape == "vc":
        return True
    return shape.endswith("cvc") and stem[-1] not in "wxy"


def _ends_double(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


# Suffix -> replacement, tried in this order.
STEP1A = (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", ""))
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP2_EXTENDED = tuple(("bli", "ble") if rule[0] == "abli" else rule for rule in STEP2) + (
    ("fulli", "ful"), ("logi", "log"),
)
STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
)
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)
# Words the extended variant looks up.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}


def _first(word: str, rules, allowed) -> str:
    """Apply the first rule whose suffix fits, if the stem before it is allowed."""
    for suffix, replacement in rules:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            return stem + replacement if allowed(stem, suffix) else word
    return word


def _plural(word: str, extended: bool) -> str:
    if extended and len(word) == 4 and word.endswith("ies"):
        return word[:-1]
    return _first(word, STEP1A, lambda stem, suffix: True)


def _past(word: str, extended: bool) -> str:
    if extended and word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        if word.endswith(suffix) and _has_vowel(word[: -len(suffix)]):
            return _repair(word[: -len(suffix)], extended)
    return word


def _repair(stem: str, extended: bool) -> str:
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _ends_double(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _ends_cvc(stem, extended) else stem


def _final_y(word: str, extended: bool) -> str:
    stem = word[:-1]
    if not word.endswith("y"):
        return word
    if extended:
        fits = len(stem) > 1 and _shape(stem)[-1] == "c"
    else:
        fits = _has_vowel(stem)
    return stem + "i" if fits else word


def _double_suffix(word: str, extended: bool) -> str:
    if not extended:
        return _first(word, STEP2, lambda stem, suffix: _measure(stem) > 0)
    while word.endswith("alli") and _measure(word[:-4]) > 0:
        word = word[:-2]
    return _first(
        word,
        STEP2_EXTENDED,
        lambda stem, suffix: _measure(stem + "l" if suffix == "logi" else stem) > 0,
    )


def _drop_suffix(word: str) -> str:
    return _first(
        word,
        [(suffix, "") for suffix in STEP4],
        lambda stem, suffix: _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))),
    )


def _tidy(word: str, extended: bool) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _ends_cvc(stem, extended)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


@lru_cache(maxsize=1 << 18)
def stem(word: str, extended: bool = True) -> str:
    word = word.lower()
    if extended and word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _final_y(_past(_plural(word, extended), extended), extended)
    word = _double_suffix(word, extended)
    word = _first(word, STEP3, lambda s, suffix: _measure(s) > 0)
    return _tidy(_drop_suffix(word), extended)
