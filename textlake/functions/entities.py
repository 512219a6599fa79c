"""HTML character references as a native expression.

The named references come from the standard library's table at planning time;
the numeric rules are those of the HTML standard.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, functions as F

from textlake.functions.arrays import let

_MAX_CODE = 0x10FFFF


def _numeric_exceptions() -> dict[int, str]:
    """Code numbers whose reference is not simply that character."""
    out = {n: "" for n in (*range(0x01, 0x09), 0x0B, *range(0x0E, 0x20), 0x7F)}
    out.update({n: "" for n in range(0xFDD0, 0xFDF0)})
    out.update({plane * 0x10000 + low: "" for plane in range(17) for low in (0xFFFE, 0xFFFF)})
    for n in range(0x80, 0xA0):  # read as windows-1252 where that page has a character
        try:
            out[n] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            out[n] = chr(n)
    out[0x00] = "\ufffd"
    out[0x0D] = "\r"
    out[0xFEFF] = "\ufeff"  # the UTF-32 decoder would take it for a byte order mark
    return out


def _lookup(pairs: dict) -> Column:
    """String map from one literal, folded once at planning; a map built from
    thousands of literals would slow down every pass of the optimizer."""
    text = "\ue001".join(f"{key}\ue000{value}" for key, value in sorted(pairs.items()))
    return F.str_to_map(F.lit(text), F.lit("\ue001"), F.lit("\ue000"))


def _from_code(code: Column) -> Column:
    """Code number (as a long) -> character."""
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(code.isNull() | (code > _MAX_CODE) | code.between(0xD800, 0xDFFF), F.lit("\ufffd"))
        .otherwise(F.coalesce(F.try_element_at(_lookup(_numeric_exceptions()), code.cast("string")), plain))
    )


def _decimal(digits: Column) -> Column:
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    return F.when(F.length(short) <= 7, F.conv(short, 10, 10).cast("long"))


def _hexadecimal(digits: Column) -> Column:
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    return F.when(F.length(short) <= 6, F.conv(short, 16, 10).cast("long"))


def _resolve(piece: Column) -> Column:
    """``piece`` is what followed one ampersand."""
    full = {name: text for name, text in html5.items() if name.endswith(";")}
    bare = {name: text for name, text in html5.items() if not name.endswith(";")}
    longest_first = "|".join(sorted(bare, key=lambda name: (-len(name), name)))

    decimal = r"^#([0-9]+);?"
    hexadecimal = r"^#[xX]([0-9a-fA-F]+);?"
    name = F.regexp_extract(piece, r"^([^\t\n\f <&#;]{1,32};)", 1)
    prefix = F.regexp_extract(piece, f"^(?:{longest_first})", 0)
    return (
        # No reference begins otherwise; looking a name up walks through the whole map.
        F.when(~piece.rlike("^[a-zA-Z#]"), F.concat(F.lit("&"), piece))
        .when(
            piece.rlike(decimal),
            F.concat(
                _from_code(_decimal(F.regexp_extract(piece, decimal, 1))),
                F.regexp_replace(piece, decimal, ""),
            ),
        )
        .when(
            piece.rlike(hexadecimal),
            F.concat(
                _from_code(_hexadecimal(F.regexp_extract(piece, hexadecimal, 1))),
                F.regexp_replace(piece, hexadecimal, ""),
            ),
        )
        .otherwise(
            F.coalesce(
                F.concat(
                    F.try_element_at(_lookup(full), F.nullif(name, F.lit(""))),
                    F.substr(piece, F.length(name) + 1),
                ),
                F.concat(
                    F.try_element_at(_lookup(bare), F.nullif(prefix, F.lit(""))),
                    F.substr(piece, F.length(prefix) + 1),
                ),
                F.concat(F.lit("&"), piece),
            )
        )
    )


def html_unescape(c: Column) -> Column:
    """Named and numeric references -> characters, in a single pass.

    The text is cut at its ampersands, so each reference is looked at once and a
    replacement is never read again. Rows without an ampersand skip the work.
    """

    def rebuild(pieces: Column) -> Column:
        tail = F.slice(pieces, F.lit(2), F.size(pieces))
        return F.concat(
            F.get(pieces, F.lit(0)),
            F.array_join(F.transform(tail, _resolve), ""),
        )

    return F.when(F.contains(c, F.lit("&")), let(F.split(c, "&"), rebuild)).otherwise(c)
