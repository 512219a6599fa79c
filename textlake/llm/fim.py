"""Fill-in-the-middle: a text cut at two unit boundaries and rearranged.

A unit is a line with its newline (``[^\\n]*\\n|[^\\n]+``, left to right). The two
cut points come from the hex sha256 of ``<seed><doc_id>``: its first four groups
of eight hex digits, read as unsigned integers, are h1 to h4. With n units the
prefix ends after min(h1, h2) % (n + 1) units and the middle after the larger of
the two; the suffix is the rest. The form is ``plain`` when the text is empty or
holds a sentinel, or when h3 % 100 >= ``rate``; otherwise ``spm`` when
h4 % 100 < ``spm_rate``, else ``psm``::

    psm: <P> prefix <S> suffix <M> middle
    spm: <S> suffix <P> prefix <M> middle

Finding the code point where a unit ends is the only work that needs the text
unit by unit. It is done by a Fenwick tree over fixed blocks of the text that
stores, per block, the number of units ending in it and its code points; a
binary-lifting descent finds the block that holds the wanted unit end, and a
scan of that block alone places it. All else, hashes and assembly, stays in the
JVM: Spark's ``substring`` and ``instr`` count code points, as the cuts do.

Defined results: a null text counts as empty (n = 0, form ``plain``, output
empty); a null ``doc_id`` hashes the seed alone; a text holding ``<P>``, ``<S>``
or ``<M>`` is plain with null prefix and middle sizes; repeated rows get equal
results; an empty table gives an empty result; columns of the input pass through,
those named like an output column are replaced by it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import LongType, StructField, StructType

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "7:"
BLOCK = 4096

OUTPUTS = ("n", "form", "cut_prefix", "cut_middle", "prefix_chars", "middle_chars", "output")


class BlockIndex:
    """Unit ends of one text, indexed by a Fenwick tree over blocks of ``block`` code points."""

    def __init__(self, text: str, block: int = BLOCK):
        self.text, self.block = text, block
        blocks = [text[at : at + block] for at in range(0, len(text), block)]
        units = [part.count("\n") for part in blocks]
        if text and not text.endswith("\n"):
            units[-1] += 1  # the last unit ends at the end of the text
        self.n = sum(units)
        self.size = len(blocks)
        self.units = [0] * (self.size + 1)
        self.chars = [0] * (self.size + 1)
        for at, (count, part) in enumerate(zip(units, blocks), start=1):
            self._add(at, count, len(part))
        self.top = 1 << max(0, self.size.bit_length() - 1) if self.size else 0

    def _add(self, at: int, units: int, chars: int) -> None:
        while at <= self.size:
            self.units[at] += units
            self.chars[at] += chars
            at += at & -at

    def boundary(self, k: int) -> int:
        """Code points before the end of the ``k``-th unit (0 for none, the length for all)."""
        if k <= 0:
            return 0
        if k >= self.n:
            return len(self.text)
        at, left, before, step = 0, k, 0, self.top
        while step:  # largest block prefix with fewer than k unit ends
            if at + step <= self.size and self.units[at + step] < left:
                at += step
                left -= self.units[at]
                before += self.chars[at]
            step >>= 1
        part = self.text[before : before + self.block]
        end = -1
        for _ in range(left):
            end = part.index("\n", end + 1)
        return before + end + 1


def hash_part(key: Column, k: int) -> Column:
    """The k-th (1-based) group of eight hex digits of the key's sha256, unsigned."""
    return F.conv(F.substring(key, 8 * k - 7, 8), 16, 10).cast("long")


@pandas_udf(StructType([StructField(name, LongType()) for name in ("n", "cut_prefix", "cut_middle")]))
def _cuts(texts: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
    rows = []
    for text, a, b in zip(texts, h1, h2):
        index = BlockIndex(text)
        first, second = sorted((int(a) % (index.n + 1), int(b) % (index.n + 1)))
        rows.append((index.n, index.boundary(first), index.boundary(second)))
    return pd.DataFrame(rows, columns=["n", "cut_prefix", "cut_middle"], dtype="int64")


def transform(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: str = SEED,
              rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """``docs`` with n, form, the cut points (code points), the part sizes and the output text."""
    body = F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = {k: hash_part(digest, k) for k in (1, 2, 3, 4)}
    cuts = _cuts(body, h[1], h[2])
    held = F.contains(body, F.lit(PREFIX)) | F.contains(body, F.lit(SUFFIX)) | F.contains(body, F.lit(MIDDLE))
    form = (F.when((body == "") | held | (h[3] % 100 >= rate), "plain")
            .when(h[4] % 100 < spm_rate, "spm").otherwise("psm"))
    out = docs.drop(*OUTPUTS).withColumn("_fim", F.struct(cuts.alias("c"), form.alias("form"), body.alias("body")))
    c = F.col("_fim.c")
    start, end, whole = c["cut_prefix"], c["cut_middle"], F.col("_fim.body")
    prefix = F.substring(whole, F.lit(1), start.cast("int"))
    middle = F.expr("substring(_fim.body, _fim.c.cut_prefix + 1, _fim.c.cut_middle - _fim.c.cut_prefix)")
    suffix = F.expr("substring(_fim.body, _fim.c.cut_middle + 1)")
    plain = F.col("_fim.form") == "plain"
    output = (F.when(plain, whole)
              .when(F.col("_fim.form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)))
    return out.select(
        "*", c["n"].alias("n"), F.col("_fim.form").alias("form"), start.alias("cut_prefix"), end.alias("cut_middle"),
        F.when(~plain, start).alias("prefix_chars"), F.when(~plain, end - start).alias("middle_chars"),
        output.alias("output"),
    ).drop("_fim")


def restore(output: Column, form: Column) -> Column:
    """The text an output was made from, read from its sentinels alone."""
    s, m, p = F.instr(output, SUFFIX), F.instr(output, MIDDLE), F.instr(output, PREFIX)
    tail = output.substr(m + 3, F.length(output) + 1)
    psm = F.concat(output.substr(F.lit(4), s - 4), tail, output.substr(s + 3, m - s - 3))
    spm = F.concat(output.substr(p + 3, m - p - 3), tail, output.substr(F.lit(4), p - 4))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
