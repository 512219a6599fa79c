"""Fill-in-the-middle against a plain construction from the contract."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from textlake.llm import fim

LONG = "".join(f"line {i} é世\n" if i % 7 else "\n" for i in range(3000)) + "tail without end"
TEXTS = [
    (1, "one line"), (2, "a\nb\n"), (3, None), (4, ""), (5, "x <S> y\nz"), (6, LONG), (7, "\n\n\n"),
    (8, "first\nsecond\nthird\nfourth"), (8, "first\nsecond\nthird\nfourth"), (None, "no id\nat all\n"),
    (9, "ü" * 9000 + "\n" + "ß" * 5000), (10, "<M>"),
]


def expected(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    hx = hashlib.sha256(("7:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h = [int(hx[8 * k : 8 * k + 8], 16) for k in range(4)]
    k1, k2 = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:k1]), "".join(units[k1:k2]), "".join(units[k2:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 50:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(i, t, "x", 7, "clash") for i, t in TEXTS], "doc_id long, text string, n string, form int, output string"
    ).repartition(3)


def test_block_index_finds_every_unit_end():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice("ab\n世") for _ in range(rng.randrange(0, 60)))
        ends = [m.end() for m in re.finditer(r"[^\n]*\n|[^\n]+", text)]
        index = fim.BlockIndex(text, block=rng.choice([1, 2, 3, 5, 8]))
        assert index.n == len(ends)
        assert [index.boundary(k) for k in range(len(ends) + 1)] == [0] + ends


def test_fim_equals_the_contract(docs):
    got = fim.transform(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output",
        fim.restore(F.col("output"), F.col("form")).alias("restored"), F.coalesce("text", F.lit("")).alias("text"),
    ).collect()
    assert len(got) == len(TEXTS)
    want = sorted((expected(i, t) for i, t in TEXTS), key=repr)
    assert sorted((tuple(r)[:6] for r in got), key=repr) == want
    assert all(r["restored"] == r["text"] for r in got)
    assert {r["form"] for r in got} >= {"plain", "psm", "spm"}


def test_fim_on_an_empty_table(docs):
    assert fim.transform(docs.filter("false")).count() == 0
