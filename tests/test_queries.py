"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.conftest import TESTDATA
from tests.oracle import connect, differences

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")
SLOW_FITS = {"c2_fit_logreg", "c3_text_classifier", "c5_label_corpus_predicted", "c10_sweep",
             "s8_save_load_model", "p1_score_stream"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert differences(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW_FITS))
def test_query_gives_rows(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "score", "text", "sentiment"]
    assert df.count() > 0
