"""Every query with a SQL twin gives the same rows on the small tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference, spark_rows, sql_rows

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, con, small):
    got = spark_rows(entry.queries()[name](spark, small))
    assert difference(got, sql_rows(con, ORACLES[name])) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def more():
    return connect("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n.startswith(("ast_", "feat_", "rel_rules", "rul_"))))
def test_text_query_equals_sql_on_more_documents(name, spark, more):
    """The larger table plants secrets in the texts, which the smallest does not."""
    got = spark_rows(entry.queries()[name](spark, "/root/testdata/sf0.01"))
    assert difference(got, sql_rows(more, ORACLES[name])) is None
