"""Every query that has SQL equals it on the smallest tables."""

import oracle
import pytest

from veriflume import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert oracle.difference(spark, SF, catalog.QUERIES[name], catalog.ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_candidates_equal_sql(spark):
    """The smallest tables yield none."""
    assert oracle.difference(spark, SF.replace("0.001", "0.01"), catalog.QUERIES["triage_candidates"], catalog.ORACLE_SQL["triage_candidates"]) is None


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
