"""Every curation query against its DuckDB SQL."""

import pytest

from regloom import published_queries, rule_queries, text_queries, validator_queries  # noqa: F401  these add their queries
from regloom.queries import ORACLES, QUERIES
from tests.compare import differences, views

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert differences(got, views(SF).execute(ORACLES[name]).df()) == ""
    else:
        assert len(got) > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
