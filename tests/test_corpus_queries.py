import importlib
import os
import sys

import pytest
from testdata import SF_SMALL

from parley.plans import catalog, corpus_queries
from parley.sources.tables import TABLES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))


def test_registered_beside_the_lazy_queries():
    entry = importlib.import_module("__spark_entry__")
    assert set(corpus_queries.QUERIES) == set(corpus_queries.ORACLES)
    assert not set(corpus_queries.QUERIES) & set(catalog.queries())
    assert set(corpus_queries.QUERIES) <= set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("name", ["heavy_terms", "topic_phrases"])
def test_equal_to_sql(spark, name):
    import compare
    con = compare.duckdb_connection(SF_SMALL, TABLES)
    df = corpus_queries.QUERIES[name](spark, SF_SMALL)
    sql = corpus_queries.ORACLES[name]
    assert compare.diff(compare.spark_rows(df), compare.duckdb_rows(con, sql)) is None
    assert compare.schema_diff(df, con, sql) is None
