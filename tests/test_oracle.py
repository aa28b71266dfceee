"""Differential test: every deterministic catalogue query against its DuckDB
SQL on the same Parquet tables (exact multiset equality, columns by name)."""

import pytest

from conftest import SF_SMALL

from __spark_entry__ import oracle_sql, queries
from clientele.plans.catalog import QUERIES
from clientele.plans.compare import compare, duckdb_connection

ORACLE = {k: v for k, v in oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    res = compare(df, con, ORACLE[name])
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["exact"], res


def test_rows_only_queries_are_the_iterative_ones():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"kmeans_elbow", "kmeans_segments", "cluster_summary", "cluster_ranked",
                         "bgnbd_fit", "gg_fit", "fitted_scores", "customer_clusters"}
