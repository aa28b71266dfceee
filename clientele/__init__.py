"""clientele — customer analytics and segmentation on Spark DataFrames.

Every operator is a plain function ``DataFrame(s) -> DataFrame`` built on the
DataFrame API, Catalyst and Spark ML.  Sub-packages:

* ``sources``   — transaction schema, loaders (CSV / Parquet / test tables), sinks
* ``functions`` — null-safe aggregates, date helpers, distributed ranking,
                  special functions (log-gamma, digamma, Gauss hypergeometric)
* ``operators`` — customer features, cohorts, BTYD models, baskets, segments, churn
* ``plans``     — the named query catalogue and its DuckDB oracle SQL
"""

__version__ = "0.1.0"
