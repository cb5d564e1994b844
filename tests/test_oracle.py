"""Every registered query vs its DuckDB oracle (the driver's check), on sf0.001."""

import os

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck
from conftest import SF_SMALL

from strata.plans.catalog import REGISTRY
from strata.plans.duckdb_oracle import SQL as OWN_SQL

# the training-data queries have tests of their own beside their subpackage's
QUERIES = {k: v for k, v in E.queries().items() if k in REGISTRY}
SQL = {k: v for k, v in E.oracle_sql().items() if k in OWN_SQL}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = {"table_footprint"}
    assert set(QUERIES) - set(SQL) == rows_only
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    os.environ["ORACLE_STRICT"] = "1"
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name], con)
    assert r["ok"] and "types" not in r, r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "median_fare_usd" in df.columns


def test_pipeline_built_gold_tables_match_oracle(spark, con, scratch):
    """The stored tables (four of them from the fused grouping-sets path) equal
    the oracle's models."""
    from oracle_harness import canon
    from strata.plans import pipeline
    from strata.plans.layers import Medallion
    b = pipeline.build(Medallion(spark, SF_SMALL), root=scratch + "/layers", run_tests=False)
    for name in ("daily_revenue", "hourly_demand", "borough_pairs", "driver_economics", "shared_vs_solo"):
        df = b.gold(name)
        res = con.execute(SQL["gold_" + name])
        assert canon(df.columns, [tuple(r) for r in df.collect()]) == \
            canon([d[0] for d in res.description], res.fetchall()), name
