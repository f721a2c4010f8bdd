"""The registered queries and their SQL twins at the smallest scale."""

import duckdb
import pytest
from check_oracle import TABLES, compare

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# One query per module here; tests/check_oracle.py runs all of them.
SAMPLE = ["gold_hourly", "gold_daily", "feature_matrix_chunked", "rank_average", "variant_landing", "did_cross_products", "stream_hourly_counts"]


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 90


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_sql(spark, con, sf_dir, name):
    text, ok = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES[name])
    assert ok, text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
