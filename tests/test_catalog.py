import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation supplier part orders lineitem events"

# a spread of operators; tools/check_queries.py runs all of them
SAMPLE = [
    "a4_write_partitioned",
    "b17_registry_keys",
    "c5_is_holiday",
    "d18_resample_month_sum",
    "e5_carry_over",
    "e10_strict_ma7",
    "j1_metrics_per_pair",
    "k13_quantile_scoring",
    "l3_reorder_points",
    "l5_impact_report",
    "features_table",
]

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_every_sql_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) > 100


@needs_data
def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["store_nbr", "family"] and df.count() > 0


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cur = con.execute(oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    df = queries()[name](spark, FOLDER)
    assert df.columns == columns
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got == sorted(cur.fetchall(), key=repr)
