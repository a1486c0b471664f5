"""Every registered query with SQL is compared with it on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, compare

# The community loop has a fixed cost per round; its queries are checked by check_oracle.py.
SLOW = {"detect_communities", "build_cluster_index", "cluster_entries", "run_refresh"}


@pytest.fixture(scope="module")
def connection(folder):
    made = duckdb.connect()
    for table in TABLES:
        made.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return made


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n not in SLOW])
def test_query_equals_sql(spark, folder, connection, name):
    outcome = compare(spark, folder, name, connection)
    assert outcome.startswith("ok") and "KINDS" not in outcome, outcome


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
