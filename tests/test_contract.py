"""A cross-section of the driver queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SAMPLE = ["parse_kv", "envelope_parsing", "validate_reasons", "control_connection", "schedule_flagging",
          "geo_longest_prefix", "route_statistics", "hop_delays", "reassemble_records", "upsert_latest_rows",
          "search_documents", "port_ranges", "denormalized_rules"]


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in os.listdir(FOLDER):
        con.execute(f"create view {name.split('.')[0]} as select * from '{FOLDER}/{name}'")
    return con


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    own = [name for name in contract.queries() if not (name == "pipeline" or name.startswith("op"))]
    assert len(set(own) - set(contract.oracle_sql())) <= 1


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, engine, name):
    df = contract.queries()[name](spark, FOLDER)
    relation = engine.sql(contract.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    order = [relation.columns.index(c) for c in columns]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    left = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    right = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=key)
    assert left == right
