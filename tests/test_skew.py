"""The registered queries on tables in which one key holds a third of all rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

# One order key (as many different rows and as copies of one reading), one day, one user.
HOT = {
    "orders": """SELECT if(r % 3 = 0, 1, o_orderkey) AS o_orderkey, o_custkey, o_orderstatus,
        o_totalprice + if(r % 3 = 0, r, 0) AS o_totalprice,
        if(r % 3 = 0, TIMESTAMP '1997-03-01', o_orderdate) AS o_orderdate, o_orderpriority FROM t""",
    "lineitem": """SELECT if(r % 3 = 0, 1, l_orderkey) AS l_orderkey, l_partkey, l_suppkey,
        CAST(if(r % 6 = 0, 1, if(r % 3 = 0, r, l_linenumber)) AS int) AS l_linenumber, l_quantity, l_extendedprice,
        l_discount, l_tax, l_returnflag, l_linestatus,
        if(r % 3 = 0, TIMESTAMP '1997-03-01', l_shipdate) AS l_shipdate FROM t""",
    "events": """SELECT event_id, if(r % 3 = 0, TIMESTAMP '2024-01-09 01:00:00', ts) AS ts,
        if(r % 3 = 0, 5, user_id) AS user_id, if(r % 3 = 0, 'click', event_type) AS event_type, value, props FROM t""",
}

QUERIES = [
    "rate_by_year",
    "rate_by_region",
    "role_playing_flow",
    "capture_mix",
    "layer_fact",
    "layer_quarantine",
    "layer_stg_leituras",
    "layer_stg_carga",
    "last_event_per_key",
    "window_count_then_pick",
    "anti_by_key",
    "dedup_keep_latest",
    "dq_unique_key",
    "dq_no_row_lost",
    "ing_file_hash",
    "bronze_append_merge",
    "batch_stats",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for path in glob.glob(f"{entry_points.SMOKE_DIR}/*.parquet"):
        name = os.path.basename(path)[:-8]
        source = f"(SELECT *, row_number() OVER () AS r FROM '{path}') t"
        body = HOT.get(name, f"SELECT * FROM '{path}' t").replace("FROM t", f"FROM {source}")
        con.execute(f"COPY ({body}) TO '{folder}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return folder, con


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, skewed, name):
    folder, con = skewed
    df = entry_points.queries()[name](spark, folder)
    columns = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = con.sql(f"SELECT {quoted} FROM ({entry_points.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, theirs)) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())
