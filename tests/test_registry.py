"""Every registered query against its SQL, over the smallest given tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from catalog.entries import QUERIES

SF_DIR = entry_points.SMOKE_DIR


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry_points.queries()) and set(QUERIES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    sql = entry_points.oracle_sql()[name]
    columns = sorted(df.columns)
    assert columns == sorted(duck.sql(sql).columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(repr(r) for r in duck.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    ours = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    assert ours == theirs
    assert ours


# Queries whose Spark plan is over tables they have written before.
STORED = {"dq_report", "layer_roundtrip", "ing_run_counts", "ing_real_files", "ing_real_rows", "pipeline_entry"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_plan_has_no_pairwise_join_and_prunes_columns(spark, plan, name):
    text = plan(entry_points.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    for scan in text.split("FileScan parquet")[1:]:
        if "lineitem.parquet" in scan.split("ReadSchema")[0]:
            assert "l_discount" not in scan and "l_tax" not in scan


def test_flagship(spark):
    assert [r["exercicio"] for r in entry_points.entry(spark).collect()] == sorted(range(1995, 2002))


def test_reports_cover_the_whole_fact(spark):
    queries = entry_points.queries()
    fact = queries["layer_fact"](spark, SF_DIR)
    for name in ("rate_by_year", "rate_by_region", "rate_two_criteria"):
        assert queries[name](spark, SF_DIR).groupBy().sum("bens_em_carga").first()[0] == fact.count()


ORDERS = {
    "rate_by_year": lambda r: (r["exercicio"],),
    "rate_by_region": lambda r: (r["exercicio"], r["taxa_localizacao_pct"], r["regiao"], r["comarca"]),
    "rate_two_criteria": lambda r: (
        r["exercicio"],
        -(r["taxa_criterio_antigo_pct"] - r["taxa_criterio_novo_pct"]),
        r["comarca"],
    ),
    "role_playing_flow": lambda r: (r["exercicio"], -r["bens"], r["area_da_carga"], r["area_onde_foi_lido"]),
    "quarantine_summary": lambda r: (r["lote"], r["motivo"]),
    "count_by_raw_value": lambda r: (-r["leituras"], r["origem_leitura"] is not None, r["origem_leitura"] or ""),
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_reports_come_in_their_order(spark, name):
    found = [r.asDict() for r in QUERIES[name](spark, SF_DIR).collect()]
    keys = [tuple(round(x, 9) if isinstance(x, float) else x for x in ORDERS[name](r)) for r in found]
    assert keys == sorted(keys) and len(found) > 1


@pytest.mark.parametrize("name, most", [("layer_fact", 6), ("anti_by_key", 5), ("dedup_keep_first", 1)])
def test_shuffles_are_few(spark, plan, name, most):
    assert plan(QUERIES[name](spark, SF_DIR)).count("Exchange hashpartitioning") <= most
