"""Silver, quarantine, fact and reports on small hand-made layers."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR
from catalog.entries import QUERIES
from helpers import rows
from stocktake.plans import gold, quality, reports, silver
from stocktake.plans.quality import Check
from stocktake.sources.seed import reading_origins

REGISTER = (
    "exercicio int, numero_patrimonio long, descricao_bem string, codigo_area_carga int, "
    "valor_atual decimal(14,2), situacao_bem string"
)
READINGS = (
    "id_leitura string, exercicio int, numero_patrimonio long, codigo_area int, espaco_fisico string, "
    "coletado_em timestamp_ntz, origem_recebida string, origem_leitura string, tipo_captura string, lote string"
)


def asset(number, area, value="10.00", status="ATIVO", year=2026):
    return (year, number, "bem", area, Decimal(value), status)


def read(ident, number, area, hour=9, origin="celular", year=2026):
    moment = None if hour is None else datetime(2026, 8, 5, hour)
    return (ident, year, number, area, "sala", moment, origin, origin, "Leitura automática", "lote_1")


@pytest.fixture
def layers(spark):
    register = spark.createDataFrame(
        [
            asset(1, 10),
            asset(2, 10),
            asset(3, 99),
            asset(4, 10),
            asset(5, None),
            asset(6, 98),
            asset(7, 10, status="BAIXADO"),
            asset(8, 10, "1.00"),
            asset(8, 10, "2.00"),
            asset(None, 10),
            asset(9, 20),
        ],
        REGISTER,
    )
    readings = spark.createDataFrame(
        [
            read("a", 1, 10),
            read("b", 2, 10, 8),
            read("c", 2, 20, 9),
            read("d", 3, 97),
            read("e", 4, None),
            read("f", 5, 10),
            read("g", 6, 98),
            read("h", 7, 10),
            read("i", None, 10),
            read("j", 1, 10, year=2025),
            read("k", 9, 10, None),
            read("l", 9, 20, None),
            read("m", 8, 10),
        ],
        READINGS,
    )
    areas = spark.createDataFrame(
        [(10, "A", "Judicial", "X", None), (20, "B", "Administrativa", None, None)],
        "codigo_area int, nome_area string, tipo_area string, comarca string, regiao string",
    )
    return register, readings, gold.dim_area(areas)


def test_quarantine_keeps_every_unmatched_reading_with_a_reason(layers):
    register, readings, _ = layers
    assert rows(silver.quarantine(readings, register), "id_leitura", "motivo") == [
        ("h", "fora_da_carga"),  # written off
        ("i", "patrimonio_ausente"),
        ("j", "fora_da_carga"),  # other year
    ]


def test_fact_states_and_flags(layers):
    fact = gold.fact(*layers)
    columns = ["numero_patrimonio", "area_carga_id", "area_leitura_id", "situacao_inventario"]
    flags = ["localizado_na_area", "localizado_em_outra_area", "nao_localizado", "quantidade_leituras"]
    assert rows(fact, *columns, *flags) == [
        (None, 10, None, "Não localizado", 0, 0, 1, 0),
        (1, 10, 10, "Localizado", 1, 0, 0, 1),
        (2, 10, 20, "Localizado em outra área", 0, 1, 0, 2),  # the last of two counts
        (3, -1, -1, "Localizado em outra área", 0, 1, 0, 1),  # two unknown codes are not equal
        (4, 10, None, "Não localizado", 0, 0, 1, 1),  # read, but in no readable area
        (5, -1, 10, "Localizado em outra área", 0, 0, 0, 1),  # cannot be compared: no flag
        (6, -1, -1, "Localizado", 1, 0, 0, 1),  # the same unknown code
        (8, 10, 10, "Localizado", 1, 0, 0, 1),
        (8, 10, 10, "Localizado", 1, 0, 0, 1),
        (9, 20, 20, "Localizado", 1, 0, 0, 2),  # no time: the greater id is the last
    ]
    missing = rows(fact.filter("nao_localizado = 1"), "numero_patrimonio", "valor_nao_localizado")
    assert missing == [(None, Decimal("10.00")), (4, Decimal("10.00"))]
    assert dict(fact.dtypes)["valor_nao_localizado"] == "decimal(14,2)"


def test_left_out_join_changes_nothing(layers):
    """Readings in quarantine never reach the fact, with or without being removed first."""
    register, readings, dimension = layers
    valid = silver.unmatched(readings, silver.quarantine(readings, register), ["id_leitura"])
    assert rows(gold.fact(register, valid, dimension)) == rows(gold.fact(register, readings, dimension))


def test_checks_find_the_planted_violations(layers):
    register, readings, dimension = layers
    fact, rejected = gold.fact(*layers), silver.quarantine(readings, register)
    assert rows(quality.repeated_keys(fact, silver.ASSET)) == [(2026, 8, 2)]
    assert rows(quality.not_exclusive(fact, ["numero_patrimonio"], reports_flags())) == [(5,)]
    assert quality.lost_rows(readings, fact, rejected).count() == 0
    assert rows(quality.lost_rows(readings, fact, rejected.filter("motivo = 'fora_da_carga'"))) == [("i",)]
    assert rows(quality.orphans(register, "codigo_area_carga", dimension, "area_id")) == [(98, 1), (99, 1)]
    assert rows(quality.count_nulls(register, ["numero_patrimonio", "codigo_area_carga"])) == [
        ("codigo_area_carga", 1),
        ("numero_patrimonio", 1),
    ]
    assert rows(quality.unexpected_values(register, "situacao_bem", ["ATIVO"])) == [("BAIXADO", 1)]
    assert quality.repeated_values(register, "numero_patrimonio").count() == 1


def reports_flags():
    return ["localizado_na_area", "localizado_em_outra_area", "nao_localizado"]


def test_severity_decides_between_warning_and_failure(spark):
    tables = {"t": spark.createDataFrame([(1,), (1,), (None,)], "k int"), "p": spark.createDataFrame([(2,)], "k int")}
    checks = [
        Check("not_null", "t", ("k",)),
        Check("unique", "t", ("k",)),
        Check("relationships", "t", ("k",), parent="p", parent_column="k", severity="warn"),
        Check("accepted_values", "t", ("k",), values=("1",)),
    ]
    report = quality.run_checks(checks, tables)
    assert rows(report, "verificacao", "violacoes", "situacao") == [
        ("accepted_values", 0, "PASS"),
        ("not_null", 1, "FAIL"),
        ("relationships", 2, "WARN"),
        ("unique", 1, "FAIL"),
    ]
    with pytest.raises(ValueError):
        quality.violations(Check("other", "t", ("k",)), tables)


def test_identities_hold(layers):
    register, readings, _ = layers
    fact, rejected = gold.fact(*layers), silver.quarantine(readings, register)
    assert fact.count() == silver.active(register).count()
    keyed = fact.filter("numero_patrimonio is not null").dropDuplicates(["exercicio", "numero_patrimonio"])
    assert keyed.agg(F.sum("quantidade_leituras")).first()[0] + rejected.count() == readings.count()


def test_reports(layers, spark):
    fact, dimension = gold.fact(*layers), layers[2]
    region = reports.rate_by_region(fact, dimension)
    assert rows(region, "regiao", "comarca", "bens_em_carga", "taxa_localizacao_pct") == [
        ("Não informada", "Não informada", 3, 33.3),
        ("Não informada", "X", 6, 50.0),
        ("Não se aplica", "Não se aplica", 1, 100.0),
    ]
    two = rows(reports.rate_two_criteria(fact, dimension), "comarca", "taxa_criterio_antigo_pct", "taxa_criterio_novo_pct")
    assert two == [("Não informada", 66.7, 33.3), ("Não se aplica", 100.0, 100.0), ("X", 66.7, 50.0)]
    flow = reports.misplaced_flow(fact, dimension)
    assert [tuple(r) for r in flow.collect()] == [
        (2026, "A", "B", 1),
        (2026, "Área não cadastrada", "Área não cadastrada", 1),
    ]
    assert reports.misplaced_flow(fact, dimension, top=1).count() == 1
    mix = reports.capture_mix(fact, gold.dim_origin(reading_origins(spark)))
    assert [tuple(r) for r in mix.collect()] == [(2026, "Leitura automática", "celular", 9)]
    by_year = reports.rate_by_year(fact).first()
    assert (by_year["bens_em_carga"], by_year["nao_localizados"], str(by_year["valor_nao_localizado"])) == (10, 2, "20.00")


def test_reports_agree_on_fact_and_states(layers):
    register, readings, dimension = layers
    fact, states = gold.fact(*layers), gold.asset_states(register, readings)
    for report in (reports.rate_by_region, reports.rate_two_criteria, reports.misplaced_flow):
        assert rows(report(states, dimension)) == rows(report(fact, dimension))


def test_reports_sum_the_fact_before_the_join(layers, plan):
    fact, dimension = gold.fact(*layers), layers[2]
    text = plan(reports.rate_by_region(fact, dimension))
    join = text.index("area_carga_id")
    assert "partial_sum" in text[join:]


def test_raw_samples(spark):
    bronze = spark.createDataFrame([("00123", "a"), ("1.2", "b"), ("123", "c"), (None, "d")], "n string, x string")
    assert rows(reports.raw_defects(bronze, ["n", "x"], "n")) == [("00123", "a"), ("1.2", "b")]
    assert reports.raw_defects(bronze, ["n", "x"], "n", top=1).count() == 1
    assert reports.raw_defects(bronze, ["n", "x"], "n", top=None).count() == 2
    assert rows(reports.count_by_value(bronze.select("n"), "n", "c"))[0] == (None, 1)


def test_silver_removes_spelling_only_repeats(spark):
    columns = "exercicio, numero_patrimonio, descricao_bem, codigo_area_carga, valor_atual, situacao_bem".split(", ")
    bronze = spark.createDataFrame(
        [
            ("2026", "00123456", "Mesa ", "1101", "1.234,56", "ATIVO"),
            (" 2026", "123.456", "Mesa", " 1101", "1234.56", "Ativo "),
            ("2026", "123457", "Mesa", "x", "abc", "ativo"),
        ],
        columns,
    )
    assert rows(silver.stg_register(bronze)) == [
        (2026, 123456, "Mesa", 1101, Decimal("1234.56"), "ATIVO"),
        (2026, 123457, "Mesa", None, None, "ATIVO"),
    ]


def test_readings_drop_resends_and_logins(spark):
    columns = (
        "id_leitura exercicio numero_patrimonio origem_leitura coletor coletado_em "
        "local_codigo_area local_espaco_fisico _arquivo_origem"
    ).split()
    bronze = spark.createDataFrame(
        [
            ("r1", "2026", "1", "Scanner ", "fulano", "2026-08-05T10:00:00", "10", " s1", "lote_2"),
            (" r1 ", "2026", "1", "scanner", "fulano", "2026-08-05T10:00:00", "10", "s1 ", "lote_1"),
            ("r2", "2026", "2", None, "fulano", "05/08/2026 10:00", "x", "s", "lote_1"),
            ("r3", "2026", "3", "drone", "fulano", "ontem", "10", "s", "lote_1"),
        ],
        columns,
    )
    got = silver.stg_readings(bronze, reading_origins(spark))
    assert "coletor" not in got.columns
    assert rows(got, "id_leitura", "codigo_area", "origem_recebida", "origem_leitura", "tipo_captura", "lote") == [
        ("r1", 10, "scanner", "celular", "Leitura automática", "lote_1"),
        ("r2", None, "nao_informada", "nao_informada", "Não informado", "lote_1"),
        ("r3", 10, "drone", None, None, "lote_1"),
    ]
    assert got.filter("coletado_em is null").count() == 1


def test_late_typing_changes_nothing(spark):
    """Repeats cut as received and then typed are the same as all rows typed and then cut."""
    columns = ["id_leitura", "exercicio", "numero_patrimonio", "origem_leitura", "coletado_em", "local_codigo_area", "local_espaco_fisico", "_arquivo_origem"]
    spelled = [" a", "a", "a ", "\u00a0a", "b", "", None, " ", "c"]
    data = [
        (spelled[i % 9], "2026", f"{i % 4:03d}", ["Scanner", None, " manual "][i % 3], ["2026-08-05T10:00:00", "05/08/2026 10:00", "x", None][i % 4], f"{i % 5}", f" Sala {i % 2}", [None, "l2", "l1"][i % 7 % 3])
        for i in range(400)
    ]
    bronze = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))
    ties = ["coletado_em", "espaco_fisico", "codigo_area", "numero_patrimonio", "origem_recebida"]
    early = silver.keep_first(silver.type_readings(bronze), ["id_leitura"], "lote", ties)
    assert rows(silver.first_arrivals(bronze)) == rows(early) and early.count() == 5


def test_one_mark_splits_the_readings(layers):
    register, readings, _ = layers[0], layers[1], layers[2]
    marked = silver.tagged(readings, register)
    rejected = silver.quarantine(readings, register)
    assert rows(marked.filter("not ativo").select("id_leitura")) == rows(rejected.select("id_leitura"))
    assert rows(silver.not_quarantined(readings, register)) == rows(silver.unmatched(readings, rejected, ["id_leitura"]))


def test_checks_of_a_table_share_one_scan(spark, layers, plan, tmp_path):
    register, readings, dimension = layers
    tables = {}
    for name, df in {"register": register, "readings": readings, "areas": dimension}.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    checks = [
        Check("not_null", "register", ("numero_patrimonio",)),
        Check("unique", "register", ("numero_patrimonio",)),
        Check("unique_key", "register", ("exercicio", "numero_patrimonio")),
        Check("accepted_values", "register", ("situacao_bem",), values=("ATIVO",)),
        Check("relationships", "register", ("codigo_area_carga",), parent="areas", parent_column="area_id", severity="warn"),
        Check("unique", "readings", ("id_leitura",)),
        Check("unique", "areas", ("area_id",)),
    ]
    report = quality.run_checks(checks, tables)
    text = plan(report)
    assert text.count("FileScan parquet") == 3 and "Join" not in text
    alone = [(c.kind, c.table, quality.violations(c, tables).first()[0]) for c in checks]
    together = [(r["verificacao"], r["tabela"], r["violacoes"]) for r in report.collect()]
    # accepted values count rows per value by themselves; here every value once
    assert sorted(together) == sorted(alone)
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert {r["violacoes"] for r in quality.run_checks(checks, empty).collect()} == {0}


def test_conservation_makes_readings_and_register_once(spark, plan):
    text = plan(QUERIES["dq_no_row_lost"](spark, SMOKE_DIR))
    assert "lineitem.parquet" not in text and "orders.parquet" not in text and "conservation" in text
