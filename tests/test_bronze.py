"""Versioned tables and idempotent ingestion, on files written by the test."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from catalog import drops
from helpers import rows
from stocktake.__main__ import main
from stocktake.plans.bronze import APPEND, OVERWRITE, VersionedTable, all_text, batch_summary, compare_versions
from stocktake.plans.build import build_layers, check_layers, current_bronze
from stocktake.plans.ingest import READINGS, REGISTER, ingest, land, run_bronze, unseen_append, unseen_overwrite
from stocktake.plans.quality import ChecksFailed, require_passed, summary
from stocktake.plans.reports import rate_by_year
from stocktake.sources.files import list_files
from stocktake.streaming.arrivals import start_arrivals
from test_sources import book

HEADER = "exercicio;numero_patrimonio;descricao_bem;codigo_area_carga;valor_atual;situacao_bem\r\n"
ASSETS = [
    "2026;00123456;Cadeira giratória;1101;1.234,56;ATIVO",
    "2026;123.456;Cadeira giratória;1101;1234.56;Ativo",
    "2026;123457;Mesa;1101;310,00;ATIVO",
    "2026;123458;Armário;1205;99.90;ATIVO",
    "2026;123459;Baixado;1101;1,00;BAIXADO",
    "2025;123456;Cadeira giratória;1102;1.300,00;ATIVO",
]


def reading(ident, number, area, moment, year=2026, origin="celular", **more):
    return {
        "id_leitura": ident, "exercicio": year, "numero_patrimonio": number,
        "local": {"codigo_area": area, "espaco_fisico": " Sala 1 "}, "origem_leitura": origin,
        "coletor": "login.x", "coletado_em": moment, **more,
    }


BATCHES = {
    "lote_1.json": [
        reading("r1", "00123456", 1101, "2026-08-05T10:00:00", origin="scanner"),
        reading("r2", " 123457 ", 1101, "05/08/2026 11:00", origin=None),
        reading("r3", "", 1101, "2026-08-05T12:00:00"),
    ],
    "lote_2.json": [
        reading("r2", "123457", 1101, "05/08/2026 11:00", origin=None),
        reading("r4", "123457", 1102, "2026-08-06T09:00:00", origin="mobile_manual"),
        reading("r5", "999999", 1102, "2026-08-06T09:30:00"),
        reading("r6", "123458", 1102, "2026-08-06T09:45:00", versao_app="2.1"),
    ],
}


def write_batch(raw, name, readings):
    path = raw / "leituras" / name
    document = {"sistema": "coleta", "exercicio": 2026, "gerado_em": "2026-08-28", "leituras": readings}
    path.write_text(json.dumps(document, ensure_ascii=False), encoding="utf-8")


def areas_book():
    def text(value):
        return f'<c t="inlineStr"><is><t xml:space="preserve">{value}</t></is></c>' if value else "<c/>"

    header = ["codigo_area", "nome_area", "tipo_area", "comarca", "regiao", "atualizado_em"]
    lines = [
        ["1101", "1ª  Vara", "JUDICIAL", "Comarca de Dourados", "2ª", "03/03/2026"],
        ["1101", "1a Vara", "Judicial", "DOURADOS", "", "2024-11-08 00:00:00"],
        ["1102", "2ª Vara", "judicial ", " rio  BRILHANTE", "", "2026-02-10 00:00:00"],
        ["9001", "Secretaria", "Adm.", "", "", "2026-02-10 00:00:00"],
    ]
    return book("".join(f"<row>{''.join(map(text, line))}</row>" for line in [header, *lines]))


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    (folder / "leituras").mkdir(parents=True)
    (folder / "areas.xlsx").write_bytes(areas_book())
    (folder / "carga_patrimonial.csv").write_bytes((HEADER + "\r\n".join(ASSETS) + "\r\n").encode("latin-1"))
    for name, readings in BATCHES.items():
        write_batch(folder, name, readings)
    return folder


@pytest.fixture
def bronze(tmp_path):
    return str(tmp_path / "bronze")


def ingest_register(spark, raw, bronze):
    return land(spark, REGISTER, list_files(spark, str(raw), REGISTER.glob), bronze)


def ingest_readings(spark, raw, bronze):
    return land(spark, READINGS, list_files(spark, f"{raw}/leituras", READINGS.glob), bronze)


def test_register_keeps_every_row_and_its_text(spark, raw, bronze):
    assert ingest_register(spark, raw, bronze) == 1
    stored = VersionedTable(spark, f"{bronze}/carga_patrimonial").snapshot()
    assert stored.count() == len(ASSETS)
    assert stored.filter(F.col("valor_atual").contains(",")).count() == 4
    assert stored.filter(F.col("numero_patrimonio").contains(".")).count() == 1
    assert stored.filter("descricao_bem = 'Cadeira giratória'").count() == 3


def test_readings_become_columns_with_lineage(spark, raw, bronze):
    assert ingest_readings(spark, raw, bronze) == 2
    table = VersionedTable(spark, f"{bronze}/leituras_coleta")
    stored = table.snapshot()
    wanted = {"id_leitura", "numero_patrimonio", "local_codigo_area", "coletor", "_arquivo_origem", "_ingerido_em"}
    assert wanted <= set(stored.columns)
    assert {t for c, t in stored.dtypes if c != "_versao"} == {"string"}
    assert table.latest_version() == 1
    assert rows(table.history(), "versao", "arquivo_origem", "num_linhas") == [(0, "lote_1.json", 3), (1, "lote_2.json", 4)]
    assert stored.filter(~F.col("_ingerido_em").endswith("+00:00")).count() == 0
    report = rows(table.history_report(), "versao", "operacao", "arquivo_origem")
    assert report == [(0, "WRITE", "lote_1.json"), (1, "WRITE", "lote_2.json")]


def test_second_run_writes_nothing(spark, raw, bronze):
    assert run_bronze(spark, str(raw), bronze) == 4
    assert run_bronze(spark, str(raw), bronze) == 0
    write_batch(raw, "lote_3_copia.json", BATCHES["lote_1.json"])
    assert ingest_readings(spark, raw, bronze) == 0


def test_changed_file_becomes_a_new_version(spark, raw, bronze):
    ingest_register(spark, raw, bronze)
    path = raw / "carga_patrimonial.csv"
    before = path.read_bytes()
    path.write_bytes(before + "2026;999999;Cadeira;1101;310,00;ATIVO\r\n".encode("latin-1"))
    assert ingest_register(spark, raw, bronze) == 1
    table = VersionedTable(spark, f"{bronze}/carga_patrimonial")
    assert table.latest_version() == 1
    assert (table.snapshot().count(), table.snapshot(0).count()) == (len(ASSETS) + 1, len(ASSETS))
    path.write_bytes(before)  # old content again, after a change: new version
    assert ingest_register(spark, raw, bronze) == 1
    assert table.latest_version() == 2 and table.snapshot().count() == len(ASSETS)
    assert ingest_register(spark, raw, bronze) == 0


def test_append_ignores_content_seen_in_any_version(spark, raw, bronze):
    ingest_readings(spark, raw, bronze)
    path = raw / "leituras" / "lote_2.json"
    before = path.read_bytes()
    write_batch(raw, "lote_2.json", [reading("r9", "1", 1101, "2026-08-07T09:00:00")])
    assert ingest_readings(spark, raw, bronze) == 1
    path.write_bytes(before)
    assert ingest_readings(spark, raw, bronze) == 0


def test_columns_merge_on_append_and_are_replaced_on_overwrite(spark, bronze):
    def frame(schema, *values):
        name = F.lit(f"f{values[0][0]}")
        return spark.createDataFrame(list(values), schema).withColumns({"_arquivo_origem": name, "_path": name})

    def listing(df):
        return df.select("_arquivo_origem").distinct().select(
            F.col("_arquivo_origem").alias("arquivo_origem"),
            F.col("_arquivo_origem").alias("path"),
            F.lit(1).alias("tamanho"),
            F.sha2("_arquivo_origem", 256).alias("hash_arquivo"),
        )

    first, second = frame("a int, b int", (1, 2)), frame("a int, c string", (3, "x"))
    appended, replaced = VersionedTable(spark, f"{bronze}/x"), VersionedTable(spark, f"{bronze}/y")
    for df in (first, second):
        ingest(appended, listing(df), lambda _, df=df: df, APPEND)
        ingest(replaced, listing(df), lambda _, df=df: df, OVERWRITE)
    assert rows(appended.snapshot(), "a", "b", "c") == [("1", "2", None), ("3", None, "x")]
    assert "c" not in appended.snapshot(0).columns
    assert rows(replaced.snapshot(), "a", "c") == [("3", "x")] and "b" not in replaced.snapshot().columns
    assert rows(replaced.snapshot(0), "a", "b") == [("1", "2")]


def test_many_files_in_bounded_commits(spark, raw, bronze):
    for i in range(5):
        write_batch(raw, f"m_{i}.json", [reading(f"m{i}", "1", 1, "2026-08-07T09:00:00")])
    table = VersionedTable(spark, f"{bronze}/leituras_coleta")
    listing = list_files(spark, f"{raw}/leituras", "*.json")
    read = lambda files: READINGS.read(spark, [r["path"] for r in files.collect()])
    assert ingest(table, listing, read, APPEND, files_per_commit=3) == 7
    history = table.history()
    assert history.select("execucao").distinct().count() == 3
    names = [r["arquivo_origem"] for r in history.orderBy("versao").collect()]
    assert names == sorted(names) and table.snapshot().count() == 12


def test_unfinished_run_is_invisible(spark, raw, bronze):
    ingest_readings(spark, raw, bronze)
    table = VersionedTable(spark, f"{bronze}/leituras_coleta")
    before = table.snapshot().count()
    table.snapshot().drop("_path").write.parquet(f"{table.path}/data/execucao=dead")
    assert (table.snapshot().count(), table.latest_version()) == (before, 1)


def test_snapshot_prunes_runs_and_versions(spark, raw, bronze, plan):
    ingest_register(spark, raw, bronze)
    (raw / "carga_patrimonial.csv").write_bytes((HEADER + ASSETS[0] + "\r\n").encode("latin-1"))
    ingest_register(spark, raw, bronze)
    table = VersionedTable(spark, f"{bronze}/carga_patrimonial")
    latest = table.snapshot()
    assert len(latest.inputFiles()) < len(table.snapshot(0).inputFiles()) + len(latest.inputFiles())
    assert "PushedFilters: [IsNotNull(_versao), GreaterThanOrEqual(_versao,1)" in plan(latest)


def test_no_table_and_unknown_version(spark, raw, bronze):
    table = VersionedTable(spark, f"{bronze}/nothing")
    assert table.latest_version() is None and table.history().count() == 0
    with pytest.raises(ValueError):
        table.snapshot()
    ingest_readings(spark, raw, bronze)
    with pytest.raises(ValueError):
        VersionedTable(spark, f"{bronze}/leituras_coleta").snapshot(9)


def test_batch_without_readings_is_a_version(spark, raw, bronze):
    ingest_readings(spark, raw, bronze)
    write_batch(raw, "lote_3.json", [])
    assert ingest_readings(spark, raw, bronze) == 1
    table = VersionedTable(spark, f"{bronze}/leituras_coleta")
    assert rows(table.history(), "versao", "num_linhas") == [(0, 3), (1, 4), (2, 0)]
    assert table.snapshot().count() == 7 and "id_leitura" in table.snapshot().columns
    assert ingest_readings(spark, raw, bronze) == 0


def test_ingestion_time_is_utc_in_any_session(spark, raw, bronze):
    from datetime import datetime, timezone

    spark.conf.set("spark.sql.session.timeZone", "America/Campo_Grande")
    try:
        ingest_register(spark, raw, bronze)
        stamp = VersionedTable(spark, f"{bronze}/carga_patrimonial").snapshot().first()["_ingerido_em"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    age = datetime.now(timezone.utc) - datetime.fromisoformat(stamp)
    assert 0 <= age.total_seconds() < 120


def test_compare_previous_and_latest(spark, raw, bronze):
    ingest_readings(spark, raw, bronze)
    table = VersionedTable(spark, f"{bronze}/leituras_coleta")
    compared = compare_versions(table, lambda df: batch_summary(df, ["exercicio"]))
    assert rows(compared, "versao", "exercicio", "leituras", "lotes") == [(0, "2026", 3, 1), (1, "2026", 7, 2)]


def test_unseen_rules(spark):
    listing = spark.createDataFrame(
        [("a", "a", 1, "A"), ("b", "b", 1, "B"), ("c", "c", 1, "B"), ("d", "d", 1, "A"), ("e", "e", 1, "C")],
        "arquivo_origem string, path string, tamanho long, hash_arquivo string",
    )
    history = spark.createDataFrame([(0, "C"), (1, "A")], "versao int, hash_arquivo string")
    assert rows(unseen_append(listing, history), "arquivo_origem") == [("b",)]
    assert rows(unseen_append(listing, history.limit(0)), "arquivo_origem") == [("a",), ("b",), ("e",)]
    assert rows(unseen_overwrite(listing, history), "arquivo_origem") == [("b",), ("d",), ("e",)]
    assert rows(unseen_overwrite(listing, history.limit(0)), "arquivo_origem") == [("a",), ("b",), ("d",), ("e",)]


def test_all_text(spark):
    df = spark.sql("SELECT 1 AS a, true AS b, CAST(1.50 AS decimal(4,2)) AS c, CAST(NULL AS int) AS d")
    assert rows(all_text(df)) == [("1", "true", "1.50", None)]


def test_from_files_to_the_answer(spark, raw, bronze, tmp_path):
    run_bronze(spark, str(raw), bronze)
    tables = build_layers(current_bronze(spark, bronze), str(tmp_path / "layers"))
    assert "coletor" not in tables["stg_leituras"].columns
    assert rows(tables["dim_area"]) == [
        (-1, "Área não cadastrada", "Não informado", "Não informada", "Não informada"),
        (1101, "1ª Vara", "Judicial", "Dourados", "2ª"),
        (1102, "2ª Vara", "Judicial", "Rio Brilhante", "Não informada"),
        (9001, "Secretaria", "Administrativa", "Não se aplica", "Não se aplica"),
    ]
    assert rows(tables["qrt_leituras_rejeitadas"], "id_leitura", "motivo", "lote") == [
        ("r3", "patrimonio_ausente", "lote_1.json"),
        ("r5", "fora_da_carga", "lote_2.json"),
    ]
    fact = tables["fato_bem_inventariado"]
    columns = ["exercicio", "numero_patrimonio", "area_carga_id", "area_leitura_id", "situacao_inventario"]
    assert rows(fact, *columns, "origem_leitura", "quantidade_leituras") == [
        (2025, 123456, 1102, None, "Não localizado", None, 0),
        (2026, 123456, 1101, 1101, "Localizado", "celular", 1),
        (2026, 123457, 1101, 1102, "Localizado em outra área", "manual", 2),
        (2026, 123458, -1, 1102, "Localizado em outra área", "celular", 1),
    ]
    answer = [tuple(str(v) for v in r) for r in rate_by_year(fact).collect()]
    assert answer == [
        ("2025", "1", "0", "0", "1", "0.0", "1300.00"),
        ("2026", "3", "1", "2", "0", "33.3", "0.00"),
    ]
    report = check_layers(tables)
    assert rows(summary(report)) == [("PASS", 40), ("WARN", 1)]
    assert rows(report.filter("situacao = 'WARN'"), "coluna", "violacoes") == [("codigo_area_carga", 1)]
    require_passed(report)
    with pytest.raises(ChecksFailed):
        require_passed(report.withColumn("situacao", F.lit("FAIL")))


def test_files_taken_in_as_they_arrive(spark, raw, bronze):
    def arrive():
        query = start_arrivals(spark, READINGS, str(raw), bronze)
        query.awaitTermination()

    arrive()
    table = VersionedTable(spark, f"{bronze}/leituras_coleta")
    assert (table.latest_version(), table.snapshot().count()) == (1, 7)
    arrive()
    assert table.latest_version() == 1
    write_batch(raw, "lote_3.json", [reading("r7", "123457", 1101, "2026-08-09T09:00:00")])
    write_batch(raw, "lote_4_copia.json", BATCHES["lote_1.json"])
    arrive()
    assert (table.latest_version(), table.snapshot().count()) == (2, 8)


def test_replaced_sources_do_not_stream(spark, raw, bronze):
    with pytest.raises(ValueError, match="replaced in place"):
        start_arrivals(spark, REGISTER, str(raw), bronze)


NAMES = ["lote_[1].json", "lote_1.json", "lote_{a,b}.json", "lote_*.json", "lote_?.json", "lote 100%.json", "lote_a,b.json", "lote_%5B1%5D.json"]


def test_awkward_file_names_land_once_each(spark, tmp_path, bronze):
    raw = tmp_path / "awkward"
    (raw / "leituras").mkdir(parents=True)
    for i, name in enumerate(NAMES):
        write_batch(raw, name, [reading(f"id{i}", "1", 1101, "2026-08-09T09:00:00")])
    assert land(spark, READINGS, list_files(spark, f"{raw}/leituras", READINGS.glob), bronze) == len(NAMES)
    table = VersionedTable(spark, f"{bronze}/leituras_coleta")
    assert rows(table.snapshot(), "_arquivo_origem", "id_leitura") == sorted((n, f"id{i}") for i, n in enumerate(NAMES))
    assert {r["num_linhas"] for r in table.history().collect()} == {1}
    assert land(spark, READINGS, list_files(spark, f"{raw}/leituras", READINGS.glob), bronze) == 0


def test_hidden_and_missing_files_are_errors(spark, raw, bronze, tmp_path):
    with pytest.raises(FileNotFoundError, match="areas.xlsx"):
        (tmp_path / "nothing" / "leituras").mkdir(parents=True)
        run_bronze(spark, str(tmp_path / "nothing"), bronze)
    write_batch(raw, "_lote_9.json", BATCHES["lote_1.json"])
    with pytest.raises(ValueError, match="_lote_9.json"):
        run_bronze(spark, str(raw), bronze)


def test_second_writer_is_noticed(spark, raw, bronze):
    land(spark, READINGS, list_files(spark, f"{raw}/leituras", READINGS.glob), bronze)
    table = VersionedTable(spark, f"{bronze}/leituras_coleta")
    table.history().limit(1).write.mode("append").parquet(f"{table.path}/ledger")
    write_batch(raw, "lote_9.json", [reading("r9", "123457", 1101, "2026-08-09T09:00:00")])
    with pytest.raises(RuntimeError, match="another writer"):
        land(spark, READINGS, list_files(spark, f"{raw}/leituras", READINGS.glob), bronze)


def test_command_line(spark, raw, bronze, tmp_path, capsys):
    layers = str(tmp_path / "layers")
    assert main(["ingest", str(raw), bronze]) == 0
    assert "4 new version(s)" in capsys.readouterr().out
    assert main(["build", bronze, layers]) == 0
    assert "WARN" in capsys.readouterr().out
    assert main(["ask", layers, "rate_by_year"]) == 0
    assert "1300.00" in capsys.readouterr().out
    assert main(["raw", bronze]) == 0
    assert "123.456" in capsys.readouterr().out
    assert main(["history", f"{bronze}/leituras_coleta", "--version", "0"]) == 0
    assert "lote_2.json" in capsys.readouterr().out
    assert main(["history", f"{bronze}/areas"]) == 0
    (raw / "carga_patrimonial.csv").write_bytes((HEADER + "2026;;x;1101;1,00;ATIVO\r\n").encode("latin-1"))
    assert main(["ingest", str(raw), bronze]) == 0
    assert main(["build", bronze, layers]) == 1
    assert "not_null" in capsys.readouterr().err


def test_many_overwrites_are_one_write_and_all_readable(spark, tmp_path, bronze):
    """Registers whose columns change from file to file, taken in together."""
    contents = ["a;b\n1;x\n", "a;c\n2;y\n3;z\n", "b\nw\n", "a;b\n1;x\n"]
    for i, text in enumerate(contents):
        (tmp_path / f"r_{i}.csv").write_bytes(text.encode("latin-1"))
    table = VersionedTable(spark, f"{bronze}/registers")
    listing = list_files(spark, str(tmp_path), "r_*.csv")
    read = lambda files: REGISTER.read(spark, [r["path"] for r in files.collect()])
    assert ingest(table, listing, read, OVERWRITE) == 4
    history = table.history().orderBy("versao").collect()
    assert [(r["versao"], r["num_linhas"]) for r in history] == [(0, 1), (1, 2), (2, 1), (3, 1)]
    assert len({r["execucao"] for r in history}) == 1
    shown = [[c for c in table.snapshot(v).columns if not c.startswith("_")] for v in range(4)]
    assert shown == [["a", "b"], ["a", "c"], ["b"], ["a", "b"]]
    assert rows(table.snapshot(1), "a", "c") == [("2", "y"), ("3", "z")] and rows(table.snapshot(2), "b") == [("w",)]
    assert ingest(table, listing.filter("arquivo_origem = 'r_3.csv'"), read, OVERWRITE) == 0
    assert ingest(table, listing.filter("arquivo_origem = 'r_1.csv'"), read, OVERWRITE) == 1
    assert rows(table.snapshot(), "a", "c") == [("2", "y"), ("3", "z")]


def test_versions_are_compared_in_one_scan(spark, raw, bronze, plan):
    ingest_readings(spark, raw, bronze)
    write_batch(raw, "lote_3.json", [reading("r9", "1", 1, "2026-08-07T09:00:00", year=2025)])
    ingest_readings(spark, raw, bronze)
    table = VersionedTable(spark, f"{bronze}/leituras_coleta")
    compared = compare_versions(table, lambda df: batch_summary(df, ["exercicio"]), version=0)
    text = plan(compared)
    scans = [x.split("\n")[0] for x in text.split("FileScan parquet")[1:]]
    data = [x for x in scans if x.startswith(" [_versao#")]
    assert len(data) == 1 and "dynamicpruning" in data[0].lower(), scans
    assert rows(compared, "versao", "exercicio", "leituras", "lotes") == [(0, "2026", 3, 1), (2, "2025", 1, 1), (2, "2026", 7, 2)]
    by_hand = compare_versions(table, lambda df: df.groupBy("exercicio").agg(F.count("*").alias("leituras")), version=0)
    assert rows(by_hand, "versao", "exercicio", "leituras") == [(0, "2026", 3), (2, "2025", 1), (2, "2026", 7)]


def test_rows_of_one_file_are_written_by_the_tasks_that_read_them(spark, bronze):
    files = spark.createDataFrame([("a.csv", "file:/a.csv", "h", 0)], "arquivo_origem string, path string, hash_arquivo string, _ordem int").checkpoint()
    rows = spark.range(0, 4000, 1, 4).select(F.col("id").alias("n"), F.lit("a.csv").alias("_arquivo_origem"), F.lit("file:/a.csv").alias("_path"))
    table = VersionedTable(spark, bronze)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table.commit(rows, files, OVERWRITE)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    written = [n for _, _, names in os.walk(f"{bronze}/data") for n in names if n.startswith("part-")]
    assert len(written) == 4 and table.snapshot().count() == 4000


def test_lines_of_many_tasks_are_one_file(spark, tmp_path):
    lines = spark.range(0, 3000, 1, 3).select(F.concat(F.lit("é;"), F.col("id").cast("string")))
    drops.write_lines(lines, f"file://{tmp_path}/drop", "many.csv", "a;b", "latin-1")
    header, *rest = (tmp_path / "drop" / "many.csv").read_text(encoding="latin-1").splitlines()
    assert header == "a;b" and sorted(rest) == sorted(f"é;{i}" for i in range(3000))
    drops.write_lines(lines.where("id < 0"), f"file://{tmp_path}/drop", "none.csv", "a;b", "latin-1")
    assert (tmp_path / "drop" / "none.csv").read_text() == "a;b\n"
