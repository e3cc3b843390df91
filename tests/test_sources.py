"""Text scans of files written by the test."""

from __future__ import annotations

import hashlib
import io
import json
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from stocktake.sources import delimited, files, json_envelope, seed, sheet, tables

REGISTER = (
    "exercicio;numero_patrimonio;descricao_bem;valor_atual\r\n"
    "2026;00123456;Cadeira giratória;1.234,56\r\n"
    '2026;123.457;"Mesa; de ""reunião""";310,00\r\n'
    "2026;;;\r\n"
)


def write(path, text, encoding="latin-1"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_delimited_keeps_text_as_received(spark, tmp_path):
    path = write(tmp_path / "carga.csv", REGISTER)
    df = delimited.read_delimited(spark, [path])
    expected = pd.read_csv(path, sep=";", dtype=str, encoding="latin-1", keep_default_na=False)
    assert rows(df.drop("_arquivo_origem", "_path")) == sorted(map(tuple, expected.values.tolist()))
    assert {t for c, t in df.dtypes} == {"string"}
    assert {r["_arquivo_origem"] for r in df.collect()} == {"carga.csv"}


def test_line_break_inside_a_value(spark, tmp_path):
    path = write(tmp_path / "carga.csv", 'a;b\r\n1;"x\ny"\r\n2;z\r\n')
    df = delimited.read_delimited(spark, [path], line_breaks_in_values=True)
    assert rows(df, "a", "b") == [("1", "x\ny"), ("2", "z")]
    # a source that doesn't announce line breaks must not have them
    with pytest.raises(Exception, match="open quote"):
        delimited.read_delimited(spark, [path]).collect()


def test_short_rows_are_filled_and_long_ones_refused(spark, tmp_path):
    path = write(tmp_path / "short.csv", "a;b;c\r\n1\r\n2;x;\r\n3;y;z\r\n")
    assert rows(delimited.read_delimited(spark, [path]), "a", "b", "c") == [("1", "", ""), ("2", "x", ""), ("3", "y", "z")]
    path = write(tmp_path / "long.csv", 'a;b\r\n1;2\r\n"3;3";4;5\r\n')
    with pytest.raises(Exception, match="more values than columns"):
        delimited.read_delimited(spark, [path]).collect()
    # ... also when only some columns are asked for
    with pytest.raises(Exception, match="more values than columns"):
        delimited.read_delimited(spark, [path]).select("a").collect()


def test_files_with_other_headers_are_refused(spark, tmp_path):
    paths = [write(tmp_path / "1.csv", "a;b\r\n1;2\r\n"), write(tmp_path / "2.csv", "b;a\r\n1;2\r\n")]
    with pytest.raises(Exception, match="CSV header does not conform"):
        delimited.read_delimited(spark, paths).collect()


def test_large_file_scans_in_splits(spark, tmp_path):
    lines = "".join(f"{i};valor {i}\r\n" for i in range(50_000))
    path = write(tmp_path / "big.csv", "id;v\r\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = delimited.read_delimited(spark, [path])
        assert df.rdd.getNumPartitions() > 4
        assert df.count() == 50_000 and df.select("id").distinct().count() == 50_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def envelope(readings, **more):
    return json.dumps({"sistema": "coleta", "exercicio": 2026, "gerado_em": "x", **more, "leituras": readings})


READINGS = [
    {
        "id_leitura": "a1", "exercicio": 2026, "numero_patrimonio": "00123456",
        "local": {"codigo_area": 1101, "espaco_fisico": "Sala 1"}, "origem_leitura": None, "ok": True,
    },
    {
        "id_leitura": "a2", "exercicio": 2026, "numero_patrimonio": " 5 ",
        "local": {"codigo_area": "1102", "espaco_fisico": None}, "origem_leitura": "celular", "ok": False, "lista": [1, 2],
    },
]


def test_envelope_becomes_flat_text_rows(spark, tmp_path):
    path = write(tmp_path / "lote.json", json.dumps(json.loads(envelope(READINGS)), indent=2), "utf-8")
    df = json_envelope.read_envelopes(spark, [path], "leituras")
    assert {t for c, t in df.dtypes} == {"string"}
    assert set(df.columns) == {
        "id_leitura", "exercicio", "numero_patrimonio", "local_codigo_area", "local_espaco_fisico", "origem_leitura",
        "ok", "lista", "_arquivo_origem", "_path",
    }
    got = rows(df, "id_leitura", "exercicio", "local_codigo_area", "local_espaco_fisico", "origem_leitura", "ok")
    assert got == [("a1", "2026", "1101", "Sala 1", None, "True"), ("a2", "2026", "1102", None, "celular", "False")]


def test_one_envelope_per_line(spark, tmp_path):
    path = write(tmp_path / "lotes.json", envelope(READINGS) + "\n" + envelope(READINGS[:1]) + "\n", "utf-8")
    df = json_envelope.read_envelopes(spark, [path], "leituras", one_per_line=True)
    assert sorted(r["id_leitura"] for r in df.collect()) == ["a1", "a1", "a2"]


def test_broken_documents_are_refused(spark, tmp_path):
    good = write(tmp_path / "good.json", envelope(READINGS), "utf-8")
    broken = write(tmp_path / "broken.json", envelope(READINGS)[:-9], "utf-8")
    with pytest.raises(Exception):
        json_envelope.read_envelopes(spark, [good, broken], "leituras").collect()
    other = write(tmp_path / "other.json", '{"sistema": "x"}', "utf-8")
    with pytest.raises(Exception, match="no list of leituras"):
        json_envelope.read_envelopes(spark, [good, other], "leituras").collect()


def test_given_schema_needs_no_inference(spark, tmp_path):
    path = write(tmp_path / "lote.json", envelope(READINGS), "utf-8")
    schema = spark.createDataFrame([], "leituras array<struct<id_leitura:string,local:struct<codigo_area:int>>>").schema
    df = json_envelope.read_envelopes(spark, [path], "leituras", schema=schema)
    assert rows(df, "id_leitura", "local_codigo_area") == [("a1", "1101"), ("a2", "1102")]


MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def book(sheet_rows, shared=(), styles=""):
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets><sheet name="A" sheetId="1" '
        'r:id="rId7"/><sheet name="B" sheetId="2" r:id="rId8"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": "<Relationships>"
        '<Relationship Id="rId8" Target="worksheets/sheet2.xml"/>'
        '<Relationship Id="rId7" Target="/xl/worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{MAIN}"><sheetData>{sheet_rows}</sheetData></worksheet>',
        "xl/worksheets/sheet2.xml": f'<worksheet xmlns="{MAIN}"><sheetData/></worksheet>',
        "xl/styles.xml": f'<styleSheet xmlns="{MAIN}">{styles}</styleSheet>',
    }
    if shared:
        items = "".join(f"<si>{s}</si>" for s in shared)
        parts["xl/sharedStrings.xml"] = f'<sst xmlns="{MAIN}">{items}</sst>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as out:
        for name, text in parts.items():
            out.writestr(name, text)
    return buffer.getvalue()


STYLES = (
    '<numFmts><numFmt numFmtId="170" formatCode="dd/mm/yyyy;@"/><numFmt numFmtId="171" formatCode="[Red]0.00&quot;d&quot;"/>'
    '</numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
)
SHARED = ["<t>codigo</t>", "<t>nome</t>", "<t>quando</t>", "<r><t>Vara </t></r><r><t>Única</t></r><rPh><t>x</t></rPh>"]
SHEET = (
    '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c></row>'
    '<row r="2"><c r="A2"><v>1101</v></c><c r="B2" t="s"><v>3</v></c><c r="C2" s="1"><v>46063</v></c></row>'
    '<row r="3"><c r="A3" t="str"><v> 1102 </v></c><c r="C3" t="inlineStr"><is><t>03/03/2026</t></is></c></row>'
    '<row r="4"><c r="A4"/></row>'
    '<row r="5"><c r="A5" s="3"><v>12.5</v></c><c r="B5" t="b"><v>1</v></c><c r="C5" s="2"><v>46063.75</v></c></row>'
    '<row r="6"><c r="A6" t="e"><v>#N/A</v></c></row>'
)


def test_sheet_cells_as_text(spark, tmp_path):
    (tmp_path / "areas.xlsx").write_bytes(book(SHEET, SHARED, STYLES))
    df = sheet.read_sheets(spark, str(tmp_path))
    assert rows(df, "_linha", "codigo", "nome", "quando") == [
        (0, "1101", "Vara Única", "2026-02-10 00:00:00"),
        (1, " 1102 ", None, "03/03/2026"),
        (2, None, None, None),
        (3, "12.5", "True", "2026-02-10 18:00:00"),
    ]
    assert {r["_arquivo_origem"] for r in df.collect()} == {"areas.xlsx"}


def test_many_workbooks_with_different_columns(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(book(SHEET, SHARED, STYLES))
    other = '<row><c t="inlineStr"><is><t>outra</t></is></c></row><row><c><v>1</v></c></row>'
    (tmp_path / "b.xlsx").write_bytes(book(other))
    df = sheet.read_sheets(spark, str(tmp_path))
    assert sorted(c for c in df.columns if not c.startswith("_")) == ["codigo", "nome", "outra", "quando"]
    assert df.filter("outra = '1'").count() == 1 and df.count() == 5


def test_file_listing_and_fingerprint(spark, tmp_path):
    for name, text in {"b.csv": "x", "a b.csv": "y", "skip.txt": "z"}.items():
        write(tmp_path / name, text)
    listing = files.list_files(spark, str(tmp_path), "*.csv")
    assert rows(listing, "arquivo_origem", "tamanho", "hash_arquivo") == [
        ("a b.csv", 1, hashlib.sha256(b"y").hexdigest()),
        ("b.csv", 1, hashlib.sha256(b"x").hexdigest()),
    ]
    paths = [files.literal(p) for p in files.local_names([r["path"] for r in listing.collect()])]
    assert spark.read.text(paths).count() == 2


def test_fingerprint_is_of_the_bytes(spark, tmp_path):
    contents = [b"h;v\r\n1;a\r\n2;b\r\n", b"2;b\nh;v\n1;a\n", b"h;v\n1;a\n2;b\n", bytes(range(256)) * 20_000]
    for i, content in enumerate(contents):
        (tmp_path / f"{i}.csv").write_bytes(content)
    found = dict(rows(files.list_files(spark, str(tmp_path), "*.csv"), "arquivo_origem", "hash_arquivo"))
    assert found == {f"{i}.csv": hashlib.sha256(c).hexdigest() for i, c in enumerate(contents)}


@pytest.mark.parametrize(
    "cells",
    [
        '<row><c r="B1" t="inlineStr"><is><t>b</t></is></c></row><row><c r="A2"><v>1</v></c></row>',
        '<row><c t="inlineStr"><is><t>b</t></is></c><c t="inlineStr"><is><t>b</t></is></c></row>',
    ],
    ids=["no header", "repeated header"],
)
def test_sheet_cells_are_not_dropped(spark, tmp_path, cells):
    (tmp_path / "a.xlsx").write_bytes(book(cells))
    with pytest.raises(Exception, match="header"):
        sheet.read_sheets(spark, str(tmp_path)).collect()


def test_seed_from_literals_and_from_file(spark, tmp_path):
    literal = seed.text_seed(spark, [("a'b", "c\\d"), ("1", "2")], ["x", "y"])
    assert rows(literal) == [("1", "2"), ("a'b", "c\\d")]
    path = write(tmp_path / "seed.csv", "x,y\n01,2\n", "utf-8")
    assert rows(seed.read_seed(spark, path, ["x", "y"])) == [("01", "2")]
    assert seed.reading_origins(spark).count() == 8


@pytest.mark.parametrize("partition_by", [[], ["ano"]])
def test_layer_round_trip_keeps_types(spark, tmp_path, partition_by):
    df = spark.createDataFrame([(2025, "01", 1), (2026, "02", 2), (2026, None, 3)], "ano int, texto string, n int")
    back = tables.write_table(df, str(tmp_path / "t"), partition_by)
    assert back.dtypes == df.dtypes and rows(back) == rows(df)
    again = tables.write_table(df.limit(1), str(tmp_path / "t"), partition_by)
    assert again.count() == 1


def test_text_partition_value_stays_text(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", 1)], "lote string, n int")
    assert tables.write_table(df, str(tmp_path / "t"), ["lote"]).dtypes == df.dtypes


def test_partitioned_read_is_pruned(spark, tmp_path, plan):
    df = spark.createDataFrame([(2025, 1), (2026, 2)], "ano int, n int")
    back = tables.write_table(df, str(tmp_path / "t"), ["ano"])
    assert "PartitionFilters: [isnotnull(ano" in plan(back.filter("ano = 2026"))


def test_hot_partition_value_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50000")
    try:
        n = F.col("id")
        df = spark.range(0, 60_000, 1, 8).select(
            F.when(n % 10 < 8, 2026).otherwise(2025).alias("ano"), F.sha2(n.cast("string"), 256).alias("x")
        )
        tables.write_table(df, str(tmp_path / "t"), ["ano"])
        hot = list((tmp_path / "t" / "ano=2026").glob("*.parquet"))
        assert len(hot) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_known_fields_are_columns_even_of_empty_lists(spark, tmp_path):
    record = T.StructType.fromDDL("id string, local struct<area: string, room: string>")
    empty = write(tmp_path / "empty.json", envelope([]), "utf-8")
    read = lambda *paths: json_envelope.read_envelopes(spark, list(paths), "leituras", record=record)
    assert read(empty).columns == ["id", "local_area", "local_room", "_arquivo_origem", "_path"] and read(empty).count() == 0
    more = write(tmp_path / "more.json", envelope([{"id": 1, "extra": True, "local": {"area": 7, "floor": 2}}, {"id": 2, "local": None}]), "utf-8")
    rows = read(empty, more).select("id", "local_area", "local_room", "local_floor", "extra").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "7", None, "2", "True"), ("2", None, None, None, None)]
    other = write(tmp_path / "other.json", envelope([{"id": 1, "local": "no struct"}]), "utf-8")
    with pytest.raises(Exception, match="other.json|MALFORMED|FAILFAST"):
        read(other).collect()


def test_whole_numbers_are_read_as_such_and_shown_as_text(spark, tmp_path, plan):
    record = T.StructType.fromDDL("n string, local struct<area: string>")
    exact = write(tmp_path / "exact.json", envelope([{"n": 7, "local": {"area": -12}}, {"n": 2**62, "local": None}]), "utf-8")
    df = json_envelope.read_envelopes(spark, [exact], "leituras", record=record).select("n", "local_area")
    assert "n:bigint" in plan(df) and "area:bigint" in plan(df)
    assert {t for _, t in df.dtypes} == {"string"}
    assert [tuple(r) for r in df.collect()] == [("7", "-12"), (str(2**62), None)]
    mixed = write(tmp_path / "mixed.json", '{"leituras": [{"n": 1.50, "local": {"area": 3, "x": [{"y": 1}]}}, {"n": 4, "local": {"area": "03"}}, {"n": 99999999999999999999}]}', "utf-8")
    got = json_envelope.read_envelopes(spark, [exact, mixed], "leituras", record=record).select("n", "local_area", "local_x")
    assert sorted(map(tuple, got.collect()), key=str) == [("1.50", "3", '[{"y":"1"}]'), ("4", "03", None), (str(2**62), None, None), ("7", "-12", None), ("9" * 20, None, None)]


def test_inference_takes_names_as_they_are_and_runs_no_python(spark, tmp_path, plan):
    for name in ("lote_[1].json", "lote {a,b}.json", "lote*.json"):
        write(tmp_path / name, envelope([{"id": name, "n": 1.5}]), "utf-8")
    df = json_envelope.read_envelopes(spark, [files.literal(str(p)) for p in tmp_path.iterdir()], "leituras")
    assert {tuple(r) for r in df.select("id", "n").collect()} == {(n, "1.5") for n in ("lote_[1].json", "lote {a,b}.json", "lote*.json")}
    assert "Python" not in plan(df) and "ExistingRDD" not in plan(df)
