"""Documents of any size are written and read by tasks that hold a few records of them."""

from __future__ import annotations

import io
import json
import random

import pytest
from pyspark.sql import functions as F

from catalog import drops
from stocktake.plans import ingest
from stocktake.sources import files, json_envelope, pieces

RECORDS = [
    '{"id": "a,]}\\"\'", "n": 1.50, "l": [1,\n 2], "local": {"x": [{"y": 1e2}]}}',
    "{}",
    '{"id":\n"é\\\\", "n": -7, "b": true}',
    '{"id": null, "n": 12345678901234567890, "b": false, "local": {"x": []}}',
]


def _document(n, seed):
    r = random.Random(seed)
    listed = ",\n ".join(r.choice(RECORDS) for _ in range(n))
    return '{"other": {"leituras": [7]}, "s": "\\"leituras\\":[", "leituras" : [ ' + listed + ' ], "year": 2024, "last": [[1], {"leituras": 3}]}'


def _cut(text, monkeypatch, piece, chunk):
    monkeypatch.setattr(pieces, "PIECE_BYTES", piece)
    monkeypatch.setattr(pieces, "CHUNK_BYTES", chunk)
    return [x.decode() for x in pieces.cut(io.BytesIO(text.encode()), "leituras")]


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_pieces_hold_all_elements(monkeypatch, chunk):
    for text in (_document(40, 1), _document(1, 2), '{"leituras":[]}', '{"leituras":[1,"a,b]",[2,3],null]}'):
        *cut, around = _cut(text, monkeypatch, 60, chunk)
        whole = json.loads(text)
        assert [x for p in cut for x in json.loads(p)["leituras"]] == whole["leituras"]
        assert json.loads(around) == {**whole, "leituras": []}
        assert len(cut) > 10 or len(whole["leituras"]) < 5


def test_pieces_of_what_cannot_be_cut(monkeypatch):
    for text in ("", "[]", '[{"leituras":[1]}]', '{"a":[1]}', '{"leituras":null}', '{"leituras":{"a":[1]}}', "x" * 50):
        assert _cut(text, monkeypatch, 60, 8) == []
    for text in ('{"leituras":[1,2', '{"leituras":[{"a":"', '{"leituras":[1,2}', '{"leituras":[11,22,]}', '{"leituras":[1],"leituras":[2]}'):
        with pytest.raises(ValueError):
            _cut(text, monkeypatch, 2, 8)


def test_large_documents_read_as_whole_ones(spark, tmp_path, monkeypatch):
    """Same rows, number texts, names and paths; no scan gets a document above the limit."""
    for i, name in enumerate(["a [1]", "b+%20", "c"]):
        (tmp_path / f"{name}.json").write_text(_document((30, 200, 2)[i], i))
    (tmp_path / "d.json").write_text('{"leituras":[]}')
    paths = [files.literal(str(p)) for p in sorted(tmp_path.iterdir())]
    read = lambda: json_envelope.read_envelopes(spark, paths, "leituras")
    whole = read()
    monkeypatch.setattr(pieces, "PIECE_BYTES", 300)
    monkeypatch.setattr(json_envelope, "WHOLE_BYTES", 1000)
    cut = read()
    assert cut.dtypes == whole.dtypes and "n" in cut.columns and whole.count() == 232
    assert cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty()
    sizes = spark.read.format("binaryFile").load([files.literal(p) for p in files.local_names(cut.inputFiles())])
    assert sizes.agg(F.max("length")).first()[0] <= 1000
    (tmp_path / "e.json").write_text('{"x": "' + "y" * 2000 + '"}')
    paths.append(str(tmp_path / "e.json"))
    with pytest.raises(Exception, match="no list of leituras"):
        read().collect()


def test_large_batches_are_ingested_once(spark, tmp_path, monkeypatch):
    (tmp_path / "raw" / "leituras").mkdir(parents=True)
    for i in range(2):
        records = ",".join(f'{{"id_leitura":"{i}-{k}","exercicio":2024}}' for k in range(90))
        (tmp_path / "raw" / "leituras" / f"lote {i}.json").write_text(f'{{"leituras":[{records}]}}')
    monkeypatch.setattr(json_envelope, "WHOLE_BYTES", 500)
    bronze = str(tmp_path / "bronze")
    listing = files.list_files(spark, str(tmp_path / "raw" / "leituras"), "*.json")
    assert [ingest.land(spark, ingest.READINGS, listing, bronze) for _ in range(2)] == [2, 0]
    table = ingest.VersionedTable(spark, f"{bronze}/leituras_coleta")
    assert sorted((x.arquivo_origem, x.num_linhas) for x in table.history().collect()) == [("lote 0.json", 90), ("lote 1.json", 90)]
    assert table.snapshot().select("id_leitura").distinct().count() == 180


def test_files_are_written_part_by_part(spark, tmp_path):
    rows = [(f"f {k % 3}.txt", f"<{k % 3}:", k, f"é{k}") for k in range(500)]
    parts = spark.createDataFrame(rows, "name string, head string, k int, part string").repartition(7)
    drops.write_parts(parts, f"file://{tmp_path}/drop", ["k"], ",", ">\n")
    for f in range(3):
        expected = f"<{f}:" + ",".join(f"é{k}" for k in range(500) if k % 3 == f) + ">\n"
        assert (tmp_path / "drop" / f"f {f}.txt").read_text() == expected
