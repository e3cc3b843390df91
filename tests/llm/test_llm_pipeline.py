"""The stages of the pipeline, each held against what its operator says about its own input, and the registered queries."""

from __future__ import annotations

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from stocktake.llm import queries
from test_llm_dedup import _fingerprint, _roots
from test_llm_others import _similar_windows

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def _sentences(prose, seed, n):
    return "\n".join(prose(seed * 50 + k, 25).capitalize() + "." for k in range(n))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory, prose):
    """Input rows and the rows after each stage, over documents made here."""
    folder = tmp_path_factory.mktemp("pipeline")
    item = prose(4000, 40)
    texts = [_sentences(prose, i, 4) for i in range(6)]
    long = prose(4100, 600).split()
    near = [" ".join(long), " ".join([*long[:300], "changed", *long[301:]])]
    texts += [texts[0], texts[1] + "\n" + _sentences(prose, 9, 3), _sentences(prose, 10, 2) + " " + item + "\n" + _sentences(prose, 11, 2)]
    texts += [*near, "too short", None, "", "thor " * 90, _sentences(prose, 12, 4) + "\nHome | News | About | Contact | Login |"]
    rows = [(i, t, None if i % 5 == 0 else "en", "src", len(t or "")) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "en", "src", 1), (None, _sentences(prose, 13, 4), "en", None, None), (None, _sentences(prose, 14, 4), "en", None, None)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(folder))
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found[name] = docs.collect()
    return found, item


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "decontamination", "bpe_codec"]


def test_columns_stay_those_of_documents(stages):
    found, _ = stages
    for name in ("quality_rules", "line_dedup", "simhash_near_dedup", "decontamination"):
        assert all(tuple(r.asDict()) == ("doc_id", "text", "lang", "source", "n_chars") and r.n_chars == len(r.text) for r in found[name]), name


def test_rejected_documents_go(stages):
    found, _ = stages
    ids = [r.doc_id for r in found["quality_rules"]]
    assert sorted(i for i in ids if i is not None) == sorted([*range(11), 3, 15]) and ids.count(None) == 2
    assert not any("Home" in r.text for r in found["quality_rules"])


def test_one_line_of_equal_ones_stays(stages):
    found, _ = stages
    lines = [x for r in found["line_dedup"] for x in r.text.split("\n") if r.doc_id != 3]
    assert len(set(lines)) == len(lines)
    assert {x for r in found["quality_rules"] for x in r.text.split("\n")} >= set(lines)
    assert 6 not in {r.doc_id for r in found["line_dedup"]}


def test_one_document_of_a_group_stays(stages):
    found, _ = stages
    before, after = found["line_dedup"], found["simhash_near_dedup"]
    prints = [_fingerprint(r.text) for r in before]
    nodes = range(len(before))
    roots = _roots(nodes, [(a, b) for a in nodes for b in nodes if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    assert len(after) == len(set(roots.values()))
    kept = sorted(str(r.doc_id) for r in after)
    least = {}
    for n, root in roots.items():
        i = before[n].doc_id
        least[root] = min(least.get(root, (True, 0)), (i is None, i or 0))
    assert kept == sorted("None" if none else str(i) for none, i in least.values())


def test_documents_with_an_item_go(stages):
    found, item = stages
    before, after = found["simhash_near_dedup"], found["decontamination"]
    hit = {d for d, _ in _similar_windows(list(enumerate(r.text for r in before)), [(0, item)])}
    assert sorted(r.text for r in after) == sorted(r.text for n, r in enumerate(before) if n not in hit) and hit


def test_what_is_left_is_encoded(stages):
    found, _ = stages
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    expected = sorted((str(r.doc_id), len(library.encode(r.text, add_special_tokens=False).ids)) for r in found["decontamination"])
    assert sorted((str(r.doc_id), r.n_tokens) for r in found["bpe_codec"]) == expected


def test_queries_are_registered_and_run(spark):
    names = set(entry_points.queries())
    assert {re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES} == {str(n) for n in range(1, 14)}
    assert {*queries.QUERIES, "pipeline"} <= names
    for name in ("op3_decontamination", "op5_quality_rules", "op7_pii_pseudonyms"):
        assert "doc_id" in entry_points.queries()[name](spark, entry_points.SMOKE_DIR).columns


def test_empty_documents(spark, tmp_path):
    for name, schema in (("documents", DOCUMENTS), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
