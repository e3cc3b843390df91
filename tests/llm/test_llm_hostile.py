"""Texts and column names made to break an operator."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from stocktake.llm.line_dedup import deduped, without_lines
from stocktake.llm.pii import pseudonymised
from stocktake.llm.quality_rules import judged
from stocktake.llm.substring_dedup import dedup_substrings

HELPERS = ["_quality", "_all", "_row", "_removed", "__row", "quality", "pii", "others", "row", "removed", "k", "band", "doc", "line", "n", "x"]


@pytest.fixture(scope="module")
def named_like_helpers(spark, prose):
    texts = ["\n".join(prose(i * 10 + j, 40).capitalize() + "." for j in range(3)) for i in range(6)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(6, texts[0]), (7, texts[1] + "\n" + texts[2].split("\n")[0]), (None, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *(F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(c) for c in HELPERS))


def _kept(df, columns):
    return sorted(tuple(r[c] for c in ["doc_id", *columns]) for r in df.where("doc_id is not null").collect())


def test_columns_named_like_helpers_come_through(named_like_helpers):
    df = named_like_helpers
    same = [c for c in HELPERS if c not in ("quality",)]
    assert _kept(judged(df), same) == _kept(df, same)
    same = [c for c in HELPERS if c not in ("pii",)]
    assert _kept(pseudonymised(df, "k"), same) == _kept(df, same)
    assert _kept(without_lines(df), HELPERS) == _kept(df, HELPERS)
    assert deduped(df).count() == df.count()


def test_stages_keep_columns_named_like_helpers(spark, named_like_helpers, tmp_path):
    spark.createDataFrame([(1, "quite another text of no document")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    df = named_like_helpers
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, df, str(tmp_path)).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == df.columns, name
        assert set(_kept(after, HELPERS)) <= set(_kept(named_like_helpers, HELPERS)), name
        df = after
    assert df.count() >= 5


def test_mail_with_very_many_labels(spark, docs_of):
    text = "see a.Name@" + "b." * 300_000 + "c, or x@y..z, or x@y.z."
    (row,) = pseudonymised(docs_of([(1, text)]), "k").collect()
    assert [e.kind for e in row.pii] == ["email", "email"] and len(row.text) == len(text)
    assert row.pii[0].value == text.split(",")[0][4:] and row.pii[1].value == "x@y.z" and "x@y..z" in row.text


def test_very_long_secret_and_name(docs_of):
    secret, name = "Ab3/" * 4_000, "n" * 20_000
    (row,) = pseudonymised(docs_of([(1, f"token={secret} and {name}@host.org")]), "k").collect()
    assert [(e.kind, len(e.pseudonym)) for e in row.pii] == [("secret", len(secret) + 6), ("email", len(name) + 9)]
    assert secret not in row.text and name not in row.text


def _thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("size", [1024, 2048])
def test_words_that_weak_hashes_take_for_one(docs_of, size):
    """Two words of opposite Thue-Morse order are equal to any polynomial modulo a power of two."""
    one = _thue_morse(size)
    other = one.translate(str.maketrans("ab", "ba"))
    common = [f"w{i}" for i in range(49)]
    first, second = " ".join([one, *common]), " ".join([other, *common])
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in dedup_substrings(docs_of([(1, first), (2, second), (3, second)])).collect()}
    assert got == {
        1: (50, 0, hashlib.sha256(first.encode()).hexdigest()),
        2: (50, 0, hashlib.sha256(second.encode()).hexdigest()),
        3: (50, 50, hashlib.sha256(b"").hexdigest()),
    }
