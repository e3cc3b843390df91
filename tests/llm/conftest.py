from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (id, text) rows, with extra columns whose names operators use inside."""

    def make(rows, id_col="doc_id", text_col="text"):
        df = spark.createDataFrame(list(rows), f"`{id_col}` long, `{text_col}` string")
        clashing = ["gid", "key", "bytes", "bucket", "fp", "k", "line", "n", "band", "node", "root", "quality", "pii", "x", "toxic", "digest"]
        return df.select("*", *(F.lit("other").alias(c) for c in clashing if c not in df.columns))

    return make


WORDS = "the of and in to river stone window paper light green under over never always garden letter market yellow silent".split()


@pytest.fixture(scope="session")
def prose():
    """Repeatable prose: n words from a seed."""
    import random

    def make(seed, n):
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) + r.choice(["", "s", "ed", "ing", "ly"]) for _ in range(n))

    return make
