"""How far the sources of a language differ in their words, on digests of the words.

The counts of words by source are shuffled as 64-bit digests. Each task tells
the words behind its digests once per language; the smallest and the largest
word of a digest show where several share it, and only these are counted again
by the words themselves. Words are joined back for the rows that are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktake.llm.hashing import text_bytes
from stocktake.session import new_work_path

GROUP = ["lang", "source"]
# Letters and all characters beyond ASCII make a term, A to Z count as lower case; shares are in billionths.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SCALE = 1_000_000_000
#: Text whose terms a task counts at a time.
CHUNK_BYTES = 12 << 20
#: Cells (sources times terms) of one matrix of shares.
CELLS = 100_000
TERM_ROWS = "lang string, source string, digest long, term string, n long, docs long"


def _term_counts(batches: Iterator[pa.RecordBatch], bits: int, named: bool) -> Iterator[pa.RecordBatch]:
    """Counts of each chunk of a task, as ``_counted`` gives them."""
    held, size = [], 0
    for batch in batches:
        for begin in range(0, len(batch), 512):
            part = batch.slice(begin, 512)
            held.append(part)
            size += pc.sum(pc.binary_length(part["text"])).as_py() or 0
            if size >= CHUNK_BYTES:
                yield from _counted(pa.Table.from_batches(held), bits, named)
                held, size = [], 0
    if held:
        yield from _counted(pa.Table.from_batches(held), bits, named)


def _terms_of(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms of some texts, and for each occurrence its term and its text."""
    data, offsets = text_bytes(column)
    plain = data.tobytes().translate(PLAIN)
    texts = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(plain)])
    split = pc.ascii_split_whitespace(texts)
    filled = pc.not_equal(split.flatten(), "")  # blanks at either end leave empty pieces
    coded = split.flatten().filter(filled).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), pc.list_parent_indices(split).filter(filled).to_numpy()


def _counted(docs: pa.Table, bits: int, named: bool) -> Iterator[pa.RecordBatch]:
    """Occurrences of each digest by language and source; then, without a source, each term of a language and its documents.

    ``named`` gives the first kind only, with its terms.
    """
    terms, code, text = _terms_of(docs["text"])
    if not len(terms):
        return
    m = len(terms)
    digests = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in terms.cast(pa.large_binary()).to_pylist()), np.uint64, m)
    digests = (digests >> np.uint64(64 - bits)).view(np.int64)
    keys = docs.select(GROUP).to_pandas()
    lang, langs = keys["lang"].factorize()
    group, groups = keys.set_index(GROUP).index.factorize()
    once, n = np.unique(text * m + code, return_counts=True)
    text, code = once // m, once % m

    def rows(home: np.ndarray, names: list, sources: list | None, with_terms: bool) -> Iterator[pa.RecordBatch]:
        key, of = np.unique(home[text] * m + code, return_inverse=True)
        total, in_texts = np.bincount(of, n).astype(np.int64), np.bincount(of)
        for begin in range(0, len(key), 200_000):
            part = slice(begin, begin + 200_000)
            at, term = pa.array(key[part] // m), key[part] % m
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()).take(at),
                    pa.array(sources, pa.string()).take(at) if sources is not None else pa.nulls(len(at), pa.string()),
                    pa.array(digests[term]),
                    terms.take(pa.array(term)).cast(pa.string()) if with_terms else pa.nulls(len(at), pa.string()),
                    pa.array(total[part]),
                    pa.array(in_texts[part]),
                ],
                names=["lang", "source", "digest", "term", "n", "docs"],
            )

    yield from rows(group, [g[0] for g in groups], [g[1] for g in groups], named)
    if not named:
        yield from rows(lang, list(langs), None, True)


def _share(n: Column, total: Column) -> Column:
    """p = 1 + floor(SCALE * (n + 2) / (total + 2 * v)), in decimals wide enough for any count."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(19,0)")
    return (F.lit(1) + F.call_function("div", scaled, (total + 2 * F.col("v")).cast("decimal(19,0)"))).cast("long")


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one matrix: for every two sources the sum of their terms' divergences.

    Rows without a term carry the share of a term that the source lacks.
    """
    table = pa.Table.from_batches(list(batches))
    lang, place, p = table["lang"][0].as_py(), table["place"].to_numpy(), table["p"].to_numpy()
    missing = table["digest"].is_null().to_numpy()
    absent = np.zeros(int(place.max()) + 1, np.int64)
    absent[place[missing]] = p[missing]
    named = table.filter(pa.array(~missing))
    term = named.select(["digest", "split"]).to_pandas().groupby(["digest", "split"], sort=False).ngroup().to_numpy()
    shares = np.tile(absent, (int(term.max()) + 1, 1))
    shares[term, named["place"].to_numpy()] = named["p"].to_numpy()
    for one in range(len(absent) - 1):
        a, b = shares[:, one : one + 1], shares[:, one + 1 :]
        sums = ((a - b) ** 2 // (a + b)).sum(axis=0)
        n = len(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * n, pa.string()), pa.array(np.full(n, one), pa.int32()), pa.array(np.arange(one + 1, one + 1 + n), pa.int32()), pa.array(sums, pa.int64())],
            names=["lang", "one", "other", "value"],
        )


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10, digest_bits: int = 64) -> DataFrame:
    """Per group of ``lang`` and ``source``: its distance to the other sources, and the terms it has more of.

    ``lang, source, part, item, value, rank``. Part ``pair`` has one row per other
    source of the language, part ``term`` the ``top`` terms (rank by value, then
    by the term). Every row of ``docs`` is a document; a null text, language or
    source is empty; whole texts are counted; other columns are not read; an
    empty table gives no row. ``digest_bits`` below 64 is for tests of the split.
    """
    spark = docs.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = new_work_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in [*GROUP, "text"]))
    found = stored(plain.mapInArrow(partial(_term_counts, bits=digest_bits, named=False), TERM_ROWS), "terms")
    of_source = found.where("source is not null").select(*GROUP, "digest", "n")
    of_lang = found.where("term is not null").select("lang", "digest", "term", "n", "docs")

    # What may be kept, by its digest, and the words behind it.
    both = ["lang", "digest"]
    likely = stored(
        of_lang.repartition(*both).groupBy(*both)
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"), F.min("term").alias("item"), F.max("term").alias("greatest"))
        .where(F.col("docs") >= least_docs),
        "likely-terms",
    )
    kept = likely.where("item = greatest").select(*both, F.lit("").alias("split"), "lang_n", "item")
    used = _summed(of_source.withColumn("split", F.lit("")), kept)
    mixed = likely.where("item <> greatest").select(*both)
    if mixed.head(1):
        apart = of_lang.join(mixed, both, "left_semi").groupBy(*both, F.col("term").alias("split")).agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        apart = apart.where(F.col("docs") >= least_docs).select(*both, "split", "lang_n", F.col("split").alias("item"))
        by_term = plain.mapInArrow(partial(_term_counts, bits=digest_bits, named=True), TERM_ROWS).select(*GROUP, "digest", F.col("term").alias("split"), "n")
        used = used.unionByName(_summed(by_term, apart))
        kept = kept.unionByName(apart)
    used = stored(used, "term-counts")

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = used.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    groups = (
        plain.select(*GROUP).distinct().join(sizes, "lang", "left").join(totals, GROUP, "left").na.fill(0, ["v", "lang_total", "total"])
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
        .withColumn("sources", F.count(F.lit(1)).over(Window.partitionBy("lang")))
    )
    groups = stored(groups, "groups")
    own = used.join(groups, GROUP)
    return _terms(own, kept, top).unionByName(_pairs(own, groups))


def _summed(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """Occurrences of the kept terms by group; one shuffle by the digest serves the join and the sum."""
    key = ["lang", "digest", "split"]
    joined = counts.join(kept.drop("item").hint("shuffle_hash"), key)
    return joined.groupBy("source", *key).agg(F.sum("n").alias("n"), F.first("lang_n").alias("lang_n"))


def _terms(own: DataFrame, kept: DataFrame, top: int) -> DataFrame:
    """The terms that a group has more of than its language."""
    valued = own.withColumn("p", _share(F.col("n"), F.col("total"))).withColumn("q", _share(F.col("lang_n"), F.col("lang_total"))).where("p > q")
    ranked = valued.select(*GROUP, "digest", "split", _divergence(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy(*GROUP).orderBy(F.desc("value"))
    # Equal values stay until the terms are known, as they decide between them.
    near = ranked.withColumn("rank", F.rank().over(best)).where(F.col("rank") <= top).drop("rank")
    named = near.join(kept.drop("lang_n"), ["lang", "digest", "split"]).select(*GROUP, "item", "value")
    rank = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item"))
    return named.withColumn("rank", rank).where(F.col("rank") <= top).select(*GROUP, F.lit("term").alias("part"), "item", "value", "rank")


def _pairs(own: DataFrame, groups: DataFrame) -> DataFrame:
    """Every two sources of a language, which is what the report lists, by matrices of terms times sources."""
    blocks = F.ceil(F.col("v") * F.col("sources") / F.lit(CELLS)).cast("int")
    total = F.col("total")
    shares = own.select("lang", F.pmod(F.xxhash64("digest"), blocks).cast("int").alias("block"), "digest", "split", "place", _share(F.col("n"), total).alias("p"))
    lacking = groups.where("v > 0").select(
        "lang", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(None).cast("long").alias("digest"), F.lit("").alias("split"), "place", _share(F.lit(0).cast("long"), total).alias("p")
    )
    sums = shares.unionByName(lacking).groupBy("lang", "block").applyInArrow(_pair_sums, "lang string, one int, other int, value long")
    summed = sums.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))
    both = summed.unionByName(summed.select("lang", F.col("other").alias("one"), F.col("one").alias("other"), "value"))
    ones = groups.select("lang", "source", F.col("place").alias("one"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("other"))
    listed = ones.join(others, "lang").where("one <> other").join(both, ["lang", "one", "other"], "left")
    valued = listed.select(*GROUP, F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    rank = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item"))
    return valued.withColumn("rank", rank)
