"""A hierarchical Pitman-Yor model of words, learned and applied over all documents.

Every word is a context with a restaurant of its own for the words that follow
it; all these restaurants share one parent, the restaurant of single words,
whose base is uniform over the known words and one unknown. Seating is sampled
by Gibbs sweeps: in a sweep each dish of each restaurant is seated anew, given
the tables of the sweep before, so dishes are independent and no restaurant,
however popular, is gathered anywhere. The predictive probabilities of the
sweeps after the first ones are averaged.

Documents are encoded once, as chunks of some megabytes with a dictionary of
their own. A chunk keeps its word pairs; it tells buckets their fingerprints
and counts, packed, and hears the counts over all documents. The one chunk that
owns a pair seats it, with numbers drawn by the fingerprint and the sweep only,
and reports the tables to the words concerned. Popular pairs take long to seat
and are in every chunk, so the tables that scores need come from the owners
too, through the buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.llm.groups import bucket_of
from stocktake.llm.hashing import mix
from stocktake.llm.seating import seat
from stocktake.session import new_work_path, shared_folder

#: The end of a text, a token, and its beginning, a context only; no word holds a blank.
END, BEGIN = b" end", b" begin"
CHUNK_BYTES = 20 << 20
#: Pairs of chunks that one bucket compares at a time.
BUCKET_PAIRS = 2_000_000
SWEEPS, UNUSED = 3, 1
STRENGTH = 1.0

CHUNKS = "gid long, ids array<long>, held array<boolean>, lengths binary, codes binary, words binary, tokens long"
WORD_OFFERS = "bucket int, gid long, words binary, counts binary"
WORD_STATE = "bucket int, gid long, ranks binary, counts binary, total long, kinds long"
PAIR_OFFERS = "bucket int, gid long, keys binary, counts binary"
PAIR_REPLIES = "bucket int, gid long, counts binary, owned binary, ranks binary, once long, twice long"
SUMS = "bucket int, gid long, kind int, tables binary, customers binary"
PAIR_TABLES = "bucket int, gid long, tables binary"
SEATS = "bucket int, gid long, own binary, customers binary, tables binary, n_customers long, n_tables long, once long, twice long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
STATS = -1  # the chunk number of rows that hold totals of a bucket
OF_WORDS, OF_PAIRS = 0, 1  # whose buckets a row of SUMS is for


# -- numbers and words as bytes ------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    """64-bit numbers as compressed planes of bytes; the planes of small numbers are mostly zeros."""
    planes = np.ascontiguousarray(values.astype(np.int64, copy=False).view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.int64).reshape(n)


def _packed_words(words: list[bytes]) -> bytes:
    joined = b"\n".join(words)
    return len(joined).to_bytes(8, "little") + pa.compress(joined, codec="zstd", asbytes=True)


def _unpacked_words(data: bytes) -> list[bytes]:
    n = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=n, codec="zstd", asbytes=True).split(b"\n")


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], names=[f for f, _ in fields])


# -- chunks --------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Documents of a task as chunks: a dictionary, the words as its numbers, the ids and lengths of the texts."""
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for begin in range(0, len(batch), 512):
            part = batch.slice(begin, 512)
            held.append(part)
            size += pc.sum(pc.binary_length(part["text"])).as_py() or 0
            if size >= chunk_bytes:
                yield _chunk(held, number)
                number, held, size = number + 1, [], 0
    if held:
        yield _chunk(held, number)


def _chunk(parts: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts)
    lengths, pieces = [], []
    for text in table["text"].chunks:
        # lowered as they came: of a slice that was cast, Arrow lowers the bytes before the slice
        split = pc.ascii_split_whitespace(pc.ascii_lower(text).cast(pa.large_string()))
        words, of = split.flatten(), pc.list_parent_indices(split)
        filled = pc.not_equal(words, "")  # blanks at either end leave empty pieces
        lengths.append(np.bincount(of.filter(filled).to_numpy(), minlength=len(text)))
        pieces.append(words.filter(filled).dictionary_encode())
    coded = pa.chunked_array(pieces).unify_dictionaries().combine_chunks()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.chunk(0)
    codes = coded.indices.to_numpy().astype(np.int64)
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    row = (number, table["doc_id"].to_pylist(), table["held_out"].to_pylist(), _packed(np.concatenate(lengths)), _packed(codes), _packed_words([*words, END, BEGIN]), len(codes) + len(table))
    return _batch(CHUNKS, [row])


class _Texts:
    """The tokens of a chunk: for each its word, the word before it and its document, all as numbers."""

    def __init__(self, chunk: dict, buckets: int) -> None:
        self.words = _unpacked_words(chunk["words"])
        self.hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words), np.uint64, len(self.words))
        homes = bucket_of(mix(self.hashes, 41), buckets).astype(np.int64)
        self.by_bucket = np.argsort(homes, kind="stable")
        self.word_cuts = np.searchsorted(homes[self.by_bucket], np.arange(buckets + 1))
        lengths, codes = _unpacked(chunk["lengths"]) + 1, _unpacked(chunk["codes"])
        end, begin = len(self.words) - 2, len(self.words) - 1
        last = np.cumsum(lengths) - 1
        # a chunk's numbers are below 2**31, as its words and documents take a byte each at least
        self.word = np.empty(int(lengths.sum()), np.int32)
        inside = np.ones(len(self.word), bool)
        inside[last] = False
        self.word[inside], self.word[last] = codes, end
        self.before = np.empty_like(self.word)
        self.before[1:] = self.word[:-1]
        self.before[last - lengths + 1] = begin
        self.lengths = lengths
        self.held = np.array(chunk["held"], bool)
        self.document = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)

    def word_counts(self) -> np.ndarray:
        """Training tokens of each word; of the beginning the training documents."""
        counts = np.bincount(self.word[~self.held[self.document]], minlength=len(self.words))
        counts[-1] = np.count_nonzero(~self.held)
        return counts

    def find_pairs(self, buckets: int, of_tokens: bool = True) -> None:
        """Distinct pairs in order of their fingerprints, and, if asked for, the pair of each token."""
        m = len(self.words)
        both = self.before.astype(np.int64)
        both *= m
        both += self.word
        if of_tokens:
            distinct, pair = np.unique(both, return_inverse=True)
            pair = pair.astype(np.int32)
        else:
            # without the inverse np.unique hashes, which takes many times as long
            both.sort()
            distinct = both[np.append(True, both[1:] != both[:-1])]
        del both
        keys = mix(self.hashes[distinct // m] ^ mix(self.hashes[distinct % m], 31), 32)
        order = np.argsort(keys)
        self.keys, distinct = keys[order], distinct[order]
        if of_tokens:
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            self.pair = place[pair]
        self.context, self.dish = (distinct // m).astype(np.int32), (distinct % m).astype(np.int32)
        self.pair_cuts = np.searchsorted(bucket_of(self.keys, buckets), np.arange(buckets + 1, dtype=np.uint64))

    def of_words(self, replies: list[dict], column: str) -> np.ndarray:
        """Numbers that buckets sent for the words, by word."""
        out = np.zeros(len(self.words), np.int64)
        for r in replies:
            b = r["bucket"]
            out[self.by_bucket[self.word_cuts[b] : self.word_cuts[b + 1]]] = _unpacked(r[column])
        return out

    def of_pairs(self, replies: list[dict], column: str) -> np.ndarray:
        out = np.zeros(len(self.keys), np.int64)
        for r in replies:
            b = r["bucket"]
            out[self.pair_cuts[b] : self.pair_cuts[b + 1]] = _unpacked(r[column])
        return out


def _offer_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in _rows(batch):
            texts = _Texts(chunk, buckets)
            counts, rows = texts.word_counts(), []
            for b, (a, z) in enumerate(zip(texts.word_cuts[:-1], texts.word_cuts[1:])):
                if z > a:
                    mine = texts.by_bucket[a:z]
                    rows.append((b, chunk["gid"], _packed_words([texts.words[i] for i in mine]), _packed(counts[mine])))
            yield _batch(WORD_OFFERS, rows)


def _offer_pairs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in _rows(batch):
            texts = _Texts(chunk, buckets)
            texts.find_pairs(buckets)
            counts = np.bincount(texts.pair[~texts.held[texts.document]], minlength=len(texts.keys))
            rows = []
            for b, (a, z) in enumerate(zip(texts.pair_cuts[:-1], texts.pair_cuts[1:])):
                if z > a:
                    steps = np.diff(texts.keys[a:z], prepend=np.uint64(0))
                    rows.append((b, chunk["gid"], _packed(steps.view(np.int64)), _packed(counts[a:z])))
            yield _batch(PAIR_OFFERS, rows)


def _rows(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    for i in range(len(batch)):
        yield {c: batch[c][i].as_py() for c in batch.schema.names}


# -- buckets -------------------------------------------------------------------------


def _merge_words(offers: pa.Table) -> pa.Table:
    """Counts of a bucket's words over all chunks, sent back in each chunk's order, with the words' ranks here.

    The row of totals has the words' hashes by rank.
    """
    rows = sorted(_rows(offers), key=lambda r: r["gid"])
    known: dict[bytes, int] = {}
    ranks = [np.fromiter((known.setdefault(w, len(known)) for w in _unpacked_words(r["words"])), np.int64) for r in rows]
    counts = np.zeros(len(known), np.int64)
    for r, mine in zip(rows, ranks):
        counts[mine] += _unpacked(r["counts"])
    bucket = rows[0]["bucket"]
    tokens = counts.copy()
    if BEGIN in known:
        tokens[known[BEGIN]] = 0
    out = [(bucket, r["gid"], _packed(mine), _packed(counts[mine]), 0, 0) for r, mine in zip(rows, ranks)]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, len(known))
    out.append((bucket, STATS, _packed(hashes.view(np.int64)), b"", int(tokens.sum()), int(np.count_nonzero(tokens))))
    return pa.Table.from_batches([_batch(WORD_STATE, out)])


def _merge_pairs(offers: pa.Table) -> pa.Table:
    """Counts of a bucket's pairs over all chunks, which chunk owns a pair, the first that learns it, and the pairs' ranks here as steps."""
    rows = sorted(_rows(offers), key=lambda r: r["gid"])
    keys = [np.cumsum(_unpacked(r["keys"]).view(np.uint64), dtype=np.uint64) for r in rows]
    cuts = np.cumsum([0, *map(len, keys)])
    counts = np.concatenate([_unpacked(r["counts"]) for r in rows])
    order = np.argsort(np.concatenate(keys), kind="stable")
    ordered = np.concatenate(keys)[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    total = np.add.reduceat(counts[order], first)
    all_counts = np.empty_like(counts)
    all_counts[order] = np.repeat(total, np.diff(np.append(first, len(order))))
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    learned = np.flatnonzero(counts[order] > 0)
    group = np.searchsorted(first, learned, "right")
    owned = np.zeros(len(order), np.int64)
    owned[order[learned[np.diff(group, prepend=-1) > 0]]] = 1
    bucket = rows[0]["bucket"]
    out = [(bucket, r["gid"], _packed(all_counts[a:z]), _packed(owned[a:z]), _packed(np.diff(ranks[a:z], prepend=0)), 0, 0) for r, a, z in zip(rows, cuts[:-1], cuts[1:])]
    out.append((bucket, STATS, b"", b"", b"", int(np.count_nonzero(total == 1)), int(np.count_nonzero(total == 2))))
    return pa.Table.from_batches([_batch(PAIR_REPLIES, out)])


def _spread_tables(state: pa.Table, reports: pa.Table) -> pa.Table:
    """The tables that owners report of a bucket's pairs, sent to each chunk in its order; a pair that nobody learns has none."""
    reported = {r["gid"]: _unpacked(r["tables"]) for r in _rows(reports)}
    rows = [r for r in _rows(state) if r["gid"] != STATS]
    ranks = [np.cumsum(_unpacked(r["ranks"])) for r in rows]
    tables = np.zeros(max((int(mine[-1]) + 1 for mine in ranks if len(mine)), default=0), np.int64)
    for r, mine in zip(rows, ranks):
        if r["gid"] in reported:
            tables[mine[_unpacked(r["owned"]) > 0]] = reported[r["gid"]]
    return pa.Table.from_batches([_batch(PAIR_TABLES, [(r["bucket"], r["gid"], _packed(tables[mine])) for r, mine in zip(rows, ranks)])])


def _seat_words(state: pa.Table, reports: pa.Table, weight: float | None, discount: float, sweep: int) -> pa.Table:
    """The restaurant of single words: customers are the tables of all contexts; its tables are seated here.

    ``weight`` is that of a new table; None puts each word at one table.
    """
    reported = {r["gid"]: r for r in _rows(reports)}
    totals, *rows = sorted(_rows(state), key=lambda r: r["gid"])
    hashes = _unpacked(totals["ranks"]).view(np.uint64)
    ranks, size = [_unpacked(r["ranks"]) for r in rows], len(hashes)
    own, customers = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r, mine in zip(rows, ranks):
        own[mine] += _unpacked(reported[r["gid"]]["tables"])
        customers[mine] += _unpacked(reported[r["gid"]]["customers"])
    bucket = rows[0]["bucket"]
    if weight is None:
        tables = np.minimum(customers, 1)
    else:
        tables = seat(customers, np.full(size, weight), discount, mix(hashes, 51), sweep)
    out = [(bucket, r["gid"], _packed(own[mine]), _packed(customers[mine]), _packed(tables[mine]), 0, 0, 0, 0) for r, mine in zip(rows, ranks)]
    sums = (int(customers.sum()), int(tables.sum()), int(np.count_nonzero(customers == 1)), int(np.count_nonzero(customers == 2)))
    return pa.Table.from_batches([_batch(SEATS, [*out, (bucket, STATS, b"", b"", b"", *sums)])])


# -- sweeps and scores, in the chunks ------------------------------------------------


class _State:
    """What a chunk knows of its words after a sweep: tables of each context, and the parent's probabilities."""

    def __init__(self, texts: _Texts, seats: list[dict], scalars: dict) -> None:
        own, customers, tables = (texts.of_words(seats, c) for c in ("own", "customers", "tables"))
        spread = (STRENGTH + scalars["parent_discount"] * scalars["n_tables"]) / (scalars["kinds"] + 1)
        self.parent = (customers - scalars["parent_discount"] * tables + spread) / (STRENGTH + scalars["n_customers"])
        self.own = STRENGTH + scalars["discount"] * own

    def new_table(self, texts: _Texts, which: np.ndarray | slice) -> np.ndarray:
        return self.own[texts.context[which]] * self.parent[texts.dish[which]]


def _of_kind(replies: pa.Table, kind: int) -> list[dict]:
    return list(_rows(replies.filter(pc.equal(replies["kind"], kind))))


def _sweep(chunk: pa.Table, replies: pa.Table, buckets: int, sweep: int, scalars: dict | None, used: bool) -> pa.Table:
    """Seats the pairs that the chunk owns and reports their tables to the words, and to the pairs if the sweep is used."""
    if not len(chunk):
        return pa.Table.from_batches([_batch(SUMS, [])])
    row = next(_rows(chunk))
    texts = _Texts(row, buckets)
    texts.find_pairs(buckets, of_tokens=False)
    # the tokens are not looked at again
    del texts.word, texts.before, texts.document
    pairs = _of_kind(replies, 1)
    owned = np.flatnonzero(texts.of_pairs(pairs, "b"))
    counts = texts.of_pairs(pairs, "a")[owned]
    if sweep == 0:
        tables = np.minimum(counts, 1)
    else:
        state = _State(texts, _seats(replies, 2), scalars)
        tables = seat(counts, state.new_table(texts, owned), scalars["discount"], texts.keys[owned], sweep)
    size = len(texts.words)
    own = np.bincount(texts.context[owned], tables, size).astype(np.int64)
    customers = np.bincount(texts.dish[owned], tables, size).astype(np.int64)
    out = []
    for b, (a, z) in enumerate(zip(texts.word_cuts[:-1], texts.word_cuts[1:])):
        if z > a:
            mine = texts.by_bucket[a:z]
            out.append((b, row["gid"], OF_WORDS, _packed(own[mine]), _packed(customers[mine])))
    if used:
        cuts = np.searchsorted(owned, texts.pair_cuts)
        out += [(b, row["gid"], OF_PAIRS, _packed(tables[a:z]), b"") for b, (a, z) in enumerate(zip(cuts[:-1], cuts[1:])) if z > a]
    return pa.Table.from_batches([_batch(SUMS, out)])


def _seats(replies: pa.Table, kind: int) -> list[dict]:
    return [{"bucket": r["bucket"], "own": r["a"], "customers": r["b"], "tables": r["c"]} for r in _of_kind(replies, kind)]


def _score(chunk: pa.Table, replies: pa.Table, buckets: int, scalars: list[dict]) -> pa.Table:
    """Log-probabilities of the chunk's documents; ``scalars`` are those of each used sweep."""
    if not len(chunk):
        return pa.table({f.split(" ")[0]: [] for f in SCORES.split(", ")}).cast(_SCORE_SCHEMA)
    row = next(_rows(chunk))
    texts = _Texts(row, buckets)
    texts.find_pairs(buckets)
    known = texts.of_words(_of_kind(replies, 0), "a")
    counts = texts.of_pairs(_of_kind(replies, 1), "a")
    likely = np.zeros(len(texts.keys))
    for i, now in enumerate(scalars):
        after = _State(texts, _seats(replies, 2 + 2 * i), now)
        likely += counts - now["discount"] * texts.of_pairs(_of_kind(replies, 3 + 2 * i), "a") + after.new_table(texts, slice(None))
    likely /= len(scalars) * (STRENGTH + known[texts.context])
    n, kinds = scalars[0]["tokens"], scalars[0]["kinds"]
    base = np.log10((known + 1) / (n + (kinds + 1)))
    size = len(texts.lengths)

    def per_document(values: np.ndarray) -> np.ndarray:
        return np.bincount(texts.document, values, size)

    return pa.table(
        [
            pa.array(row["ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(texts.lengths),
            pa.array(per_document(known[texts.word] > 0).astype(np.int64)), pa.array(np.full(size, n, np.int64)),
            pa.array(per_document(base[texts.word])), pa.array(per_document(np.log10(likely)[texts.pair])),
        ],
        schema=_SCORE_SCHEMA,
    )


_SCORE_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


# -- the whole -----------------------------------------------------------------------


def _discount(once: int, twice: int) -> float:
    """The share of a customer that a table gives up, from the dishes ordered once and twice."""
    return min(max(once / max(once + 2 * twice, 1), 0.05), 0.95)


def _placed(chunks: DataFrame, parts: int) -> DataFrame:
    """The chunks, checkpointed where their number puts them, so that later steps send replies there and move no chunk.

    A checkpoint keeps the partitioning of a plan that adaptive execution does
    not wrap, so it is off for this one job.
    """
    conf = chunks.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return chunks.repartition(parts, "gid").checkpoint()
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def score_texts(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    sweeps: int = SWEEPS, unused: int = UNUSED, chunk_bytes: int = CHUNK_BYTES, bucket_pairs: int = BUCKET_PAIRS,
) -> DataFrame:
    """``SCORES`` for every row of ``docs``, learned from the rows that are not ``held_out``.

    Tokens are words (A to Z as lower case) and one end per text. A null text is
    empty: one token. ``held_out`` null counts as false; ids may be null or
    repeated, every row is a document of its own. Without a row to learn from
    every token has probability 1. Texts of any length are taken whole; one is
    never cut, so a chunk may exceed ``chunk_bytes`` by one text. Columns other
    than the two are not read but for ``held_out``. ``sweeps`` Gibbs sweeps are
    made, the first ``unused`` of them are not averaged. Word counts go by the
    words themselves, pairs by 64-bit fingerprints.
    """
    if not 0 <= unused < sweeps:
        raise ValueError("at least one sweep has to be used")
    spark = docs.sparkSession
    shared_folder(spark)

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = new_work_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = _placed(plain.mapInArrow(lambda batches: _chunks(batches, chunk_bytes), CHUNKS), parts)
    buckets = max(parts, -(-(chunks.agg(F.sum("tokens")).first()[0] or 0) // bucket_pairs))

    words = stored(chunks.mapInArrow(partial(_offer_words, buckets=buckets), WORD_OFFERS).groupBy("bucket").applyInArrow(_merge_words, WORD_STATE), "lm-words")
    pairs = stored(chunks.mapInArrow(partial(_offer_pairs, buckets=buckets), PAIR_OFFERS).groupBy("bucket").applyInArrow(_merge_pairs, PAIR_REPLIES), "lm-pairs")
    seen = words.agg(F.sum("total"), F.sum("kinds")).first()
    often = pairs.agg(F.sum("once"), F.sum("twice")).first()
    fixed = {"tokens": seen[0] or 0, "kinds": seen[1] or 0, "discount": _discount(often[0] or 0, often[1] or 0), "parent_discount": 0.0}

    def reply(df: DataFrame, kind: int, *columns: str) -> DataFrame:
        sent = [F.col(c).alias(name) for c, name in zip(columns, "abc")]
        absent = [F.lit(None).cast("binary").alias(name) for name in "abc"[len(columns) :]]
        return df.where(F.col("gid") != STATS).select("gid", F.lit(kind).alias("kind"), "bucket", *sent, *absent)

    def in_chunks(replies: DataFrame, step, schema: str) -> DataFrame:
        return chunks.groupBy("gid").cogroup(replies.groupBy("gid")).applyInArrow(step, schema)

    known = reply(pairs, 1, "counts", "owned")
    seats: list[DataFrame] = []
    tables: list[DataFrame] = []
    scalars: list[dict] = []
    for sweep in range(sweeps + 1):
        replies = known.unionByName(reply(seats[-1], 2, "own", "customers", "tables")) if seats else known
        used = sweep > unused
        sums = in_chunks(replies, partial(_sweep, buckets=buckets, sweep=sweep, scalars=scalars[-1] if scalars else None, used=used), SUMS)
        if used:
            sums = stored(sums, f"lm-sums-{sweep}")
            told = sums.where(F.col("kind") == OF_PAIRS).groupBy("bucket")
            tables.append(stored(pairs.groupBy("bucket").cogroup(told).applyInArrow(_spread_tables, PAIR_TABLES), f"lm-tables-{sweep}"))
            sums = sums.where(F.col("kind") == OF_WORDS)
        weight = (STRENGTH + fixed["parent_discount"] * scalars[-1]["n_tables"]) / (fixed["kinds"] + 1) if scalars else None
        seated = words.groupBy("bucket").cogroup(sums.groupBy("bucket")).applyInArrow(partial(_seat_words, weight=weight, discount=fixed["parent_discount"], sweep=sweep), SEATS)
        seats.append(stored(seated, f"lm-seats-{sweep}"))
        total = seats[-1].agg(*(F.sum(c) for c in ("n_customers", "n_tables", "once", "twice"))).first()
        if not scalars:
            fixed["parent_discount"] = _discount(total[2] or 0, total[3] or 0)
        scalars.append({**fixed, "n_customers": total[0] or 0, "n_tables": total[1] or 0})

    replies = reply(words, 0, "counts").unionByName(known)
    for i, (seated, table) in enumerate(zip(seats[unused + 1 :], tables)):
        replies = replies.unionByName(reply(seated, 2 + 2 * i, "own", "customers", "tables")).unionByName(reply(table, 3 + 2 * i, "tables"))
    return in_chunks(replies, partial(_score, buckets=buckets, scalars=scalars[unused + 1 :]), SCORES)
