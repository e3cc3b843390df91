"""SimHash near-dedup: fingerprints of 3-word shingles, joined with themselves in a binary trie.

Two 64-bit fingerprints within the distance agree on at least one of
``distance + 1`` blocks of bits. So the trie is rooted once per block, with that
block's bits first: below a node that the block spells out, node pairs are
walked together, differing bits add up and a pair over the budget is dropped.
The block's value deals the work to tasks; a value that too many fingerprints
hold is dealt as pairs of slices. Equal fingerprints are one leaf, so copies
never meet as pairs, and a task reports a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.components import components
from stocktake.llm.hashing import text_bytes
from stocktake.session import shared_folder

SHINGLE_WORDS = 3
DISTANCE = 3
SEED = 42
SLICE = 200_000
LEAF_PAIRS = 64
FRONTIER = 400_000
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: bytes, shingle_words: int) -> int:
    """The SimHash of one text, as a signed 64-bit number; zero without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), SEED)).astype(np.int64))
    line = b" ".join(words)
    begins = np.cumsum(np.array([0, *map(len, words)]) + 1) - 1
    ends = begins[shingle_words:] - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(begins.tolist(), ends.tolist())], ">u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros(64, np.int64)
    for at in range(0, len(bits), 255):
        total += bits[at : at + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * total > len(bits)).view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """``doc_id, fp`` per row."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            fps = [fingerprint(raw[a:b], shingle_words) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(fps, pa.int64())})

    only = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return only.mapInArrow(batches, "doc_id long, fp long")


class Forest:
    """Sets of positions, merged by arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            x, y = root[a], root[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            apart = low != high
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(root, high[apart], low[apart])
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root[:] = up


def trie_links(values: np.ndarray, skip: int, distance: int) -> np.ndarray:
    """For sorted distinct fingerprints, the least position that links within ``distance`` reach.

    Only pairs that agree on the first ``skip`` bits are sure to be found.
    """
    forest = Forest(len(values))
    for step in range(1, 4):
        near = np.flatnonzero(np.bitwise_count(values[step:] ^ values[:-step]) <= distance)
        forest.merge(near, near + step)
    top = values >> np.uint64(64 - skip)
    cuts = np.flatnonzero(np.append(True, top[1:] != top[:-1]))
    begin, end = cuts, np.append(cuts[1:], len(values))
    zero = np.zeros(len(begin), np.int64)
    stack = [(skip, begin, end, begin, end, zero)]
    while stack:
        bit, a, b, c, d, spent = stack.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack += [(bit, *(x[:half] for x in (a, b, c, d, spent))), (bit, *(x[half:] for x in (a, b, c, d, spent)))]
            continue
        settled = _one_set(forest.root, a, b, c, d)
        a, b, c, d, spent = (x[~settled] for x in (a, b, c, d, spent))
        small = ((b - a) * (d - c) <= LEAF_PAIRS) | (bit == 64)
        if small.any():
            _leaf_pairs(values, forest, *(x[small] for x in (a, b, c, d)), distance)
        a, b, c, d, spent = (x[~small] for x in (a, b, c, d, spent))
        if not len(a):
            continue
        m, n = _middle(values, a, bit), _middle(values, c, bit)
        m, n = np.clip(m, a, b), np.clip(n, c, d)
        cross = a != c
        parts = [(a, m, c, n, spent), (m, b, n, d, spent), (a, m, n, d, spent + 1)]
        parts.append(tuple(x[cross] for x in (m, b, c, n, spent + 1)))
        a, b, c, d, spent = (np.concatenate(x) for x in zip(*parts))
        alive = (b > a) & (d > c) & (spent <= distance) & ((a != c) | (b - a > 1))
        stack.append((bit + 1, *(x[alive] for x in (a, b, c, d, spent))))
    return forest.root


def _middle(values: np.ndarray, begin: np.ndarray, bit: int) -> np.ndarray:
    """Where the children with the bit set begin."""
    keep = np.uint64(64 - bit)
    prefix = (values[begin] >> keep) << keep if bit else np.zeros(len(begin), np.uint64)
    return np.searchsorted(values, prefix | np.uint64(1 << (63 - bit)))


def _one_set(root: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Which node pairs hold one set only, and so no link that is news."""
    if not len(a):
        return np.zeros(0, bool)
    padded = np.append(root, root[-1])

    def span(function, begin, end):
        return function.reduceat(padded, np.stack([begin, end], 1).ravel())[::2]

    low, high = span(np.minimum, a, b), span(np.maximum, a, b)
    return (low == high) & (span(np.minimum, c, d) == low) & (span(np.maximum, c, d) == low)


def _leaf_pairs(values: np.ndarray, forest: Forest, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, distance: int) -> None:
    wide = d - c
    sizes = (b - a) * wide
    which = np.repeat(np.arange(len(a)), sizes)
    within = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    i = a[which] + within // wide[which]
    j = c[which] + within % wide[which]
    close = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= distance)
    forest.merge(i[close], j[close])


def linked_fingerprints(distinct: DataFrame, distance: int, slice_size: int = SLICE) -> DataFrame:
    """Links ``a, b`` between different fingerprints (column ``fp``) that connect all pairs within ``distance``."""
    blocks = distance + 1
    width = 64 // blocks
    turned = [
        F.struct(F.lit(i).alias("block"), F.expr(f"shiftleft(fp, {i * width}) | shiftrightunsigned(fp, {64 - i * width})" if i else "fp").alias("turned"))
        for i in range(blocks)
    ]
    rows = distinct.select(F.explode(F.array(*turned)).alias("x")).select("x.block", "x.turned")
    rows = rows.withColumn("top", F.shiftrightunsigned("turned", 64 - width))
    total = distinct.count()
    slots = max(1, -(-total * blocks // slice_size), int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = rows.groupBy("block", "top").count().where(F.col("count") > slice_size).select("block", "top", F.ceil(F.col("count") / slice_size).cast("int").alias("n"))
    rows = rows.join(hot, ["block", "top"], "left")
    mine = F.pmod(F.xxhash64("turned"), F.col("n")).cast("int")
    tasks = F.when(F.col("n").isNull(), F.array(F.concat(F.lit("s"), F.pmod(F.xxhash64("block", "top"), F.lit(slots)))))
    pair = lambda k: F.concat_ws("_", F.lit("h"), "block", "top", F.least(k, F.col("mine")), F.greatest(k, F.col("mine")))
    rows = rows.withColumn("mine", mine).withColumn("task", F.explode(tasks.otherwise(F.transform(F.sequence(F.lit(0), F.col("n") - 1), pair))))

    def walk(table: pa.Table) -> pa.Table:
        block = table["block"].to_numpy()
        values = table["turned"].to_numpy().view(np.uint64)
        out = []
        for i in np.unique(block):
            own = np.sort(values[block == i])
            root = trie_links(own, width, distance)
            apart = np.flatnonzero(root != np.arange(len(own)))
            back = np.uint64(i * width), np.uint64((64 - i * width) % 64)
            turn = lambda x: (x >> back[0]) | (x << back[1]) if i else x
            out.append((turn(own[apart]).view(np.int64), turn(own[root[apart]]).view(np.int64)))
        a, b = (np.concatenate(x) for x in zip(*out))
        return pa.table({"a": a, "b": b})

    return rows.select("task", "block", "turned").groupBy("task").applyInArrow(walk, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``.

    Rows whose fingerprints are within ``distance`` bits are linked; the
    component is the smallest id reachable. Null and empty texts have
    fingerprint zero and link like any other; repeated rows are kept and link; a
    null id is never a component's id unless no row of it has one; an empty
    table gives no rows; columns besides id and text are not read.
    """
    shared_folder(docs.sparkSession)
    fps = fingerprints(docs, id_col, text_col, shingle_words).checkpoint()
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least")).checkpoint()
    roots = components(linked_fingerprints(distinct, distance))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    fingerprint_hex = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return fps.join(by_fp, "fp").select("doc_id", fingerprint_hex, "component_id")
