"""Documents dealt into groups of a bounded size, and the keys that groups share.

Operators that look for equal pieces of text in different documents work on
groups of documents (some megabytes of text, dealt by a hash of the id, so that
no source or cluster of copies fills one). A group sums up its own pieces first,
so a piece that a third of all documents hold is sent once per group, and sends
them packed: one row per group and bucket, not one per piece.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.hashing import NULL_ID, packed, slices

KEY_BITS = np.uint64(30)
REPLY = "gid int, kind int, bucket int, payload binary"


def group_count(docs: DataFrame, text: str, group_bytes: int) -> int:
    """Groups needed for ``group_bytes`` of text each, one per shuffle partition at least."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(math.ceil(total / group_bytes), partitions)


def dealt(docs: DataFrame, id_col: str, text_col: str, count: int) -> DataFrame:
    """``doc_id, text, gid``; other columns go. A null id falls in some group too."""
    doc_id = F.col(id_col).cast("long").alias("doc_id")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    spread = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.octet_length(text_col)), F.lit(count)).cast("int")
    return docs.select(doc_id, text, spread.alias("gid"))


def in_order(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows by id and text, whatever order they arrived in, and their ids; a null id is the largest."""
    table = table.append_column("key", pc.fill_null(table["doc_id"], NULL_ID))
    table = table.append_column("bytes", pc.binary_length(table["text"]))
    ids = table["key"].to_numpy()
    if len(np.unique(ids)) == len(ids):
        order = np.argsort(ids)
    else:
        order = pc.sort_indices(table, [("key", "ascending"), ("bytes", "ascending"), ("text", "ascending")])
    table = table.take(pa.array(order))
    return table.drop_columns(["bytes"]), table["key"].to_numpy()


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the upper half of the hash; hashes in order give buckets in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def short_keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket and the low bits of each hash in one number, as known to ``shared_keys``."""
    return (bucket_of(hashes, buckets) << KEY_BITS) | (hashes & np.uint64((1 << 30) - 1))


def offered_keys(hashes: np.ndarray, rows: np.ndarray, anchor: np.ndarray | None, gid: int, buckets: int) -> pa.Table:
    """Packed distinct hashes of a group: low bits, whether two rows hold it, whether it is an anchor."""
    order = np.argsort(hashes)
    h, r = hashes[order], rows[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    if not len(h):
        return packed({"bucket": np.zeros(0, np.int32), "gid": gid}, np.zeros(1, np.int64), np.zeros(0, np.uint32))
    several = np.minimum.reduceat(r, first) != np.maximum.reduceat(r, first)
    anchored = np.ones(len(first), bool) if anchor is None else np.logical_or.reduceat(anchor[order], first)
    h = h[first]
    entry = (h & np.uint64((1 << 30) - 1)).astype(np.uint32) << np.uint32(2)
    entry |= several.astype(np.uint32) << np.uint32(1) | anchored.astype(np.uint32)
    cuts = np.searchsorted(bucket_of(h, buckets), np.arange(buckets + 1, dtype=np.uint64))
    return packed({"bucket": np.arange(buckets), "gid": gid}, cuts, entry)


def shared_keys(offers: pa.Table) -> pa.Table:
    """Of one bucket: to every group the low bits of its keys that another document holds and that are an anchor somewhere."""
    entries, cuts = slices(offers["payload"], np.uint32)
    gids, bucket = offers["gid"].to_numpy(), offers["bucket"][0].as_py()
    ordered = np.sort(entries)
    low = ordered >> np.uint32(2)
    first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    flags = np.bitwise_or.reduceat(ordered & np.uint32(3), first)
    held = np.diff(np.append(first, len(low)))
    chosen = ((flags & 1) > 0) & ((held > 1) | ((flags & 2) > 0))
    wanted = low[first][chosen]
    mine = entries >> np.uint32(2)
    at = np.searchsorted(wanted, mine)
    at[at == len(wanted)] = 0
    hit = wanted[at] == mine if len(wanted) else np.zeros(len(mine), bool)
    owner = np.repeat(np.arange(len(gids)), np.diff(cuts))[hit]
    return packed({"gid": gids, "kind": 0, "bucket": bucket}, np.searchsorted(owner, np.arange(len(gids) + 1)), mine[hit])


def known_keys(replies: pa.Table) -> np.ndarray:
    """What ``shared_keys`` said to a group, as sorted ``short_keys``."""
    if not replies.num_rows:
        return np.zeros(0, np.uint64)
    low, cuts = slices(replies["payload"], np.uint32)
    bucket = np.repeat(replies["bucket"].to_numpy().astype(np.uint64), np.diff(cuts))
    return np.sort((bucket << KEY_BITS) | low.astype(np.uint64))


def of_kind(replies: pa.Table, kind: int) -> pa.Table:
    return replies.filter(pc.equal(replies["kind"], kind))


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession
