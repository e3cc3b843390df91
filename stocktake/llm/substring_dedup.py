"""Substring dedup on words: fixed-block anchors, rolling probes, maximal exact repeats.

Any ``window`` consecutive words that two documents share hold, in the earlier
document, one of its non-overlapping blocks of ``window // 2`` words whole. So
the blocks are the index and every rolling run of that many words probes it.
Probes that hit a block and are held by two documents are extended word by word
to all windows around them; a window's least document follows from its 128-bit
fingerprint, over 128-bit hashes of the words, and neighbouring windows merge into maximal repeats.

Extending per pair of documents would grow with the square of a group of
copies. Here a group of documents sends each distinct window once with its least
document, and is told which of them an earlier document has.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm import groups as G
from stocktake.llm.hashing import NULL_ID, in_sorted, packed, rolling_hashes, slices, text_bytes, word_codes, word_spans

WINDOW = 50
GROUP_BYTES = 4 << 20
RESULT = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string"


class _Words:
    """The words of a group's documents, and their probes."""

    def __init__(self, table: pa.Table, window: int):
        self.table, self.ids = G.in_order(table)
        self.data, self.offsets = text_bytes(self.table["text"])
        self.begins, self.ends, self.rows = word_spans(self.data, self.offsets)
        self.window, self.block = window, max(1, window // 2)
        self.codes, self.more = word_codes(self.data, self.begins, self.ends).T.copy()
        self.first_word = np.searchsorted(self.rows, np.arange(len(self.ids) + 1))
        n = len(self.codes)
        self.probe = rolling_hashes(self.codes, self.block, 2)
        self.whole = self._inside(self.block)
        self.n = n

    def _inside(self, width: int) -> np.ndarray:
        """For each run of ``width`` words, whether one row holds it."""
        n = max(0, len(self.rows) - width + 1)
        return self.rows[:n] == self.rows[width - 1 : width - 1 + n]

    def offer(self, gid: int, buckets: int) -> pa.Table:
        at = np.flatnonzero(self.whole)
        anchor = (at - self.first_word[self.rows[at]]) % self.block == 0
        return G.offered_keys(self.probe[at], self.rows[at], anchor, gid, buckets)

    def extended(self, shared: np.ndarray, buckets: int):
        """Windows around the hits: first word, and by distinct window its fingerprint and least id."""
        hit = np.zeros(self.n + 1, np.int64)
        at = np.flatnonzero(self.whole)
        hit[1 + at[in_sorted(G.short_keys(self.probe[at], buckets), shared)]] = 1
        sums = np.cumsum(hit)
        reach = self.window - self.block + 1
        whole = self._inside(self.window)
        begin = np.flatnonzero(whole & (sums[np.arange(len(whole)) + reach] > sums[: len(whole)]))
        h1 = rolling_hashes(self.codes, self.window, 3)[begin]
        h2 = rolling_hashes(self.more, self.window, 4)[begin]
        order = np.lexsort((h2, h1))
        h1, h2 = h1[order], h2[order]
        new = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) if len(order) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        ids = self.ids[self.rows[begin[order]]]
        least = np.minimum.reduceat(ids, first) if len(first) else ids
        return begin[order], np.cumsum(new) - 1, h1[first], h2[first], least


_ENTRY = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("least", "<i8")])


def _least_elsewhere(offers: pa.Table) -> pa.Table:
    """Of one bucket of windows: to every group a bit per window it sent, set if a smaller id has it."""
    entries, cuts = slices(offers["payload"], _ENTRY)
    order = np.lexsort((entries["h2"], entries["h1"]))
    e = entries[order]
    new = np.append(True, (e["h1"][1:] != e["h1"][:-1]) | (e["h2"][1:] != e["h2"][:-1]))
    least = np.minimum.reduceat(e["least"], np.flatnonzero(new))[np.cumsum(new) - 1]
    later = np.empty(len(e), bool)
    later[order] = least < e["least"]
    bits = [np.packbits(later[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
    kinds = {"gid": offers["gid"].to_numpy(), "kind": np.ones(len(bits)), "bucket": offers["bucket"].to_numpy()}
    return pa.table({**{k: pa.array(v.astype(np.int32)) for k, v in kinds.items()}, "payload": pa.array(bits, pa.binary())})


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, group_bytes: int = GROUP_BYTES, keep_text: bool = False) -> DataFrame:
    """Per row of ``docs``: words, removed words, maximal removed runs, hash of what is left (and, asked for, the text left).

    A word goes if a window that covers it also starts in a document with a
    smaller id, judged on the input. Null and empty texts have no words; rows
    with the same id never remove from each other; a null id is larger than any
    other; an empty table gives no rows; columns besides id and text are not read; words
    and texts of any length are taken whole.
    """
    count = G.group_count(docs, text_col, group_bytes)
    dealt = G.dealt(docs, id_col, text_col, count)
    schema = RESULT + (", kept_text string" if keep_text else "")

    def offer(table: pa.Table) -> pa.Table:
        return _Words(table, window).offer(table["gid"][0].as_py(), count)

    def widen(texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return packed({"bucket": np.zeros(0, np.int32), "gid": 0}, np.zeros(1, np.int64), np.zeros(0, np.uint8))
        words = _Words(texts, window)
        _, _, h1, h2, least = words.extended(G.known_keys(G.of_kind(replies, 0)), count)
        entries = np.empty(len(h1), _ENTRY)
        entries["h1"], entries["h2"], entries["least"] = h1, h2, least
        cuts = np.searchsorted(G.bucket_of(h1, count), np.arange(count + 1, dtype=np.uint64))
        return packed({"bucket": np.arange(count), "gid": texts["gid"][0].as_py()}, cuts, entries)

    def remove(texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table({k: [] for k in schema.replace(",", "").split()[::2]}, pa.schema([(k, pa.string() if t == "string" else pa.int64()) for k, t in (x.split() for x in schema.split(", "))]))
        words = _Words(texts, window)
        begin, which, h1, _, least = words.extended(G.known_keys(G.of_kind(replies, 0)), count)
        told = {b: p for b, p in zip(*(G.of_kind(replies, 1)[c].to_pylist() for c in ("bucket", "payload")))}
        elsewhere = np.zeros(len(h1), bool)
        bucket = G.bucket_of(h1, count)
        for b, bits in told.items():
            lo, hi = np.searchsorted(bucket, np.array([b, b + 1], np.uint64))
            elsewhere[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
        gone = begin[elsewhere[which] | (least[which] < words.ids[words.rows[begin]])] if len(begin) else begin
        edge = np.zeros(words.n + 1, np.int64)
        np.add.at(edge, gone, 1)
        np.add.at(edge, gone + window, -1)
        covered = np.cumsum(edge)[:-1] > 0
        return _kept(words, covered, keep_text)

    schema_offer = "bucket int, gid int, payload binary"
    probes = dealt.groupBy("gid").applyInArrow(offer, schema_offer)
    shared = probes.groupBy("bucket").applyInArrow(G.shared_keys, G.REPLY)
    windows = dealt.groupBy("gid").cogroup(shared.groupBy("gid")).applyInArrow(widen, schema_offer)
    earlier = windows.groupBy("bucket").applyInArrow(_least_elsewhere, G.REPLY)
    replies = shared.unionByName(earlier)
    return dealt.groupBy("gid").cogroup(replies.groupBy("gid")).applyInArrow(remove, schema)


def _kept(words: _Words, covered: np.ndarray, keep_text: bool) -> pa.Table:
    data = words.data.tobytes()
    sizes, removed, spans, hashes, texts = [], [], [], [], []
    for row, (a, b) in enumerate(zip(words.first_word, words.first_word[1:])):
        off = covered[a:b]
        n_off = int(off.sum())
        if n_off:
            stay = np.flatnonzero(~off) + a
            kept = b" ".join([data[s:e] for s, e in zip(words.begins[stay].tolist(), words.ends[stay].tolist())])
        else:
            kept = b" ".join(data[words.offsets[row] : words.offsets[row + 1]].split())
        sizes.append(int(b - a))
        removed.append(n_off)
        spans.append(int(off[:1].sum() + (off[1:] & ~off[:-1]).sum()))
        hashes.append(hashlib.sha256(kept).hexdigest())
        if keep_text:
            texts.append(kept.decode())
    ids = pa.array(words.ids, mask=words.ids == NULL_ID)
    columns = {"doc_id": ids, "n_words": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(hashes, pa.string())}
    return pa.table({**columns, "kept_text": pa.array(texts, pa.string())} if keep_text else columns)
