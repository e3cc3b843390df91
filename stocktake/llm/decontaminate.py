"""Benchmark decontamination: SimHash windows of the items' sizes, multi-index Hamming search, exact check.

Words are runs of letters and digits, lower case for A-Z. A window has as many
words as an item, and both are bags of shingles of five words (of all words,
where there are fewer). Windows that hold too few shingles of items of their
size to be similar are passed over; the others get a SimHash. Item fingerprints
are indexed by blocks of bits with all their neighbours, so that every item
within ``RADIUS`` bits of a window is found; for these the weighted Jaccard
similarity of the bags decides. A text with fewer words than an item, but so many
that it can be similar, is one window as a whole, and its bag is compared with the
items' without a SimHash.

The benchmark is a query set, taken in passes of a bounded number of items; the
documents are read once per pass and never shuffled.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.hashing import _BYTE_CODES, in_sorted, rolling_hashes, span_hashes, text_bytes

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BLOCKS = 4
BLOCK_FLIPS = 4
#: If no block differs in BLOCK_FLIPS bits or fewer, at least this many bits and one differ.
RADIUS = BLOCKS * (BLOCK_FLIPS + 1) - 1
ITEMS_PER_PASS = 1_000
SLICE_BYTES = 2 << 20
RESULT = "doc_id long, item_id long, similarity double, first_word long, n_words long, n_windows long"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_INSIDE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code and row of every word."""
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    begins = np.flatnonzero(begin)
    codes = span_hashes(_BYTE_CODES[_FOLD[data]], begins, np.flatnonzero(end) + 1, 21)
    return codes, np.searchsorted(offsets, begins, "right") - 1


def _flips() -> np.ndarray:
    """All changes of at most BLOCK_FLIPS bits of a block."""
    width = 64 // BLOCKS
    sets = itertools.chain.from_iterable(itertools.combinations(range(width), k) for k in range(BLOCK_FLIPS + 1))
    return np.array([sum(1 << i for i in s) for s in sets], np.uint64)


def _fingerprints(shingles: np.ndarray, begins: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of ``size`` shingles: a bit is set if more than half of them have it."""
    bits = np.unpackbits(shingles.byteswap().view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    over = 2 * (sums[begins + size] - sums[begins]) > size
    return np.packbits(over, axis=1).view(">u8").ravel().astype(np.uint64)


class Items:
    """One pass' items: their bags, and the index of their fingerprints."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        codes, rows = _words(data, offsets)
        cuts = np.searchsorted(rows, np.arange(len(ids) + 1))
        self.ids, self.bags, self.sizes, self.widths, prints = [], [], [], [], []
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a == b:
                continue
            width = int(min(SHINGLE_WORDS, b - a))
            shingles = rolling_hashes(codes[a:b], width, 22)
            self.ids.append(ids[i])
            self.bags.append(Counter(shingles.tolist()))
            self.sizes.append(len(shingles))
            self.widths.append(width)
            prints.append(_fingerprints(shingles, np.zeros(1, np.int64), len(shingles))[0])
        self.prints = np.array(prints, np.uint64)
        self.alike: dict[tuple[int, int], list[int]] = {}
        for i, kind in enumerate(zip(self.widths, self.sizes)):
            self.alike.setdefault(kind, []).append(i)
        self.kinds: dict[int, dict[int, np.ndarray]] = {}
        for bag, size, width in zip(self.bags, self.sizes, self.widths):
            by_size = self.kinds.setdefault(width, {})
            by_size[size] = np.union1d(by_size.get(size, np.zeros(0, np.uint64)), np.array(list(bag), np.uint64))
        self.every = {w: reduce(np.union1d, by_size.values()) for w, by_size in self.kinds.items()}
        self.index = []
        flips, width = _flips(), 64 // BLOCKS
        for block in range(BLOCKS if len(prints) else 0):
            keys = (self._block(self.prints, block)[:, None] ^ flips).ravel()
            order = np.argsort(keys, kind="stable")
            self.index.append((keys[order], order // len(flips)))
        assert width * BLOCKS == 64

    @staticmethod
    def _block(prints: np.ndarray, block: int) -> np.ndarray:
        width = 64 // BLOCKS
        return (prints >> np.uint64(block * width)) & np.uint64((1 << width) - 1)

    def within_radius(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (place in ``prints``, item) that differ in RADIUS bits or fewer."""
        pairs = []
        for block, (keys, items) in enumerate(self.index):
            mine = self._block(prints, block)
            low, high = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
            counts = high - low
            place = np.repeat(np.arange(len(prints)), counts)
            item = items[np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
            near = np.bitwise_count(prints[place] ^ self.prints[item]) <= RADIUS
            pairs.append(place[near] * len(self.prints) + item[near])
        both = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        return both // max(1, len(self.prints)), both % max(1, len(self.prints))


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of the lesser counts by sum of the greater ones."""
    common = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return common / (a.total() + b.total() - common)


def _found(items: Items, data: np.ndarray, offsets: np.ndarray, similarity: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, similarity, first word in the row, words) of every similar window."""
    codes, rows = _words(data, offsets)
    first_word = np.searchsorted(rows, np.arange(len(offsets)))
    for width, by_size in items.kinds.items():
        shingles = rolling_hashes(codes, width, 22)
        known = np.flatnonzero(in_sorted(shingles, items.every[width]))
        if len(known):
            yield from _shorter(items, shingles, known, first_word, width, similarity)
        for size, own in by_size.items():
            if not len(known):
                break
            hits = known[in_sorted(shingles[known], own)]
            words = size + width - 1
            # of two bags of this size, the common part must be so large
            needed = _needed(size, size, similarity)
            if len(hits) < needed:
                continue
            # a window begins at most size - 1 places before a hit
            begins = _near(hits, size)
            begins = begins[(begins >= 0) & (begins + words <= len(codes))]
            begins = begins[rows[begins] == rows[begins + words - 1]]
            begins = begins[np.searchsorted(hits, begins + size) - np.searchsorted(hits, begins) >= needed]
            for part in np.array_split(begins, len(begins) // 20_000 + 1):
                if len(part):
                    yield from _verified(items, shingles, rows, first_word, part, size, width, similarity)


def _needed(size: int, other: int, similarity: float) -> int:
    """How many shingles two bags of these sizes have in common at least, if they are similar."""
    return max(1, math.ceil((size + other) * similarity / (1 + similarity) - 1e-9))


def _shorter(items: Items, shingles: np.ndarray, known: np.ndarray, first_word: np.ndarray, width: int, similarity: float) -> Iterator[tuple[int, int, float, int, int]]:
    """Of the rows with fewer words than an item, those that are similar to it as a whole."""
    by_size = items.kinds[width]
    sizes = np.maximum(np.diff(first_word) - width + 1, 0)
    hits = np.searchsorted(known, first_word[:-1] + sizes) - np.searchsorted(known, first_word[:-1])
    # the next larger size asks for the fewest common shingles
    likely = (sizes > 0) & (sizes < max(by_size)) & (hits >= (2 * sizes + 1) * similarity / (1 + similarity) - 1e-9)
    for row in np.flatnonzero(likely).tolist():
        own = int(sizes[row])
        mine = shingles[first_word[row] : first_word[row] + own]
        bag = Counter(mine.tolist())
        for size, theirs in by_size.items():
            if own < size and own >= similarity * size - 1e-9 and np.count_nonzero(in_sorted(mine, theirs)) >= _needed(own, size, similarity):
                for item in items.alike[width, size]:
                    found = weighted_similarity(bag, items.bags[item])
                    if found >= similarity:
                        yield row, item, found, 0, own + width - 1


def _near(hits: np.ndarray, size: int) -> np.ndarray:
    """All places from ``size - 1`` before a hit up to the hit, once."""
    gap = np.minimum(np.diff(hits, prepend=hits[0] - size), size)
    at = np.repeat(hits - gap + 1, gap)
    return at + np.arange(len(at)) - np.repeat(np.cumsum(gap) - gap, gap)


def _verified(items: Items, shingles: np.ndarray, rows: np.ndarray, first_word: np.ndarray, begins: np.ndarray, size: int, width: int, similarity: float) -> Iterator[tuple[int, int, float, int, int]]:
    used = _near(begins + size - 1, size)  # all shingles of the windows, in order
    prints = _fingerprints(shingles[used], np.searchsorted(used, begins), size)
    bags: dict[int, Counter] = {}
    for place, item in zip(*(x.tolist() for x in items.within_radius(prints))):
        if items.sizes[item] != size or items.widths[item] != width:
            continue
        begin = int(begins[place])
        if place not in bags:
            bags[place] = Counter(shingles[begin : begin + size].tolist())
        found = weighted_similarity(bags[place], items.bags[item])
        if found >= similarity:
            row = int(rows[begin])
            yield row, item, found, begin - int(first_word[row]), size + width - 1


def row_slices(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about ``size`` bytes."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, b
        a = b


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """One row per document and item found in it: the best window, and how many windows are similar.

    Windows of an item's number of words count from a weighted Jaccard
    similarity of ``similarity`` on; of equally good ones the first is given. A
    text with fewer words than the item is one window.
    Null and empty texts and items have no words and match nothing; repeated
    rows of documents are reported each, repeated items too; null ids are kept;
    an empty table on either side gives no rows; other columns are not read.
    """
    items = benchmark.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("item_text"))
    passes = max(1, -(-items.count() // items_per_pass))
    only = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = []
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "item_text"), F.lit(passes)) == k).orderBy("item_id", "item_text").collect()
        found.append(_one_pass(only, Items([r["item_id"] for r in part], [r["item_text"] for r in part]), similarity))
    return reduce(DataFrame.unionAll, found)


def _one_pass(docs: DataFrame, items: Items, similarity: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            data, offsets = text_bytes(batch.column("text"))
            best: dict[tuple[int, int], list] = {}
            for a, b in row_slices(offsets, SLICE_BYTES):
                for row, item, found, word, words in _found(items, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], similarity):
                    now = best.setdefault((a + row, item), [found, word, words, 0])
                    now[3] += 1
                    if (-found, word) < (-now[0], now[1]):
                        now[:2] = found, word
            rows = [(ids[row], items.ids[item], *found) for (row, item), found in best.items()]
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "item_id", "similarity", "first_word", "n_words", "n_windows"])

    return docs.mapInArrow(search, RESULT)
