"""BPE encoding and decoding with a transducer lexicon of frequent words.

The corpus' most frequent words are compiled, with their ids, into a minimal
acyclic transducer. It is broadcast (its size is bounded by ``lexicon_words``),
written once per executor into a file of the worker's own and memory-mapped by
all workers there. Words that it doesn't hold are merged by the ranked pairs of
the vocabulary file, exactly. Ids decode through the vocabulary.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import sys
import tempfile
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.transducer import Transducer, build

LEXICON_WORDS = 65_536
MEMO_WORDS = 600_000
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Up to here the pattern and case tables of Python and of the vocabulary's library agree.
_PLAIN = regex.compile("[^\u0000-ӿ]")
_IDS = np.dtype("<u4")


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


def _spelled_out(pattern: str) -> str:
    """The pattern for plain texts, with its classes as lists of letters, for the faster engine."""
    plain = [chr(c) for c in range(0x500)]

    def listed(name: str) -> str:
        out, members = "", [c for c in plain if regex.match(name, c)]
        for c in members:
            ends = ord(c) - 1 < 0 or chr(ord(c) - 1) not in members, chr(ord(c) + 1) not in members
            out += (re.escape(c) if ends[0] else "") + ("-" if ends == (True, False) else "") + (re.escape(c) if ends == (False, True) else "")
        return out

    classes = {name: listed(name) for name in (r"\s", r"\p{L}", r"\p{N}")}
    spelled = re.sub(r"\[\^?[^\]]*\]", lambda m: re.sub(r"\\s|\\p\{[LN]\}", lambda c: classes[c[0]], m[0]), pattern)
    return spelled


class Vocabulary:
    """A vocabulary file of byte-level BPE with word ends: splitting, merging and the way back."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.path, self.ids = path, model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.letters = _byte_letters()
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pairs, self.merged = {}, []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.pairs[self.ids[a], self.ids[b]] = rank
            self.merged.append(self.ids[a + b])
        self.merged.append(-1)  # for the rank of pairs that don't merge
        self.inner, self.last = ([self.ids[x + end] for x in self.letters] for end in ("", self.end))
        self.plain = re.compile(_spelled_out(split["pattern"]["Regex"]))
        self.tokens = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, i in {**self.ids, **self.special}.items():
            self.tokens[i] = token
        self._library = None

    def words(self, text: str) -> list[str]:
        """Normal form, then the pieces that the pattern matches; special tokens must be cut out before."""
        if _PLAIN.search(text):
            return self._library_words(text)
        # the pattern matches no white space, so the normal form of that makes no difference
        return self.plain.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def _library_words(self, text: str) -> list[str]:
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        text = self._library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[str]:
        """The text cut at special tokens, which stand at the odd places."""
        return self._special.split(text) if self._special and "<" in text else [text]

    def merge(self, word: str) -> list[int]:
        """The ids of one word: always the pair of least rank first, the leftmost of equal ones."""
        raw = word.encode()
        row = [self.inner[b] for b in raw[:-1]]
        row.append(self.last[raw[-1]])
        if len(row) > 64:
            return self._merge_long(row)
        find, merged, never = self.pairs.get, self.merged, len(self.merged) - 1
        ranks = [find(pair, never) for pair in zip(row, row[1:])]
        while ranks:
            rank = min(ranks)
            if rank == never:
                break
            i = ranks.index(rank)
            row[i : i + 2] = [merged[rank]]
            del ranks[i]
            if i:
                ranks[i - 1] = find((row[i - 1], row[i]), never)
            if i < len(ranks):
                ranks[i] = find((row[i], row[i + 1]), never)
        return row

    def _merge_long(self, row: list[int]) -> list[int]:
        """The same with a heap of pairs, for very long words."""
        n = len(row)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := self.pairs.get((row[i], row[j]))) is not None:
                heapq.heappush(heap, (rank, i, row[i], row[j], self.merged[rank]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            if row[i] != a or j >= n or row[j] != b:
                continue
            row[i], row[j] = merged, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in row if x >= 0]

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by blanks, as the library does for a vocabulary without a decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


_VOCABULARIES: dict[str, Vocabulary] = {}
_MEMOS: dict[str, dict] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


class _Memo(dict):
    """Ids in bytes by word: from the mapped lexicon, else merged; forgets all when full."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Transducer):
        self.vocabulary, self.lexicon = vocabulary, lexicon

    def __missing__(self, word: str) -> bytes:
        ids = self.lexicon.get(word.encode())
        if ids is None:
            ids = self.vocabulary.merge(word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = found = _packed(ids)
        return found


def _packed(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


def _mapped(flat: bytes) -> mmap.mmap:
    """The lexicon as a mapped file; written once per folder of temporary files, found by its digest."""
    path = os.path.join(tempfile.gettempdir(), f"lexicon-{hashlib.sha256(flat).hexdigest()}")
    if not os.path.exists(path):
        with tempfile.NamedTemporaryFile(dir=tempfile.gettempdir(), delete=False) as file:
            file.write(flat)
        os.replace(file.name, path)
    with open(path, "rb") as file:
        return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)


def encode(vocabulary: Vocabulary, memo: dict[str, bytes], text: str) -> np.ndarray:
    out = []
    for i, piece in enumerate(vocabulary.pieces(text)):
        if i % 2:
            out.append(_packed([vocabulary.special[piece]]))
        elif piece:
            out += map(memo.__getitem__, vocabulary.words(piece))
    return np.frombuffer(b"".join(out), _IDS)


def lexicon(docs: DataFrame, vocabulary_path: str, text_col: str = "text", size: int = LEXICON_WORDS) -> bytes:
    """The flat transducer of the ``size`` most frequent words, counted over all texts; ties go by word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, seen = _vocabulary(vocabulary_path), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for piece in vocabulary.pieces(text or "")[::2]:
                    seen.update(vocabulary.words(piece))
                if len(seen) > MEMO_WORDS:
                    yield pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())})
                    seen = Counter()
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    words = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "word string, n long")
    top = words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(size).select("word").toLocalIterator()
    vocabulary = _vocabulary(vocabulary_path)
    return build((w, tuple(vocabulary.merge(w.decode()))) for w in sorted(row[0].encode() for row in top))


def encode_decode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = LEXICON_WORDS, outputs: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row; with ``outputs`` also ``ids`` and ``decoded``.

    Null and empty texts have no ids; strings of special tokens in a text become
    these tokens; repeated rows and null ids are kept as they are; an empty table
    gives no rows; columns besides id and text are not read. ``vocabulary_path``
    must be readable on every executor.
    """
    session = docs.sparkSession
    flat = session.sparkContext.broadcast(lexicon(docs, vocabulary_path, text_col, lexicon_words))
    schema = RESULT + (", ids array<long>, decoded string" if outputs else "")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(vocabulary_path)
        key = f"{vocabulary_path}:{hashlib.sha256(flat.value).hexdigest()}"
        if key not in _MEMOS:
            _MEMOS.clear()
            _MEMOS[key] = _Memo(vocabulary, Transducer(_mapped(flat.value)))
        memo = _MEMOS[key]
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                ids = encode(vocabulary, memo, text or "")
                decoded = vocabulary.decode(ids)
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), *((ids, decoded) if outputs else ())))
            columns = list(zip(*rows)) or [()] * (5 if outputs else 3)
            out = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(columns[0], pa.int64()), "ids_sha256": pa.array(columns[1], pa.string()), "decoded_sha256": pa.array(columns[2], pa.string())}
            if outputs:
                out |= {"ids": pa.array([x.astype(np.int64) for x in columns[3]], pa.list_(pa.int64())), "decoded": pa.array(columns[4], pa.string())}
            yield pa.RecordBatch.from_pydict(out)

    only = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return only.mapInArrow(code, schema)
