"""Substring, suffix-array, SimHash and line dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from stocktake.llm.components import components
from stocktake.llm.line_dedup import deduped, without_lines
from stocktake.llm.simhash_dedup import fingerprint, linked_fingerprints, near_duplicates
from stocktake.llm.substring_dedup import dedup_substrings
from stocktake.llm.suffix_dedup import dedup_bytes
from stocktake.llm.suffix_grouping import suffix_array

BIG = 1 << 62


@pytest.fixture(scope="module")
def corpus(prose):
    """Copies, shared passages, a hot passage, repeats inside a document, nulls, empty and very long texts."""
    passage, hot = prose(1, 60), prose(2, 52)
    rows = [(i, prose(100 + i, 40 + 7 * i)) for i in range(12)]
    rows += [(20, rows[3][1]), (21, rows[3][1] + " " + rows[5][1]), (22, prose(7, 30) + "\n" + passage + "\t" + prose(8, 30)), (23, passage)]
    rows += [(30 + i, f"{prose(200 + i, 5)} {hot} {prose(300 + i, 5)}") for i in range(8)]
    rows += [(50, None), (51, ""), (52, " \n "), (53, prose(9, 49)), (54, prose(9, 49)), (55, "é" * 60), (56, "ñ é" * 40 + "é" * 60)]
    rows += [(60, prose(10, 6000)), (61, prose(10, 6000)[5000:20000]), (62, passage + " " + passage), (62, passage), (None, passage), (None, "short")]
    return rows


def _key(i):
    return BIG if i is None else i


def _covered(units, least, i, window):
    gone = [False] * len(units)
    for s in range(len(units) - window + 1):
        if least[units[s : s + window]] < _key(i):
            gone[s : s + window] = [True] * window
    return gone


def _least(all_units, window):
    least = defaultdict(lambda: BIG)
    for i, units in all_units:
        for s in range(len(units) - window + 1):
            least[units[s : s + window]] = min(least[units[s : s + window]], _key(i))
    return least


def test_substring_dedup_is_exact(docs_of, corpus):
    split = [(i, tuple(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t in corpus]
    least, expected = _least(split, 50), []
    for i, words in split:
        gone = _covered(words, least, i, 50)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        expected.append((_key(i), len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = dedup_substrings(docs_of(corpus), group_bytes=4000).collect()
    assert sorted((_key(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(expected)
    assert sum(e[2] for e in expected) > 500


def test_suffix_dedup_is_exact(docs_of, corpus):
    raw = [(i, (t or "").encode()) for i, t in corpus]
    least, expected = _least(raw, 50), []
    for i, data in raw:
        gone = _covered(data, least, i, 50)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not h for g, h in zip(gone, [False, *gone]))
        expected.append((_key(i), len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = dedup_bytes(docs_of(corpus), group_bytes=4000).collect()
    assert sorted((_key(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(expected)


def test_substring_and_suffix_dedup_of_nothing(docs_of):
    assert dedup_substrings(docs_of([])).collect() == [] and dedup_bytes(docs_of([])).collect() == []


def test_outputs_of_substring_and_suffix_dedup(docs_of, prose):
    text = prose(5, 55)
    rows = [(1, text), (2, "before " + text + " after")]
    kept = {r.doc_id: r.kept_text for r in dedup_substrings(docs_of(rows), keep_text=True).collect()}
    assert kept == {1: text, 2: "before after"}
    # the blanks around the passage differ from the ends of the first document
    rest = {r.doc_id: bytes(r.kept) for r in dedup_bytes(docs_of(rows), keep_bytes=True).collect()}
    assert rest == {1: text.encode(), 2: b"before  after"}


def test_suffix_arrays_by_grouping():
    r = random.Random(3)
    for k in range(400):
        codes = [r.randint(1, r.randint(1, 4)) for _ in range(r.randint(0, 30))]
        codes = (codes[:4] * 6 if k % 4 == 0 else codes) + [0]
        assert suffix_array(np.array(codes)).tolist() == sorted(range(len(codes)), key=lambda i: codes[i:])
    assert suffix_array(np.zeros(0, np.int64)).tolist() == []


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [" ".join(words[a : a + 3]) for a in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def _roots(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_fingerprints_and_groups(docs_of, corpus, prose):
    long = prose(77, 900).split()
    near = [(400 + k, " ".join(w if i % 301 != k else "XX" for i, w in enumerate(long))) for k in range(12)]
    rows = [r for r in corpus if r[0] is not None and r[0] != 62] + near
    prints = {i: _fingerprint(t) for i, t in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    roots = _roots(prints, links)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(docs_of(rows)).collect()}
    assert got == {i: (f"{p:016x}", roots[i]) for i, p in prints.items()}
    assert any(roots[400 + k] == 400 for k in range(1, 12))
    assert near_duplicates(docs_of([])).collect() == []
    only_null = near_duplicates(docs_of([(None, "a"), (None, "a"), (3, "a")])).collect()
    assert {(r.doc_id, r.component_id) for r in only_null} == {(None, 3), (3, 3)}


def test_short_texts_have_one_shingle():
    for text in ("", "one", "One two", "one two three"):
        assert fingerprint(text.encode(), 3) % 2**64 == _fingerprint(text)


@pytest.mark.parametrize("slice_size", [200_000, 40], ids=["one task a block", "hot values in slices"])
def test_trie_finds_every_link(spark, slice_size):
    r = random.Random(5)
    prints = {r.getrandbits(64) for _ in range(300)}
    for seed in list(prints)[:40]:
        for _ in range(6):
            prints.add(seed ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 4))))
    hot = r.getrandbits(64)
    prints |= {(hot & (2**64 - 2**48)) | r.getrandbits(48) for _ in range(150)} | {hot ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    links = linked_fingerprints(spark.createDataFrame(signed, "fp long"), 3, slice_size).collect()
    assert all(((a ^ b) % 2**64).bit_count() >= 1 for a, b in links)
    found = _roots([p for (p,) in signed], links)
    array = np.array([p for (p,) in signed], np.int64).view(np.uint64)
    pairs = [(signed[i][0], signed[j][0]) for i in range(len(array)) for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 3).tolist() if i < j]
    assert found == _roots([p for (p,) in signed], pairs)


def test_components(spark):
    r = random.Random(6)
    links = [(i, i + 1) for i in range(0, 60)] + [(r.randint(100, 400), r.randint(100, 400)) for _ in range(180)] + [(7, 7), (500, 501)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    roots = _roots(nodes, [x for x in links if x[0] != x[1]])
    edges = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    assert {row.node: row.root for row in components(edges).collect()} == roots
    assert components(edges.limit(0)).collect() == []


def _lines(text):
    return [] if text is None else [x.strip(" \t\x0b\x0c\r") for x in text.split("\n")]


def _shingles(line, k=5):
    return {line[a : a + k] for a in range(max(1, len(line) - k + 1))}


def test_line_dedup_is_exact_here(docs_of, prose):
    base = [prose(500 + i, 12 + i) for i in range(10)]
    edited = [" ".join("changed" if j == 3 else w for j, w in enumerate(line.split())) for line in base]
    rows = [(1, "\n".join(base)), (2, "\n".join(edited)), (3, "Yes.\nNo.\n\nYes.\n  Yes. "), (4, None), (5, ""), (6, "\n\n"), (7, prose(9, 4000)), (None, base[0]), (8, base[0] + "\r\n" + prose(8, 20))]
    places = defaultdict(list)
    for i, text in rows:
        for n, line in enumerate(_lines(text)):
            if line:
                places[line].append((_key(i), n))
    lines = list(places)
    sets = [_shingles(x) for x in lines]
    links = [(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines)) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    roots, kept = _roots(range(len(lines)), links), defaultdict(lambda: (BIG, BIG))
    for a, line in enumerate(lines):
        kept[roots[a]] = min(kept[roots[a]], min(places[line]))
    gone = {(p, n) for a, line in enumerate(lines) for p, n in places[line] if (p, n) != kept[roots[a]]}
    got = deduped(docs_of(rows)).collect()
    assert {(_key(r.doc_id), n) for r in got for n in r.removed_lines} == gone and links
    assert {_key(r.doc_id): r.n_lines for r in got} == {_key(i): len(_lines(t)) for i, t in rows}
    texts = {_key(r.doc_id): r.text for r in without_lines(docs_of(rows)).collect()}
    for i, text in rows:
        stay = [x for n, x in enumerate(text.split("\n")) if (_key(i), n) not in gone] if text is not None else None
        assert texts[_key(i)] == (None if stay is None else "\n".join(stay))


def test_line_dedup_of_nothing(docs_of):
    assert deduped(docs_of([])).collect() == []
