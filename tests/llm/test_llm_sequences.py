"""Prefix tree, source audit and language model against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from __spark_entry__ import SMOKE_DIR
from pyspark.sql import functions as F

from stocktake.llm import language_model, queries, seating
from stocktake.llm.hashing import mix
from stocktake.llm.language_model import score_texts
from stocktake.llm.prefix_trie import prefix_trie, rebuilt, turns, whole
from stocktake.llm.source_audit import audit

# -- prefix tree -------------------------------------------------------------------


def _conversations(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clashing = ["conv", "place", "a", "b", "h", "chars", "part", "depth", "ka", "kb", "last", "ids", "weight", "leaf", "head"]
    return df.select("*", *(F.lit("other").alias(c) for c in clashing))


def _borrowed(conv):
    return zlib.crc32(str(conv).encode()) % 6


def _received(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    return {c: [x[3:] for x in sorted(v, key=lambda x: (x[0], x[1], x[2]))] for c, v in own.items()}


def _tree(sequences):
    members = defaultdict(list)
    for conv, turns_ in sequences.items():
        for d in range(len(turns_) + 1):
            members[tuple(turns_[:d])].append(conv)
    children = Counter(p[:-1] for p in members if p)
    rows = set()
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(sequences[c]) == len(path)))
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        parent = min(members[path[:-1]]) if path else None
        leaves = sum(1 for p in below if not children[p])
        rows.add((min(convs), len(path), parent, len(convs), children[path], leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def _random_conversations(seed, n):
    r = random.Random(seed)
    said = ["", "hello", "hello there", "how are you", "fine \U0001F600", "é", None, "x" * 5000]
    rows = []
    for _ in range(n):
        conv = r.choice([0, 100, 200, -100, 1, 2, 3, 7, 55, 101, 102, 150, 203, 204, 340, 341, -3, -150, 12345678901])
        rows.append((conv, r.choice([None, 0, 1, 2, 3, 4, 5]), r.choice(["user", "assistant", None, ""]), r.choice(said)))
    same = [(c, t, "user", f"turn {t % 2}") for c in range(400, 440) for t in range(c % 4)]
    return rows + same + [(None, 1, "user", "lost"), (9, 1, None, None), (9, 1, None, None)]


@pytest.mark.parametrize("seed", range(3))
def test_tree_of_rebuilt_conversations(spark, seed):
    rows = _random_conversations(seed, 60)
    received = _received(rows)
    built = {c: received.get(c - int(math.fmod(c, 100)), [])[: _borrowed(c)] + t[_borrowed(c) :] for c, t in received.items()}
    table = turns(_conversations(spark, rows))
    got = [tuple(x) for x in prefix_trie(rebuilt(table, 100, F.crc32(F.col("conv").cast("string")) % 6, 5)).collect()]
    assert set(got) == _tree(built) and len(got) == len(set(got))
    got = [tuple(x) for x in prefix_trie(whole(table)).collect()]
    assert set(got) == _tree(received) and len(got) == len(set(got))


def test_tree_without_conversations(spark):
    empty = turns(_conversations(spark, [(None, 1, "user", "lost")]))
    assert prefix_trie(whole(empty)).collect() == []
    one = [tuple(x) for x in prefix_trie(rebuilt(turns(_conversations(spark, [(1, 1, "user", "gone")])), 100, F.lit(5), 5)).collect()]
    assert one == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]


def test_ends_of_a_large_group_are_in_order(spark):
    ids = list(range(-5000, 9000, 3))
    got = prefix_trie(whole(turns(_conversations(spark, [(c, 0, "user", "same") for c in reversed(ids)])))).orderBy("depth").collect()
    assert [x.n_convs for x in got] == [len(ids)] * 2
    assert got[1].ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and got[1].saved_tokens == 4 * (len(ids) - 1)


# -- source audit ------------------------------------------------------------------


def _audit(rows, least, top):
    groups, seen, in_docs = set(), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        seen[lang, source].update(terms)
        in_docs[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        sources = [s for g, s in groups if g == lang]
        counts = {s: seen[lang, s] for s in sources}
        counts[None] = sum(counts.values(), Counter())
        total = {s: sum(c[t] for t in kept) for s, c in counts.items()}
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (total[s] + 2 * len(kept)) for t in kept} for s, c in counts.items()}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            more = [(-((p[s][t] - p[None][t]) ** 2 // (p[s][t] + p[None][t])), t.encode()) for t in kept if counts[s][t] and p[s][t] > p[None][t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(more)[:top])):
                out |= {(lang, s, part, item.decode(), -value, i) for i, (value, item) in enumerate(ranked, 1)}
    return out


def _audited(spark, rows, **options):
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    clashing = ["digest", "term", "n", "docs", "split", "place", "v", "total", "value", "rank", "doc_id"]
    got = [tuple(x) for x in audit(df.select("*", *(F.lit("other").alias(c) for c in clashing)), **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("bits", [64, 4])
def test_audit_is_exact_whatever_the_digests(spark, bits):
    r = random.Random(bits)
    vocabulary = ["Ärger", "ärger", "the", "The", "THE", "a1b", "naïve", "x", "東京", "don't", "e-mail", "zeta", "eta", "theta", "iota", "É"]
    rows = [(r.choice(["en", "de", None]), r.choice(["s1", "s2", "s2", "s2", "s3", ""]), " ".join(r.choices(vocabulary, k=r.randrange(12)))) for _ in range(200)]
    rows += [("en", "s9", None), ("en", "s8", "12 ... 34"), ("en", "s7", "once only"), ("fr", "alone", "seul"), ("fr", "other", ""), (None, None, None)]
    rows += [("en", "s1", "long " * 20000)] * 3
    got = _audited(spark, rows, least_docs=5, top=4, digest_bits=bits)
    assert got == _audit(rows, 5, 4) and len(got) > 60


def test_audit_of_ties_and_of_nothing(spark):
    rows = [("en", s, " ".join(f"w{chr(97 + i)}" for i in range(20))) for s in ("a", "b") for _ in range(3)] + [("en", "c", "wa wb"), ("en", "c", "wa")]
    assert _audited(spark, rows, least_docs=2, top=3) == _audit(rows, 2, 3)
    assert _audited(spark, [], least_docs=2) == set()


# -- language model ----------------------------------------------------------------


def _key(context, dish):
    h = [np.array([xxhash.xxh3_64_intdigest(w.encode())], np.uint64) for w in (context, dish)]
    return mix(h[0] ^ mix(h[1], 31), 32)


def _one_by_one(customers, new, discount, key, sweep):
    """Tables of one dish, its customers seated one after the other, as long as the operator does not jump."""
    assert customers <= seating.SINGLY
    tables = min(customers, 1)
    for k in range(1, customers):
        join = k - discount * tables
        if float(seating.uniforms(key, sweep, k)[0]) * (join + new) < new:
            tables += 1
    return tables


def _discount(counts):
    once, twice = sum(c == 1 for c in counts), sum(c == 2 for c in counts)
    return min(max(once / max(once + 2 * twice, 1), 0.05), 0.95)


def _model(texts, sweeps=3, unused=1):
    """Probability of a word after a word, by dictionaries; checked to sum to one."""
    pairs, words = Counter(), Counter()
    for text in texts:
        said = [" begin", *_words(text), " end"]
        pairs.update(zip(said, said[1:]))
        words.update(said[1:])
    size = len(words)
    follows = Counter()
    for (u, _), n in pairs.items():
        follows[u] += n
    d, tables, samples = _discount(pairs.values()), {p: 1 for p in pairs}, []
    parent_d, seats, state = 0.0, None, None
    for sweep in range(sweeps + 1):
        if state:
            tables = {(u, w): _one_by_one(n, state[0](u) * state[1](w), d, _key(u, w), sweep) for (u, w), n in pairs.items()}
        own, customers = Counter(), Counter()
        for (u, w), t in tables.items():
            own[u] += t
            customers[w] += t
        if seats is None:
            seats = {w: 1 for w in customers}
            parent_d = _discount(customers.values())
        else:
            weight = (1.0 + parent_d * sum(seats.values())) / (size + 1)
            seats = {w: _one_by_one(c, weight, parent_d, mix(np.array([xxhash.xxh3_64_intdigest(w.encode())], np.uint64), 51), sweep) for w, c in customers.items()}
        spread = (1.0 + parent_d * sum(seats.values())) / (size + 1)
        parent = lambda w, c=customers, s=dict(seats), x=spread: (c[w] - parent_d * s.get(w, 0) + x) / (1.0 + c.total())
        strength = lambda u, o=own: 1.0 + d * o[u]
        state = (strength, parent)
        if sweep > unused:
            samples.append((dict(tables), *state))

    def likely(u, w):
        return sum((pairs[u, w] - d * t.get((u, w), 0) + a(u) * p(w)) / (1.0 + follows[u]) for t, a, p in samples) / len(samples)

    for u in [*list(words)[:5], " begin", "never seen"]:
        assert abs(sum(likely(u, w) for w in [*words, "unknown"]) - 1) < 1e-9
    return likely, words


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _scored(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    clashing = ["gid", "bucket", "ids", "held", "codes", "words", "tokens", "counts", "a", "b", "c"]
    return score_texts(df.select("*", *(F.lit("other").alias(c) for c in clashing)), F.col("kind") == "test", **options)


def test_scores_are_those_of_the_model(spark):
    r = random.Random(2)
    vocabulary = ["the", "The", "river", "stone", "Ünder", "ünder", "green", "a", "of", "light", " x", "!"]
    rows = [(i, " ".join(r.choices(vocabulary, weights=range(17, 5, -1), k=r.randrange(9))), r.choice(["train", "train", "test", None])) for i in range(30)]
    rows += [(90, None, "train"), (91, "", "test"), (92, " \t\n", "train"), (93, "never seen before", "test"), (None, "the river", None), (90, "the stone", "train"), (94, "the\x0briver\x0cof\rstone", "test")]
    likely, words = _model([t for _, t, k in rows if k != "test"])
    expected = []
    for i, text, kind in rows:
        said = [" begin", *_words(text), " end"]
        base = sum(math.log10((words[w] + 1) / (words.total() + len(words) + 1)) for w in said[1:])
        score = sum(math.log10(likely(u, w)) for u, w in zip(said, said[1:]))
        expected.append((i if i is not None else -1, kind == "test", len(said) - 1, sum(w in words for w in said[1:]), words.total(), round(base, 6), round(score, 6)))
    for options in ({}, {"chunk_bytes": 200, "bucket_pairs": 20}):
        got = [(x.doc_id if x.doc_id is not None else -1, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6), round(x.score, 6)) for x in _scored(spark, rows, **options).collect()]
        assert sorted(got) == sorted(expected)


def test_all_words_of_a_long_batch_are_counted(spark, prose):
    rows = [(i, f"{prose(i, i % 9)} Only{i}", "test" if i % 7 == 2 else "train") for i in range(1300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string").coalesce(1)  # chunks take a batch in slices
    said = {i: [*_words(text), " end"] for i, text, _ in rows}
    counts = Counter(w for i, _, kind in rows if kind == "train" for w in said[i])
    expected = [(i, kind == "test", len(said[i]), sum(w in counts for w in said[i]), counts.total(), round(sum(math.log10((counts[w] + 1) / (counts.total() + len(counts) + 1)) for w in said[i]), 6)) for i, _, kind in rows]
    got = score_texts(df, F.col("kind") == "test", sweeps=1, unused=0).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6))
    assert sorted(map(tuple, got.collect())) == expected


def test_chunks_hold_little_text_and_seat_without_a_pair_per_token(spark, prose):
    assert language_model.CHUNK_BYTES <= 20 << 20  # what a task holds follows from it
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": [prose(i, 60) for i in range(3)], "held_out": [False, True, False]})
    chunk = next(language_model._rows(language_model._chunk([batch], 7)))
    whole, lean = language_model._Texts(chunk, 3), language_model._Texts(chunk, 3)
    whole.find_pairs(3)
    lean.find_pairs(3, of_tokens=False)
    assert not hasattr(lean, "pair")
    for name in ("keys", "context", "dish", "pair_cuts"):
        assert np.array_equal(getattr(whole, name), getattr(lean, name))
    assert np.array_equal(whole.context[whole.pair], whole.before) and np.array_equal(whole.dish[whole.pair], whole.word)


def test_pairs_are_seated_by_their_owners_only():
    # popular pairs are in every chunk: a chunk that scores must not seat them again
    assert "seat" not in language_model._score.__code__.co_names


def test_scores_without_texts_to_learn_from(spark):
    got = _scored(spark, [(1, "all held out", "test"), (2, None, "test")]).collect()
    assert sorted((x.doc_id, x.n_tokens, x.n_known, x.train_tokens, x.base_score, x.score) for x in got) == [(1, 4, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert _scored(spark, []).collect() == []
    with pytest.raises(ValueError):
        _scored(spark, [], sweeps=1, unused=1)


def test_held_out_prose_is_likelier_than_by_single_words(spark, prose):
    rows = [(i, " ".join([f"so it begins {prose(i % 40, 30)}", "x" * 3000 if i == 5 else "and ends"]), "test" if i % 7 == 2 else "train") for i in range(300)]
    test = _scored(spark, rows).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert test[0] > 0.7 * test[1]


def test_seating_by_jumps_has_the_distribution_of_single_steps():
    n, keys = 20000, mix(np.arange(20000, dtype=np.uint64), 3)
    for customers, new, discount in [(200, 0.7, 0.8), (900, 5.0, 0.5), (26, 0.02, 0.75)]:
        jumps = seating.seat(np.full(n, customers), np.full(n, new), discount, keys, 1)
        tables = np.ones(n)
        for k in range(1, customers):
            join = k - discount * tables
            tables += seating.uniforms(keys, 2, k) * (join + new) < new
        assert abs(jumps.mean() - tables.mean()) < 5 * tables.std() * (2 / n) ** 0.5 + 1e-9
        assert abs(jumps.std() - tables.std()) < 0.05 * tables.std() + 1e-9
    x = np.array([0.2, 1.0, 3.7, 9.0, 1234.5])
    assert np.allclose(seating.log_gamma(x), [math.lgamma(v) for v in x], atol=1e-9)


# -- registered queries ------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_source_audit"])
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMOKE_DIR}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SMOKE_DIR)
    columns = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(repr(r) for r in con.sql(f"SELECT {quoted} FROM ({queries.ORACLE[name]})").fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == theirs and theirs
