"""Decontamination, quality rules, toxicity, pseudonyms, archives and BPE against brute force, round trips and held-out rows."""

from __future__ import annotations

import base64
import datetime
import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stocktake.llm import bpe_codec, toxicity
from stocktake.llm.decontaminate import leaks
from stocktake.llm.pii import pseudonymised
from stocktake.llm.quality_rules import judged
from stocktake.llm.transducer import Transducer, build
from stocktake.llm.warc import capture_index, merged, url_key

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# -- decontamination ---------------------------------------------------------------


def _bag_words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _similar_windows(docs, items):
    out = {}
    for d, text in docs:
        words = _bag_words(text)
        for i, item in items:
            own = _bag_words(item)
            width = min(5, len(own))
            bag = Counter(tuple(own[a : a + width]) for a in range(len(own) - width + 1)) if own else None
            for a in range(len(words) - len(own) + 1) if own else ():
                window = Counter(tuple(words[b : b + width]) for b in range(a, a + len(own) - width + 1))
                common = sum((window & bag).values())
                s = common / (window.total() + bag.total() - common)
                if s >= 0.8:
                    best, at, n = out.get((d, i), (0, 0, 0))
                    out[d, i] = (s, a, n + 1) if s > best else (best, at, n + 1)
    return out


def test_leaks_are_all_similar_windows(spark, docs_of, prose):
    r = random.Random(4)
    items = [(i, prose(900 + i, 20 + 3 * i)) for i in range(8)] + [(20, "two words"), (21, None), (22, " .. "), (23, prose(900, 20))]
    docs = []
    for k in range(40):
        words = items[k % 8][1].split()
        for _ in range(k % 4):
            j = r.choice([0, 1, len(words) - 1, r.randrange(len(words))])
            words[j] = r.choice(["zz", words[j] + " more", words[j].upper() + "!"])
        docs.append((k, prose(k, 9) + " " + " ".join(words) + ". " + prose(k + 50, 9)))
    docs += [(90, None), (91, ""), (92, "some two, words"), (93, prose(3, 5000) + " " + items[2][1])]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("other"))
    got = {(x.doc_id, x.item_id): (x.similarity, x.first_word, x.n_windows) for x in leaks(docs_of(docs), table, items_per_pass=5).collect()}
    assert got == _similar_windows(docs, items) and len(got) > 30
    assert leaks(docs_of([]), table).collect() == [] and leaks(docs_of(docs), table.limit(0)).collect() == []
    repeated = leaks(docs_of([(1, items[0][1]), (1, items[0][1]), (None, items[0][1])]), table).collect()
    assert Counter(x.doc_id for x in repeated) == {1: 4, None: 2}  # item 23 is item 0 again


# -- quality rules -----------------------------------------------------------------


def test_quality_metrics_and_verdicts(docs_of, prose):
    clean = "\n".join(prose(i, 30).capitalize() + "." for i in range(4))
    texts = [
        clean, None, "", " \n\t", "too short.", clean + "\n" + clean, "thor " * 80, clean + "\nHome | News | About | Contact | Login |",
        " ".join(w + "***" for w in prose(1, 90).split()), "\n".join("SHOUT NOW!! " * 20 for _ in range(3)), "a | b | c | " * 30,
        clean + "\nWe use cookies. All rights reserved.", "a b c x a b c", "b\r\na\r\na\r\n", "a #*$%&|<> ü x", prose(6, 8000) + ".",
    ]
    got = {r.doc_id: r.quality for r in judged(docs_of(enumerate(texts))).collect()}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = list(zip(words, words[1:], words[2:]))
        counts, inside = Counter(windows), set()
        for a, window in enumerate(windows):
            if counts[window] > 1:
                inside |= {a, a + 1, a + 2}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        base = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        q = got[i]
        assert (q.n_words, q.word_chars, q.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")))
        assert (q.n_dup_lines, q.n_repeat_words, q.base_failed) == (len(lines) - len(set(lines)), len(inside), base)
        assert not (base and q.kept)
    assert [i for i in got if got[i].kept] == [0, 7, 11, 15]
    assert got[7].clean_text == got[11].clean_text == clean
    assert judged(docs_of([])).collect() == []


# -- toxicity ----------------------------------------------------------------------


def _segments_by_definition(scores):
    if not scores:
        return []
    sums = np.concatenate([[0], np.cumsum(scores)])
    best = max(((round(sums[j] - sums[i], 9), i - j, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)))
    if best[0] <= 1e-9:
        return []
    _, _, i, j = best
    right = [(s, a + j, b + j) for s, a, b in _segments_by_definition(scores[j:])]
    return [*_segments_by_definition(scores[:i]), (round(sums[j] - sums[i], 6), i, j - 1), *right]


def test_maximal_segments():
    r = random.Random(1)
    for _ in range(200):
        n = r.randint(1, 14)
        hits = [(i, r.choice([0.35, 1.21, 2.03])) for i in range(n) if r.random() < 0.4]
        scores = [dict(hits).get(i, -0.37) for i in range(n)]
        assert [(round(s, 6), a, b) for s, a, b in toxicity.segments(hits, 0.37)] == _segments_by_definition(scores)


def test_tokens_are_all_runs_of_letters():
    r = random.Random(5)
    alphabet = [*map(chr, range(0x250)), *" aZé_5²½٣\u2014\u3000\u0130\u1e9e語\U00010400\U0001f600\u0301"]
    texts = ["".join(r.choices(alphabet, k=r.randrange(40))) for _ in range(4000)] + ["Plain, OLD_text 2x", "só letras é", "a\x1cb\x85c\xa0d", "", None]
    assert [toxicity.tokens(t) for t in texts] == [re.findall(r"[^\W\d_]+", (t or "").lower()) for t in texts]
    assert toxicity.tokens("a" * 200_000 + "é2" * 200_000)[1:] == ["é"] * 199_999


def test_tokens_of_plain_letters_need_no_pattern(monkeypatch):
    monkeypatch.setattr(toxicity, "_TOKEN", None)
    assert toxicity.tokens("Plain, OLD_text 2x") == ["plain", "old", "text", "x"]
    assert toxicity.tokens("Só letras; é") == ["só", "letras", "é"]


def test_toxicity_on_rows_held_out(spark, docs_of, prose):
    r = random.Random(2)
    bad, rows, labels = ["scum", "vermin", "filth", "trash"], [], []
    for i in range(600):
        words = prose(1000 + i, r.randint(20, 200)).split()
        toxic = i % 7 == 0
        for _ in range(max(2, len(words) // 25) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(bad) + r.choice([".", "", ","]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(700, None), (701, ""), (702, "Scum! SCUM scum vermin " * 4000), (None, "scum vermin filth"), (703, "x")]
    table = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int").withColumn("text", F.lit("other"))
    held_out = {x.doc_id for x in docs_of(rows).where(toxicity.fold(F.col("doc_id")) == 0).collect()}
    model = toxicity.train(docs_of(rows), table.where(toxicity.fold(F.col("doc_id")) != 0))
    got = {x.doc_id: x for x in toxicity.score(docs_of(rows), model).collect()}
    truth = dict(labels)
    tested = [(truth[i], got[i].score >= 0.5) for i in truth if i in held_out]
    assert len(tested) > 80 and np.mean([a == b for a, b in tested]) > 0.97
    assert got[702].score > 0.9 and got[702].n_passages >= 1 and max(got[i].score for i in (700, 701, 703)) < 0.2
    words = toxicity.tokens(dict(rows)[7])
    assert any(w in bad for w in words[got[7].best_start : got[7].best_start + got[7].best_length])
    assert all(0 <= x.score <= 1 for x in got.values())
    steps = [toxicity.posterior(model, x / 4) for x in range(-60, 200)]
    assert steps == sorted(steps)


def test_toxicity_of_nothing(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs_of([(1, "a")]), labels)
    assert [x.score < 1 for x in toxicity.score(docs_of([(1, "a")]), model).collect()] == [True]
    assert toxicity.score(docs_of([]), model).collect() == []


# -- pseudonyms --------------------------------------------------------------------


def _luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_pseudonyms_keep_formats_and_links(spark, docs_of):
    r = random.Random(3)
    cards = []
    while len(cards) < 40:
        number = "4" + "".join(r.choice("0123456789") for _ in range(15))
        cards += [number] if _luhn(number) else []
    days = [(datetime.date(1950, 1, 1) + datetime.timedelta(days=17 * k)) for k in range(300)]
    ips = [".".join(str(r.randrange(256)) for _ in range(4)) for _ in range(60)]
    ssns = [f"{r.choice([1, 665, 667, 899, 123]):03d}-{r.randint(1, 99):02d}-{r.randint(1, 9999):04d}" for _ in range(60)]
    phones = [f"+1 ({r.randint(200, 999)}) {r.randint(200, 999)}-{r.randint(0, 9999):04d}" for _ in range(60)]
    mails = [f"ab{k}.C-d@mail{k % 3}.example.com" for k in range(40)]
    values = [*cards, *(d.isoformat() for d in days), *(d.strftime("%d.%m.%Y") for d in days), *ips, *ssns, *phones, *mails, 'token = "0123abcd4567ef89"']
    rows = [(i, f"before {v}, after {v}.") for i, v in enumerate(values)]
    shown = {}
    for x in pseudonymised(docs_of(rows), "key").collect():
        first, second = re.fullmatch(r"before (.*), after (.*)\.", x.text).groups()
        assert first == second and {e.pseudonym for e in x.pii} <= {first} and re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", first.partition("@")[0]))) == re.sub(
            r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", values[x.doc_id].partition("@")[0]))
        ) or first.count(".") == 3 or "token" in first
        shown[values[x.doc_id]] = first
    assert len(set(shown.values())) == len(set(values)) and sum(a == b for a, b in shown.items()) <= 3
    assert all(_luhn(shown[c]) for c in cards)
    assert all(datetime.date.fromisoformat(shown[d.isoformat()]).strftime("%d.%m.%Y") == shown[d.strftime("%d.%m.%Y")] for d in days)
    assert all(all(0 <= int(p) <= 255 for p in shown[x].split(".")) for x in ips)
    assert all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", shown[x]) for x in ssns)
    other = {x.doc_id: x.text for x in pseudonymised(docs_of(rows[:5]), "another key").collect()}
    assert all(other[i] != f"before {shown[values[i]]}, after {shown[values[i]]}." for i in range(5))


def test_what_is_not_valid_stays(docs_of):
    rows = [(1, None), (2, ""), (3, "card 4562298812442146, 2023-02-29, 999.1.1.1, 1.2.3.4.5, 000-12-3456, 666-12-3456, 900-12-3456, year 1999, 12345"), (4, "x" * 200_000), (4, "x"), (None, "a@b.org")]
    got = [(x.doc_id, x.text) for x in pseudonymised(docs_of(rows), "key").collect()]
    assert got[:5] == rows[:5] and got[5][1].endswith("@b.org") and len(got[5][1]) == 7
    assert pseudonymised(docs_of([]), "key").collect() == []


# -- archives ----------------------------------------------------------------------


def test_archives_and_their_index(spark):
    html = ["WARC/1.1\r\n", "xWARC/1.1\r\nWARC/1.1\r\n\r\n", "", "\r\n\r\n", None, "a\r\n", "é\x00ñ", "WARC/1.1\r", "x" * 200_000, "", "WARC/1.1\r\n"]
    rows = [(i, f"http://www.Host{i % 3}.org:80/p/{i % 2}#x" if i else None, h) for i, h in enumerate(html)] + [(8, "http://u", "x" * 200_000), (None, "http://u", "é\x00ñ"), (None, None, "lonely")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("run", F.lit("other")).withColumn("digest", F.lit(1))
    index = capture_index(pages).collect()
    first = {}
    for i, _, h in rows:
        first[h or ""] = min(first.get(h or "", 1 << 62), 1 << 62 if i is None else i)
    expected = []
    for i, _, h in rows:
        raw = (h or "").encode()
        answer = first[h or ""] in (i, 1 << 62)
        expected.append((str(i), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if answer else "revisit", None if answer else first[h or ""]))
    assert sorted((str(x.page_id), x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in index) == sorted(expected, key=lambda x: x[:4])
    assert [(x.url_key, x.captured) for x in index] == sorted((x.url_key, x.captured) for x in index)
    assert capture_index(pages.limit(0)).collect() == []
    shorter = capture_index(pages.where("page_id IS NOT NULL"), min_bytes=100).collect()
    assert Counter(x.record_type for x in shorter) == {"response": 12}


def test_loser_tree_and_url_keys():
    r = random.Random(2)
    for _ in range(50):
        runs = [sorted(({"url_key": r.choice("abc"), "captured": "", "page_id": r.randint(0, 9)} for _ in range(r.randint(0, 9))), key=lambda x: (x["url_key"], x["page_id"])) for _ in range(r.randint(0, 6))]
        order = [(x["url_key"], x["page_id"]) for x in merged(runs)]
        assert order == sorted((x["url_key"], x["page_id"]) for run in runs for x in run)
    assert url_key("https://www.Example.com:443/a?b#c") == url_key("http://example.com/a?b") == "com,example)/a?b"
    assert url_key("") == ")/" and url_key("http://u@h:8080") == "h:8080)/"


# -- BPE ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_codes_are_the_librarys(library, docs_of):
    r = random.Random(1)
    letters = "abcßéÀΣσς 's'll12½٣ ñ\t\n　\x1c漢字한글éİ!*&Ղ՘"
    texts = [None, "", " ", "<|endoftext|>", "a<|startoftext|><|endoftext|>B", "word " * 3000, "abcdefgh" * 5000]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(1, 50))) + r.choice(["", "<|endoftext|>!"]) for _ in range(150)]
    rows = [*enumerate(texts), (3, "again"), (None, "no id")]
    got = bpe_codec.encode_decode(docs_of(rows), VOCABULARY, lexicon_words=50, outputs=True).collect()
    assert len(got) == len(rows)
    for (i, text), x in zip(rows, got):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (x.doc_id, x.n_tokens, x.ids, x.decoded) == (i, len(ids), ids, decoded)
        assert x.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe_codec.encode_decode(docs_of([]), VOCABULARY).collect() == []


def test_transducer_is_minimal_and_exact():
    r = random.Random(3)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 7))).encode() for _ in range(600)})
    outputs = {w: tuple(r.choice([1, 2, 3]) for _ in range(r.randint(0, 4))) for w in words}
    found = Transducer(build((w, outputs[w]) for w in words))
    assert all(found.get(w) == list(o) for w, o in outputs.items())
    assert all(found.get(w) is None for w in (b"", b"z", b"abcabcabca"))
    # words of all endings over a shared suffix need one state per letter of the longest
    suffixes = sorted(a + b"ing" for a in (b"p", b"q", b"r"))
    assert Transducer(build((w, (i,)) for i, w in enumerate(suffixes))).states == 5
    assert Transducer(build([])).get(b"a") is None
