"""Toxic passages as maximum-scoring segments of token log-odds, calibrated by extreme values.

A feature, a word or a beginning of words, has the lower bound of its log-odds
between toxic and other labelled documents that hold it, smoothed by a Dirichlet
prior that follows its share of the whole collection. A token scores as the best
of its features; tokens without evidence cost a little. A linear scan finds all
maximal scoring segments of a document. A segment's score, times the lambda for
which the collection's tokens expect one, less the logarithm of the length, has
an extreme-value distribution; one is fitted for each label to the documents'
best segments, and their ratio gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABELLED_ROWS = 20_000
LEXICON = 20_000
PRIOR_DOCS = 5.0
PRIOR_SHARE = 0.02
BOUND = 2.5
TOKEN_COST = 0.1
SIGNIFICANCE = 0.05
#: Of lambda, for collections whose tokens expect to score above zero.
LEAST_RATE = 0.05
FOLDS = 5
EULER = 0.5772156649015329
RESULT = "doc_id long, score double, n_tokens long, n_passages long, best_start long, best_length long"
_TOKEN = re.compile(r"[^\W\d_]+")
#: Blanks for all bytes that are ASCII and no small letter.
_LETTERS = bytes(i if i >= 128 or 97 <= i <= 122 else 32 for i in range(256))
_FLUSH = 300_000
_MEMO = 200_000
#: Lengths of the beginnings of words that are features.
BEGINNINGS = range(3, 9)


def tokens(text: str | None) -> list[str]:
    """Runs of letters. ASCII but for letters always parts them, so only what is left with other letters needs the pattern."""
    low = (text or "").lower()
    pieces = low.encode("utf-8", "surrogatepass").translate(_LETTERS).decode("utf-8", "surrogatepass").split()
    if low.isascii() or "".join(pieces).isalpha():
        return pieces
    return [token for p in pieces for token in ((p,) if p.isalpha() else _TOKEN.findall(p))]


def features(token: str) -> list[str]:
    """The token and its beginnings, which end in an asterisk."""
    return [token, *(token[:k] + "*" for k in BEGINNINGS if k < len(token))]


class _Known(dict):
    """What is known of a token, worked out once per token; forgets all when full."""

    def __init__(self, find):
        self.find = find

    def __missing__(self, token: str):
        if len(self) >= _MEMO:
            self.clear()
        self[token] = found = self.find(token)
        return found


def token_scores(scores: dict[str, float]) -> dict[str, float]:
    """By token, the best score of its features, or zero."""
    return _Known(lambda token: max((scores[f] for f in features(token) if f in scores), default=0.0))


def fold(doc_id: Column) -> Column:
    """Remainder of the id's checksum; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


@dataclass
class Model:
    scores: dict[str, float]
    rate: float = 1.0
    #: Location and scale of the best segments' distribution, of other and of toxic documents.
    other: tuple[float, float] = (0.0, 1.0)
    toxic: tuple[float, float] = (1.0, 1.0)
    share: float = 0.5


def segments(hits: list[tuple[int, float]], cost: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last) of tokens that cost ``cost`` but for the hits (place, score)."""
    found: list[tuple[float, int, int, float, float]] = []  # score, first, last, sum before, sum up to its end
    total, after = 0.0, 0
    for place, gain in hits:
        total -= cost * (place - after)
        before, total, after = total, total + gain, place + 1
        new = (gain, place, place, before, total)
        while found:
            k = len(found) - 1
            while k >= 0 and found[k][3] >= new[3]:
                k -= 1
            if k < 0 or found[k][4] >= new[4]:
                break
            left = found[k]
            new = (new[4] - left[3], left[1], new[2], left[3], new[4])
            del found[k:]
        found.append(new)
    return [x[:3] for x in found]


def measured(model: Model, scores: dict[str, float], text: str | None) -> tuple[float, int, int, int, int]:
    """Normal best score, tokens, significant passages, begin and length of the best one."""
    words = tokens(text)
    hits = [(i, s) for i, s in enumerate(map(scores.__getitem__, words)) if s]
    if not hits:
        return -math.inf, len(words), 0, 0, 0
    size = math.log(len(words))
    found = segments(hits, TOKEN_COST)
    best = max(found, key=lambda x: (x[0], -x[1]))
    location, scale = model.other
    tail = lambda s: -math.expm1(-math.exp(min(700.0, -(model.rate * s - size - location) / scale)))
    passages = sum(tail(s) < SIGNIFICANCE for s, _, _ in found)
    return model.rate * best[0] - size, len(words), passages, best[1], best[2] - best[1] + 1


def posterior(model: Model, x: float) -> float:
    """Share of toxic documents among those with a normal best score of ``x``; never falls as it rises."""
    x = min(max(x, model.other[0]), model.toxic[0] + 20 * model.toxic[1])

    def log_density(location: float, scale: float) -> float:
        z = (x - location) / scale
        return -math.log(scale) - z - math.exp(min(700.0, -z))

    odds = math.log(model.share / (1 - model.share)) + log_density(*model.toxic) - log_density(*model.other)
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def _counted(rows: DataFrame, only: set[str] | None = None) -> DataFrame:
    """``feature, toxic, n``: documents (rows with ``text, toxic``) that hold a feature; the empty one stands for all documents.

    With ``only``, of its features alone.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = features if only is None else lambda token: tuple(f for f in features(token) if f in only)
        seen, known = Counter(), _Known(find)

        def out() -> pa.RecordBatch:
            names, toxic = zip(*seen) if seen else ((), ())
            return pa.RecordBatch.from_pydict({"feature": pa.array(names, pa.string()), "toxic": pa.array(toxic, pa.int32()), "n": pa.array(list(seen.values()), pa.int64())})

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = set().union(*map(known.__getitem__, set(tokens(text))))
                seen.update((f, toxic) for f in held)
                seen["", toxic] += 1
                if len(seen) > _FLUSH:
                    yield out()
                    seen = Counter()
        yield out()

    found = rows.select("text", F.col("toxic").cast("int")).mapInArrow(count, "feature string, toxic int, n long")
    return found.groupBy("feature", "toxic").agg(F.sum("n").alias("n"))


def _shares(docs: DataFrame, scores: dict[str, float]) -> list[tuple[float, float]]:
    """Shares of a document's tokens by score, in steps of a tenth, on average over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(scores)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = _Known(lambda token, known=token_scores(shared.value): round(10 * known[token]))
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = tokens(text)
                for step, n in Counter(map(steps.__getitem__, words)).items():
                    seen[step] += n / len(words)
        yield pa.RecordBatch.from_pydict({"step": pa.array(list(seen), pa.int64()), "n": pa.array(list(seen.values()), pa.float64())})

    found = docs.select("text").mapInArrow(count, "step long, n double").groupBy("step").agg(F.sum("n").alias("n")).collect()
    every = max(1, sum(r["n"] for r in found))
    return sorted((r["n"] / every, r["step"] / 10) for r in found if r["step"])


def train(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, words: int = LEXICON) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    At most ``rows`` labelled rows, those of the least hashes of their ids, teach
    it, and at most ``words`` features get a score of their own; the shares of
    features and tokens are those of all documents. Rows without id or label teach nothing.
    """
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    labels = labels.select(F.col("doc_id").cast("long"), (F.col("toxic") > 0).cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    taught = docs.join(F.broadcast(labels), "doc_id")
    sizes = {r["toxic"]: r["n"] for r in taught.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total, others = sizes.get(1, 0), sizes.get(0, 0)
    if not total or not others:
        return Model({})
    # only features of toxic documents can speak for the label
    counts = _counted(taught.where("toxic = 1")).where("feature != ''").select("feature", F.col("n").alias("a"))
    counts = counts.join(_counted(taught.where("toxic = 0")).select("feature", F.col("n").alias("b")), "feature", "left").fillna(0, ["b"])
    expected = (F.col("a") + F.col("b")) * (total / (total + others))
    surplus = (F.col("a") - expected) / F.sqrt(expected)
    top = counts.where(F.col("a") > expected).orderBy(F.desc(surplus), "feature").limit(words).collect()
    known = {r["feature"]: (r["a"], r["b"]) for r in top}
    spread = {r["feature"]: r["n"] for r in _counted(docs.select("text", F.lit(0).alias("toxic")), set(known)).collect()}
    held = {f: spread.get(f, 0) / spread[""] for f in known}
    scores = _scores(known, total, others, held)
    model = Model(scores, _rate(_shares(docs, scores)))
    quartiles = F.percentile_approx("x", F.array(F.lit(0.25), F.lit(0.75)), 10_000)
    fitted = _measured_rows(taught, model).groupBy("toxic").agg(F.count("*").alias("n"), quartiles.alias("q"))
    by_label = {r["toxic"]: r for r in fitted.collect()}
    model.share = total / (total + others)
    for name, label in (("other", 0), ("toxic", 1)):
        low, high = by_label[label]["q"]
        scale = max(0.05, (high - low) / (math.log(math.log(4)) - math.log(math.log(4 / 3))))
        setattr(model, name, (low + scale * math.log(math.log(4)), scale))
    return model


def _scores(known: dict[str, tuple[int, int]], toxic: int, other: int, held: dict[str, float]) -> dict[str, float]:
    """Features whose log-odds are above zero by their bound, with that bound less the cost of a token."""
    out = {}
    for feature, (a, b) in known.items():
        prior = PRIOR_DOCS / (toxic + other) + PRIOR_SHARE * held[feature]
        x, y = a + prior * toxic, b + prior * other
        odds = math.log(x / max(1e-9, toxic * (1 + 2 * prior) - x)) - math.log(y / max(1e-9, other * (1 + 2 * prior) - y))
        low = odds - BOUND * math.sqrt(1 / x + 1 / y)
        if low > TOKEN_COST:
            out[feature] = low - TOKEN_COST
    return out


def _rate(shares: list[tuple[float, float]]) -> float:
    """The lambda above zero for which the tokens expect exp(lambda * score) of one."""
    rest = 1 - sum(p for p, _ in shares)

    def excess(rate: float) -> float:
        return rest * math.exp(-rate * TOKEN_COST) + sum(p * math.exp(min(700.0, rate * s)) for p, s in shares) - 1

    low, high = 1e-6, 1e-6
    while high < 64 and excess(high) < 0:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return max(low, LEAST_RATE)


def _measured_rows(rows: DataFrame, model: Model) -> DataFrame:
    """``toxic, x`` with the normal best score, at least minus the logarithm of the length."""
    session = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = token_scores(session.value.scores)
        for batch in batches:
            got = [measured(session.value, scores, t) for t in batch.column("text").to_pylist()]
            x = [m[0] if m[0] > -math.inf else -math.log(max(1, m[1])) for m in got]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "x": pa.array(x, pa.float64())})

    return rows.select("text", "toxic").mapInArrow(run, "toxic int, x double")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``RESULT`` per row of ``docs``: the score, and where the best passage begins and ends, in tokens.

    Null and empty texts have no passage and the least score; repeated rows are
    scored alike; null ids stay null; an empty table gives no rows. Only the
    text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = token_scores(shared.value.scores)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                x, n, passages, start, length = measured(shared.value, scores, text)
                rows.append((posterior(shared.value, x), n, passages, start, length))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.float64(), *[pa.int64()] * 4]
            names = ["score", "n_tokens", "n_passages", "best_start", "best_length"]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **{n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)}})

    only = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return only.mapInArrow(run, RESULT)
