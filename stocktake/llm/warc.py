"""WARC archives of page captures, and an index of them merged from sorted runs.

Archives are written by Spark's text writer, record by record, and read back by
its text reader cut at the version line; a record that its Content-Length says
is longer is put together from the following pieces, so payloads may hold any
text. A file's records give a run of the index, sorted by URL key and time. Runs
are dealt by ranges of (key, time, page), so that a host or URL with a third of
all captures is split too, and each range merges its runs with a loser tree.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.session import new_work_path

MIN_BYTES = 0
RECORDS_PER_FILE = 4_000
FIRST_SECOND = 1_577_836_800
VERSION = "WARC/1.1\r\n"
INDEX = "url_key string, captured string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, run string"
_FIELDS = [(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in INDEX.split(", "))]
_SCHEMA = pa.schema(_FIELDS)


def sha1_base32(text: Column) -> Column:
    """SHA-1 of the UTF-8 bytes in upper-case base 32."""
    digest = F.sha1(text)
    parts = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES) -> None:
    """One record per row of ``pages`` in gzipped files below ``path``.

    Of rows with equal payloads of ``min_bytes`` bytes or more the one with the
    smallest id is a response and the others revisit it, also when ids repeat
    with other rows; a null id never is the smallest unless the payload has no
    other. Null payloads and addresses are empty; other columns are not read.
    """
    page_id, url, html = F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string")
    empty = F.lit("")
    pages = pages.select(page_id.alias("page_id"), F.coalesce(url, empty).alias("url"), F.coalesce(html, empty).alias("html"))
    pages = pages.withColumn("digest", sha1_base32("html"))
    first = pages.groupBy("digest").agg(F.min("page_id").alias("first"))
    pages = pages.join(first, "digest")
    size = F.octet_length("html")
    revisit = F.coalesce((size >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    moment = F.timestamp_seconds(F.lit(FIRST_SECOND) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9)))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    identity = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), empty), F.lit(">"))
    # an address can hold no line end in a header
    target = F.translate("url", "\r\n", "")
    record = F.concat(
        F.lit(VERSION),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", identity("page_id")),
        line("WARC-Date", F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                line("WARC-Refers-To", identity("first")),
                line("X-Payload-Length", size.cast("string")),
            ),
        ).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, 0).otherwise(size).cast("string")),
        F.lit("\r\n"),
        F.when(revisit, "").otherwise(F.col("html")),
        F.lit("\r\n"),
    )
    writer = pages.select(record.alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def url_key(url: str) -> str:
    """The address with its host turned round, so that neighbours in the order are neighbours on the web."""
    rest = url.strip().split("#", 1)[0].lower()
    scheme, mark, after = rest.partition("://")
    rest = after if mark else rest
    cut = min((i for i in (rest.find(c) for c in "/?") if i >= 0), default=len(rest))
    host, path = rest[:cut].rpartition("@")[2], rest[cut:] or "/"
    name, _, port = host.partition(":")
    name = ",".join(reversed([x for x in name.removeprefix("www.").split(".") if x]))
    return f"{name}{':' + port if port not in ('', '80', '443') else ''}){path}"


class _Reader:
    """Records of the files of a task, from pieces in the order of the files."""

    def __init__(self):
        self.file, self.held, self.missing = None, [], 0
        self.headers: dict[str, str] = {}

    def take(self, file: str, piece: bytes) -> dict | None:
        """The record that this piece completes, if it does."""
        if file != self.file:
            self.done()
            self.file = file
        if self.missing > 0:  # the version line stood in the payload
            piece = VERSION.encode() + piece
            self.held.append(piece)
            self.missing -= len(piece)
        else:
            if not piece:
                return None
            head, mark, body = piece.partition(b"\r\n\r\n")
            if not mark:
                raise ValueError(f"no end of the header in {file}")
            self.headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n"))
            self.held = [body]
            self.missing = int(self.headers["Content-Length"]) + 4 - len(body)
        if self.missing > 0:
            return None
        if self.missing < 0:
            raise ValueError(f"a record in {file} is longer than its header says")
        return self._record(b"".join(self.held)[:-4])

    def done(self) -> None:
        if self.missing > 0:
            raise ValueError(f"the last record of {self.file} is cut off")

    def _record(self, payload: bytes) -> dict:
        h = self.headers
        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = h["WARC-Type"]
        if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"a payload in {self.file} doesn't have its digest")
        number = lambda name: int(x) if (x := h[name].removeprefix("<urn:page:").removesuffix(">")) else None
        return {
            "url_key": url_key(h["WARC-Target-URI"]), "captured": h["WARC-Date"], "page_id": number("WARC-Record-ID"), "url": h["WARC-Target-URI"], "record_type": kind,
            "refers_to": number("WARC-Refers-To") if kind == "revisit" else None, "payload_bytes": len(payload) if kind == "response" else int(h["X-Payload-Length"]), "payload_digest": digest, "run": self.file,
        }


def _order(row: dict) -> tuple:
    return row["url_key"], row["captured"], row["page_id"] is None, row["page_id"] or 0


def read_runs(archives: DataFrame) -> DataFrame:
    """The index runs of archives read as pieces (``value``) with their file (``run``): each file's entries in order."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, run = _Reader(), []
        for batch in batches:
            for file, piece in zip(batch.column("run").to_pylist(), batch.column("value").to_pylist()):
                if run and file != run[0]["run"]:
                    yield pa.RecordBatch.from_pylist(sorted(run, key=_order), _SCHEMA)
                    run = []
                if (record := reader.take(file, piece)) is not None:
                    run.append(record)
        reader.done()
        yield pa.RecordBatch.from_pylist(sorted(run, key=_order), _SCHEMA)

    return archives.select("run", F.col("value").cast("binary").alias("value")).mapInArrow(parse, INDEX)


def merged(runs: list[list[dict]]) -> Iterator[dict]:
    """The entries of sorted runs in order, by a tree of losers: a step replays one path from leaf to root."""
    k = 1
    while k < len(runs):
        k *= 2
    ends = (1,)
    sources = [iter(x) for x in runs] + [iter(())] * (k - len(runs))

    def pull(i: int) -> tuple:
        row = next(sources[i], None)
        return (ends, i, None) if row is None else ((0, *_order(row)), i, row)

    losers = [None] * k

    def play(node: int) -> tuple:
        if node >= k:
            return pull(node - k)
        a, b = play(2 * node), play(2 * node + 1)
        winner, losers[node] = (a, b) if a[:2] <= b[:2] else (b, a)
        return winner

    best = play(1) if k > 1 else pull(0)
    while best[2] is not None:
        yield best[2]
        i = best[1]
        best = pull(i)
        node = (i + k) // 2
        while node >= 1 and k > 1:
            if losers[node][:2] < best[:2]:
                best, losers[node] = losers[node], best
            node //= 2


def merge_index(runs: DataFrame) -> DataFrame:
    """All entries in the order of URL key, capture time and page; partitions follow each other in that order."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_run: dict[str, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                by_run.setdefault(row["run"], []).append(row)
        # a run that reached this range from several tasks is several runs
        out = []
        for row in merged([part for run in by_run.values() for part in _ordered_parts(run)]):
            out.append(row)
            if len(out) == 10_000:
                yield pa.RecordBatch.from_pylist(out, _SCHEMA)
                out = []
        yield pa.RecordBatch.from_pylist(out, _SCHEMA)

    return runs.repartitionByRange(F.col("url_key"), F.col("captured"), F.col("page_id").asc_nulls_last()).mapInArrow(merge, INDEX)


def _ordered_parts(rows: list[dict]) -> list[list[dict]]:
    parts: list[list[dict]] = []
    for row in rows:
        if parts and _order(parts[-1][-1]) <= _order(row):
            parts[-1].append(row)
        else:
            parts.append([row])
    return parts


def capture_index(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Archives of ``pages`` below ``path`` (a fresh folder in the shared one if not given), and their merged index.

    One row per page, also for repeated ones: columns as in ``INDEX``. See
    ``write_archives`` for nulls and ties; an empty table gives no rows.
    """
    spark = pages.sparkSession
    path = path or new_work_path(spark, "warc")
    write_archives(pages, f"{path}/archive", id_col, url_col, html_col, min_bytes)
    archives = spark.read.option("lineSep", VERSION).text(f"{path}/archive").select("value", F.col("_metadata.file_name").alias("run"))
    read_runs(archives).write.parquet(f"{path}/runs")
    return merge_index(spark.read.schema(INDEX).parquet(f"{path}/runs"))
