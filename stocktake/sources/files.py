"""Received files as a listing: path, name, size and content fingerprint."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from fnmatch import fnmatch
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20


def plain_name(encoded: Column) -> Column:
    """Scans report names URL-encoded; a plus sign is not a blank there."""
    return F.coalesce(F.try_url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B"))), encoded)


def file_columns() -> list[Column]:
    """Where a scanned row came from: the file's name and its path as reported."""
    return [
        plain_name(F.col("_metadata.file_name")).alias("_arquivo_origem"),
        F.col("_metadata.file_path").alias("_path"),
    ]


def literal(path: str) -> str:
    """A path that readers take as it is, not as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """One row per file of a folder whose name fits: ``arquivo_origem, path, tamanho, hash_arquivo``.

    Scans pass over names that begin with an underscore or a dot; such a file,
    if its name fits, is an error.
    """
    if hidden := hidden_files(spark, folder, glob):
        raise ValueError(f"files that no scan reads: {', '.join(hidden)}")
    return _fingerprints(spark.read.format("binaryFile").option("pathGlobFilter", glob).load(literal(folder)))


def list_paths(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The same for single files."""
    return _fingerprints(spark.read.format("binaryFile").load([literal(p) for p in paths]))


def hidden_files(spark: SparkSession, folder: str, glob: str) -> list[str]:
    """Names in a folder that fit but are hidden from scans; checksum files of file systems don't count."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(literal(folder), "{_,.}*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names = (status.getPath().getName() for status in found if status.isFile())
    return sorted(n for n in names if fnmatch(n, glob) and not n.endswith(".crc") and n != "_SUCCESS")


def _fingerprints(found: DataFrame) -> DataFrame:
    """SHA-256 of the bytes, at every size: each file is streamed in chunks by the task that lists it."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [_sha256(p) for p in batch.column("path").to_pylist()]
            yield batch.append_column("hash_arquivo", pa.array(hashes, pa.string()))

    listed = found.select(
        plain_name(F.col("_metadata.file_name")).alias("arquivo_origem"),
        F.col("_metadata.file_path").alias("path"),
        F.col("length").alias("tamanho"),
    )
    return listed.mapInArrow(digest, "arquivo_origem string, path string, tamanho long, hash_arquivo string")


def _sha256(path: str) -> str:
    """Of a file by its reported path, whose names are URL-encoded."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        system, name = FileSystem.from_uri("file:///")[0], unquote(parts.path)
    else:
        system, name = FileSystem.from_uri(unquote(path))
    total = hashlib.sha256()
    with system.open_input_stream(name) as stream:
        while chunk := stream.read(CHUNK_BYTES):
            total.update(chunk)
    return total.hexdigest()


def rows_digest(*columns: str) -> Column:
    """Aggregate: SHA-256 over the row count and two sums of row hashes.

    It does not depend on row order and combines map-side, so a file or batch
    of any size is fingerprinted in splits.
    """
    row = F.sha2(F.concat_ws("\u001f", *(F.coalesce(F.col(c), F.lit("\u0000")) for c in columns)), 256)
    halves = [F.conv(F.substring(row, start, 15), 16, 10).cast("decimal(20,0)") for start in (1, 16)]
    parts = [F.count(F.lit(1)), *(F.sum(h) for h in halves)]
    return F.sha2(F.concat_ws(":", *(p.cast("string") for p in parts)), 256)


def local_names(paths: Sequence[str]) -> list[str]:
    """Reported paths, decoded."""
    return [unquote(p) for p in paths]


def same_files(reported: Sequence[str], listed: Sequence[str]) -> bool:
    """Whether two lists of reported paths name the same files, each once."""

    def places(paths: Sequence[str]) -> list[tuple[str, str]]:
        return sorted((urlsplit(p).netloc, urlsplit(p).path) for p in paths)

    return places(reported) == places(listed)
