"""Received files written by tasks into the shared folder, as a drop to ingest."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_documents(documents: DataFrame, folder: str) -> None:
    """One file per row of ``name, content``; a repeated task writes the same bytes under the same name."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = FileSystem.from_uri(folder)
        system.create_dir(place, recursive=True)
        for batch in batches:
            for name, content in zip(batch["name"].to_pylist(), batch["content"].to_pylist()):
                with system.open_output_stream(f"{place}/{name}") as stream:
                    stream.write(content)
            yield batch.select(["name"])

    written = documents.select("name", documents["content"].cast("binary").alias("content"))
    written.mapInArrow(put, "name string").write.format("noop").mode("overwrite").save()


def write_parts(parts: DataFrame, folder: str, order: list[str], separator: str, tail: str) -> None:
    """One file per name of ``name, head, part``: the head, the parts in order and the tail.

    The rows of a file are sorted in one task that writes them as they come, so
    it holds some thousands of them and never a file.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = FileSystem.from_uri(folder)
        system.create_dir(place, recursive=True)
        stream, last = None, None
        for batch in batches:
            for name, head, part in zip(*(batch[c].to_pylist() for c in ("name", "head", "part"))):
                if name is None:
                    raise ValueError(f"a part without a file: {part}")
                if name == last:
                    stream.write(f"{separator}{part}".encode())
                    continue
                if stream:
                    stream.write(tail.encode())
                    stream.close()
                stream, last = system.open_output_stream(f"{place}/{name}", buffer_size=1 << 20), name
                stream.write(f"{head}{part}".encode())
            yield batch.select(["name"]).slice(0, 0)
        if stream:
            stream.write(tail.encode())
            stream.close()

    sorted_parts = parts.repartition("name").sortWithinPartitions("name", *order).select("name", "head", "part")
    sorted_parts.mapInArrow(put, "name string").write.format("noop").mode("overwrite").save()


def write_lines(lines: DataFrame, folder: str, name: str, header: str, charset: str) -> None:
    """One file of all rows of one text column.

    Such a file is one by nature and written by one task; all tasks make the
    lines and send them to it encoded and compressed, some thousands at a time.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = "".join(f"{line}\n" for line in batch.column(0).to_pylist()).encode(charset)
            block = pa.compress(text, codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([len(text)], pa.int64()), pa.array([block], pa.binary())], names=["size", "block"])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = FileSystem.from_uri(folder)
        system.create_dir(place, recursive=True)
        with system.open_output_stream(f"{place}/{name}") as stream:
            stream.write(f"{header}\n".encode(charset))
            for batch in batches:
                for size, block in zip(batch["size"].to_pylist(), batch["block"].to_pylist()):
                    if size:
                        stream.write(pa.decompress(block, decompressed_size=size, codec="zstd", asbytes=True))
        yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

    # without lines there is still this block, so that a file with a header is written
    nothing = lines.sparkSession.range(1).select(F.lit(0).cast("long").alias("size"), F.lit(b"").alias("block"))
    blocks = lines.mapInArrow(pack, "size long, block binary").unionByName(nothing)
    blocks.repartition(1).mapInArrow(put, "name string").write.format("noop").mode("overwrite").save()
