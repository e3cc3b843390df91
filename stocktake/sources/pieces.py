"""Large JSON documents cut into smaller ones, so that no task holds a document as a whole."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 1 << 20
PIECE_BYTES = 4 << 20

_STRINGS = rb'"(?:[^"\\]++|\\.)*+"|\'(?:[^\'\\]++|\\.)*+\''
# Up to the next bracket; no match where a string or the bracket is not read yet.
_BRACKET = re.compile(rb'(?:[^"\'{}\[\]]++|' + _STRINGS + rb')*+[{}\[\]]', re.S)
# The same between the elements of a list, up to a comma too.
_BETWEEN = re.compile(rb'(?:[^"\'{}\[\],]++|' + _STRINGS + rb')*+[{}\[\],]', re.S)
_TOKEN = re.compile(rb"(" + _STRINGS + rb")\s*+(:)?|[{}\[\]\"']", re.S)
_ROOT = re.compile(rb"\s*+\{")


class _Buffer:
    """What is read of a stream and still needed."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.data, self.ended = stream, b"", False

    def more(self, begin: int) -> None:
        """Drop what is before ``begin`` and read on."""
        chunk = self.stream.read(CHUNK_BYTES)
        self.ended = not chunk
        self.data = self.data[begin:] + chunk


def _lists(text: bytes, items: str) -> Iterator[int]:
    """Ends of the opening brackets of the root's lists of that name, as far as the text goes."""
    depth = 0
    for token in _TOKEN.finditer(text):
        if token[0] in b"\"'":  # a string that is not read yet
            return
        if token[1] is None:
            depth += 1 if token[0] in b"{[" else -1
            if depth == 0:
                return
        elif depth == 1 and token[2] and _plain(token[1]) == items and (opened := re.compile(rb"\s*+\[").match(text, token.end())):
            yield opened.end()


def _plain(quoted: bytes) -> str | None:
    text = quoted[1:-1].decode("utf-8", "replace")
    try:
        return json.loads(f'"{text}"') if quoted[:1] == b'"' else text
    except ValueError:
        return None


def cut(stream: BinaryIO, items: str) -> Iterator[bytes]:
    """Documents with some of the elements of ``items`` each, as they are written, and one with all that stands around the list.

    Nothing comes of a document whose root is no object with such a list. What
    is between brackets is not checked: that is left to who parses the pieces.
    """
    buffer, key = _Buffer(stream), json.dumps(items).encode()
    while not (begin := next(_lists(buffer.data, items), 0)):
        if buffer.ended or len(buffer.data) > CHUNK_BYTES and not _ROOT.match(buffer.data):
            return
        for _ in range(1 + len(buffer.data) // CHUNK_BYTES):
            buffer.more(0)
    if not _ROOT.match(buffer.data):
        return
    head, at, depth, several = buffer.data[:begin], begin, 0, False
    while True:
        if not (found := (_BRACKET if depth else _BETWEEN).match(buffer.data, at)):
            if buffer.ended:
                raise ValueError(f"the list of {items} does not end")
            buffer.more(begin)
            at, begin = at - begin, 0
            continue
        at = found.end()
        sign = buffer.data[at - 1 : at]
        if sign in b"{[":
            depth += 1
        elif depth and sign != b",":
            depth -= 1
        elif sign == b"]" or sign == b"," and at - begin > PIECE_BYTES:
            piece = buffer.data[begin : at - 1]
            if not piece.strip() and (several or sign == b","):
                raise ValueError(f"an element of {items} is missing")
            yield b"{" + key + b":[" + piece + b"]}"
            begin, several = at, True
            if sign == b"]":
                break
        elif sign == b"}":
            raise ValueError(f"the list of {items} does not end")
    rest = [buffer.data[at:], *iter(lambda: stream.read(CHUNK_BYTES), b"")]
    around = b"".join([head, b"]", *rest])
    if len([*_lists(around, items)]) > 1:
        raise ValueError(f"more than one list of {items}")
    yield around


def write_pieces(documents: DataFrame, items: str, folder: str) -> DataFrame:
    """The pieces of the documents ``number, path`` as files of ``folder/number``; returned is how many each has.

    A repeated task writes the same bytes under the same names.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = FileSystem.from_uri(folder)
        for batch in batches:
            counts = []
            for number, path in zip(batch["number"].to_pylist(), batch["path"].to_pylist()):
                count = 0
                with _opened(path) as stream:
                    for count, piece in enumerate(cut(stream, items), 1):
                        system.create_dir(f"{place}/{number}", recursive=True)
                        with system.open_output_stream(f"{place}/{number}/{count:06d}.json") as out:
                            out.write(piece)
                counts.append(count)
            yield pa.RecordBatch.from_arrays([batch["number"], pa.array(counts, pa.int64())], names=["number", "pieces"])

    return documents.select("number", "path").mapInArrow(put, "number long, pieces long")


def _opened(path: str) -> BinaryIO:
    """A file by its reported path, whose names are URL-encoded."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return FileSystem.from_uri("file:///")[0].open_input_stream(unquote(parts.path))
    system, name = FileSystem.from_uri(unquote(path))
    return system.open_input_stream(name)
