"""Words and rolling hashes over Arrow text columns, in numpy, for use inside tasks.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form
feed and carriage return. All arithmetic is modulo 2^64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

SEPARATORS = b" \t\n\v\f\r"
NULL_ID = np.iinfo(np.int64).max
_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[list(SEPARATORS)] = True
_BASES = {}


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values (shift, multiply, shift)."""
    x = values + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


_BYTE_CODES = mix(np.arange(256, dtype=np.uint64), 11)


def _powers(n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base and of its inverse."""
    known = _BASES.get(salt)
    if known is None or len(known[0]) <= n:
        base = int(mix(np.array([salt], np.uint64), 5)[0]) | 5
        size = max(1024, 1 << (n + 1).bit_length())
        both = []
        for step in (base, pow(base, -1, 2**64)):
            powers = np.full(size, step, np.uint64)
            powers[0] = 1
            both.append(np.cumprod(powers, dtype=np.uint64))
        known = _BASES[salt] = tuple(both)
    return known


def span_hashes(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    """Hash of codes[begin:end] for every pair; equal spans have equal hashes."""
    power, inverse = _powers(len(codes), salt)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * power[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[begins]) * inverse[begins], salt)


def rolling_hashes(codes: np.ndarray, width: int, salt: int) -> np.ndarray:
    """Hash of each run of ``width`` codes, by its first position."""
    n = max(0, len(codes) - width + 1)
    begins = np.arange(n)
    return span_hashes(codes, begins, begins + width, salt)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in a line, and the n + 1 offsets of the rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.large_binary())
    column = column.cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"") if not pa.types.is_binary(column.type) else column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and len(column) else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of every word; words never cross rows."""
    inside = ~_IS_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    begins = np.flatnonzero(begin)
    rows = np.searchsorted(offsets, begins, "right") - 1
    return begins, np.flatnonzero(end) + 1, rows


def word_codes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128 bits of xxh3 per word, as two columns; each different word is hashed once."""
    lengths = ends - begins
    after = np.cumsum(lengths)
    joined = data[np.arange(after[-1] if len(after) else 0) + np.repeat(begins - (after - lengths), lengths)]
    offsets = np.concatenate([[0], after]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
    coded = words.dictionary_encode()
    digests = b"".join(map(xxhash.xxh3_128_digest, coded.dictionary.to_pylist()))
    return np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2)[coded.indices.to_numpy()]


def packed(kinds: dict[str, np.ndarray | int], cuts: np.ndarray, payload: np.ndarray) -> pa.Table:
    """One row per slice payload[cuts[i]:cuts[i+1]] that is not empty, with its bytes and the given columns."""
    width = payload.dtype.itemsize
    filled = np.flatnonzero(np.diff(cuts))
    bounds = np.append(cuts[filled], cuts[-1] if len(cuts) else 0).astype(np.int64) * width
    binary = pa.Array.from_buffers(
        pa.large_binary(), len(filled), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(np.ascontiguousarray(payload).tobytes())]
    )
    columns = {k: (np.full(len(filled), v) if np.isscalar(v) else v[filled]) for k, v in kinds.items()}
    return pa.table({**{k: pa.array(v, pa.int32()) for k, v in columns.items()}, "payload": binary.cast(pa.binary())})


def slices(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The payloads of all rows in a line, and the n + 1 cuts between the rows."""
    data, offsets = text_bytes(column)
    return data.view(dtype) if data.flags.aligned and len(data) else np.frombuffer(data.tobytes(), dtype), offsets // np.dtype(dtype).itemsize


def in_sorted(values: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Which values are among the sorted members."""
    if not len(members):
        return np.zeros(len(values), bool)
    at = np.searchsorted(members, values)
    at[at == len(members)] = 0
    return members[at] == values
