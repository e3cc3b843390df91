"""A minimal acyclic transducer from words to number sequences, as flat memory that can be mapped.

Words are added in order; a state is shared with an equal one as soon as no
later word can change it, and outputs move as far towards the start as all words
through a transition agree. The flat form holds, for each state, its range of
transitions; for each transition its byte, target and range of output numbers.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterable

import numpy as np

_HEAD = struct.Struct("<5I")
_BYTES = [bytes([b]) for b in range(256)]


class _State:
    __slots__ = ("arcs", "last", "number")

    def __init__(self):
        self.arcs: dict[int, list] = {}
        self.last: tuple[int, ...] | None = None
        self.number = -1


def _common(a: tuple, b: tuple) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def build(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """The flat transducer of (word, outputs), which must be sorted by word without repeats."""
    known: dict[tuple, _State] = {}
    frozen: list[_State] = []
    path = [_State()]
    previous = b""

    def settle(state: _State) -> _State:
        key = (state.last, *((b, id(t), o) for b, (t, o) in state.arcs.items()))
        same = known.get(key)
        if same is None:
            state.number = len(frozen)
            frozen.append(state)
            known[key] = same = state
        return same

    def shorten(length: int) -> None:
        while len(path) - 1 > length:
            done = path.pop()
            path[-1].arcs[previous[len(path) - 1]][0] = settle(done)

    for word, output in entries:
        shared = _common(word, previous)
        shorten(shared)
        for depth in range(shared):
            arc = path[depth].arcs[word[depth]]
            n = _common(arc[1], output)
            rest, arc[1] = arc[1][n:], arc[1][:n]
            output = output[n:]
            if rest:
                below = path[depth + 1]
                for other in below.arcs.values():
                    other[1] = rest + other[1]
                if below.last is not None:
                    below.last = rest + below.last
        for byte in word[shared:]:
            path.append(_State())
            path[-2].arcs[byte] = [path[-1], ()]
        if len(word) > shared:
            path[shared].arcs[word[shared]][1] = output
            path[-1].last = ()
        else:
            path[-1].last = output
        previous = word
    shorten(0)
    start = settle(path[0])
    return _flat(frozen, start.number)


def _flat(states: list[_State], start: int) -> bytes:
    first, finals, labels, targets, outs, pool = [0], [], bytearray(), [], [], []
    at: dict[tuple, int] = {}

    def place(output: tuple[int, ...]) -> int:
        if output not in at:
            at[output] = len(pool)
            pool.extend((len(output), *output))
        return at[output]

    place(())
    for state in states:
        for byte, (target, output) in sorted(state.arcs.items(), key=lambda x: x[0]):
            labels.append(byte)
            targets.append(target.number)
            outs.append(place(output))
        first.append(len(labels))
        finals.append(place(state.last) + 1 if state.last is not None else 0)
    labels += bytes(-len(labels) % 4)
    words = [np.array(x, "<u4").tobytes() for x in (first, finals, targets, outs, pool)]
    return _HEAD.pack(len(states), start, len(labels), len(targets), len(pool)) + b"".join(words) + bytes(labels)


class Transducer:
    """Lookups in a flat transducer held in any buffer, as a mapped file."""

    def __init__(self, buffer: bytes | mmap.mmap):
        n, self._start, labels, arcs, pool = _HEAD.unpack_from(buffer)
        self.states = n
        view, at = memoryview(buffer), _HEAD.size
        parts = []
        for size in (n + 1, n, arcs, arcs, pool):
            parts.append(view[at : at + 4 * size].cast("I"))
            at += 4 * size
        self._first, self._finals, self._targets, self._outs, self._pool = parts
        self._labels, self._find = at, buffer.find

    def get(self, word: bytes) -> list[int] | None:
        """The outputs of a word, or None if the transducer doesn't hold it."""
        state, found = self._start, []
        first, pool, outs, targets, find, base = self._first, self._pool, self._outs, self._targets, self._find, self._labels
        for byte in word:
            arc = find(_BYTES[byte], base + first[state], base + first[state + 1])
            if arc < 0:
                return None
            arc -= base
            if out := outs[arc]:  # at 0 lies the empty output
                found += pool[out + 1 : out + 1 + pool[out]]
            state = targets[arc]
        last = self._finals[state]
        if not last:
            return None
        return found + list(pool[last : last + pool[last - 1]])
