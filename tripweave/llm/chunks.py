"""Encoding each different stretch of text once per slice instead of at every occurrence.

Texts are cut into chunks on their bytes; Arrow numbers the different ones, and numpy puts the encoded chunks
together again.  Python only sees the different ones.
"""

from __future__ import annotations

import gc
import string
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from tripweave.llm.columns import text_buffers

_SPACE, _APOSTROPHE = 0x20, 0x27
_BYTES = np.arange(256)
# First bytes of characters that are no white space, and second and last bytes of those that may be.
_STARTS_SIGN = ((_BYTES > 0x20) & (_BYTES < 0x7F)) | ((_BYTES >= 0xC3) & ~np.isin(_BYTES, (0xE1, 0xE2, 0xE3)))
_ENDS_SIGN = (_BYTES > 0x20) & (_BYTES < 0x7F)
_BEFORE_LAST = np.isin(_BYTES, (0xC2, 0x9A, 0x80, 0x81))
_ALNUM = np.isin(_BYTES, np.frombuffer((string.digits + string.ascii_letters).encode(), np.uint8))
_SIGN = _ENDS_SIGN & ~_ALNUM


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin in the bytes of some texts: at the texts that are not empty, and before spaces and between
    letters or digits and signs where a cut never changes the matches of the pattern.

    The pattern takes a space either first in a match (before letters, digits or signs), or in a run of white
    space, which gives its last character to a following word.  So matches never cross the place before
    a space that has something else on one side at least.  Signs never share a match with letters or digits but
    after an apostrophe.  Where that is not sure, there is no cut.
    """
    at = np.flatnonzero(data == _SPACE)
    after = data[np.minimum(at + 1, len(data) - 1)]
    before, second = data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    # A character of several bytes is white space only if the byte before its last is one of these.
    sign_before = _ENDS_SIGN[before] | ((before >= 0x80) & ~_BEFORE_LAST[second])
    ends = np.zeros(len(data) + 1, bool)
    ends[offsets] = True
    sure = (sign_before & ~ends[at]) | (_STARTS_SIGN[after] & ~ends[np.minimum(at + 1, len(data))])
    starts = np.zeros(len(data) + 1, bool)
    starts[at[sure]] = True
    alnum, sign = _ALNUM[data], _SIGN[data]
    starts[1 : len(data)] |= (alnum[:-1] & sign[1:]) | (sign[:-1] & (data[:-1] != _APOSTROPHE) & alnum[1:])
    starts[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    return np.flatnonzero(starts[: len(data)])


def chunks_of(text: str) -> list[str]:
    """Parts of ``text`` that can be encoded alone."""
    data = np.frombuffer(text.encode(), np.uint8)
    places = [*cuts(data, np.array([0, len(data)])), len(data)]
    return [data[a:b].tobytes().decode() for a, b in zip(places, places[1:], strict=False)]


@contextmanager
def _no_collector() -> Iterator[None]:
    """What is made and remembered inside the block holds no cycles, and is too much to be searched for them."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Pieces(NamedTuple):
    """Values of all texts one after the other; those of text i are offsets[i]:offsets[i + 1]."""

    values: np.ndarray
    offsets: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.values[a:b] for a, b in zip(self.offsets[:-1], self.offsets[1:], strict=True)]


def gathered(parts: Sequence[bytes], codes: np.ndarray, texts: np.ndarray, kind: str) -> Pieces:
    """The values (of type ``kind``) of the parts that ``codes`` names in order; ``texts[i]`` of the codes
    come before text i."""
    values = np.frombuffer(b"".join(parts), kind)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // values.itemsize
    starts = np.cumsum(lengths) - lengths
    each = lengths[codes]
    ends = np.concatenate([[0], np.cumsum(each)])
    # Half the bytes to move, where places fit.
    small = np.int32 if max(ends[-1], len(values)) < 1 << 31 else np.int64
    place = np.repeat((starts[codes] - ends[:-1]).astype(small), each)
    place += np.arange(ends[-1], dtype=small)
    return Pieces(values[place], ends[texts])


def encode_by_chunks(texts: pa.Array, encode: Callable[[list[str]], Sequence[list[bytes]]], kinds: Sequence[str]) -> list[Pieces]:
    """The texts encoded by ``encode``, which gives for each of ``kinds`` the bytes value of each different chunk."""
    data, offsets = text_buffers(texts)
    starts = cuts(data, offsets) if len(data) else np.zeros(0, np.int64)
    ends = np.concatenate([starts, [len(data)]])
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    chunks = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode()
    with _no_collector():
        columns = encode(chunks.dictionary.to_pylist())
    codes = chunks.indices.to_numpy()
    before = np.searchsorted(starts, offsets)
    return [gathered(column, codes, before, kind) for column, kind in zip(columns, kinds, strict=True)]


class Memory:
    """What is known of some short texts, in two generations of at most half of ``most`` bytes each.

    What is asked for moves to the young one.  When that is full, it becomes the old one and the old
    one is forgotten, so frequent texts stay.  Texts longer than ``longest`` are not remembered.  The bounds
    cost time and never change a result.
    """

    ENTRY = 200  # bytes of a text and its value besides their length

    def __init__(self, most: int, longest: int = 64, entry: int = ENTRY):
        self.half, self.longest, self.entry = most // 2, longest, entry
        self.young, self.old, self.size = {}, {}, 0

    def lookup(self, wanted: Sequence[str]) -> list:
        """The value of each, None where it is not known."""
        if self.size > self.half:
            self.young, self.old, self.size = {}, self.young, 0
        out = list(map(self.young.get, wanted))
        if self.old:
            for i in [i for i, value in enumerate(out) if value is None]:
                value = out[i] = self.old.get(wanted[i])
                if value is not None:
                    self.put(wanted[i], value)
        return out

    def put(self, key: str, value) -> None:
        if len(key) <= self.longest:
            self.young[key] = value
            self.size += self.entry + 3 * len(key)


def matches(chunk: str, split: Callable[[str], list[str]]) -> list[str]:
    """The matches of the pattern in a chunk; letters alone, or after a space, are one."""
    return [chunk] if chunk.isalpha() or (chunk[0] == " " and chunk[1:].isalpha()) else split(chunk)


def encoded(chunks: list[str], split: Callable[[str], list[str]], encode: Callable[[list[str]], Iterable], join: Callable, memory: Memory) -> list:
    """The value of each chunk: what is remembered, else ``join`` of the values of its matches, of which ``encode``
    gives those that are not remembered either."""
    values = memory.lookup(chunks)
    missing = [i for i, value in enumerate(values) if value is None]
    pieces = [matches(chunks[i], split) for i in missing]
    words = list({w: None for p in pieces for w in p})
    known = dict(zip(words, memory.lookup(words), strict=True))
    new = [w for w, value in known.items() if value is None]
    for w, value in zip(new, encode(new), strict=True):
        known[w] = value
        memory.put(w, value)
    for i, p in zip(missing, pieces, strict=True):
        if len(p) == 1:
            values[i] = known[p[0]]
        else:
            values[i] = join([known[w] for w in p])
            memory.put(chunks[i], values[i])
    return values
