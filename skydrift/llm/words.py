"""Vectorised word splitting over Arrow string columns.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; only A-Z are lower-cased,
so working on UTF-8 bytes gives the same words as working on characters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skydrift.llm.tables import small_batches

SLICE_BYTES = 1 << 20
#: Words are hashed so many bytes at a time; bounds the tables of powers.
HASHED_BYTES = 1 << 17

_MASK64 = (1 << 64) - 1


def _mixed(n: int) -> int:
    n = (n * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _MASK64
    n = ((n ^ (n >> 30)) * 0xBF58476D1CE4E5B9) & _MASK64
    n = ((n ^ (n >> 27)) * 0x94D049BB133111EB) & _MASK64
    return n ^ (n >> 31)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODE = np.array([0 if _IS_SPACE[b] else _mixed(int(_LOWER[b])) for b in range(256)], np.uint64)
_BYTE_CODE_CASED = np.array([0 if _IS_SPACE[b] else _mixed(b) for b in range(256)], np.uint64)
_BYTE_CODE_ALL = np.array([_mixed(b) for b in range(256)], np.uint64)
_BASE = _mixed(1 << 20) | 1
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse (mod 2**64), at least n."""
    global _powers
    if len(_powers[0]) < n:
        def table(base: int) -> np.ndarray:
            t = np.full(n, base, np.uint64)
            t[0] = 1
            return np.multiply.accumulate(t)
        _powers = (table(_BASE), table(pow(_BASE, -1, 1 << 64)))
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Words:
    """The words of some consecutive texts: ``data[starts[k]:ends[k]]`` is word
    k, text i has the words ``first[i]`` to ``first[i + 1]``, and the bytes
    ``offsets[i]`` to ``offsets[i + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, lower: bool = True) -> np.ndarray:
        """A 64-bit hash of each word, A-Z lower-cased unless told otherwise."""
        return self._hashed(_BYTE_CODE if lower else _BYTE_CODE_CASED)

    def byte_hashes(self) -> np.ndarray:
        """A 64-bit hash of the bytes from each start to the next, white space
        included: for units that lie end to end."""
        return self._hashed(_BYTE_CODE_ALL)

    def _hashed(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        word = 0
        while word < len(out):
            begin = self.starts[word]
            after = max(word + 1, int(np.searchsorted(self.ends, begin + HASHED_BYTES, "right")))
            v = codes[self.data[begin: self.ends[after - 1]]]
            up, down = _power_tables(len(v))
            v *= up[: len(v)]
            at = self.starts[word:after] - begin
            out[word:after] = mix(np.add.reduceat(v, at) * down[at])
            word = after
        return out

    def prefix_hashes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the words of n bytes at least, and a hash of their
        first n bytes, A-Z lower-cased."""
        long = np.flatnonzero(self.ends - self.starts >= n)
        up, _ = _power_tables(n)
        h = np.full(len(long), n, np.uint64)
        for k in range(n):
            h += _BYTE_CODE[self.data[self.starts[long] + k]] * up[k]
        return long, mix(h)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and its offsets; a null is an empty text."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, held = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_IS_SPACE[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1]
    before[cuts[cuts < len(data)]] = False
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:] & before[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Consecutive rows, about ``most`` bytes at a time (one text is never
    divided), with their words."""
    data, offsets = text_bytes(texts)
    row = 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end, split(data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row])
        row = end


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def read(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> tuple[DataFrame, str]:
    """``keep``, with the text after it if it isn't among them; its name."""
    small_batches(docs.sparkSession)
    kept = [F.col(f"`{c}`") for c in keep]
    return (docs.select(*kept), text) if text in keep else (docs.select(*kept, F.col(f"`{text}`").alias("__text")), "__text")
