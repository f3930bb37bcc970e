"""Packing of tokenised documents by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skydrift.llm.tables import small_batches
from skydrift.llm.words import Words, column, slices

CAPACITY = 4096
#: So many windows are balanced at a time; bounds a task's memory.
WINDOWS = 96
#: A worker keeps the ids of so many words before it starts anew.
MEMO_WORDS = 600_000
#: And those of so many parts of words.
MEMO_PARTS = 150_000


def byte_letters() -> str:
    """The letter that byte-level vocabularies write for each byte: itself if
    printable, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(spare)) for b in range(256))


class WordTokenizer:
    """Ids of texts by a tokenizer whose pre-tokens hold no white space, so that
    a text's ids are those of its words, one after another; each distinct word
    is encoded once. Words are known by a 64-bit hash."""

    #: Lower-case Latin letters, then ASCII punctuation: two pre-tokens at most.
    SIMPLE = re.compile(r"([A-Za-zß-öø-ÿ]*)([!-&(-/:;=?-@\[-`{}~]*)")

    def __init__(self, definition: str):
        self._whole = Tokenizer.from_str(definition)
        self._model = self._whole.model
        self._letters = byte_letters()
        self._forget()

    def _forget(self) -> None:
        self._hashes, self._place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._parts: dict[str, list[int]] = {}
        self._ids = np.zeros(0, "<u4")
        self._from = np.zeros(1, np.int64)

    def _part(self, part: str) -> list[int]:
        got = self._parts.get(part)
        if got is None:
            if len(self._parts) > MEMO_PARTS:
                self._parts.clear()
            shown = "".join([self._letters[b] for b in part.encode()])
            got = self._parts[part] = [t.id for t in self._model.tokenize(shown)]
        return got

    def word(self, word: str) -> list[int]:
        m = self.SIMPLE.fullmatch(word)
        if m is None:
            return self._whole.encode(word, add_special_tokens=False).ids
        a, b = m.groups()
        return (self._part(a.lower()) if a else []) + (self._part(b) if b else [])

    def _learn(self, words: list[str], hashes: np.ndarray) -> None:
        ids = [self.word(w) for w in words]
        ends = self._from[-1] + np.cumsum([len(x) for x in ids], dtype=np.int64)
        place = np.concatenate([self._place, len(self._from) - 1 + np.arange(len(words))])
        self._ids = np.concatenate([self._ids, np.array([i for x in ids for i in x], "<u4")])
        self._from = np.concatenate([self._from, ends])
        hashes = np.concatenate([self._hashes, hashes])
        rising = np.argsort(hashes, kind="stable")
        self._hashes, self._place = hashes[rising], place[rising]

    def encode(self, w: Words, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, ``end`` after each, and where each text begins."""
        if len(self._hashes) > MEMO_WORDS:
            self._forget()
        texts = len(w.first) - 1
        hashes, seen, word = np.unique(w.hashes(lower=False), return_index=True, return_inverse=True)
        at = np.searchsorted(self._hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self._hashes)
        new[inside] = self._hashes[at[inside]] != hashes[inside]
        if new.any():
            data, some = w.data.tobytes(), seen[new]
            self._learn([data[a:b].decode() for a, b in zip(w.starts[some].tolist(), w.ends[some].tolist())], hashes[new])
            at = np.searchsorted(self._hashes, hashes)
        place = self._place[at][word]
        length = self._from[place + 1] - self._from[place]
        before = np.concatenate([[0], np.cumsum(length)])
        source = np.arange(before[-1]) + np.repeat(self._from[place] - before[:-1], length)
        begin = before[w.first] + np.arange(texts + 1)
        out = np.full(int(begin[-1]), end, "<u4")
        inside = np.ones(len(out), bool)
        inside[begin[1:] - 1] = False
        out[inside] = self._ids[source]
        return out, begin


@lru_cache(maxsize=2)
def word_tokenizer(definition: str) -> WordTokenizer:
    return WordTokenizer(definition)


def karmarkar_karp(sizes: list[int], k: int) -> list[list[int]]:
    """k windows of item numbers with near-equal sums: the two partial
    partitions of the largest spread are merged, large sums with small ones,
    until one is left."""
    if k <= 1 or not sizes:
        return ([list(range(len(sizes)))] + [[] for _ in range(k - 1)])[:k]
    children: list[tuple[int, int]] = []

    def single(item: int) -> tuple[np.ndarray, np.ndarray]:
        sums, slot = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], slot[0] = sizes[item], item
        return sums, slot

    heap: list[tuple[int, int, tuple | None]] = [(-s, i, None) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    number, n = len(sizes), len(sizes)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, j, b = heapq.heappop(heap)
        (a_sums, a_slot), (b_sums, b_slot) = a or single(i), b or single(j)
        sums, b_slot = a_sums + b_sums[::-1], b_slot[::-1]
        slot = np.maximum(a_slot, b_slot)
        both = np.flatnonzero((a_slot >= 0) & (b_slot >= 0))
        slot[both] = n + len(children) + np.arange(len(both))
        children += zip(a_slot[both].tolist(), b_slot[both].tolist())
        order = np.argsort(-sums, kind="stable")
        sums, slot = sums[order], slot[order]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), number, (sums, slot)))
        number += 1
    _, i, last = heap[0]
    windows = []
    for node in (last or single(i))[1].tolist():
        window, todo = [], [node] if node >= 0 else []
        while todo:
            x = todo.pop()
            if x < n:
                window.append(x)
            else:
                todo += children[x - n]
        windows.append(sorted(window))
    return windows


Piece = tuple[int, int, int]  # document, its ids from .. to


def whole_windows(pieces: list[Piece], capacity: int) -> list[list[Piece]]:
    """Windows of whole pieces (none above the capacity); their number rises
    until none holds more than the capacity."""
    sizes = [b - a for _, a, b in pieces]
    k = -(-sum(sizes) // capacity)
    while True:
        windows = karmarkar_karp(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return [[pieces[i] for i in w] for w in windows if w]
        k += 1


def full_windows(pieces: list[Piece], capacity: int) -> list[list[Piece]]:
    """Windows of exactly the capacity from pieces that sum to a multiple of it:
    near-equal ones by differencing, then the little that one has too much is
    cut off and given to those that have too little."""
    sizes = [b - a for _, a, b in pieces]
    windows = [[pieces[i] for i in w] for w in karmarkar_karp(sizes, sum(sizes) // capacity)]
    spare: list[Piece] = []
    short = []
    for w in windows:
        over = sum(b - a for _, a, b in w) - capacity
        while over > 0:
            doc, a, b = w.pop()
            cut = max(a, b - over)
            if cut > a:
                w.append((doc, a, cut))
            spare.append((doc, cut, b))
            over -= b - cut
        if over < 0:
            short.append((w, -over))
    for w, room in short:
        while room:
            doc, a, b = spare.pop()
            cut = min(b, a + room)
            w.append((doc, a, cut))
            room -= cut - a
            if cut < b:
                spare.append((doc, cut, b))
    return windows


def split_off(pieces: list[Piece], tokens: int) -> tuple[list[Piece], list[Piece]]:
    """The pieces without their last ``tokens`` tokens, and those."""
    kept, last = list(pieces), []
    while tokens:
        doc, a, b = kept.pop()
        cut = max(a, b - tokens)
        if cut > a:
            kept.append((doc, a, cut))
        last.append((doc, cut, b))
        tokens -= b - cut
    return kept, last[::-1]


def pack_pieces(pieces: list[Piece], capacity: int, final: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows, and the pieces that wait for more; if final, those too make
    sequences, each of a power of two tokens, and so need no padding."""
    windows, rest = [], []
    for doc, a, b in pieces:
        while b - a >= capacity:
            windows.append([(doc, a, a + capacity)])
            a += capacity
        if b > a:
            rest.append((doc, a, b))
    rest, tail = split_off(rest, sum(b - a for _, a, b in rest) % capacity)
    windows += full_windows(rest, capacity)
    left = sum(b - a for _, a, b in tail)
    while final and left:
        size = 1 << (left.bit_length() - 1)
        tail, last = split_off(tail, size)
        windows.append(last)
        left -= size
    return windows, tail


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY,
         doc_id: str = "doc_id", text: str = "text", with_ids: bool = False, cut: bool = True) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, if asked for, its ``ids`` (binary, little-endian
    unsigned 32-bit).

    Each task tokenises its documents and packs them ``WINDOWS`` windows at a
    time, so nothing is shuffled and no task holds more than that and one
    document. With ``cut``, documents may be cut anywhere: all sequences are
    full, but for the last of a partition, which are powers of two. Without, a
    document is cut only at multiples of the capacity, and the number of windows
    rises until each holds its pieces.

    A null or empty text is the end id alone. Null and repeated doc_ids are
    documents like any other; an empty table gives no rows; sequence_id holds
    the partition number above bit 32."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    extra = [F.lit(b"").alias("ids")] if with_ids else []
    zero = F.lit(0).cast("long")
    schema = source.select("doc_id", *[zero.alias(c) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")], *extra).schema

    def run(batches):
        own = word_tokenizer(definition.value)
        sequence = TaskContext.get().partitionId() << 32
        ids: list[np.ndarray] = []      # of the documents at hand
        names: list = []
        waiting: list[Piece] = []
        held, kind = 0, None

        def pieces_of(final: bool):
            nonlocal sequence, ids, names, waiting, held
            if cut:
                windows, waiting = pack_pieces(waiting, capacity, final)
            else:
                parts = [(d, x, min(b, x + capacity)) for d, a, b in waiting for x in range(a, b, capacity)]
                windows, waiting = whole_windows(parts, capacity), []
            rows = []
            for window in windows:
                offset = 0
                for doc, a, b in window:
                    part = ids[doc][a:b]
                    rows.append((names[doc], a, b - a, zlib.crc32(part), len(ids[doc]), sequence, offset,
                                 *([part.tobytes()] if with_ids else [])))
                    offset += b - a
                sequence += 1
            used = sorted({doc for doc, _, _ in waiting})
            number = {doc: k for k, doc in enumerate(used)}
            ids, names = [ids[d] for d in used], [names[d] for d in used]
            waiting = [(number[d], a, b) for d, a, b in waiting]
            held = sum(b - a for _, a, b in waiting)
            columns = list(zip(*rows)) or [()] * len(schema)
            kinds = [kind, *[pa.int64()] * 6, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], schema.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            named = batch.column(0).to_pylist()
            for row, _, w in slices(column(batch, "__text")):
                flat, begin = own.encode(w, end_id)
                for k in range(len(begin) - 1):
                    own_ids = flat[begin[k]: begin[k + 1]].copy()
                    waiting.append((len(ids), 0, len(own_ids)))
                    ids.append(own_ids)
                    names.append(named[row + k])
                    held += len(own_ids)
                    if held >= WINDOWS * capacity:
                        yield pieces_of(False)
        if waiting:
            yield pieces_of(True)

    return source.mapInArrow(run, schema)
