"""Alignment of two tokenizers' tokens by lockstep vectorised merging.

Both tokenizers cut the same bytes. Where a token of each ends at one byte, the
text is cut; the tokens between two cuts are a group, and each token of one
side in it is linked to each of the other. The cuts are found by a merge of the
two lists of token ends, for all documents of a batch at once: a state vector
holds an A and a B pointer for each document (long ones are several lanes, cut
at blanks where both sides cut in any case); each step compares the ends under
all pointers, marks the cuts, moves the pointer that is behind, and from time
to time takes finished lanes out.

How many documents hold an id pair linked is counted by Spark. Up to a stated
number of pairs the counts are broadcast; beyond, a chunk's pairs go to the
segments of the table that hold them (``lookup.py``)."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skydrift.llm.kk_packing import byte_letters
from skydrift.llm.lookup import looked_up
from skydrift.llm.tables import written
from skydrift.llm.words import Words, column, read, slices

#: A lane of the merge takes about so many bytes of a document.
LANE_BYTES = 512
#: Finished lanes are taken out after so many steps.
COMPACT_STEPS = 16
#: A worker keeps the tokens of so many different units, before it starts anew.
MEMO_UNITS = 1_500_000
MEMO_TOKENS = 8_000_000
#: New units are encoded so many at a time.
JOINED_UNITS = 4_000
#: Counts of more pairs than this are not broadcast (16 bytes each).
MOST_PAIRS = 4_000_000
#: A task adds up so many pairs before it hands their counts on.
FLUSH_PAIRS = 2_000_000
#: Groups of more links are joined by their distinct ids.
WIDE_GROUP = 4096
#: Bits of a B id in a pair; the A id is above them.
ID_BITS = 20
#: So many A ids are one segment of the table of pairs.
SEGMENT_BITS = 6

_PROBE = ["don't we'll x=1,2;3 a_b (c) [d] {e}", "é naïve Straße ñandú übermäßig", "中文 字符 テスト 한국어", "tab\there\nnew line\r\n x",
          "1234 5678.90 € $5 a  b   c", "UPPER Case camelCase snake_case", "\U0001f600 emoji \U0001f9d1‍\U0001f680", "...!? -- 'quote' \"q\" I'm you're"]

# The place of a blank that both sides cut before: after and before a character
# that is certainly no white space, told by its bytes.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_TAIL = np.zeros(256, bool)
_TAIL[0x80:0xC0] = True
_LEAD2, _LEAD34 = np.zeros(256, bool), np.zeros(256, bool)
_LEAD2[0xC3:0xE0] = True
_LEAD34[0xE4:0xF5] = True
_OPENS = re.compile(rb"[\x21-\x7e\xc3-\xdf\xe4-\xf4]")
_CLOSES = re.compile(rb"(?:[\x21-\x7e]|[\xc3-\xdf][\x80-\xbf]|[\xe4-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})\Z")


@dataclass
class Aligned:
    """The tokens of some texts, with an empty list for those that have none:
    text i has the A tokens ``a_first[i]`` to ``a_first[i + 1]``, and group k the
    A tokens before ``a_ends[k]`` that no earlier group has; ``first`` are the
    groups of each text."""

    a: np.ndarray
    b: np.ndarray
    a_first: np.ndarray
    b_first: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    first: np.ndarray

    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return np.diff(self.a_ends, prepend=0), np.diff(self.b_ends, prepend=0)


def merged_cuts(a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, b_from: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the A and the B tokens that end at a cut. ``a_end`` and ``b_end``:
    rising ends of all lanes' tokens, lane after lane; lane k begins at the tokens
    ``a_from[k]`` and ``b_from[k]``, and its last two end at the same byte."""
    a_cut, b_cut = np.zeros(len(a_end) + 1, bool), np.zeros(len(b_end) + 1, bool)
    past = np.iinfo(np.int64).max  # a pointer that runs over the end stays there
    a_end, b_end = np.append(a_end, past), np.append(b_end, past)
    a, b, last = a_from.copy(), b_from.copy(), np.append(a_from[1:], len(a_end) - 1)
    a_top, b_top = len(a_end) - 1, len(b_end) - 1
    while len(a):
        for _ in range(COMPACT_STEPS):
            x, y = a_end[a], b_end[b]
            behind, ahead = x <= y, y <= x
            both = behind & ahead
            a_cut[a[both]] = True
            b_cut[b[both]] = True
            a += behind
            b += ahead
            np.minimum(a, a_top, out=a)
            np.minimum(b, b_top, out=b)
        # one that is past its lane has marked the next lane's cuts once more
        left = a < last
        a, b, last = a[left], b[left], last[left]
    return a_cut[:-1], b_cut[:-1]


class Pair:
    """Two tokenizers: a byte-level one (A), and one of pieces with byte fallback (B)."""

    def __init__(self, definition: str, model: bytes):
        self._a = Tokenizer.from_str(definition)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_proto=model)
        back = {letter: byte for byte, letter in enumerate(byte_letters())}
        shown = [self._a.id_to_token(i) or "" for i in range(self._a.get_vocab_size())]
        self.a_bytes = [bytes([back[c] for c in t]) if all(c in back for c in t) else b"" for t in shown]
        self.b_bytes = [self._piece(i) for i in range(self._b.get_piece_size())]
        if max(len(self.a_bytes), len(self.b_bytes)) >> ID_BITS:
            raise ValueError(f"ids of more than {ID_BITS} bits")
        self.a_length = np.array([len(t) for t in self.a_bytes], np.int32)
        self.b_length = np.array([len(t) for t in self.b_bytes], np.int32)
        self._whole = not self._cuts_at_blanks()
        self._forget()

    def _piece(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        if self._b.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return b"" if self._b.is_control(i) or self._b.is_unknown(i) else piece.replace("▁", " ").encode()

    def _ids(self, text: str) -> tuple[list[int], list[int]]:
        return self._a.encode(" " + text, add_special_tokens=False).ids, self._b.encode(text)

    def _cuts_at_blanks(self) -> bool:
        """That no token goes over a blank between other characters: by B's
        pieces, and for both by some texts."""
        if any(re.search("[^▁]▁", self._b.id_to_piece(i)) for i in range(len(self.b_bytes))):
            return False
        for text in [*_PROBE, " ".join(_PROBE)]:
            data, offsets = spaced(*_text_bytes([text]))
            at = self._starts(data, offsets)
            units = [data[x + 1: y].tobytes().decode() for x, y in zip(at, [*at[1:], len(data)])]
            parts = [self._ids(u) for u in units]
            if self._ids(text) != ([i for p in parts for i in p[0]], [i for p in parts for i in p[1]]):
                return False
        return True

    @staticmethod
    def _starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where units begin: with the blank before each text, and with each
        blank between two characters that are no white space."""
        before = np.concatenate([np.zeros(4, np.uint8), data[:-1]])  # before[i + 3] precedes data[i]
        p1, p2, p3, p4 = (before[3 - k: len(before) - k] for k in range(4))
        after = np.append(data[1:], np.uint8(0))
        blank = np.flatnonzero(data == 0x20)
        p1, p2, p3, p4, after = p1[blank], p2[blank], p3[blank], p4[blank], after[blank]
        left = _PLAIN[p1] | _TAIL[p1] & (_LEAD2[p2] | _TAIL[p2] & (_LEAD34[p3] | _TAIL[p3] & _LEAD34[p4]))
        begins = np.zeros(len(data), bool)
        begins[blank] = left & (_PLAIN[after] | _LEAD2[after] | _LEAD34[after])
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(begins)

    def _forget(self) -> None:
        self._hashes, self._place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._from = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self._held = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self._valid = np.zeros(0, bool)

    def _encoded(self, units: list[bytes]) -> list[tuple]:
        """Parts (A ids, B ids, A tokens and B tokens of each unit, whether their
        bytes are the unit's) for units that each follow a blank. All are encoded
        as one text; if its bytes differ, the halves are."""
        raw = b" " + b" ".join(units)
        a, b = (np.array(x, np.int32) for x in self._ids(raw[1:].decode()))
        ok = b"".join([self.a_bytes[i] for i in a.tolist()]) == raw and b"".join([self.b_bytes[i] for i in b.tolist()]) == raw
        if ok:
            ends = np.cumsum([len(u) + 1 for u in units])
            a_ends, b_ends = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
            at, bt = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
            if (a_ends[at] == ends).all() and (b_ends[bt] == ends).all():
                return [(a, b, np.diff(at, prepend=-1), np.diff(bt, prepend=-1), np.ones(len(units), bool))]
        if len(units) == 1:
            nothing = np.zeros(0, np.int32)
            return [(nothing, nothing, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, bool))]
        half = len(units) // 2
        return self._encoded(units[:half]) + self._encoded(units[half:])

    def _learn(self, units: list[bytes], hashes: np.ndarray) -> None:
        """``units`` without their first blank."""
        plain = [bool(_OPENS.match(u)) and bool(_CLOSES.search(u)) for u in units]
        order = [k for k, x in enumerate(plain) if x]
        some = [units[k] for k in order]
        parts = [x for n in range(0, len(some), JOINED_UNITS) for x in self._encoded(some[n: n + JOINED_UNITS])]
        for k, x in enumerate(plain):
            if not x:
                order.append(k)
                parts += self._encoded([units[k]])
        a, b, na, nb, valid = (np.concatenate(x) for x in zip(*parts))
        for side, ids, n in ((0, a, na), (1, b, nb)):
            self._from[side] = np.concatenate([self._from[side], self._from[side][-1] + np.cumsum(n)])
            self._held[side] = np.concatenate([self._held[side], ids])
        place = np.concatenate([self._place, len(self._valid) + np.arange(len(units))])
        self._valid = np.concatenate([self._valid, valid])
        hashes = np.concatenate([self._hashes, hashes[order]])
        rising = np.argsort(hashes, kind="stable")
        self._hashes, self._place = hashes[rising], place[rising]

    def _places(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The number of each unit among those that are known now."""
        if len(self._valid) > MEMO_UNITS or max(len(h) for h in self._held) > MEMO_TOKENS:
            self._forget()
        ends = np.append(starts[1:], len(data))
        one = np.zeros(2, np.int64)
        hashes, seen, unit = np.unique(Words(data, one, starts, ends, one).byte_hashes(), return_index=True, return_inverse=True)
        at = np.searchsorted(self._hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self._hashes)
        new[inside] = self._hashes[at[inside]] != hashes[inside]
        if new.any():
            text, some = data.tobytes(), seen[new]
            self._learn([text[x + 1: y] for x, y in zip(starts[some].tolist(), ends[some].tolist())], hashes[new])
            at = np.searchsorted(self._hashes, hashes)
        return self._place[at][unit]

    def align(self, data: np.ndarray, offsets: np.ndarray) -> Aligned:
        """Of the texts with the bytes ``offsets[i]`` to ``offsets[i + 1]``; a text
        that is empty, or whose tokens' bytes are not its own, has no tokens."""
        texts = len(offsets) - 1
        data, offsets = spaced(data, offsets)
        starts = offsets[:-1][np.diff(offsets) > 0] if self._whole else self._starts(data, offsets)
        place = self._places(data, starts) if len(starts) else np.zeros(0, np.int64)
        text = np.searchsorted(offsets, starts, "right") - 1
        # a unit that is not rendered takes its whole text out
        bad = np.bincount(text[~self._valid[place]], minlength=texts) > 0
        keep = ~bad[text]
        place, text, begin = place[keep], text[keep], starts[keep]
        flat, ends, unit_from, text_from = [], [], [], []
        for held, where, length in zip(self._held, self._from, (self.a_length, self.b_length)):
            n = where[place + 1] - where[place]
            after = np.cumsum(n)
            before = after - n
            ids = held[np.arange(int(n.sum())) + np.repeat(where[place] - before, n)]
            flat.append(ids)
            ends.append(np.cumsum(length[ids], dtype=np.int64))
            unit_from.append(before)
            text_from.append(np.concatenate([[0], np.cumsum(np.bincount(text, n, texts).astype(np.int64))]))
        lane = np.ones(len(place), bool)
        piece = (begin - offsets[text]) // LANE_BYTES
        lane[1:] = (text[1:] != text[:-1]) | (piece[1:] != piece[:-1])
        a_cut, b_cut = merged_cuts(*ends, unit_from[0][lane], unit_from[1][lane])
        a_ends, b_ends = np.flatnonzero(a_cut) + 1, np.flatnonzero(b_cut) + 1
        return Aligned(*flat, *text_from, a_ends, b_ends, np.searchsorted(a_ends, text_from[0], "right"))


def _text_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts, a blank before each that is not empty."""
    some = np.diff(offsets) > 0
    return np.insert(data, offsets[:-1][some], 0x20), offsets + np.concatenate([[0], np.cumsum(some)])


@lru_cache(maxsize=2)
def pair(definition: str, model: bytes) -> Pair:
    return Pair(definition, model)


def linked(x: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text, id pair (A id above B id) and number of links of each distinct pair
    of each text, in rising order."""
    na, nb = x.sizes()
    text = np.repeat(np.arange(len(x.first) - 1), np.diff(x.first))
    wide = np.flatnonzero(na * nb > WIDE_GROUP)
    some = np.flatnonzero(na * nb <= WIDE_GROUP)
    n, width = (na * nb)[some], nb[some]
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    width = np.repeat(width, n)
    a = x.a[np.repeat(x.a_ends[some] - na[some], n) + within // width]
    b = x.b[np.repeat(x.b_ends[some] - nb[some], n) + within % width]
    key = np.repeat(text[some], n).astype(np.uint64) << np.uint64(2 * ID_BITS) | a.astype(np.uint64) << np.uint64(ID_BITS) | b.astype(np.uint64)
    key, times = np.unique(key, return_counts=True)
    if len(wide):
        keys, counts = [key], [times]
        for k in wide.tolist():
            ia, ca = np.unique(x.a[x.a_ends[k] - na[k]: x.a_ends[k]], return_counts=True)
            ib, cb = np.unique(x.b[x.b_ends[k] - nb[k]: x.b_ends[k]], return_counts=True)
            keys.append(((np.uint64(text[k]) << np.uint64(2 * ID_BITS)) | ia.astype(np.uint64)[:, None] << np.uint64(ID_BITS)
                         | ib.astype(np.uint64)).ravel())
            counts.append((ca[:, None] * cb).ravel())
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, place, np.concatenate(counts))
        times = total
    return (key >> np.uint64(2 * ID_BITS)).astype(np.int64), key & np.uint64((1 << 2 * ID_BITS) - 1), times


@lru_cache(maxsize=4)
def _decimals(top: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal letters of 0 to ``top``, left-aligned, and how many each has."""
    text = np.arange(top + 1).astype(f"S{len(str(top))}")
    letters = text.view(np.uint8).reshape(top + 1, -1)
    return letters, (letters > 0).sum(1).astype(np.int64)


def shown(x: Aligned) -> pa.Array:
    """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
    na, nb = x.sizes()
    n = len(x.a) + len(x.b)
    ids, mark = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    group = np.arange(len(na))
    a_at = np.arange(len(x.a)) + np.repeat((x.b_ends - nb)[group], na)
    b_at = np.arange(len(x.b)) + np.repeat(x.a_ends[group], nb)
    ids[a_at], ids[b_at] = x.a, x.b
    mark[x.a_ends + x.b_ends - nb - 1] = ord("|")
    mark[x.a_ends + x.b_ends - 1] = ord(";")
    letters, wide = _decimals((1 << int(ids.max()).bit_length()) - 1 if n else 0)
    digits = wide[ids]
    first = x.a_first + x.b_first
    length = digits + 1
    length[first[1:][np.diff(first) > 0] - 1] -= 1  # nothing after a text's last
    ends = np.cumsum(length)
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    begin = ends - length
    follows = length > digits
    out[ends[follows] - 1] = mark[follows]
    some = np.arange(n)
    for k in range(letters.shape[1]):
        some = some[digits[some] > k]
        out[begin[some] + k] = letters[ids[some], k]
    edges = np.concatenate([[0], ends])[first]
    return pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(out))


def _counted(texts: DataFrame, own) -> DataFrame:
    """pair and n, the number of the rows of ``texts`` (text) that hold it linked."""
    def run(batches):
        waiting, held = [], 0

        def taken():
            some, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), pa.array(n)], ["pair", "n"])

        for batch in batches:
            for *_, w in slices(column(batch, "text")):
                waiting.append(linked(own().align(w.data, w.offsets))[1])
                held += len(waiting[-1])
                if held >= FLUSH_PAIRS:
                    yield taken()
                    waiting, held = [], 0
        if waiting:
            yield taken()

    return texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, a_path: str, b_path: str, keep: tuple[str, ...] = ("doc_id",),
          most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``keep`` (any columns but those that follow), n_a, n_b, n_groups, n_links,
    n_best, count_sum (long) and ``groups`` (string: ``a1,a2|b1;a3|b2,b3``) for
    each row of ``docs`` (text). A: a byte-level tokenizer's definition, given a
    blank and the text; B: a model of pieces with byte fallback that puts that
    blank there itself. ``n_best``: links whose pair's count (the number of rows
    that hold it linked) is the highest of its A id's pairs; ``count_sum``: the
    sum of the links' counts.

    A null or empty text, and one that either side does not render byte by byte,
    has no tokens: zeros and an empty string. A long text is merged in several
    lanes, but nothing of it is left out; one without blanks is one lane. Nulls,
    ties and repeated rows in ``keep`` pass through, each row being a document;
    an empty table gives no rows; other columns are not read."""
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:  # some MB, fixed
        files = spark.sparkContext.broadcast((f.read(), g.read()))

    def own() -> Pair:
        return pair(*files.value)

    source, text = read(docs, keep)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = source.select(*source.columns[:len(keep)], *[F.lit(0).cast("long").alias(c) for c in names], F.lit("").alias("groups")).schema
    # within an A id there are no more pairs than B ids
    best = F.max("n").over(Window.partitionBy(F.shiftright("pair", ID_BITS)))
    counted = written(_counted(docs.select("text"), own), "pairs")
    # twice the count, and one if it is the A id's highest
    table = written(counted.select("pair", (2 * F.col("n") + (F.col("n") == best).cast("long")).alias("told")), "told")

    def finished(batch: pa.RecordBatch, w: Words, found) -> pa.RecordBatch:
        x = own().align(w.data, w.offsets)
        texts = batch.num_rows
        na, nb = x.sizes()
        owner, key, times = linked(x)
        told = found(key)
        links, best_links, total = (np.zeros(texts, np.int64) for _ in range(3))
        np.add.at(links, np.repeat(np.arange(texts), np.diff(x.first)), na * nb)
        np.add.at(best_links, owner, times * (told & 1))
        np.add.at(total, owner, times * (told >> 1))
        made = [np.diff(x.a_first), np.diff(x.b_first), np.diff(x.first), links, best_links, total]
        return pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *(pa.array(m.astype(np.int64)) for m in made), shown(x).cast(pa.string())],
                                          schema.names)

    if table.count() > most_pairs:
        low = ID_BITS + SEGMENT_BITS

        def gathered(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("pair")
            return pa.table({"segment": pa.array([rows.column("pair")[0].as_py() >> low], pa.int32()), **{
                c: pa.array([np.ascontiguousarray(rows.column(c).to_numpy(), "<i8").tobytes()], pa.binary()) for c in ("pair", "told")}})

        def answer(keys: np.ndarray, one: dict) -> np.ndarray:
            if not one:
                return np.zeros(len(keys), "<i8")
            return np.frombuffer(one["told"], "<i8")[np.searchsorted(np.frombuffer(one["pair"], "<i8"), keys.astype(np.int64))]

        # a segment has no more pairs than its A ids have with all B ids
        segments = table.groupBy(F.shiftright("pair", low).cast("int").alias("segment")).applyInArrow(gathered, "segment int, pair binary, told binary")
        return looked_up(source, text, lambda w: np.unique(linked(own().align(w.data, w.offsets))[1]), lambda k: k >> np.uint64(low),
                         written(segments, "segments"), answer, lambda batch, w, _, found: finished(batch, w, found), schema)

    rows = table.toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast((rows.column("pair").to_numpy(), rows.column("told").to_numpy()))

    def run(batches):
        pairs, told = shared.value
        for batch in batches:
            for a, b, w in slices(column(batch, text)):
                yield finished(batch.slice(a, b - a), w, lambda key: told[np.searchsorted(pairs, key.astype(np.int64))])

    return source.mapInArrow(run, schema)
