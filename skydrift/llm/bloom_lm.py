"""Language-model scores from a log-frequency Bloom filter.

The counts of the corpus's unigrams and bigrams are quantised to levels, level
q for counts of 2^(q-1) and more. The filter holds each n-gram once for every
level up to its own; a count is read back by probing level after level until
one is absent. The filter is built in segments, each by one task from the
n-grams of one hash range; its size follows the counted levels, so that false
positives are alike at every size. Up to a stated bound the filter is
broadcast; beyond, the n-grams to be scored go to the segments' bits and their
levels come back.

The base score is that of a smoothed unigram model with exact counts. The
counts of the most frequent words are broadcast (a fixed number of them); those
of all other words are joined."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skydrift.llm.lookup import looked_up
from skydrift.llm.tables import written
from skydrift.llm.words import Words, column, mix, slices

BITS_PER_ENTRY = 8.0
PROBES = 4
#: A filter of more bytes is not broadcast.
MOST_BYTES = 128 << 20
#: Exact counts of so many words at most, the most frequent, are broadcast.
FREQUENT = 1_000_000
SEGMENT_TOKENS = 500_000
#: A task adds up so many tokens before it hands their counts on.
FLUSH_TOKENS = 3_000_000
#: Of a count below 2^63.
MOST_LEVEL = 63
ALPHA = 0.1
BIGRAM_SHARE = 0.2

END = np.uint64(0x1F3D5B79A2C4E6F1)
BEGIN = np.uint64(0x8A6C4E2F0D1B3957)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = 0xD1B54A32D192ED03
_LOW48 = np.uint64((1 << 48) - 1)


def tokens(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text and its end, and where each begins."""
    texts = len(w.first) - 1
    begin = w.first + np.arange(texts + 1)
    out = np.full(int(begin[-1]), END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[begin[1:] - 1] = False
    out[inside] = w.hashes()
    return out, begin


def bigrams(token: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token, a hash of it and its context, and the context's hash."""
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[begin[:-1]] = BEGIN
    return mix(context * _PAIR + token), context


def _added(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(hashes, return_counts=True)
    distinct, place = np.unique(hashes, return_inverse=True)
    return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)


def _segmented(hashes: np.ndarray, counts: np.ndarray, segments: int) -> pa.RecordBatch:
    """One row for each segment: its n-grams (6 bytes each) and their counts."""
    segment = _segment(hashes, segments)
    order = np.argsort(segment, kind="stable")
    hashes, counts, segment = hashes[order], counts[order], segment[order]
    names, at = np.unique(segment, return_index=True)
    edges = [*at.tolist(), len(segment)]
    low = (hashes & _LOW48).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    parts = [low[a:b].tobytes() for a, b in zip(edges, edges[1:])]
    small = [counts[a:b] for a, b in zip(edges, edges[1:])]
    wide = [x.astype("<u8").tobytes() if x.max() > 255 else x.astype(np.uint8).tobytes() for x in small]
    return pa.RecordBatch.from_arrays(
        [pa.array(names.astype(np.int32)), pa.array(parts, pa.binary()), pa.array(wide, pa.binary())], ["segment", "grams", "counts"])


def _segment(hashes: np.ndarray, segments: int) -> np.ndarray:
    return ((hashes >> np.uint64(48)) * np.uint64(segments)) >> np.uint64(16)


def _middle(level: np.ndarray) -> np.ndarray:
    """The middle of each level, as a count."""
    return np.where(level > 1, 1.5 * 2.0 ** (level.astype(float) - 1), level.astype(float))


def _levels(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(counts)).astype(np.int64) + 1


class Filter:
    """Segments of bits; segment s holds ``sizes[s]`` bits from byte ``at[s]``,
    and no level above ``tops[s]``."""

    def __init__(self, sizes: np.ndarray, bits: bytes, tops: np.ndarray | None = None):
        self.tops = np.full(len(sizes), MOST_LEVEL) if tops is None else tops
        self.sizes = sizes.astype(np.uint64)
        self.at = (np.cumsum(sizes) - sizes).astype(np.uint64) >> np.uint64(3)
        self.bits = np.frombuffer(bits, np.uint8)  # not copied

    @staticmethod
    def positions(low: np.ndarray, level: int, size) -> list[np.ndarray]:
        x = mix(low + np.uint64((level * _LEVEL) % (1 << 64)))
        a, step = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
        out = []
        for _ in range(PROBES):
            out.append((a * size) >> np.uint64(32))
            a = (a + step) & np.uint64(0xFFFFFFFF)
        return out

    @classmethod
    def segment(cls, low: np.ndarray, counts: np.ndarray, bits_per_entry: float) -> bytes:
        level = _levels(counts)
        size = max(64, -(-int(level.sum() * bits_per_entry) // 64) * 64)
        bits = np.zeros(size, bool)
        for q in range(1, int(level.max(initial=0)) + 1):
            for at in cls.positions(low[level >= q], q, np.uint64(size)):
                bits[at.astype(np.int64)] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The level of each n-gram by repeated probes; 0 if it is absent."""
        out = np.zeros(len(hashes), np.int64)
        if not len(self.bits):
            return out
        segment = _segment(hashes, len(self.sizes)).astype(np.int64)
        low, size, base, top = hashes & _LOW48, self.sizes[segment], self.at[segment], self.tops[segment]
        alive = np.flatnonzero(size)
        q = 1
        while len(alive):
            held = np.ones(len(alive), bool)
            for at in self.positions(low[alive], q, size[alive]):
                byte = self.bits[(base[alive] + (at >> np.uint64(3))).astype(np.int64)]
                held &= (byte >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            alive = alive[held]
            out[alive] = q
            alive = alive[top[alive] > q]
            q += 1
        return out

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        return _middle(self.levels(hashes))


def held_out(doc_id: F.Column) -> F.Column:
    """crc32 of the id as text, mod 10, is 0 (a null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _unigrams(training: DataFrame) -> DataFrame:
    def run(batches):
        waiting: list[np.ndarray] = []
        held = 0

        def flush():
            hashes, counts = _added(np.concatenate(waiting))
            return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], ["h", "c"])

        for batch in batches:
            for *_, w in slices(column(batch, "text")):
                token, _ = tokens(w)
                waiting.append(token)
                held += len(token)
                if held >= FLUSH_TOKENS:
                    yield flush()
                    waiting, held = [], 0
        if waiting:
            yield flush()

    return training.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def build(training: DataFrame, unigrams: DataFrame, segments: int) -> DataFrame:
    """segment, bits and top (its highest level) of the filter's segments, for
    the unigram counts (h, c) and the bigrams of the training texts."""
    schema = "segment int, grams binary, counts binary"

    def of_texts(batches):
        waiting: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for *_, w in slices(column(batch, "text")):
                token, begin = tokens(w)
                waiting.append(bigrams(token, begin)[0])
                held += len(token)
                if held >= FLUSH_TOKENS:
                    yield _segmented(*_added(np.concatenate(waiting)), segments)
                    waiting, held = [], 0
        if waiting:
            yield _segmented(*_added(np.concatenate(waiting)), segments)

    def of_counts(batches):
        for batch in batches:
            if batch.num_rows:
                yield _segmented(column(batch, "h").to_numpy().view(np.uint64), column(batch, "c").to_numpy(), segments)

    def finish(table: pa.Table) -> pa.Table:
        low, counts = [], []
        for grams, c in zip(table.column("grams").to_pylist(), table.column("counts").to_pylist()):
            six = np.frombuffer(grams, np.uint8).reshape(-1, 6)
            eight = np.zeros((len(six), 8), np.uint8)
            eight[:, :6] = six
            low.append(eight.view("<u8").ravel())
            counts.append(np.frombuffer(c, np.uint8 if len(c) == len(six) else "<u8").astype(np.int64))
        distinct, added = _added(np.concatenate(low), np.concatenate(counts))
        return pa.table({"segment": table.column("segment")[:1],
                         "bits": pa.array([Filter.segment(distinct, added, BITS_PER_ENTRY)], pa.binary()),
                         "top": pa.array([int(_levels(added).max())], pa.int32())})

    grams = training.select("text").mapInArrow(of_texts, schema).union(unigrams.select("h", "c").mapInArrow(of_counts, schema))
    return written(grams.groupBy("segment").applyInArrow(finish, "segment int, bits binary, top int"), "segments")


def collected(made: DataFrame, segments: int) -> tuple[np.ndarray, bytes, np.ndarray]:
    """The sizes (in bits), bits and highest levels of all segments. The driver
    holds the bits as they come and once more side by side."""
    table = made.toArrow()
    some = table.column("segment").to_numpy()
    held = [x.as_buffer() for chunk in table.column("bits").chunks for x in chunk]
    sizes, tops = np.zeros(segments, np.int64), np.zeros(segments, np.int64)
    sizes[some], tops[some] = [8 * x.size for x in held], table.column("top").to_numpy()
    return sizes, b"".join([held[k] for k in np.argsort(some)]), tops


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT,
          most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10), one row for each row of ``docs``, learning from those that are not
    held out.

    A token is a word (A-Z lower-cased) or the end of a text; a null text is
    empty and has its end only. Null ids count as the empty text for
    ``held_out``; repeated rows count each; a text of any length is scored whole. With no training rows all counts
    are 0 and every token has the same probability. Words are known by a 64-bit
    hash, n-grams in the filter by 48 bits and their segment."""
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    training = source.filter(~F.col("held_out"))
    unigrams = written(_unigrams(training), "unigrams")
    sizes = unigrams.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = sizes.n or 0, sizes.v
    # whole classes of like counts, from the highest on, as long as they fit
    like = F.floor(F.log2("c") * 8)
    taken, least = 0, None
    for r in sorted(unigrams.groupBy(like.alias("class")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        if taken + r.n > frequent:
            break
        taken, least = taken + r.n, r["class"]
    top = unigrams.filter(F.lit(False) if least is None else like >= least).toArrow()  # ``frequent`` rows at most
    hashes = top.column("h").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    segments = max(16, -(-n // SEGMENT_TOKENS))
    made = build(training, unigrams, segments)
    within = (made.agg(F.sum(F.octet_length("bits")).alias("n")).first().n or 0) <= most_bytes
    shared = spark.sparkContext.broadcast(
        (hashes[order], top.column("c").to_numpy()[order], collected(made, segments) if within else None))
    rare_left = v > taken
    spread = n + ALPHA * (v + 1)
    names = ["key", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"]

    def scored_rows(batch: pa.RecordBatch, w: Words, key: np.ndarray, counts) -> pa.RecordBatch:
        known, known_counts, _ = shared.value
        begins = counts(np.array([BEGIN]))[0] or counts(np.array([END]))[0]
        texts = batch.num_rows
        token, begin = tokens(w)
        owner = np.repeat(np.arange(texts), np.diff(begin))
        word, place = np.unique(token, return_inverse=True)
        at = np.minimum(np.searchsorted(known, word), max(0, len(known) - 1))
        exact = np.where(known[at] == word, known_counts[at], 0) if len(known) else np.zeros(len(word), np.int64)
        unigram = counts(word)
        gram, _ = bigrams(token, begin)
        before = np.empty(len(token))
        before[1:] = unigram[place[:-1]]
        before[begin[:-1]] = begins
        share = np.minimum(1.0, counts(gram) / np.maximum(1.0, before))
        p = BIGRAM_SHARE * share + (1 - BIGRAM_SHARE) * ((unigram + ALPHA) / spread)[place]
        c = exact[place]
        rare = np.flatnonzero(c == 0) if rare_left else np.zeros(0, np.int64)
        plain = np.log10((c + ALPHA) / spread)
        plain[rare] = 0.0
        ends = np.searchsorted(rare, begin)
        return pa.RecordBatch.from_arrays([
            pa.array(key), *batch.columns[:2], pa.array(np.diff(begin)),
            pa.array(np.bincount(owner, c > 0, texts).astype(np.int64)), pa.array(np.bincount(owner, plain, texts)),
            pa.array(np.bincount(owner, np.log10(p), texts)),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(token[rare].view(np.int64)))], names)

    def run(batches):
        lm = Filter(*shared.value[2])
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b, w in slices(column(batch, "text")):
                yield scored_rows(batch.slice(a, b - a), w, key + np.arange(b - a), lm.counts)
                key += b - a

    def asked(w: Words) -> np.ndarray:
        token, begin = tokens(w)
        return np.concatenate([token, bigrams(token, begin)[0], [BEGIN, END]])

    def probed(hashes: np.ndarray, one: dict) -> np.ndarray:
        if not one:
            return np.zeros(len(hashes), np.uint8)
        lm = Filter(np.array([8 * len(one["bits"])]), one["bits"], np.array([one["top"]]))
        return lm.levels(hashes).astype(np.uint8)

    def joined(batch: pa.RecordBatch, w: Words, key: np.ndarray, levels) -> pa.RecordBatch:
        return scored_rows(batch, w, key, lambda hashes: _middle(levels(hashes)))

    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"key long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, rare array<long>"
    scored = source.mapInArrow(run, schema) if within else looked_up(
        source, "text", asked, lambda hashes: _segment(hashes, segments), made, probed, joined, schema)
    total = F.lit(int(n)).cast("long").alias("train_tokens")
    if not rare_left:
        return scored.select("doc_id", "held_out", "n_tokens", "n_known", total, "base_score", "score")
    scored = written(scored, "scored")
    rest = scored.select("key", F.explode("rare").alias("h")).join(unigrams, "h", "left").groupBy("key").agg(
        F.count("c").alias("more"), F.sum(F.log10((F.coalesce("c", F.lit(0)) + ALPHA) / spread)).alias("part"))
    return scored.drop("rare").join(rest, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), total,
        (F.col("base_score") + F.coalesce("part", F.lit(0.0))).alias("base_score"), "score")
