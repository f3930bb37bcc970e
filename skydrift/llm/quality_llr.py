"""Quality rules by a hashed n-gram log-likelihood ratio.

Word unigrams and bigrams are hashed into buckets, whose number follows that of
the corpus's distinct n-grams, so that collisions are alike at every size. Two multinomials over the
buckets are counted: that of documents labelled as good, and that of the whole
raw corpus. A document's score is the mean log ratio of the two over its
n-grams; every document is judged by the same fixed threshold."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skydrift.llm.lookup import looked_up
from skydrift.llm.tables import small_batches, written
from skydrift.llm.words import Words, column, mix, read, slices

#: So many buckets at least.
BUCKETS = 1 << 17
#: So many distinct n-grams a bucket at most, on average.
LOAD = 4
#: One of so many n-grams, by their hashes, is counted for that.
COUNTED = 256
#: More buckets than this are not broadcast.
MOST_SHARED = 1 << 24
#: A row of the table of buckets.
SEGMENT = 1 << 15
#: A task holds a count for each bucket up to so many; beyond, it adds up so many
#: n-grams before it hands their counts on.
DENSE = 1 << 21
FLUSH_GRAMS = 4_000_000
#: The counts of so many tasks are added by one.
BLOCK_TASKS = 32
#: So many ids of trusted documents are broadcast at most (8 bytes each).
MOST_IDS = 4_000_000
#: Of the table that tells which documents may be trusted (8 MB), where they are more.
MARK_BITS = 1 << 26
#: So many n-grams of the raw corpus's own mix are added to each bucket of both
#: multinomials, so that a bucket of few n-grams has a ratio near 1.
SMOOTHING = 10.0
THRESHOLD = -0.2

MIN_WORDS = 10
WINDOW = 5
MOST_REPEATED_PERCENT = 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _spanned(w: Words, n: int) -> np.ndarray:
    """Numbers of the words that begin a run of n words of one text."""
    begin = np.arange(len(w.starts) - n + 1) if len(w.starts) >= n else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(w.first) - 1), w.counts())
    return begin[text[begin] == text[begin + n - 1]]


def n_grams(w: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the slice's unigrams and bigrams, and the text of each."""
    text = np.repeat(np.arange(len(w.first) - 1), w.counts())
    pair = _spanned(w, 2)
    both = mix(hashes[pair] * np.uint64(3) + hashes[pair + 1]) if len(pair) else np.zeros(0, np.uint64)
    return np.concatenate([hashes, both]), np.concatenate([text, text[pair]])


def repeated_words(w: Words, hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text, the words that lie in a window found twice or more in it."""
    texts = len(w.first) - 1
    begin = _spanned(w, window)
    if not len(begin):
        return np.zeros(texts, np.int64)
    text = np.repeat(np.arange(texts), w.counts())
    key = text[begin].astype(np.uint64)
    for k in range(window):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[begin + k])
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(len(w.starts) + 1, np.int64)
    np.add.at(cover, begin[again], 1)
    np.add.at(cover, begin[again] + window, -1)
    return _per_text(np.cumsum(cover[:-1]) > 0, w.first)


def repeated_lines(texts: list[bytes]) -> list[int]:
    out = []
    for t in texts:
        lines = [x for x in t.split(b"\n") if x.strip()]
        out.append(len(lines) - len(set(lines)))
    return out


def base(w: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """The plain counts of each text."""
    inside = np.zeros(len(w.data) + 1, np.int8)
    inside[w.starts] += 1
    inside[w.ends] -= 1
    held = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    data, at = w.data.tobytes(), w.offsets.tolist()
    return {
        "n_words": w.counts().astype(np.int64),
        "word_chars": _per_text(held & ((w.data & 0xC0) != 0x80), w.offsets),
        "n_symbols": _per_text(_SYMBOL[w.data], w.offsets),
        "n_dup_lines": np.array(repeated_lines([data[a:b] for a, b in zip(at, at[1:])]), np.int64),
        "n_repeat_words": repeated_words(w, hashes),
    }


def buckets_for(docs: DataFrame, least: int = BUCKETS) -> int:
    """A power of two that the distinct n-grams of ``docs`` (text) load at most
    ``LOAD`` times."""
    def run(batches):
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            for *_, w in slices(column(batch, "text")):
                gram = mix(n_grams(w, w.hashes(lower=False))[0])
                seen = np.union1d(seen, gram[gram % np.uint64(COUNTED) == 0])
                if len(seen) > FLUSH_GRAMS:
                    yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64))], ["gram"])
                    seen = seen[:0]
        yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64))], ["gram"])

    small_batches(docs.sparkSession)
    distinct = docs.select("text").mapInArrow(run, "gram long").distinct().count() * COUNTED
    return max(least, 1 << max(0, -(-distinct // LOAD) - 1).bit_length())


def _packed(side: int, block: int, some: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A row for each segment of the rising bucket numbers ``some``: which of its
    buckets have counts and each count if below 255, compressed, and the counts
    that are not."""
    names, at = np.unique(some // SEGMENT, return_index=True)
    spans = list(zip(at.tolist(), [*at[1:].tolist(), len(some)]))
    few = np.minimum(counts, 255).astype(np.uint8)
    packed = []
    for a, b in spans:
        held = np.zeros(SEGMENT, bool)
        held[some[a:b] % SEGMENT] = True
        press = zlib.compressobj(1, strategy=zlib.Z_RLE)
        packed.append(press.compress(np.packbits(held).tobytes() + few[a:b].tobytes()) + press.flush())
    n = len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, side, np.int32)), pa.array(names.astype(np.int32)), pa.array(np.full(n, block)), pa.array(packed, pa.binary()),
         pa.array([counts[a:b][few[a:b] == 255].astype("<i8").tobytes() for a, b in spans], pa.binary()),
         pa.array([int(counts[a:b].sum()) for a, b in spans], pa.int64())],
        [c.split()[0] for c in _COUNTS.split(", ")])


_COUNTS = "side int, segment int, block long, few binary, many binary, total long"


def _unpacked(rows: pa.Table) -> np.ndarray:
    """The sum of rows of one segment, for either side."""
    out = np.zeros((2, SEGMENT), np.int64)
    for side, few, many in zip(*(rows.column(c).to_pylist() for c in ("side", "few", "many"))):
        flat = np.frombuffer(zlib.decompress(few), np.uint8)
        counts = flat[SEGMENT // 8:].astype(np.int64)
        counts[counts == 255] = np.frombuffer(many, "<i8")
        out[side, np.flatnonzero(np.unpackbits(flat[: SEGMENT // 8]))] += counts
    return out


def _merged(rows: pa.Table) -> pa.Table:
    segment, block = rows.column("segment")[0].as_py(), rows.column("block")[0].as_py() // BLOCK_TASKS
    made = []
    for side, counts in enumerate(_unpacked(rows)):
        low = np.flatnonzero(counts)
        made.append(_packed(side, block, segment * SEGMENT + low, counts[low]))
    return pa.Table.from_batches(made)


def _counted(texts: DataFrame, side: int, buckets: int) -> DataFrame:
    """What each task counts of the n-grams of ``texts`` (text)."""
    def run(batches):
        block = TaskContext.get().partitionId()
        dense = np.zeros(buckets if buckets <= DENSE else 0, np.int64)
        kind = np.uint32 if buckets <= 1 << 32 else np.uint64
        waiting, held = [], 0
        for batch in batches:
            for *_, w in slices(column(batch, "text")):
                bucket = (n_grams(w, w.hashes(lower=False))[0] & np.uint64(buckets - 1)).astype(kind)
                if len(dense):
                    np.add.at(dense, bucket, 1)
                    continue
                waiting.append(bucket)
                held += len(bucket)
                if held >= FLUSH_GRAMS:
                    yield _packed(side, block, *np.unique(np.concatenate(waiting), return_counts=True))
                    waiting, held = [], 0
        if held:
            yield _packed(side, block, *np.unique(np.concatenate(waiting), return_counts=True))
        if len(dense):
            some = np.flatnonzero(dense)
            yield _packed(side, block, some, dense[some])

    return texts.select("text").mapInArrow(run, _COUNTS)


def _named(docs: DataFrame, ids: DataFrame, most: int = MOST_IDS) -> DataFrame:
    """text of the rows of ``docs`` whose doc_id is among ``ids`` (distinct). Up to
    ``most`` ids are broadcast, and no text is shuffled. Of more, a table of bits
    (MARK_BITS / 64 rows at most) is broadcast, so that few other texts are
    shuffled to the exact join (an inner one: a semi-join would be moved below
    the table of bits)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = written(ids, "ids")
    if ids.count() <= most:
        return own.join(F.broadcast(ids), "doc_id").select("text")
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(MARK_BITS))
    word = F.shiftright(slot, 6)

    def bit(x: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(x, F.lit(64)).cast("int"))

    marks = ids.select(word.alias("word"), bit(slot).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return own.withColumn("word", word).join(F.broadcast(marks), "word").filter(F.col("bits").bitwiseAND(bit(slot)) != 0) \
        .join(ids, "doc_id").select("text")


def fit(docs: DataFrame, trusted: DataFrame, buckets: int) -> DataFrame | None:
    """segment and ratios: the log ratios of ``SEGMENT`` buckets each (float32; 0
    for segments without a row); None if nothing is trusted. ``trusted``
    (doc_id) names the documents of the target; all of them are counted. Each
    task adds up its n-grams before the shuffle, and the tasks' sums are added
    ``BLOCK_TASKS`` tasks at a time."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    rows = _counted(docs, 0, buckets).unionAll(_counted(_named(docs, ids), 1, buckets))
    while True:
        rows = written(rows.groupBy("segment", F.floor(F.col("block") / BLOCK_TASKS).alias("group")).applyInArrow(_merged, _COUNTS), "counts")
        n = rows.agg(F.max("block").alias("top"), *[F.sum(F.when(F.col("side") == k, F.col("total"))).alias(c)
                                                  for k, c in enumerate(("raw", "target"))]).first()
        if not n.top:
            break
    if not n.target:
        return None
    share = n.target / n.raw

    def ratios(held: pa.Table) -> pa.Table:
        raw, target = _unpacked(held)
        made = np.log((target + SMOOTHING * share) / ((raw + SMOOTHING) * share)).astype("<f4").tobytes()
        return pa.table({"segment": held.column("segment")[:1], "ratios": pa.array([made], pa.binary())})

    return rows.groupBy("segment").applyInArrow(ratios, "segment int, ratios binary")


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",),
          most_shared: int = MOST_SHARED) -> DataFrame:
    """``keep`` (any columns but those that follow), the counts n_words,
    word_chars, n_symbols, n_dup_lines and n_repeat_words, base_failed, score and
    kept, for each row of ``docs`` (doc_id, text).

    A null text has no words, and so fails the base rules, with score 0; a text
    of any length is judged whole; null and repeated doc_ids are judged like
    others; an empty table gives no rows. Columns not named are not read."""
    spark = docs.sparkSession
    buckets = buckets_for(docs)
    table = fit(docs, trusted, buckets)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    source, text = read(docs, keep)
    schema = source.select(*source.columns[:len(keep)], *[F.lit(0).cast("long").alias(c) for c in names],
                           F.lit(False).alias("base_failed"), F.lit(0.0).alias("score"), F.lit(False).alias("kept")).schema

    def judged(batch: pa.RecordBatch, w: Words, ratio) -> pa.RecordBatch:
        hashes = w.hashes(lower=False)
        counts = base(w, hashes)
        gram, owner = n_grams(w, hashes)
        texts = batch.num_rows
        total = np.bincount(owner, ratio(gram & np.uint64(buckets - 1)), texts)
        score = total / np.maximum(1, np.bincount(owner, minlength=texts))
        n, repeated = counts["n_words"], counts["n_repeat_words"]
        failed = (n < MIN_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)
        made = [*(counts[c] for c in names), failed, score, ~failed & (score >= threshold)]
        return pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *(pa.array(x) for x in made)], schema.names)

    if table is not None and buckets > most_shared:
        def asked(w: Words) -> np.ndarray:
            return n_grams(w, w.hashes(lower=False))[0] & np.uint64(buckets - 1)

        def answer(bucket: np.ndarray, one: dict) -> np.ndarray:
            return np.frombuffer(one["ratios"], "<f4")[(bucket % np.uint64(SEGMENT)).astype(np.int64)] if one else np.zeros(len(bucket), "<f4")

        return looked_up(source, text, asked, lambda bucket: bucket // np.uint64(SEGMENT), table, answer,
                         lambda batch, w, _, ratio: judged(batch, w, ratio), schema)

    held = np.zeros(buckets, np.float32)
    for segment, x in zip(*table.toArrow().to_pydict().values()) if table is not None else ():
        held[segment * SEGMENT: (segment + 1) * SEGMENT] = np.frombuffer(x, "<f4")
    weights = spark.sparkContext.broadcast(held)

    def run(batches):
        for batch in batches:
            for a, b, w in slices(column(batch, text)):
                yield judged(batch.slice(a, b - a), w, lambda bucket: weights.value[bucket.astype(np.int64)])

    return source.mapInArrow(run, schema)
