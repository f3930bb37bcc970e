"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is cut into segments; the vector of their bit counts is a
point on an integer grid, and the Manhattan distance of two points never
exceeds the Hamming distance of the fingerprints. Fingerprints within d bits
are found by a range join on that grid: each one looks into the cells within
Manhattan distance d of its own, and each candidate is verified by its exact
Hamming distance.

The join is kept selective by what the distance leaves over. A pair differs in
a set S of segments, each at a cost of at least one bit, or two where its bit
count stays the same; the segments outside S agree bit for bit. So the key of
a look-up is (S, cell, bits outside S). S belongs to the pair, so each link
comes out once, and a crowded cell is divided by the exact bits."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
import xxhash

from skydrift.llm.components import components
from skydrift.llm.tables import written
from skydrift.llm.words import Words, column, read, slices

BITS = 64
SEGMENTS = 4
SEED = 42


def _fingerprints(w: Words, shingle: int) -> np.ndarray:
    """One fingerprint for each text of the slice."""
    n = w.counts()
    texts = len(n)
    out = np.zeros(texts, np.uint64)
    if not len(w.starts):
        return out
    length = w.ends - w.starts
    # words joined by single spaces
    ends = np.cumsum(length + 1) - 1
    starts = ends - length
    joined = np.full(int(ends[-1]) + 1, 0x20, np.uint8)
    held = np.zeros(len(w.data) + 1, np.int8)
    held[w.starts] += 1
    held[w.ends] -= 1
    inside = np.cumsum(held[:-1], dtype=np.int8).astype(bool)
    joined[np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)] = w.data[inside]
    upper = (joined >= 65) & (joined <= 90)
    joined[upper] += 32
    text = joined.tobytes()
    made = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    begin = np.concatenate([[0], np.cumsum(made)])
    owner = np.repeat(np.arange(texts), made)
    word = w.first[:-1][owner] + np.arange(begin[-1]) - begin[:-1][owner]
    last = np.minimum(word + shingle, w.first[1:][owner]) - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(text[a:b], SEED) for a, b in zip(starts[word].tolist(), ends[last].tolist())], "<u8")
    some = np.flatnonzero(made)
    for a in range(0, len(some), 512):  # some texts at a time: 64 bytes a shingle
        part = some[a: a + 512]
        lo, hi = begin[part[0]], begin[part[-1] + 1]
        bits = np.unpackbits(h[lo:hi].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, begin[part] - lo, axis=0, dtype=np.int64)
        most = 2 * ones > made[part][:, None]
        out[part] = np.packbits(most, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``fp`` (long) and ``row``, a number of the row: a bit is 1 if
    set in over half the XXH64 values of the text's word shingles (repeats
    included). A null text, and one without words, has fingerprint 0; a text of
    fewer words than a shingle has its whole word sequence as the one shingle."""
    source, text = read(docs, keep)
    zero = F.lit(0).cast("long")
    schema = source.select(*source.columns[:len(keep)], zero.alias("fp"), zero.alias("row")).schema

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            found = [_fingerprints(w, shingle) for _, _, w in slices(column(batch, text))]
            fp = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(fp.view(np.int64)), pa.array(row + np.arange(len(fp)))], schema.names)
            row += len(fp)

    return source.mapInArrow(run, schema)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _looks(bits: int, segments: int) -> list[tuple[tuple[int, ...], list[tuple[int, ...]]]]:
    """Each set S of segments that a pair within ``bits`` can differ in, with the
    shifts of their bit counts, one of each pair of opposite shifts."""
    out = []
    for size in range(1, min(bits, segments) + 1):
        shifts = [d for d in product(range(-bits, bits + 1), repeat=size)
                  if sum(abs(x) or 2 for x in d) <= bits and d >= tuple(-x for x in d)]
        out += [(s, shifts) for s in combinations(range(segments), size)]
    return out


def links(prints: DataFrame, bits: int = 2, segments: int = SEGMENTS) -> DataFrame:
    """Pairs (u, v) of different fingerprints of ``prints`` (fp, distinct) that
    differ in ``bits`` bits at most, each once."""
    width = -(-BITS // segments)
    spans = [((1 << max(0, min(width, BITS - k * width))) - 1) << (k * width) for k in range(segments)]
    fp = F.col("fp")

    def counted(k: int) -> Column:
        return F.bit_count(fp.bitwiseAND(F.lit(_signed(spans[k]))))

    cells, looks = [], []
    for number, (s, shifts) in enumerate(_looks(bits, segments)):
        rest = fp.bitwiseAND(F.lit(_signed(((1 << BITS) - 1) & ~sum(spans[k] for k in s))))
        cells.append(F.xxhash64(F.lit(number), rest, *[counted(k) for k in s]))
        looks += [F.xxhash64(F.lit(number), rest, *[counted(k) + F.lit(d) for k, d in zip(s, shift)])
                  for shift in shifts]
    schema = "u long, v long"
    if not cells:
        return prints.sparkSession.createDataFrame([], schema)
    cell = prints.select(F.explode(F.array(*cells)).alias("key"), fp.alias("v"))
    look = prints.select(F.explode(F.array(*looks)).alias("key"), fp.alias("u"))
    u, v = F.col("u"), F.col("v")

    def at(x: Column, k: int) -> Column:
        return F.bit_count(x.bitwiseAND(F.lit(_signed(spans[k]))))

    manhattan = sum((F.abs(at(u, k) - at(v, k)) for k in range(segments)), F.lit(0))
    near = look.join(cell, "key").filter((u != v) & (manhattan <= bits) & (F.bit_count(u.bitwiseXOR(v)) <= bits))
    # a shift of 0 finds a pair from either side
    return near.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct()


def _grouped(docs: DataFrame, shingle: int, bits: int, segments: int, keep: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The rows with their fingerprints, and for each distinct fingerprint the
    ``first`` row of its component: that of the smallest doc_id, nulls last."""
    own = written(fingerprints(docs, shingle, keep=keep), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    least = written(own.groupBy("fp").agg(F.min(place).alias("least")), "prints")
    roots = components(links(least.select("fp"), bits, segments))
    rooted = least.join(roots, least.fp == roots.node, "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    whole = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return own, rooted.join(whole, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, segments: int = SEGMENTS) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, fp (long) and
    component_id, the smallest doc_id that links of at most ``bits`` differing
    bits reach.

    A text of any length gives one fingerprint. Copies meet in it, so links are between distinct fingerprints
    only. Null doc_ids are kept; they are never a component_id unless the whole
    component has no other. Repeated rows each have their row; an empty table
    gives an empty result; further columns play no part."""
    own, named = _grouped(docs, shingle, bits, segments, ("doc_id",))
    return own.join(named, "fp").select("doc_id", "fp", F.col("first.doc_id").alias("component_id"))


def first_of_each(docs: DataFrame, shingle: int = 3, bits: int = 2, segments: int = SEGMENTS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others but ``fp`` and ``row``)
    without near-duplicates: of each component the one row of the smallest
    doc_id, any one of them if rows of that id are several or have no id."""
    own, named = _grouped(docs, shingle, bits, segments, tuple(docs.columns))
    firsts = named.select("first.row").distinct()
    return own.join(firsts, "row", "left_semi").select(*docs.columns)


def hex_print(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
