"""Line deduplication by a log-template tree.

Lines are parsed by a tree of fixed depth: the number of their words, then
their leading words. Words that hold a digit are variable fields from the start,
unless they are more than a third of the line: such a line says little but its
figures, and is compared by its own words only.
Within a leaf, lines that share most of their words, place by place, are linked,
and those that links reach are of one template; the places where they differ are
variable fields too. The lines of a crowded leaf meet in bands, by the words of
every k-th place, where k is one more than the places in which lines alike may
differ: they share one of them. A band larger than a block is dealt into blocks;
then its lines that are not in its largest component yet meet all others of the
band. A template that recurs across documents stays in the first of them, and its
lines are dropped from the others."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skydrift.llm.components import components
from skydrift.llm.tables import written
from skydrift.llm.words import Words, column, mix, slices

LEADING = 3
MIN_WORDS = 5
MIN_DOCS = 2
#: Share of a line's words, digits aside, that must be fixed in its template.
SIMILARITY = 0.8
#: So many lines are held against each other at a time.
BLOCK = 1000
#: Size of the table of crowded leaves that is broadcast; when it fills up,
#: more lines than needed are looked at, none fewer.
LEAF_BITS = 1 << 26

#: Share of a line's words without digits from which on digits are variable.
LEAST_PLAIN = 2 / 3

_VARIABLE = np.uint64(0x5A17B3C94D2E8F61)
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


class Lines:
    """The lines of a slice that hold words: ``text`` and ``number`` of each,
    its ``words``, and hashes of its ``leaf`` and of its whole, with the variable
    fields left open."""

    def __init__(self, w: Words):
        feeds = np.flatnonzero(w.data == 10) + 1
        edges = np.union1d(feeds, w.offsets[:-1])
        line = np.searchsorted(edges, w.starts, "right") - 1
        first = np.flatnonzero(np.diff(line, prepend=-1))
        token = w.hashes(lower=False)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[w.data])])
        digit = digits[w.ends] > digits[w.starts]
        words = np.diff(np.append(first, len(line)))
        figures = np.add.reduceat(digit, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
        alone = words - figures < LEAST_PLAIN * words
        token[digit & ~np.repeat(alone, words)] = _VARIABLE
        place = np.arange(len(line)) - np.repeat(first, words)
        placed = mix(token * np.uint64(3) + place.astype(np.uint64))
        self.token, self.first, self.words = token, first, words
        if len(first):
            self.whole = mix(np.add.reduceat(placed, first) + words.astype(np.uint64))
            lead = np.where(place < LEADING, placed, np.uint64(0))
            leaf = mix(np.add.reduceat(lead, first) ^ (words.astype(np.uint64) << np.uint64(32)))
            self.leaf = np.where(alone, self.whole, leaf)  # no other line's
        else:
            self.whole = self.leaf = np.zeros(0, np.uint64)
        self.text = np.searchsorted(w.offsets, w.starts[first], "right") - 1
        before = np.searchsorted(feeds, w.offsets[:-1], "right")
        self.number = np.searchsorted(feeds, w.starts[first], "right") - before[self.text]


def _keyed(docs: DataFrame, copies_together: bool) -> DataFrame:
    """doc_id, text and all other columns in one, so that none of their names meets
    one used here; ``__key`` tells documents apart, rows of one key are the same.
    Rows of one ``__unit`` keep and lose the same lines."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    key = F.xxhash64("doc_id", "text")
    return docs.select("doc_id", "text", F.struct(*others or [F.lit(0)]).alias("rest"), key.alias("__key"),
                       (F.xxhash64("text") if copies_together else key).alias("__unit"))


def _occurrences(docs: DataFrame, min_words: int) -> DataFrame:
    """key, unit, leaf, line for each document's distinct lines of enough words."""
    def run(batches):
        for batch in batches:
            keys, units = column(batch, "__key").to_numpy(), column(batch, "__unit").to_numpy()
            for a, _, w in slices(column(batch, "text")):
                lines = Lines(w)
                some = np.flatnonzero(lines.words >= min_words)
                pair = np.rec.fromarrays([lines.text[some], lines.whole[some]])
                some = some[np.unique(pair, return_index=True)[1]] if len(some) else some
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[a + lines.text[some]]), pa.array(units[a + lines.text[some]]),
                     pa.array(lines.leaf[some].view(np.int64)), pa.array(lines.whole[some].view(np.int64))],
                    ["key", "unit", "leaf", "line"])

    return docs.select("__key", "__unit", "text").mapInArrow(run, "key long, unit long, leaf long, line long")


def _templates(docs: DataFrame, lines: DataFrame, min_words: int, similarity: float, block: int = BLOCK) -> DataFrame:
    """line and template for the lines that differ from others of their template
    in variable words. ``lines``: the distinct (leaf, line)."""
    spark = docs.sparkSession
    counts = written(lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "leaves")
    crowded = counts.select("leaf")
    slot = F.col("leaf").bitwiseAND(F.lit(LEAF_BITS - 1))
    table = crowded.groupBy(F.shiftright(slot, 6).alias("word")) \
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast((leaf & {LEAF_BITS - 1}) & 63 as int))")).alias("bits")).toArrow()  # LEAF_BITS / 64 rows at most
    held = np.zeros(LEAF_BITS // 64, np.int64)
    held[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    shared = spark.sparkContext.broadcast(held)

    def run(batches):
        bits = shared.value.view(np.uint64)
        for batch in batches:
            for *_, w in slices(column(batch, "text")):
                lines = Lines(w)
                at = lines.leaf & np.uint64(LEAF_BITS - 1)
                hit = (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
                some = np.flatnonzero(hit & (lines.words >= min_words))
                some = some[np.unique(lines.whole[some], return_index=True)[1]]
                n = lines.words[some]
                ends = np.concatenate([[0], np.cumsum(n)])
                at = np.arange(ends[-1]) + np.repeat(lines.first[some] - ends[:-1], n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lines.leaf[some].view(np.int64)), pa.array(lines.whole[some].view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(lines.token[at].view(np.int64)))],
                    ["leaf", "line", "words"])

    texts = docs.select("text").mapInArrow(run, "leaf long, line long, words array<long>") \
        .join(crowded, "leaf", "left_semi").groupBy("leaf", "line").agg(F.first("words").alias("words"))
    texts = written(texts.join(counts, "leaf"), "lines")
    small, left = texts.filter(F.col("n") <= block), texts.filter(F.col("n") > block)
    found = _joined(small.select(F.col("leaf").alias("block"), "line", "words"), similarity)
    met = written(left.mapInArrow(_banded(similarity), "band long, line long"), "bands")
    sizes = met.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("line").alias("mark"),
                                    F.bit_xor(F.xxhash64("line")).alias("other")).filter("n > 1")
    # bands of the same lines are looked at once
    sizes = written(sizes.groupBy("n", "mark", "other").agg(F.min("band").alias("band")).select("band", "n"), "sizes")
    shared = met.join(sizes, "band")
    # larger ones are dealt in two ways, so that what is alike in two blocks meets in others
    ways = shared.withColumn("way", F.explode(F.when(F.col("n") > block, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    salt = F.pmod(F.xxhash64("line", "band", "way"), F.ceil(F.col("n") / block))
    dealt = ways.select(F.xxhash64("band", "way", salt).alias("block"), "line")
    links = written(_joined(_worded(dealt, left), similarity), "pairs")
    hot = sizes.filter(F.col("n") > block)
    if not hot.isEmpty():
        links = links.union(_across(shared.filter(F.col("n") > block), links, left, similarity, block))
    whole = components(links.select(F.col("line").alias("u"), F.col("template").alias("v")))
    found = written(found.union(whole.filter("node <> root").select(F.col("node").alias("line"), F.col("root").alias("template"))), "templates")
    return found.union(found.select(F.col("template").alias("line"), "template").distinct())


def _worded(blocks: DataFrame, texts: DataFrame) -> DataFrame:
    """block, line, words for ``blocks`` (block, line)."""
    return blocks.join(texts.select("line", "words"), "line").select("block", "line", "words")


def _across(met: DataFrame, links: DataFrame, texts: DataFrame, similarity: float, block: int) -> DataFrame:
    """The links between lines of different blocks of one band, for the bands
    larger than a block (``met``: band, line). Lines that ``links`` has joined
    need not meet again: the lines beside the band's largest component are held
    against all lines of the band, some of both at a time."""
    whole = components(links.select(F.col("line").alias("u"), F.col("template").alias("v")))
    held = written(met.select("band", "line").join(whole, F.col("line") == F.col("node"), "left")
                   .select("band", "line", F.coalesce("root", "line").alias("root")), "held")
    parts = held.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    half = F.lit(max(1, block // 2))
    bands = parts.groupBy("band").agg(F.sum("n").alias("all"), F.max(F.struct("n", "root")).alias("most")) \
        .filter(F.col("all") > F.col("most.n")) \
        .select("band", F.col("most.root").alias("most"), F.ceil(F.col("all") / half).alias("chunks"),
                F.ceil((F.col("all") - F.col("most.n")) / half).alias("others"))
    held = held.join(written(bands, "hot"), "band")
    own, least = F.xxhash64("line", "band"), F.lit(0).cast("long")
    one = held.select("band", "line", F.pmod(own, F.col("chunks")).alias("i"),
                      F.explode(F.sequence(least, F.col("others") - 1)).alias("j"))
    other = held.filter("root <> most").select("band", "line", F.explode(F.sequence(least, F.col("chunks") - 1)).alias("i"),
                                               F.pmod(own, F.col("others")).alias("j"))
    dealt = one.union(other).select(F.xxhash64("band", "i", "j").alias("block"), "line").distinct()
    return written(_joined(_worded(dealt, texts), similarity), "across")


def _most_differ(n: int, similarity: float) -> int:
    """In so many of their ``n`` places two lines that are alike differ at most."""
    return int(min(1 - similarity, 1 - LEAST_PLAIN) * n + 1e-6)


def _banded(similarity: float):
    """band and line, for each line of crowded leaves one band more than the places
    in which lines alike may differ: they have one in common."""
    def run(batches):
        for batch in batches:
            leaf, line, lists = column(batch, "leaf").to_numpy().view(np.uint64), column(batch, "line").to_numpy(), column(batch, "words")
            ends = np.asarray(lists.offsets)
            flat = lists.values.to_numpy().view(np.uint64)
            keys = []
            for k in range(batch.num_rows):
                word = flat[ends[k]: ends[k + 1]]
                n = len(word)
                bands = _most_differ(n, similarity) + 1
                if bands > n - LEADING:  # no word need be the same
                    band = np.zeros(1, np.uint64)
                else:
                    place = np.arange(LEADING, n)
                    placed = mix(word[LEADING:] * np.uint64(3) + place.astype(np.uint64))
                    held = np.zeros(-(-len(placed) // bands) * bands, np.uint64)
                    held[:len(placed)] = placed
                    band = held.reshape(-1, bands).sum(0, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)
                keys.append(mix(band ^ mix(leaf[k: k + 1])))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(line, [len(x) for x in keys]))],
                                                 ["band", "line"])

    return run


def _alike(words: np.ndarray, similarity: float) -> np.ndarray:
    """For each row (a line's words) the first row that links of lines alike reach."""
    first = np.arange(len(words))
    left, n = first.copy(), words.shape[1]
    plain = words != _VARIABLE
    while len(left) > 1:
        root, left = left[0], left[1:]
        reached = [root]
        while reached and len(left):
            k = reached.pop()
            same = words[left] == words[k]
            open_ = np.count_nonzero(same[:, ~plain[k]], axis=1)
            agree = np.count_nonzero(same, axis=1) - open_
            alike = (agree >= similarity * (n - open_) - 1e-9) & (agree >= LEAST_PLAIN * n - 1e-9)
            first[left[alike]] = root
            reached += left[alike].tolist()
            left = left[~alike]
    return first


def _joined(blocks: DataFrame, similarity: float) -> DataFrame:
    """line and template (the least line that links in its block reach), for the lines
    of each block (block, line, words) that are not their own."""
    def run(batches):
        last, held = None, []  # the block at hand, which may go on in the next batch

        def finish():
            lines = np.concatenate([x for x, _ in held])
            if len(lines) > 1:
                words = np.concatenate([x for _, x in held])
                joins = _alike(words.view(np.uint64).reshape(len(lines), -1), similarity)
                some = np.flatnonzero(joins != np.arange(len(joins)))
                out.append((lines[some], lines[joins[some]]))

        for batch in batches:
            if not batch.num_rows:
                continue
            out: list = []
            block, line, lists = column(batch, "block").to_numpy(), column(batch, "line").to_numpy(), column(batch, "words")
            ends = np.asarray(lists.offsets)
            flat = lists.values.to_numpy()
            at = np.flatnonzero(np.diff(block, prepend=block[0] - 1 if block[0] > 0 else block[0] + 1))
            for a, b in zip(at.tolist(), [*at[1:].tolist(), len(block)]):
                if held and block[a] != last:
                    finish()
                    held = []
                last = block[a]
                held.append((line[a:b], flat[ends[a]: ends[b]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["line", "template"])
        out = []
        if held:
            finish()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["line", "template"])

    return blocks.repartition("block").sortWithinPartitions("block", "line").mapInArrow(run, "line long, template long")


def drop_recurring(docs: DataFrame, min_words: int = MIN_WORDS, min_docs: int = MIN_DOCS,
                   similarity: float = SIMILARITY, copies_together: bool = False) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others), with the lines of
    recurring templates taken from ``text``, and ``n_dropped``, their number.

    A template recurs if ``min_docs`` documents hold it; it stays in the one of
    the smallest doc_id (null ids last). Rows equal in id and text are one
    document: they keep and lose the same lines. With ``copies_together`` rows
    equal in text are one document, that of the smallest of their ids, for a later
    step that drops copies as a whole: they stay copies, and none is left as the
    short lines that its copy has too. Lines of fewer than
    ``min_words`` words stay, as do a null text and the order of the lines. A
    text of any length is gone through whole. An empty table gives no rows;
    further columns pass through, whatever their names, but one named n_dropped
    is replaced.

    No link between lines of a leaf is left out. Where the lines of a band larger
    than ``BLOCK`` are of many components, they meet all with all, block by block."""
    own = _keyed(docs, copies_together)
    seen = written(_occurrences(own, min_words), "occurrences")
    lines = seen.select("leaf", "line").distinct()
    templates = _templates(own, lines, min_words, similarity)
    placed = written(seen.join(templates, "line", "left").select(
        "key", "unit", "line", F.coalesce("template", "line").alias("template")), "placed")
    ids = own.filter("doc_id is not null").groupBy(F.col("__unit").alias("unit")).agg(F.min("doc_id").alias("doc_id"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "unit")
    known = placed.select("unit", "template").distinct().join(ids, "unit", "left")
    recurring = known.groupBy("template").agg(F.count(F.lit(1)).alias("n"), F.min(rank).getField("unit").alias("stays")) \
        .filter(F.col("n") >= min_docs).select("template", "stays")
    # written, so that the join's shuffle of the lines is one that Spark can split
    # where a template is frequent
    recurring = written(recurring, "recurring")
    dropped = placed.join(recurring, "template").filter("unit <> stays") \
        .groupBy(F.col("key").alias("__key")).agg(F.collect_set("line").alias("__lines"))
    joined = own.join(dropped, "__key", "left").select("doc_id", "text", "rest", "__lines")
    schema = joined.drop("__lines").withColumn("n_dropped", F.lit(0)).schema
    at = 1

    def run(batches):
        for batch in batches:
            gone = batch.column(batch.num_columns - 1)
            texts, counts = batch.column(at).to_pylist(), np.zeros(batch.num_rows, np.int32)
            touched = np.flatnonzero(gone.is_valid().to_numpy(zero_copy_only=False))
            for a, b, w in slices(batch.column(at).take(pa.array(touched))):
                lines = Lines(w)
                edges = np.searchsorted(lines.text, np.arange(b - a + 1))
                for k in range(b - a):
                    row = int(touched[a + k])
                    lo, hi = edges[k], edges[k + 1]
                    low = np.array(gone[row].as_py(), np.int64).view(np.uint64)
                    hit = np.isin(lines.whole[lo:hi], low) & (lines.words[lo:hi] >= min_words)
                    out = set(lines.number[lo:hi][hit].tolist())
                    texts[row] = "\n".join([x for i, x in enumerate(texts[row].split("\n")) if i not in out])
                    counts[row] = len(out)
            columns = [*batch.columns[:-1], pa.array(counts)]
            columns[at] = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    left = joined.mapInArrow(run, schema)
    return left.select(*[F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c).alias(c)
                         for c in docs.columns if c != "n_dropped"], "n_dropped")
