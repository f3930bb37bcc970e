"""Toxicity categories by a classifier chain.

The categories are predicted one after another by linear models over which
words, and beginnings of words, a text holds. Each later model also gets the
probabilities of the earlier categories; it is trained with out-of-fold ones,
so that it meets the same errors in training as in use."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skydrift.llm.tables import written
from skydrift.llm.words import Words, column, read, slices

#: Labelled documents that the models are fitted to: those of the least hash.
MOST_LABELLED = 16_000
#: Features of each category: those that tell most about it.
FEATURES = 2048
LEAST_DOCS = 5
#: Least log-likelihood ratio of a feature (chance gives it to 1 in 1000).
LEAST_TOLD = 10.83
PREFIXES = (4, 5, 6, 7)
FOLDS = 3
THRESHOLD = 0.5
RIDGE = 0.25
STEPS = 120


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' words and of their beginnings, and their texts."""
    text = np.repeat(np.arange(len(w.first) - 1), w.counts())
    hashes, owners = [w.hashes()], [text]
    for n in PREFIXES:
        some, h = w.prefix_hashes(n)
        hashes.append(h)
        owners.append(text[some])
    return np.concatenate(hashes), np.concatenate(owners)


class Selected:
    """The features in use, found among all by a small table first."""

    TABLE = 1 << 20

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.table = np.zeros(self.TABLE, bool)
        self.table[(self.hashes & np.uint64(self.TABLE - 1)).astype(np.int64)] = True

    def of(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, feature number) of the slice."""
        h, owner = features(w)
        some = np.flatnonzero(self.table[(h & np.uint64(self.TABLE - 1)).astype(np.int64)])
        h, owner = h[some], owner[some]
        at = np.minimum(np.searchsorted(self.hashes, h), max(0, len(self.hashes) - 1))
        same = self.hashes[at] == h if len(h) else np.zeros(0, bool)
        n = max(1, len(self.hashes))
        pair = np.unique(owner[same] * n + at[same])
        return pair // n, pair % n


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -700, 700)))


def fit_linear(rows: np.ndarray, cols: np.ndarray, n: int, width: int, extra: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (features, extra columns, bias) of a ridge logistic model, by
    accelerated gradient steps scaled to each feature."""
    columns = np.concatenate([extra, np.ones((n, 1))], axis=1)
    w = np.zeros(width + columns.shape[1])
    share = (y.sum() + 0.5) / (n + 1.0)
    w[-1] = np.log(share / (1 - share)) if n else -1000.0
    if not n or y.min() == y.max():
        return w
    per_row = np.bincount(rows, minlength=n) + (columns ** 2).sum(1)
    scale = np.concatenate([np.bincount(cols, per_row[rows], width), (columns ** 2 * per_row[:, None]).sum(0)]) / 4
    scale = scale / np.sqrt(np.maximum(1.0, per_row.mean())) + RIDGE
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 0.0
    ahead, previous, t = w.copy(), w.copy(), 1.0
    for _ in range(STEPS):
        z = np.bincount(rows, ahead[cols], n) + columns @ ahead[width:]
        error = _sigmoid(z) - y
        slope = np.concatenate([np.bincount(cols, error[rows], width), columns.T @ error]) + ridge * ahead
        w = ahead - slope / scale
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = w + (t - 1) / following * (w - previous)
        previous, t = w, following
    return w


def predict(w: np.ndarray, rows: np.ndarray, cols: np.ndarray, n: int, extra: np.ndarray) -> np.ndarray:
    width = len(w) - extra.shape[1] - 1
    return _sigmoid(np.bincount(rows, w[cols], n) + extra @ w[width:-1] + w[-1])


def fit_chain(rows: np.ndarray, cols: np.ndarray, n: int, width: int, labels: np.ndarray) -> list[np.ndarray]:
    """One model for each column of ``labels``, in order."""
    models, extra = [], np.zeros((n, 0))
    fold = np.arange(n) % FOLDS
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(float)
        models.append(fit_linear(rows, cols, n, width, extra, y))
        if c == labels.shape[1] - 1:
            break
        out = np.zeros(n)
        for k in range(FOLDS):
            test = fold == k
            number = np.cumsum(~test) - 1
            inside = ~test[rows]
            w = fit_linear(number[rows[inside]], cols[inside], int((~test).sum()), width, extra[~test], y[~test])
            out[test] = predict(w, rows, cols, n, extra)[test]
        extra = np.column_stack([extra, out])
    return models


def fit(docs: DataFrame, labels: DataFrame, categories: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The selected features and the models. Which features tell most (by the
    log-likelihood ratio of holding them and being in the category) is counted
    by Spark; the driver gets those, and the labelled sample's, only."""
    spark = docs.sparkSession
    sample = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        *[F.max(F.coalesce(F.col(c).cast("int"), F.lit(0))).alias(f"__y{k}") for k, c in enumerate(categories)]) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED)
    ys = [f"__y{k}" for k in range(len(categories))]
    texts = written(docs.join(F.broadcast(sample), "doc_id").select("doc_id", *ys, "text"), "labelled")

    def count(batches):
        for batch in batches:
            y = np.column_stack([column(batch, c).to_numpy() for c in ys])
            for a, _, w in slices(column(batch, "text")):
                h, owner = features(w)
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                first = np.ones(len(h), bool)
                first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                distinct, place = np.unique(h[first], return_inverse=True)
                mine = y[a + owner[first]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct.view(np.int64)), pa.array(np.bincount(place, minlength=len(distinct))),
                     *(pa.array(np.bincount(place, mine[:, k], len(distinct)).astype(np.int64)) for k in range(len(ys)))],
                    ["h", "n", *ys])

    counted = texts.mapInArrow(count, "h long, n long, " + ", ".join(f"{c} long" for c in ys)) \
        .groupBy("h").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in ys]).filter(F.col("n") >= LEAST_DOCS)
    counted = written(counted, "features")
    whole = texts.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ys]).first()
    chosen: set[int] = set()
    for c in ys:
        n, p = float(whole.n), float(whole[c] or 0)
        a, b = F.col(c).cast("double"), (F.col("n") - F.col(c)).cast("double")

        def part(x, group, of):
            expected = group * of / n
            return F.when(x > 0, x * F.log(x / expected)).otherwise(F.lit(0.0))

        held = F.col("n").cast("double")
        told = part(a, held, p) + part(b, held, n - p) + part(p - a, n - held, p) + part((n - p) - b, n - held, n - p)
        best = counted.select("h", told.alias("told")).filter(F.col("told") >= LEAST_TOLD)
        chosen |= {r.h for r in best.orderBy(F.desc("told"), "h").limit(FEATURES).collect()}
    hashes = np.sort(np.array(sorted(chosen), np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(hashes)

    def rows_of(batches):
        selected = Selected(shared.value)
        for batch in batches:
            for a, b, w in slices(column(batch, "text")):
                row, col = selected.of(w)
                ends = np.searchsorted(row, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns[:-1], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(col))],
                    ["doc_id", *ys, "cols"])

    kinds = ", ".join(f"{c} int" for c in ys)
    kind = texts.schema["doc_id"].dataType.simpleString()
    table = texts.mapInArrow(rows_of, f"doc_id {kind}, {kinds}, cols array<long>") \
        .orderBy("doc_id", *ys, "cols").limit(2 * MOST_LABELLED).toArrow().combine_chunks()
    n = table.num_rows
    cells = table.column("cols").combine_chunks()
    cols = cells.flatten().to_numpy(zero_copy_only=False) if n else np.zeros(0, np.int64)
    rows = np.repeat(np.arange(n), np.diff(cells.offsets.to_numpy())) if n else np.zeros(0, np.int64)
    y = np.column_stack([table.column(c).to_numpy() for c in ys]).reshape(n, len(ys))
    return hashes, fit_chain(rows, cols, n, len(hashes), y)


def score(docs: DataFrame, labels: DataFrame, categories: list[str], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` (any columns but those that follow) and a column p_<category>
    (double) for each category, in the order of the chain, for each row of
    ``docs`` (doc_id, text). ``labels`` (doc_id, a column of 0 or 1 for each
    category; null is 0) names some documents; one with several rows has a
    category if any of them has.

    A text of any length is read whole. A null text holds no features and gets the models' bias; null and repeated
    doc_ids are scored like others; without labels every probability is next to 0; an
    empty table gives no rows."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(fit(docs.select("doc_id", "text"), labels, categories))
    source, text = read(docs, keep)
    schema = source.select(*source.columns[:len(keep)], *[F.lit(0.0).alias(f"p_{c}") for c in categories]).schema

    def run(batches):
        hashes, models = shared.value
        selected = Selected(hashes)
        for batch in batches:
            for a, b, w in slices(column(batch, text)):
                rows, cols = selected.of(w)
                extra = np.zeros((b - a, 0))
                for model in models:
                    extra = np.column_stack([extra, predict(model, rows, cols, b - a, extra)])
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns[:len(keep)], *(pa.array(x) for x in extra.T)], schema.names)

    return source.mapInArrow(run, schema)
