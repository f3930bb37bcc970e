"""Exact top-k search by pivot-table elimination.

The largest inner product becomes the least Euclidean distance by one more
coordinate: with M the largest norm, a row x is placed at (x, sqrt(M^2 - |x|^2))
and a query q at (q, 0), and the squared distance is |q|^2 + M^2 - 2 q.x. The
distances from every row to many pivots are computed once; for a query, the
largest difference |d(q, p) - d(x, p)| over the pivots is a lower bound of
d(q, x). Rows are scored in the order of their bounds until the next bound is
beyond the k-th best row found."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skydrift.llm.tables import written

PIVOTS = 32
#: Queries that are answered together, and rows of one pivot table.
QUERY_BLOCK = 256
ROW_BLOCK = 4096
#: Rows scored before the first look at the stopping rule.
STEP = 128
INT64 = (1 << 63) - 1


def scaled(vector: str, scale: float) -> F.Column:
    """floor(scale * x) of every component, as an array of doubles that hold
    whole numbers (from 2^53 on, all doubles do)."""
    def whole(x):
        v = x * F.lit(scale)
        return F.when(F.abs(v) < F.lit(2.0 ** 53), F.floor(v).cast("double")).otherwise(v)

    return F.transform(F.col(vector).cast("array<double>"), whole)


def _usable(vector: str, scale: float) -> F.Column:
    wide = F.col(vector).cast("array<double>")
    return F.col(vector).isNotNull() & F.forall(
        wide, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x * F.lit(scale)) < F.lit(float("inf"))), F.lit(False)))


def exact_kind(norm: float) -> type | None:
    """The float type whose sums of products of vectors of this norm at most
    are whole numbers without error, if there is one."""
    top = norm * norm  # bounds every partial sum (Cauchy-Schwarz)
    return np.float32 if top < 1 << 23 else np.float64 if top < 1 << 52 else None


def _scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Whole inner products, as int64 (beyond its range: the nearest end).
    Vectors of an exact kind are multiplied as they are, others as integers."""
    if rows.dtype != object:
        return (rows @ query).astype(np.int64)
    whole = [sum(a * b for a, b in zip(row, query)) for row in rows]
    return np.array([max(-INT64 - 1, min(INT64, s)) for s in whole], np.int64)


def as_kind(x: np.ndarray, norm: float) -> np.ndarray:
    kind = exact_kind(norm)
    if kind:
        return x.astype(kind)
    out = np.empty(x.shape, object)
    out[:] = [[int(v) for v in row] for row in x.reshape(len(x), -1).tolist()] if x.ndim == 2 else [int(v) for v in x.tolist()]
    return out


class PivotTable:
    """Distances from the rows of a block to the pivots (single precision, with
    an allowance for its rounding in every bound)."""

    def __init__(self, rows: np.ndarray, pivots: np.ndarray, norm: float):
        self.pivots, self.norm = pivots, norm
        self.rows = as_kind(rows, norm)
        with np.errstate(over="ignore", invalid="ignore"):
            self.far = np.ascontiguousarray(self._distances(rows, self._lift(rows)).T.astype(np.float32))

    def _lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.norm ** 2 - (x ** 2).sum(1)))

    def _distances(self, x: np.ndarray, lift: np.ndarray) -> np.ndarray:
        p = self.pivots
        square = (x ** 2).sum(1)[:, None] + (p ** 2).sum(1)[None] - 2 * (x @ p.T) \
            + (lift[:, None] - self._lift(p)[None]) ** 2
        return np.sqrt(np.maximum(0.0, square))

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """At least the inner product of the query with each row. Norms beyond
        single precision's range exclude nothing."""
        if not self.norm < 1e15:
            return np.full(len(self.rows), np.inf, np.float32)
        near = self._distances(query[None], np.zeros(1))[0].astype(np.float32)
        gap = np.zeros(len(self.rows), np.float32)
        one = np.empty_like(gap)
        for far, d in zip(self.far, near):
            np.subtract(far, d, out=one)
            np.abs(one, out=one)
            np.maximum(gap, one, out=gap)
        size = float(query @ query) + self.norm ** 2
        sure = np.maximum(0.0, gap.astype(float) - 1e-5 * np.sqrt(size) - 1e-6)
        # half of |q|^2 + M^2 - d^2, rounded up to single precision
        return ((size - sure ** 2) / 2 + 1e-6 * (size + 1.0)).astype(np.float32)

    def best(self, query: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best rows (ties: smaller id) that
        reach ``floor``, a score that k rows of the whole table reach. Steps
        double, so few of them come after the one that stops the search; from
        the first that takes much of the block on, products of all its rows,
        in place, are cheaper than copies of those of the step."""
        most = self.bounds(query)
        exact = as_kind(query, self.norm)
        alive = np.flatnonzero((most >= floor) & ~own)
        order = alive[np.argsort(-most[alive])]
        falling = -most[order]
        whole = None
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, step = 0, STEP
        while a < len(order) and -falling[a] >= floor:
            b = min(a + step, int(np.searchsorted(falling, -floor, "right")))
            if whole is None and 8 * (b - a) > len(self.rows):
                whole = _scores(self.rows, exact)
            score = _scores(self.rows[order[a:b]], exact) if whole is None else whole[order[a:b]]
            reach = np.flatnonzero(score >= floor)
            if len(reach) > k:
                reach = reach[score[reach] >= np.partition(score[reach], -k)[-k]]
            found = np.concatenate([found, order[a:b][reach]])
            scores = np.concatenate([scores, score[reach]])
            best = np.lexsort((ids[found], -scores))[:k]
            found, scores = found[best], scores[best]
            if len(found) == k:
                floor = max(floor, float(scores[-1]) - 0.5)
            a, step = b, 2 * step
        return found, scores


def search(vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, vec_id: str = "vec_id",
           embedding: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is divisible
    by ``every``, the k rows of the highest inner product of floor(scale * x).

    Rows with a null id, a null vector or a null or non-finite component (also
    one that scaling makes so) take no part. A row is no candidate for a query of its own id (so none of several
    rows of one id is); only vectors of equal length are compared. Ties go to
    the smaller id, equal rows (same id and score) count once each. Scores
    beyond 64 bits are the nearest end of that range. An empty table gives no
    rows; further columns are not read.

    Queries and rows are gathered into blocks of fixed size, and each query
    block is copied to each row block, by an equi-join on the row blocks, so
    tasks grow with the rows.
    Pivots are ``pivots`` rows (a documented, bounded sample) of each length."""
    spark = vectors.sparkSession
    rows = vectors.filter(F.col(vec_id).isNotNull() & _usable(embedding, scale)).select(
        F.col(vec_id).cast("long").alias("vec_id"), scaled(embedding, scale).alias("x"))
    rows = written(rows.withColumn("dim", F.size("x")), "vectors")

    bounds = rows.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q"),
        F.max(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)).alias("norm2"))
    sizes = {r.dim: r for r in bounds.collect()}  # one row for each length of vector
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    seeds = {}
    for dim in sizes:
        chosen = rows.filter(F.col("dim") == dim).orderBy(F.xxhash64("vec_id", "x"), "vec_id").limit(pivots).collect()
        seeds[dim] = (np.array([r.vec_id for r in chosen], np.int64),
                      np.array([r.x for r in chosen], float).reshape(len(chosen), dim))
    shared = spark.sparkContext.broadcast((seeds, {d: float(np.sqrt(r.norm2)) for d, r in sizes.items()}))

    def blocks(df: DataFrame, size: int, count: str, name: str) -> DataFrame:
        """Rows in blocks of about ``size`` by a hash of the row."""
        parts = F.create_map(*[F.lit(v) for d, r in sizes.items() for v in (d, max(1, -(-r[count] // size)))])
        salt = F.xxhash64("vec_id", F.monotonically_increasing_id() if name == "rows" else F.lit(0))
        placed = df.withColumn("block", F.pmod(salt, parts[F.col("dim")]))
        return placed.groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", "x")).alias("members")) \
            .select("dim", F.col("block").alias(name), F.col("members").alias(f"{name}_members"))

    # the queries are the fewer: their blocks are copied to the blocks of rows
    many = F.create_map(*[F.lit(v) for d, r in sizes.items() for v in (d, max(1, -(-r.n // ROW_BLOCK)))])
    asked = blocks(rows.filter(F.col("vec_id") % every == 0).distinct(), QUERY_BLOCK, "q", "asked") \
        .withColumn("rows", F.explode(F.sequence(F.lit(0).cast("long"), many[F.col("dim")].cast("long") - 1)))
    held = blocks(rows, ROW_BLOCK, "n", "rows")
    # a merge, as the copies are many more bytes than their plan's size says, and would be
    # broadcast; the one block of rows of a key is held while its queries pass
    pairs = asked.join(held.hint("merge"), ["dim", "rows"])

    def members(struct: pa.Scalar, dim: int) -> tuple[np.ndarray, np.ndarray]:
        flat = struct.values
        ids = flat.field("vec_id").to_numpy(zero_copy_only=False)
        return ids, flat.field("x").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)

    def run(batches):
        seeds, norms = shared.value
        name, table, ids = None, None, None
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                dim, block = one.column(0)[0].as_py(), one.column(1)[0].as_py()
                seed_ids, seed_x = seeds[dim]
                if (dim, block) != name:  # a block of rows meets its queries one after another
                    ids, x = members(one.column(2)[0], dim)
                    name, table = (dim, block), PivotTable(x, seed_x, norms[dim])
                asked_ids, asked_x = members(one.column(3)[0], dim)
                out: list[tuple] = []
                seeds_exact = as_kind(seed_x, norms[dim])
                for q, query in zip(asked_ids.tolist(), asked_x):
                    known = np.sort(_scores(seeds_exact[seed_ids != q], as_kind(query, norms[dim])))[::-1]
                    floor = float(known[k - 1]) - 0.5 if len(known) >= k else -np.inf
                    found, scores = table.best(query, ids == q, ids, k, floor)
                    out += [(q, i, s) for i, s in zip(ids[found].tolist(), scores.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (zip(*out) if out else ((), (), ()))],
                    ["query_id", "vec_id", "score"])

    partial = pairs.select("dim", "rows", "rows_members", "asked_members") \
        .mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
