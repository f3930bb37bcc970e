"""Exact global positions and running sums without a one-partition window.

Pattern: ``repartitionByRange`` on the order key (balanced even when one key
value is hot, because the total order splits ties across ranges) ->
per-partition work that needs no further shuffle -> per-partition totals
(one row per partition, a proven size bound) -> prefix offsets over those
totals -> broadcast join back. Used by the chronological split, ordered
samples, ROC-AUC, KS, Wasserstein and exact medians.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skydrift.session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id = (partition << 33) + row index


def _range(df: DataFrame, cols: list, n: int | None) -> DataFrame:
    """Range partitioning on ``cols``. Without an explicit count AQE may
    coalesce *adjacent* small ranges, which keeps the global order intact."""
    return df.repartitionByRange(n, *cols) if n else df.repartitionByRange(*cols)


def _sort_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def global_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "pos",
                      partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order`` (must be a total order).

    Rows are range partitioned and sorted within partitions; the local index
    comes from ``monotonically_increasing_id`` (pure JVM, narrow). Per-partition
    counts are at most one row per partition, so broadcasting their prefix
    offsets is bounded by the partition count."""
    cols = _sort_cols(order)
    ranged = (_range(df, cols, partitions)
                .sortWithinPartitions(*cols)
                .withColumn("_rid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("_rid"), _LOCAL_BITS)
    local = F.col("_rid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    # Materialise once: the range bounds come from a sample of shuffled input,
    # so two lazy evaluations could disagree on which row lands where.
    ranged = materialize(ranged.withColumn("_pid", pid).withColumn("_local", local))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn(out, F.col("_off") + F.col("_local"))
                  .drop("_rid", "_pid", "_local", "_off"))


def rows_at(df: DataFrame, order: Sequence[str], positions: Sequence[int]) -> dict[int, tuple]:
    """The order values of the rows at some 0-based positions (those within the
    table); one small row per position reaches the driver.

    Where the first order column is a date, the rows are counted by date (few
    groups, combined map-side), and only the days that hold a position are looked
    into, on the other order columns. Otherwise the order columns are ranged and
    materialised, never whole rows."""
    wanted = sorted({int(p) for p in positions})
    if not wanted:
        return {}
    order = list(order)
    if len(order) > 1 and isinstance(df.schema[order[0]].dataType, T.DateType):
        return _rows_at_dates(df.select(*order), order, wanted)
    placed = global_row_number(df.select(*order), order, "_pos")
    return {r["_pos"]: tuple(r[c] for c in order)
            for r in placed.filter(F.col("_pos").isin(wanted)).collect()}


def _rows_at_dates(df: DataFrame, order: list[str], wanted: list[int]) -> dict[int, tuple]:
    day, rest = order[0], order[1:]
    counts = df.groupBy(day).agg(F.count(F.lit(1)).alias("_n"))
    # one row per day
    upto = F.sum("_n").over(Window.orderBy(F.asc_nulls_first(day)).rowsBetween(Window.unboundedPreceding, 0))
    held = F.filter(F.array(*[F.lit(p).cast("long") for p in wanted]),
                    lambda p: (p >= F.col("_upto") - F.col("_n")) & (p < F.col("_upto")))
    hit = counts.withColumn("_upto", upto).select(day, (F.col("_upto") - F.col("_n")).alias("_before"), held.alias("_held")) \
        .filter(F.size("_held") > 0).collect()
    out = {}
    for r in hit:
        on_day = df.filter(F.col(day).eqNullSafe(F.lit(r[day]).cast("date")))
        at = rows_at(on_day.select(*rest), rest, [p - r["_before"] for p in r["_held"]])
        out.update({p: (r[day], *at[p - r["_before"]]) for p in r["_held"]})
    return out


def before(df: DataFrame, order: Sequence[str], cut: tuple | None) -> Column:
    """True for the rows that come before ``cut`` in ``order`` (ascending, NULLs
    first); all rows if there is no cut. A plain filter on the source rows."""
    if cut is None:
        return F.lit(True)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = F.lit(False)
    for name, value in reversed(list(zip(order, cut))):
        c, v = F.col(name), F.lit(value).cast(types[name])
        less = F.lit(False) if value is None else c.isNull() | (c < v)
        out = less | (c.eqNullSafe(v) & out)
    return F.coalesce(out, F.lit(False))


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   values: Sequence[str], prefix: str = "cum_",
                   partitions: int | None = None, with_next: bool = False,
                   with_totals: bool = False) -> DataFrame:
    """Inclusive cumulative sums of ``values`` within each ``keys`` group,
    in ``order``. ``(keys, order)`` must be unique (pre-aggregate first).

    Range partitioning on ``keys + order`` splits even a hot group across
    many tasks; each task computes local cumulative sums over its sorted
    rows (Arrow batches, one pass), then adds the group's total from earlier
    partitions. Optionally also the next order value within the group
    (``next_<order>``) and the group totals (``tot_<value>``). NULL keys form
    groups like any others."""
    keys, order, values = list(keys), list(order), list(values)
    if with_next and len(order) != 1:
        raise ValueError("with_next needs a single order column")
    full = keys + order
    # one never-NULL code per group (NULL keys are groups like others)
    code = F.xxhash64(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))]) if keys else F.lit(0).cast("long")
    ranged = (_range(df, full, partitions)
                .sortWithinPartitions(*full)
                .withColumn("_pid", F.spark_partition_id()).withColumn("_g", code))
    ranged = materialize(ranged)  # one fixed layout for both branches below
    out_fields = ranged.schema.fields + [T.StructField(f"_l_{v}", T.DoubleType(), True) for v in values]
    if with_next:
        out_fields.append(T.StructField("_l_next", ranged.schema[order[0]].dataType, True))
    out_schema = T.StructType(out_fields)

    def totals(batch, carry):
        """The batch's running totals; ``carry`` is (group, totals) of its
        predecessor's last row, and is set to those of its own. Rows arrive
        sorted, so groups are contiguous and only the last can go on."""
        g = batch.column(batch.schema.get_field_index("_g")).to_numpy()
        begins = np.flatnonzero(np.diff(g, prepend=g[0] - 1 if g[0] > np.iinfo(np.int64).min else g[0] + 1))
        group = np.cumsum(np.isin(np.arange(len(g)), begins)) - 1
        made = []
        for k, v in enumerate(values):
            x = batch.column(batch.schema.get_field_index(v)).cast(pa.float64()).fill_null(0.0).to_numpy()
            before = np.concatenate([[0.0], np.cumsum(x)])
            total = before[1:] - before[begins][group]
            if carry and carry[0] == g[0]:
                total[group == 0] += carry[1][k]
            made.append(total)
        carry[:] = [g[-1], [t[-1] for t in made]]
        return made

    def local_pass(batches):
        carry: list = []
        pending = None            # a batch and its totals, until its successor's first row is known

        def done(batch, made, following):
            columns = [*batch.columns, *(pa.array(t) for t in made)]
            if with_next:
                at, g = batch.schema.get_field_index(order[0]), batch.column(batch.schema.get_field_index("_g"))
                values_, groups = batch.column(at), g
                if following is not None:
                    values_ = pa.concat_arrays([values_, following.column(at).slice(0, 1)])
                    groups = pa.concat_arrays([g, following.column(following.schema.get_field_index("_g")).slice(0, 1)])
                groups = groups.to_numpy()
                last = np.ones(batch.num_rows, bool)
                last[: len(groups) - 1] = groups[1:] != groups[:-1]
                columns.append(values_.take(pa.array(np.where(last, 0, np.arange(1, len(last) + 1)), mask=last)))
            return pa.RecordBatch.from_arrays(columns, out_schema.names)

        for batch in batches:
            if batch.num_rows:
                if pending is not None:
                    yield done(*pending, batch)
                pending = (batch, totals(batch, carry))
        if pending is not None:
            yield done(*pending, None)

    local = ranged.mapInArrow(local_pass, out_schema)
    aggs = [F.sum(F.col(v).cast("double")).alias(f"_t_{v}") for v in values]
    if with_next:
        aggs.append(F.min(order[0]).alias("_first"))
    part = ranged.groupBy("_pid", "_g").agg(*aggs)
    wk = Window.partitionBy("_g").orderBy("_pid")
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_g")
    stats = [F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0.0)).alias(f"_o_{v}")
             for v in values]
    if with_totals:
        stats += [F.sum(f"_t_{v}").over(whole).alias(f"{'tot_'}{v}") for v in values]
    if with_next:
        stats.append(F.lead("_first").over(wk).alias("_nx_first"))
    offsets = part.select("_pid", "_g", *stats)
    # one row per partition and group in it: as many as groups at least, so the
    # join's plan is left to the session's broadcast threshold
    joined = local.join(offsets, ["_pid", "_g"], "left")
    res = joined.withColumns({f"{prefix}{v}": F.col(f"_l_{v}") + F.coalesce(
        F.col(f"_o_{v}"), F.lit(0.0)) for v in values})
    drop = ["_pid", "_g", *[f"_l_{v}" for v in values], *[f"_o_{v}" for v in values]]
    if with_next:
        res = res.withColumn(f"next_{order[0]}", F.coalesce(F.col("_l_next"),
                                                            F.col("_nx_first")))
        drop += ["_l_next", "_nx_first"]
    return res.drop(*drop)


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (),
                 out: str = "median", partitions: int | None = None) -> DataFrame:
    """Exact interpolated median (= ``percentile(x, 0.5)``) per group without
    holding a group's values in one task: values are pre-aggregated to
    ``(group, value, count)`` map-side, cumulative counts come from
    range-partitioned running totals, and the one or two middle positions
    ``floor((n-1)/2)``, ``floor(n/2)`` are read off the value that covers them."""
    counts = df.filter(F.col(value).isNotNull()) \
        .groupBy(*by, F.col(value).cast("double").alias("_v")) \
        .agg(F.count(F.lit(1)).cast("double").alias("_c"))
    return median_from_counts(counts, "_v", "_c", by, out, partitions)


def median_from_counts(counts: DataFrame, value: str, count: str, by: Sequence[str] = (),
                       out: str = "median", partitions: int | None = None) -> DataFrame:
    """Exact median from a ``(by..., value, count)`` frame (value unique per
    group)."""
    by = list(by)
    run = running_totals(counts, by, [value], [count], prefix="_cum_", partitions=partitions,
                         with_totals=True)
    return run.groupBy(*by).agg(_median_expr(value, count).alias(out)) if by else \
        run.agg(_median_expr(value, count).alias(out))


def _median_expr(value: str, count: str) -> Column:
    """Average of the values covering positions floor((n-1)/2) and floor(n/2)
    of a group, over running-total rows (``_cum_<count>``, ``tot_<count>``)."""
    cum = F.col(f"_cum_{count}")
    n = F.col(f"tot_{count}")
    start = cum - F.col(count)
    lo = F.floor((n - 1) / 2)
    hi = F.floor(n / 2)
    covers_lo = (start <= lo) & (lo < cum)
    covers_hi = (start <= hi) & (hi < cum)
    return (F.max(F.when(covers_lo, F.col(value))) + F.max(F.when(covers_hi, F.col(value)))) / 2.0
