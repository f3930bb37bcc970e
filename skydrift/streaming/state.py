"""Keyed state across micro-batches (OP-106, 108): counts of values with expiry,
and the newest rows of each key.

Both pre-aggregate inside a micro-batch's own partitions, so that of a key which
holds a third of all rows only partial counts, or as many rows as are kept, meet
in one task."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
DAY_MS = 86_400_000


@contextmanager
def rocksdb_state(spark: SparkSession, idle_batches: bool = True):
    """Queries that are started inside keep their state in RocksDB, which keyed
    state needs. Without ``idle_batches`` each micro-batch has new rows, and what
    the watermark lets expire waits for the next one. What the session had is set
    again afterwards."""
    wanted = {_PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", _NO_DATA: str(idle_batches).lower()}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class DayCounts(StatefulProcessor):
    """Rows (day, n) of a value are added to its counts by day. A day is dropped
    when the watermark is ``keep`` days past it; whenever the value's total
    changes, it is emitted: (key..., n_cur).

    A value's days are one record, read and written once a micro-batch, however
    many rows come; one timer waits for the earliest of them."""

    def __init__(self, keep: int):
        self._keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._days = handle.getValueState("days", "day array<int>, n array<bigint>")

    def _expires(self, day: int) -> int:
        return (day + 1 + self._keep) * DAY_MS

    def _held(self) -> dict[int, int]:
        held = self._days.get()
        return dict(zip(*held)) if held is not None else {}

    def _hold(self, days: dict[int, int]) -> None:
        if days:
            self._days.update((list(days), list(days.values())))
        else:
            self._days.clear()

    @staticmethod
    def _row(key, days: dict[int, int]) -> Row:
        return Row(column=key[0], is_num=key[1], num=key[2], cat=key[3], n_cur=float(sum(days.values())))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        new: dict[int, int] = {}
        for r in rows:
            new[r.day] = new.get(r.day, 0) + r.n
        days = self._held()
        waiting = min(days, default=None)
        kept = {d: n for d, n in new.items() if self._expires(d) > now}  # the others are later than what is kept
        for day, n in kept.items():
            days[day] = days.get(day, 0) + n
        if kept:
            self._hold(days)
            earliest = min(kept)
            if waiting is None or earliest < waiting:
                self._handle.registerTimer(self._expires(earliest))
        yield self._row(key, days)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        days = {d: n for d, n in self._held().items() if self._expires(d) > now}
        self._hold(days)
        if days:
            self._handle.registerTimer(self._expires(min(days)))
        yield self._row(key, days)

    def close(self) -> None:
        pass


#: Buckets of a column's values.
BUCKETS = 1024


class BucketCounts(DayCounts):
    """:class:`DayCounts` of all values of a bucket at a time: rows (num or cat, day, n)
    of a bucket are added to one record of (value, day, n), and each value whose total
    changes is emitted. A call to the state takes far longer than adding up a row, so
    there are as many as buckets, not as values."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._days = handle.getValueState("days", "rows binary")

    def _held(self, is_num: bool) -> pa.Table:
        held = self._days.get()
        return self._schema(is_num).empty_table() if held is None else pa.ipc.open_stream(bytes(held[0])).read_all()

    def _hold(self, days: pa.Table) -> None:
        if not days.num_rows:
            self._days.clear()
            return
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, days.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as to:
            to.write_table(days)
        self._days.update((out.getvalue().to_pybytes(),))

    @staticmethod
    def _schema(is_num: bool) -> pa.Schema:
        return pa.schema([("value", pa.float64() if is_num else pa.string()), ("day", pa.int32()), ("n", pa.int64())])

    @staticmethod
    def _added(days: pa.Table) -> pa.Table:
        got = days.group_by(["value", "day"]).aggregate([("n", "sum")])
        return got.select(["value", "day", "n_sum"]).rename_columns(["value", "day", "n"]).cast(days.schema).combine_chunks()

    def _kept(self, days: pa.Table, now: int) -> pa.Array:
        return pc.greater(pc.multiply(pc.add(days.column("day").cast(pa.int64()), 1 + self._keep), DAY_MS), now)

    @staticmethod
    def _totals(key, days: pa.Table, values: pa.ChunkedArray) -> pd.DataFrame:
        """A row for each of ``values``."""
        asked = pa.table({"value": values, "n": pa.nulls(len(values), pa.int64()), "asked": pa.repeat(True, len(values))})
        both = pa.concat_tables([days.select(["value", "n"]).append_column("asked", pa.repeat(False, days.num_rows)), asked])
        got = both.group_by("value").aggregate([("n", "sum"), ("asked", "max")])
        got = got.filter(got.column("asked_max"))
        n, found = pc.fill_null(got.column("n_sum"), 0).to_numpy().astype(float), got.column("value").to_pandas()
        none = pd.Series([None] * len(n), dtype=object)
        return pd.DataFrame({"column": key[0], "is_num": bool(key[1]), "num": found if key[1] else none.astype(float),
                             "cat": none if key[1] else found, "n_cur": n})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, is_num = timerValues.getCurrentWatermarkInMs(), bool(key[1])
        schema = self._schema(is_num)
        # NaN is a number here, and NULL is no value
        parts = [pa.Table.from_arrays([pa.array(r["num"].to_numpy(float)) if is_num else pa.array(r["cat"], pa.string()),
                                       pa.array(r["day"].to_numpy(), pa.int32()), pa.array(r["n"].to_numpy(), pa.int64())], schema=schema) for r in rows]
        new = self._added(pa.concat_tables(parts))
        days = self._held(is_num)
        waiting = pc.min(days.column("day")).as_py()
        kept = new.filter(self._kept(new, now))  # the others are later than what is kept
        if kept.num_rows:
            days = self._added(pa.concat_tables([days, kept]))
            self._hold(days)
            earliest = pc.min(kept.column("day")).as_py()
            if waiting is None or earliest < waiting:
                self._handle.registerTimer(self._expires(earliest))
        yield self._totals(key, days, new.column("value"))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held(bool(key[1]))
        kept = self._kept(held, timerValues.getCurrentWatermarkInMs())
        days, gone = held.filter(kept).combine_chunks(), held.filter(pc.invert(kept))
        self._hold(days)
        if days.num_rows:
            self._handle.registerTimer(self._expires(pc.min(days.column("day")).as_py()))
        yield self._totals(key, days, gone.column("value"))


#: A task adds up so many rows of partial counts before it passes them on.
PARTIAL_ROWS = 1_000_000


def _partial_counts(batches):
    """(column, is_num, num, cat, day, ts) -> the same without repeats, and how often."""
    names = ["column", "is_num", "num", "cat", "day"]
    held, rows = [], 0

    def added() -> pa.Table:
        got = pa.concat_tables(held).group_by(names).aggregate([("event_ts", "max"), ("n", "sum")])
        return got.rename_columns([*names, "event_ts", "n"]).cast(held[0].schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        got = pa.Table.from_batches([batch]).group_by(names).aggregate([("event_ts", "max"), ("event_ts", "count")])
        held.append(got.rename_columns([*names, "event_ts", "n"]).cast(pa.schema(
            [*(batch.schema.field(c) for c in names), batch.schema.field("event_ts"), pa.field("n", pa.int64())])))
        rows += held[-1].num_rows
        if rows > PARTIAL_ROWS:
            held = [added()]
            rows = held[0].num_rows
            if rows > PARTIAL_ROWS // 2:
                yield from held[0].to_batches(10_000)
                held, rows = [], 0
    if held:
        yield from added().to_batches(10_000)


def running_counts(stream: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], ts: str, keep: int, delay: str) -> DataFrame:
    """(column, is_num, num, cat, n_cur) for each value whose count over the last
    ``keep`` days of event time changes in a micro-batch. Rows later than ``delay``
    are left out by the watermark."""
    from skydrift.operators.drift import SIDE, stack_labeled
    day = F.floor(F.unix_millis("event_ts") / DAY_MS).cast("int")
    s = stream.withColumn("event_ts", F.col(ts).cast("timestamp")).withColumn("day", day).withColumn(SIDE, F.lit("current"))
    number = (F.col("num") + 0.0).alias("num")  # one zero
    long = stack_labeled(s, num_cols, cat_cols, ["event_ts", "day"]).select("column", "is_num", number, "cat", "day", "event_ts")
    fields = {f.name: f.dataType.simpleString() for f in long.schema.fields}
    partial = long.mapInArrow(_partial_counts, ", ".join(f"`{c}` {t}" for c, t in fields.items()) + ", n long")
    counted = partial.withColumn("bucket", F.pmod(F.xxhash64("num", "cat"), F.lit(BUCKETS)).cast("int")).withWatermark("event_ts", delay)
    out = f"column string, is_num boolean, num {fields['num']}, cat string, n_cur double"
    totals = counted.groupBy("column", "is_num", "bucket").transformWithStateInPandas(BucketCounts(keep), out, "Update", "EventTime")
    return totals.withColumn("num", F.when(F.col("is_num"), F.coalesce("num", F.lit(float("nan")))))  # NaN comes back as NULL


class Newest(StatefulProcessor):
    """The newest ``n`` rows of a key by (ts, id), whatever order they arrive in;
    after each micro-batch that has rows of it: (key, rows, std of their values)."""

    def __init__(self, n: int):
        self._n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._rows = handle.getListState("newest", "ts long, id long, value double")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = [tuple(r) for r in self._rows.get()] if self._rows.exists() else []
        held += [(r.ts, r.id, r.value) for r in rows]
        held = sorted(held, key=lambda r: r[:2])[-self._n:]
        self._rows.put(held)
        values = [v for _, _, v in held if v is not None]
        mean = math.fsum(values) / len(values) if values else 0.0
        std = math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (len(values) - 1)) if len(values) > 1 else None
        yield Row(key=key[0], n_rows=len(held), rolling_std=std)

    def close(self) -> None:
        pass


def _newest_of_each(n: int):
    """The newest ``n`` rows of each key of a task's part of a micro-batch."""
    def run(batches):
        held = None
        for batch in batches:
            both = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            both = both.sort_by([("key", "ascending"), ("ts", "descending"), ("id", "descending")])
            keys = both.column("key").combine_chunks()
            starts = pc.fill_null(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)), True) if len(keys) > 1 else pa.array([], pa.bool_())
            place, out = 0, []
            for new in [True, *starts.to_pylist()][: len(keys)]:
                place = 0 if new else place + 1
                out.append(place < n)
            held = both.filter(pa.array(out, pa.bool_()))
        if held is not None and held.num_rows:
            yield from held.combine_chunks().to_batches()

    return run


def newest_std(stream: DataFrame, key: str, ts: str, id_col: str, value: str, n: int = 100) -> DataFrame:
    """OP-106/35: per key, the std of the newest ``n`` values by event time after
    each micro-batch; the state is ``n`` rows a key. A key's rows of one micro-batch
    meet in one task only after each task has kept its own newest ``n``."""
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(F.col(key).alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("ts"), F.col(id_col).cast("long").alias("id"),
                         F.col(value).cast("double").alias("value"))
    kept = rows.mapInArrow(_newest_of_each(n), f"key {kind}, ts long, id long, value double")
    return kept.groupBy("key").transformWithState(Newest(n), f"key {kind}, n_rows long, rolling_std double", "Update", "None")
