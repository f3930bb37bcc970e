"""Values for the hashed keys of texts, from a table too large to broadcast.

The rows are dealt into chunks. A chunk's distinct keys go to the segments of
the table that hold them; the answers, in the order of the keys, come back to
the chunk's rows. Nothing but one chunk or one segment is held by a task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from skydrift.llm.tables import written
from skydrift.llm.words import Words, column, slices

#: A chunk ends at so many keys.
CHUNK_KEYS = 2_000_000


def looked_up(source: DataFrame, text: str, keys: Callable[[Words], np.ndarray], segment: Callable[[np.ndarray], np.ndarray],
              table: DataFrame, answer: Callable[[np.ndarray, dict], np.ndarray],
              finish: Callable[[pa.RecordBatch, Words, np.ndarray, Callable], pa.RecordBatch], schema) -> DataFrame:
    """The rows (of ``schema``) that ``finish`` makes of some consecutive rows of
    ``source``, their words, a number of its own for each row, and a function
    from keys (unsigned 64-bit) to their answers.

    ``keys``: all that ``finish`` will ask for these words. ``segment``: the
    segments of sorted keys, in rising order. ``answer``: a fixed-width value for
    each key, from its segment's row of ``table`` (segment, ...), {} if it has none."""
    names = source.columns
    wide = StructType([StructField("__row", LongType()), StructField("__chunk", LongType()),
                       *[StructField(f.name, f.dataType) for f in source.schema],
                       StructField("__segment", IntegerType()), StructField("__keys", BinaryType())])

    def ask(batches):
        row = chunk = TaskContext.get().partitionId() << 33
        waiting: list[np.ndarray] = []
        held, kinds = 0, []

        def asked():
            distinct = np.unique(np.concatenate(waiting))
            some, at = np.unique(segment(distinct), return_index=True)
            edges = [*at.tolist(), len(distinct)]
            n = len(some)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.array(np.full(n, chunk)), *[pa.nulls(n, t) for t in kinds], pa.array(some.astype(np.int32)),
                 pa.array([distinct[a:b].astype("<u8").tobytes() for a, b in zip(edges, edges[1:])], pa.binary())], wide.names)

        for batch in batches:
            kinds = batch.schema.types
            for a, b, w in slices(column(batch, text)):
                n = b - a
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), pa.array(np.full(n, chunk)), *batch.slice(a, n).columns,
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], wide.names)
                row += n
                waiting.append(np.unique(keys(w)))
                held += len(waiting[-1])
                if held >= CHUNK_KEYS:
                    yield asked()
                    chunk, waiting, held = row, [], 0
        if waiting:
            yield asked()

    def probe(requests: pa.Table, held: pa.Table) -> pa.Table:
        one = held.to_pylist()[0] if held.num_rows else {}
        found = [answer(np.frombuffer(k, "<u8"), one).tobytes() for k in requests.column("__keys").to_pylist()]
        return pa.table({"chunk": requests.column("__chunk"), "segment": requests.column("__segment"),
                         "answers": pa.array(found, pa.binary())})

    width = answer(np.zeros(0, np.uint64), {}).dtype

    def join(rows: pa.Table, answers: pa.Table) -> pa.Table:
        value = np.frombuffer(b"".join(answers.sort_by("segment").column("answers").to_pylist()), width)
        parts = [(batch.slice(a, b - a), w) for batch in rows.combine_chunks().to_batches()
                 for a, b, w in slices(column(batch, text))]
        distinct = np.unique(np.concatenate([np.unique(keys(w)) for _, w in parts]))
        return pa.Table.from_batches([
            finish(batch.select(names), w, column(batch, "__row").to_numpy(),
                   lambda k: value[np.searchsorted(distinct, k)]) for batch, w in parts])

    asked = written(source.mapInArrow(ask, wide), "asked")
    found = asked.filter("__segment is not null").select("__chunk", "__segment", "__keys").groupBy("__segment") \
        .cogroup(table.groupBy("segment")).applyInArrow(probe, "chunk long, segment int, answers binary")
    return asked.filter("__segment is null").drop("__segment", "__keys").groupBy("__chunk") \
        .cogroup(found.groupBy("chunk")).applyInArrow(join, schema)
