"""Staging: quality filter (OP-15), synthetic key (OP-16), rename projection
(OP-17), keep-first dedup (OP-31), missing-truth drop (OP-23) and the
integer->double coercion (OP-24)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skydrift.functions.exprs import flight_key
from skydrift.schemas import STAGING_RENAMES

SMALL_INTS = (T.ByteType, T.ShortType, T.IntegerType)
ABOVE_INTS = 1 << 31


def quality_filter(df: DataFrame, false_flags: Sequence[str] = (),
                   not_null: Sequence[str] = (), positive: Sequence[str] = ()) -> DataFrame:
    """Keep rows whose flags are exactly FALSE (NULL drops the row, like
    ``IS FALSE``), whose listed columns are present and whose listed
    measures are > 0. One conjunctive filter, pushed into the scan."""
    cond: Column = F.lit(True)
    for c in false_flags:
        cond = cond & (F.col(c) == F.lit(False))
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    for c in positive:
        cond = cond & (F.col(c) > 0)
    # NULL in the flag comparison makes the whole predicate NULL -> dropped
    return df.filter(cond)


def dedup_keep_first(df: DataFrame, key: str | Sequence[str],
                     order: Sequence[str], nulls_last: bool = True, present: Sequence[str] = ()) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY key ORDER BY order...) = 1`` as an
    aggregate: per key the minimum of ``struct(sort key, row)``.

    Unlike a window, the aggregate is combined map-side (partial
    aggregation), so a hot key that holds a third of all rows is reduced to
    one row per input partition before the shuffle -- no single task ever
    sorts the hot key's rows. ``order`` should end in columns that make the
    order total (deterministic tie-break). The columns ``present`` hold no NULL;
    a NULL of a small integer travels as a number above them all."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in df.columns if c not in keys]
    types = {f.name: f.dataType for f in df.schema.fields}
    sort_fields, small = [], {}
    for i, c in enumerate(order):
        value = F.col(c)
        if nulls_last and c not in present:
            if isinstance(types.get(c), SMALL_INTS):
                value, small[c] = F.coalesce(value.cast("long"), F.lit(ABOVE_INTS)), types[c]
            else:
                sort_fields.append(value.isNull().alias(f"_n{i}"))
        sort_fields.append(value.alias(f"_o{i}"))
    # the row comes back from its sort key, followed by the columns not in it
    at = {c: f"_best._o{i}" for i, c in reversed(list(enumerate(order)))}
    rest = [c for c in payload if c not in at]
    packed = F.struct(*sort_fields, *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)])
    at |= {c: f"_best._r{i}" for i, c in enumerate(rest)} | {k: k for k in keys}
    best = df.groupBy(*keys).agg(F.min(packed).alias("_best"))
    held = {c: F.nullif(F.col(at[c]), F.lit(ABOVE_INTS)).cast(t) for c, t in small.items() if c not in keys}
    return best.select(*[held.get(c, F.col(at[c])).alias(c) for c in df.columns])


def with_flight_key(df: DataFrame, out: str = "generated_flight_uid",
                    origin="Origin", dest="Dest", date="FlightDate",
                    airline="Operating_Airline", dep="CRSDepTime") -> DataFrame:
    return df.withColumn(out, flight_key(origin, dest, date, airline, dep))


def stage_flights(raw: DataFrame) -> DataFrame:
    """Typed raw flights -> 30-column staging table (clean, key, dedup, rename)."""
    flags, positive = ["Cancelled", "Diverted"], ["Distance"]
    not_null = ["FlightDate", "Origin", "Dest", "ArrDelay", "ArrDelayMinutes", "ArrDel15"]
    clean = quality_filter(raw, false_flags=flags, not_null=not_null, positive=positive)
    keyed = with_flight_key(clean)
    kept = [c for c in keyed.columns if c != "generated_flight_uid"]
    # the flags are FALSE in every row that is left, and order nothing
    tiebreak = ["Marketing_Airline_Network"] + [c for c in kept
                                                if c not in ("Marketing_Airline_Network", *flags)]
    # nor do last columns that no staging column is made of: rows equal in all before are one
    renamed = {r for r, _ in STAGING_RENAMES}
    while tiebreak[-1] not in renamed:
        tiebreak.pop()
    first = dedup_keep_first(keyed.select("generated_flight_uid", *tiebreak), "generated_flight_uid", tiebreak,
                             present=not_null + positive)
    return rename_to_staging(first)


def rename_to_staging(df: DataFrame, key_col: str = "generated_flight_uid") -> DataFrame:
    cols = [F.col(key_col).alias("flight_uid")]
    for raw_name, stg_name in STAGING_RENAMES:
        c = F.col(raw_name)
        if raw_name == "FlightDate":
            c = c.cast("date")
        cols.append(c.alias(stg_name))
    return df.select(*cols)


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def ints_to_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast listed columns to double only when their type is an integer."""
    int_types = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    fields = {f.name: f.dataType for f in df.schema.fields}
    todo = {c: F.col(c).cast("double") for c in columns
            if c in fields and isinstance(fields[c], int_types)}
    return df.withColumns(todo) if todo else df
