"""Column-expression helpers. All are built-in Spark expressions (JVM side,
whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- ingest casts
def text_to_int_rounded(x: ColLike) -> Column:
    """text -> NUMERIC -> INT: empty is NULL, and the numeric value is
    *rounded* half away from zero (``'2.5'`` -> 3, ``'-2.5'`` -> -3)."""
    v = F.nullif(_c(x), F.lit(""))
    return F.round(v.cast("decimal(38,6)")).cast("int")


def text_to_double(x: ColLike) -> Column:
    return F.nullif(_c(x), F.lit("")).cast("double")


def text_to_date(x: ColLike) -> Column:
    return F.nullif(_c(x), F.lit("")).cast("date")


def text_to_bool(x: ColLike) -> Column:
    """Only the exact words ``True``/``False`` are booleans; anything else NULL."""
    c = _c(x)
    return F.when(c == "True", F.lit(True)).when(c == "False", F.lit(False))


def text_nullable(x: ColLike) -> Column:
    return F.nullif(_c(x), F.lit(""))


# ---------------------------------------------------------------- keys, hashes
# Defaults of the synthetic flight key parts, in key order
# (origin, destination, flight date, operating airline, scheduled departure).
FLIGHT_KEY_DEFAULTS = ("NA", "NA", "00000000", "NA", "0000")


def flight_key(origin: ColLike, dest: ColLike, flight_date: ColLike,
               airline: ColLike, crs_dep_time: ColLike) -> Column:
    """``Origin_Dest_FlightDate_Airline_CRSDepTime`` with per-part defaults.
    The integer time is not zero padded (900 -> "900")."""
    parts = [origin, dest, flight_date, airline, crs_dep_time]
    return F.concat_ws("_", *[
        F.coalesce(_c(p).cast("string"), F.lit(d))
        for p, d in zip(parts, FLIGHT_KEY_DEFAULTS)])


def md5_bucket(x: ColLike, modulus: int) -> Column:
    """Portable deterministic bucket: first 32 bits of md5 as an unsigned
    integer, modulo ``modulus``. Same value in any engine that has md5."""
    h = F.conv(F.substring(F.md5(_c(x).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(modulus))


# ---------------------------------------------------------------- cyclic time
def hhmm_to_minutes(x: ColLike) -> Column:
    """HHMM -> minutes since midnight with floor division and a non-negative
    remainder (works for fractional imputed values too)."""
    c = _c(x).cast("double")
    hours = F.floor(c / 100)
    return hours * 60 + (c - hours * 100)


def cyclic_sin(x: ColLike) -> Column:
    return F.sin(F.lit(2.0 * math.pi) * hhmm_to_minutes(x) / F.lit(1440.0))


def cyclic_cos(x: ColLike) -> Column:
    return F.cos(F.lit(2.0 * math.pi) * hhmm_to_minutes(x) / F.lit(1440.0))


# ---------------------------------------------------------------- metric hygiene
def safe_ratio(num: ColLike, den: ColLike) -> Column:
    """num / den, 0 when the denominator is 0 or NULL."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")),
                      F.lit(0.0))


def clean_metric(x: ColLike) -> Column:
    """NaN, +-Inf and NULL -> 0.0."""
    c = _c(x).cast("double")
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(c)
