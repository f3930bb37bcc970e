"""Per-column distribution drift between a reference and a current frame
(OP-19..22, 25, 82..93).

All columns at once: both frames are stacked to a long
``(by..., column, side, num, cat)`` frame and pre-aggregated to one row per
distinct value (map-side combined). Every statistic is then a grouped job
keyed by ``(by..., column)``; the ordered ones (KS, Wasserstein) use
range-partitioned running totals, so neither a hot column nor a hot month
lands in one task. ``by`` (e.g. month) computes all slices in one job.

Test choice per column (documented default, overridable): reference with at
most 1000 rows -> KS for numeric, z-test for binary, chi-square for other
categoricals (drift when p < 0.05); larger reference -> normalised
Wasserstein for numeric, Jensen-Shannon distance for categoricals (drift
when >= 0.1). A numeric column with at most 5 distinct values counts as
categorical.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skydrift.functions.frames import join_null_safe
from skydrift.operators.positions import running_totals
from skydrift.schemas import DRIFT_DROP_COLUMNS
from skydrift.session import materialize

# Coefficients of the rational erfc approximation.
ERFC_COEFFICIENTS = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
                     0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)

#: Chi-square tails up to this many degrees of freedom are summed exactly.
EXACT_DOF = 200

# Test-selection rule and thresholds of the default drift preset.
SMALL_REFERENCE_ROWS = 1000
CATEGORICAL_MAX_UNIQUE = 5
P_VALUE_THRESHOLD = 0.05
DISTANCE_THRESHOLD = 0.1
WASSERSTEIN_MIN_NORM = 0.001
ALARM_THRESHOLD = 0.5

# Monthly drift baselines (month -> baseline), default 0.10.
MONTHLY_BASELINES = {1: 0.15, 2: 0.20, 3: 0.18, 4: 0.20, 5: 0.20, 6: 0.35,
                     7: 0.38, 8: 0.30, 9: 0.10, 10: 0.10, 11: 0.10, 12: 0.10}
DEFAULT_BASELINE = 0.10

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


# ------------------------------------------------------------ column handling
def drop_present(df: DataFrame, cols: Sequence[str] = DRIFT_DROP_COLUMNS) -> DataFrame:
    """OP-20: drop targets / ids if present (absent names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def common_columns(ref: DataFrame, cur: DataFrame) -> list[str]:
    """OP-21: columns present in both frames, in a deterministic order."""
    return sorted(set(ref.columns) & set(cur.columns))


def split_types(df: DataFrame, cols: Sequence[str]) -> tuple[list[str], list[str]]:
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in cols if isinstance(types[c], _NUMERIC)]
    cat = [c for c in cols if isinstance(types[c], T.StringType)]
    return num, cat


def numeric_spread(cur: DataFrame, num_cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """OP-22 measure: sample std of every numeric column on the *current*
    frame, one aggregate, as long rows ``(by..., column, std)``."""
    agg = [F.stddev_samp(F.col(c).cast("double")).alias(f"_sd_{c}") for c in num_cols]
    wide = cur.groupBy(*by).agg(*agg) if by else cur.agg(*agg)
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"_sd_{c}").alias("std"))
             for c in num_cols]
    return wide.select(*by, F.explode(F.array(*pairs)).alias("_p")).select(*by, "_p.column",
                                                                           "_p.std")


def near_constant_filter(cur: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str],
                         threshold: float = 0.01) -> tuple[list[str], list[str]]:
    """OP-22: keep numeric columns whose current std > threshold (one
    aggregate -> a list of names on the driver) and every string column."""
    if not num_cols:
        return [], list(cat_cols)
    row = cur.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in num_cols]).first()
    keep = [c for c in num_cols if row[c] is not None and row[c] > threshold]
    return keep, list(cat_cols)


def boost(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str]) -> DataFrame:
    """OP-25: perturbation booster (positive control): numerics x10,
    strings prefixed ``DRIFTED_``."""
    todo = {c: F.col(c) * 10 for c in num_cols}
    todo.update({c: F.concat(F.lit("DRIFTED_"), F.col(c).cast("string")) for c in cat_cols})
    return df.withColumns(todo)


# ------------------------------------------------------------ long frame
SIDE = "_side"


def label_sides(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """Union of both frames with a side label (for two distinct sources)."""
    cols = [c for c in ref.columns if c in set(cur.columns)]
    return ref.select(*cols, F.lit("reference").alias(SIDE)) \
        .unionByName(cur.select(*cols, F.lit("current").alias(SIDE)))


def stack_labeled(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str],
                  by: Sequence[str] = (), side_col: str = SIDE) -> DataFrame:
    """``(by..., column, is_num, side, num, cat)`` from one side-labelled
    frame: a single narrow explode, so one scan serves both sides; NULL
    values are dropped (they are not compared)."""
    pairs = [F.struct(F.lit(c).alias("column"), F.lit(True).alias("is_num"),
                      F.col(c).cast("double").alias("num"),
                      F.lit(None).cast("string").alias("cat")) for c in num_cols]
    pairs += [F.struct(F.lit(c).alias("column"), F.lit(False).alias("is_num"),
                       F.lit(None).cast("double").alias("num"),
                       F.col(c).cast("string").alias("cat")) for c in cat_cols]
    long = df.select(*by, F.col(side_col).alias("side"), F.explode(F.array(*pairs)).alias("_p")) \
        .select(*by, "_p.column", "_p.is_num", "side", "_p.num", "_p.cat")
    return long.filter(F.col("num").isNotNull() | F.col("cat").isNotNull())


def stack_sides(ref: DataFrame, cur: DataFrame, num_cols: Sequence[str],
                cat_cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return stack_labeled(label_sides(ref, cur), num_cols, cat_cols, by)


def value_counts(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per (by, column, value) with counts of both sides; partial
    aggregation collapses repeated values before the shuffle."""
    return long.groupBy(*by, "column", "is_num", "num", "cat").agg(
        F.sum(F.when(F.col("side") == "reference", 1).otherwise(0)).cast("double").alias("n_ref"),
        F.sum(F.when(F.col("side") == "current", 1).otherwise(0)).cast("double").alias("n_cur"))


def column_profile(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """OP-93 inputs: per column the side sizes, distinct values (of both
    sides together) and reference mean / population std."""
    x = F.col("num")
    return counts.groupBy(*by, "column").agg(
        F.first("is_num").alias("is_num"),
        F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"),
        F.count(F.lit(1)).alias("n_unique"),
        F.sum(F.col("n_ref") * x).alias("_sx"), F.sum(F.col("n_ref") * x * x).alias("_sxx"))


def select_tests(profile: DataFrame, override: dict | None = None,
                 small_reference_rows: int = SMALL_REFERENCE_ROWS,
                 categorical_max_unique: int = CATEGORICAL_MAX_UNIQUE) -> DataFrame:
    """OP-93, test per column: see the module docstring. The rule goes by the
    size of the reference: up to ``small_reference_rows`` a significance test,
    above a distance; a numeric column of at most ``categorical_max_unique``
    values counts as categorical. ``override`` maps column names to a test."""
    small = F.col("tot_ref") <= small_reference_rows
    as_num = F.col("is_num") & (F.col("n_unique") > categorical_max_unique)
    test = (F.when(small & as_num, "ks")
             .when(small & (F.col("n_unique") <= 2), "z")
             .when(small, "chisquare")
             .when(as_num, "wasserstein")
             .otherwise("jensenshannon"))
    if override:
        for c, t in override.items():
            test = F.when(F.col("column") == c, F.lit(t)).otherwise(test)
    return profile.withColumn("test", test)


# ------------------------------------------------------------ distributions
def _norm_sf(z: Column) -> Column:
    """Upper normal tail 0.5*erfc(z/sqrt 2) via the Chebyshev-fitted erfc
    (fractional error < 1.2e-7); Spark SQL has no erf."""
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * x)
    poly = F.lit(ERFC_COEFFICIENTS[-1])
    for c in reversed(ERFC_COEFFICIENTS[:-1]):
        poly = F.lit(c) + t * poly
    erfc = t * F.exp(-x * x + poly)
    upper = F.lit(0.5) * erfc
    return F.when(z >= 0, upper).otherwise(F.lit(1.0) - upper)


def _kolmogorov_sf(lam: Column) -> Column:
    """Asymptotic two-sided KS tail ``2 sum (-1)^(k-1) exp(-2 k^2 lam^2)``."""
    s = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                    lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1)
                    * F.exp(F.lit(-2.0) * k * k * lam * lam))
    p = F.lit(2.0) * s
    return F.when(lam <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


def _chi2_sf(x: Column, dof: Column) -> Column:
    """Chi-square upper tail for integer dof. Up to ``EXACT_DOF`` in closed form,
    as sums of terms that are each computed as one exponential of logarithms (no
    factor under- or overflows by itself): even dof a Poisson sum, odd dof a
    normal tail plus a finite series. Above, the cube-root normal approximation,
    which is good to about 1e-5 there; the work is bounded for any dof."""
    small = F.least(dof.cast("double"), F.lit(float(EXACT_DOF)))
    half = x / 2.0

    def series(steps: Column, shift: float, first: Column) -> Column:
        # first: log of the term for j = 0; each next one has a factor half / (j + shift)
        return F.aggregate(
            F.sequence(F.lit(0), F.greatest(steps.cast("int") - 1, F.lit(0))),
            F.struct(F.lit(0.0).alias("s"), first.alias("log")),
            lambda acc, j: F.struct(
                (acc["s"] + F.exp(acc["log"])).alias("s"),
                (acc["log"] + F.log(half / (j + 1 + F.lit(shift)))).alias("log")),
            lambda acc: acc["s"])

    even = series(small / 2, 0.0, -half)
    odd_first = F.lit(0.5) * F.log(half) - half - F.lit(math.lgamma(1.5))
    odd = F.lit(2.0) * _norm_sf(F.sqrt(x)) + F.when(
        small > 1, series((small - 1) / 2, 0.5, odd_first)).otherwise(F.lit(0.0))
    c = F.lit(2.0) / (F.lit(9.0) * dof)
    wide = _norm_sf((F.cbrt(x / dof) - (F.lit(1.0) - c)) / F.sqrt(c))
    res = F.when(dof > EXACT_DOF, wide).when(dof.cast("long") % 2 == 0, even).otherwise(odd)
    return F.when(x.isNull(), F.lit(None)).when(x == F.lit(float("inf")), F.lit(0.0)) \
        .when((x <= 0) | (dof <= 0), F.lit(1.0)).otherwise(F.least(F.greatest(res, F.lit(0.0)), F.lit(1.0)))


# ------------------------------------------------------------ statistics
def cumulative_shares(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Numeric columns: per distinct value the cumulative shares F (ref) and
    G (cur), inclusive of the value, plus the next distinct value -- one
    range pass (running totals with group totals and successor)."""
    num = counts.filter(F.col("is_num")).select(*by, "column", "num", "n_ref", "n_cur")
    run = running_totals(num, [*by, "column"], ["num"], ["n_ref", "n_cur"], with_next=True,
                         with_totals=True)
    return run.select(*by, "column", "num", "n_ref", "n_cur", "next_num",
                      F.col("tot_n_ref").alias("tot_ref"), F.col("tot_n_cur").alias("tot_cur"),
                      (F.col("cum_n_ref") / F.col("tot_n_ref")).alias("F"),
                      (F.col("cum_n_cur") / F.col("tot_n_cur")).alias("G"))


def ordered_stats(shares: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """OP-88 + OP-91 in one aggregate over the cumulative shares: KS D and
    its asymptotic p-value; Wasserstein-1 and its normalisation by
    max(population std of the reference, 0.001)."""
    gap = F.coalesce(F.col("next_num") - F.col("num"), F.lit(0.0))
    d = shares.groupBy(*by, "column").agg(
        F.max(F.abs(F.col("F") - F.col("G"))).alias("ks_stat"),
        F.sum(F.abs(F.col("F") - F.col("G")) * gap).alias("w1"),
        F.sum(F.col("n_ref") * F.col("num")).alias("_sx"),
        F.sum(F.col("n_ref") * F.col("num") * F.col("num")).alias("_sxx"),
        F.first("tot_ref").alias("_n"), F.first("tot_cur").alias("_m"))
    en = F.col("_n") * F.col("_m") / (F.col("_n") + F.col("_m"))
    mean = F.col("_sx") / F.col("_n")
    std = F.sqrt(F.greatest(F.col("_sxx") / F.col("_n") - mean * mean, F.lit(0.0)))
    return d.select(*by, "column", "ks_stat",
                    _kolmogorov_sf(F.col("ks_stat") * F.sqrt(en)).alias("ks_p_value"), "w1",
                    (F.col("w1") / F.greatest(std, F.lit(WASSERSTEIN_MIN_NORM)))
                    .alias("wasserstein_norm"))


def ks_stats(shares: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """OP-88: D = max |F - G| and the asymptotic p-value."""
    return ordered_stats(shares, by).select(*by, "column", "ks_stat", "ks_p_value")


def wasserstein_stats(shares: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """OP-91: integral |F - G| dx over the merged support, normalised."""
    return ordered_stats(shares, by).select(*by, "column", "w1", "wasserstein_norm")


def _with_shares(counts: DataFrame, by: Sequence[str], totals: DataFrame | None = None) -> DataFrame:
    """Per-value counts with both sides' totals (tot_ref, tot_cur), the number
    of values k, and the shares p, q."""
    tot = totals if totals is not None else counts.groupBy(*by, "column").agg(
        F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"), F.count(F.lit(1)).alias("k"))
    return join_null_safe(counts, tot, [*by, "column"]).withColumns({
        "p": F.col("n_ref") / F.col("tot_ref"), "q": F.col("n_cur") / F.col("tot_cur")})


def _category_stats(shares: DataFrame, by: Sequence[str]) -> DataFrame:
    """OP-89, 90, 92 in one aggregate over the shares: Jensen-Shannon distance
    (natural log); chi-square goodness of fit of the current counts against the
    reference counts scaled to the current size (dof = categories - 1); and the
    two-proportion z-test on the share of the smallest value (zero pooled
    variance: undefined, p = 1)."""
    m = (F.col("p") + F.col("q")) / 2.0
    js = F.when(F.col("p") > 0, F.col("p") * F.log(F.col("p") / m)).otherwise(0.0) + \
        F.when(F.col("q") > 0, F.col("q") * F.log(F.col("q") / m)).otherwise(0.0)
    exp = F.col("n_ref") * (F.col("tot_cur") / F.col("tot_ref"))
    chi = F.when(exp > 0, (F.col("n_cur") - exp) * (F.col("n_cur") - exp) / exp) \
        .when(F.col("n_cur") > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
    g = shares.groupBy(*by, "column").agg(
        F.sqrt(F.greatest(F.sum(js) / 2.0, F.lit(0.0))).alias("js_distance"),
        F.sum(chi).alias("chi2_stat"), (F.first("k") - 1).alias("chi2_dof"),
        F.min(F.struct("num", "cat", "p", "q", "tot_ref", "tot_cur")).alias("_f"))
    p1, p2, n1, n2 = (F.col(f"_f.{c}") for c in ("p", "q", "tot_ref", "tot_cur"))
    pool = (n1 * p1 + n2 * p2) / (n1 + n2)
    se = F.sqrt(pool * (F.lit(1.0) - pool) * (F.lit(1.0) / n1 + F.lit(1.0) / n2))
    return g.withColumn("z_stat", F.try_divide(p1 - p2, se))


def _chi2_p() -> Column:
    return _chi2_sf(F.col("chi2_stat"), F.col("chi2_dof"))


def _z_p() -> Column:
    return F.when(F.col("z_stat").isNull(), F.lit(1.0)) \
        .otherwise(F.lit(2.0) * _norm_sf(F.abs(F.col("z_stat"))))


def js_stats(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """OP-92: Jensen-Shannon distance of the value shares."""
    return _category_stats(_with_shares(counts, by), by).select(*by, "column", "js_distance")


def chi2_stats(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """OP-89: chi-square statistic, dof and p-value."""
    return _category_stats(_with_shares(counts, by), by) \
        .select(*by, "column", "chi2_stat", "chi2_dof", _chi2_p().alias("chi2_p_value"))


def z_stats(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """OP-90: two-proportion z-test."""
    return _category_stats(_with_shares(counts, by), by) \
        .select(*by, "column", "z_stat", _z_p().alias("z_p_value"))


# ------------------------------------------------------------ report
def drift_report(ref: DataFrame, cur: DataFrame, num_cols: Sequence[str],
                 cat_cols: Sequence[str], by: Sequence[str] = (),
                 override: dict | None = None) -> DataFrame:
    """OP-82: one row per (by..., column): chosen test, its statistic,
    p-value (tests) or distance, threshold and the drift flag."""
    return drift_report_labeled(label_sides(ref, cur), num_cols, cat_cols, by, override)


def drift_report_labeled(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str],
                         by: Sequence[str] = (), override: dict | None = None,
                         side_col: str = SIDE) -> DataFrame:
    """:func:`drift_report` over one frame whose ``side_col`` says
    ``reference`` / ``current`` (one scan for both sides)."""
    by = list(by)
    # the pre-aggregated counts feed five statistics: materialise them once
    counts = materialize(value_counts(stack_labeled(df, num_cols, cat_cols, by, side_col), by))
    return report_from_counts(counts, by, override)


def side_counts(df: DataFrame, side: str, num_cols: Sequence[str], cat_cols: Sequence[str],
                by: Sequence[str] = ()) -> DataFrame:
    """Per-value counts of one side only (e.g. the reference, computed once
    and reused for every current batch)."""
    lab = df.withColumn(SIDE, F.lit(side))
    return value_counts(stack_labeled(lab, num_cols, cat_cols, list(by)), list(by))


def merge_counts(a: DataFrame, b: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add two per-value count frames (reference + current)."""
    return a.unionByName(b).groupBy(*by, "column", "is_num", "num", "cat").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def report_from_counts(counts: DataFrame, by: Sequence[str] = (),
                       override: dict | None = None) -> DataFrame:
    """The drift report from per-value counts of both sides. The test of each
    column is chosen first; each statistic is then computed for the columns
    that use it only, the ordered ones in one pass, the others in another."""
    by = list(by)
    keys = [*by, "column"]
    chosen = select_tests(column_profile(counts, by), override).select(
        *keys, "test", "tot_ref", "tot_cur", "n_unique", F.col("n_unique").alias("k"))
    shares = _with_shares(counts, by, chosen)
    ordered = F.col("test").isin("ks", "wasserstein")
    tests = {
        "ks": (F.col("ks_stat"), F.col("ks_p_value")),
        "wasserstein": (F.col("wasserstein_norm"), F.lit(None).cast("double")),
        "z": (F.col("z_stat"), _z_p()),
        "chisquare": (F.col("chi2_stat"), _chi2_p()),
        "jensenshannon": (F.col("js_distance"), F.lit(None).cast("double")),
    }

    def result(stats: DataFrame, names: Sequence[str]) -> DataFrame:
        stat, p = F.lit(None).cast("double"), F.lit(None).cast("double")
        for name in names:
            hit = F.col("test") == name
            stat = F.when(hit, tests[name][0]).otherwise(stat)
            p = F.when(hit, tests[name][1]).otherwise(p)
        return join_null_safe(chosen, stats, keys).select(
            *keys, "test", "tot_ref", "tot_cur", "n_unique", stat.alias("statistic"), p.alias("p_value"))

    num = shares.filter(ordered & F.col("is_num")).drop("test", "tot_ref", "tot_cur", "n_unique", "k", "p", "q")
    r = result(ordered_stats(cumulative_shares(num, by), by), ["ks", "wasserstein"]) \
        .unionByName(result(_category_stats(shares.filter(~ordered), by), ["z", "chisquare", "jensenshannon"]))
    is_test = F.col("test").isin("ks", "z", "chisquare")
    drifted = F.when(is_test, F.coalesce(F.col("p_value") < P_VALUE_THRESHOLD, F.lit(False))) \
        .otherwise(F.coalesce(F.col("statistic") >= DISTANCE_THRESHOLD, F.lit(False)))
    return r.select(*keys, "test", "tot_ref", "tot_cur", "n_unique", "statistic", "p_value",
                    F.when(is_test, F.lit(P_VALUE_THRESHOLD))
                     .otherwise(F.lit(DISTANCE_THRESHOLD)).alias("threshold"),
                    drifted.alias("drifted"))


def drift_score(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """OP-83: share of drifted columns among the compared ones."""
    agg = [F.count(F.lit(1)).alias("n_columns"),
           F.sum(F.col("drifted").cast("int")).alias("n_drifted"),
           F.avg(F.col("drifted").cast("double")).alias("drift_score")]
    return report.groupBy(*by).agg(*agg) if by else report.agg(*agg)


def with_alarm(scores: DataFrame, month_col: str | None = None,
               threshold: float = ALARM_THRESHOLD) -> DataFrame:
    """OP-84/85: alarm when score > threshold; with a month column, also the
    monthly baseline (small literal table, broadcast join) and its flag."""
    out = scores.withColumn("alarm", F.col("drift_score") > F.lit(threshold))
    if month_col:
        spark = scores.sparkSession
        base = spark.createDataFrame(sorted(MONTHLY_BASELINES.items()),
                                     f"{month_col} int, baseline double")
        out = out.join(F.broadcast(base), month_col, "left") \
            .withColumn("baseline", F.coalesce(F.col("baseline"), F.lit(DEFAULT_BASELINE))) \
            .withColumn("above_baseline", F.col("drift_score") > F.col("baseline"))
    return out


def target_month(log: DataFrame, ts_col: str = "ts", given: int | None = None) -> DataFrame:
    """OP-86: the given month, else the month of the latest timestamp, else 1."""
    if given:
        return log.sparkSession.range(1).select(F.lit(given).alias("month"))
    return log.agg(F.coalesce(F.month(F.max(ts_col)), F.lit(1)).alias("month"))
