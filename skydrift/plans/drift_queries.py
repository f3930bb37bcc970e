"""Drift queries (OP-19..22, 25, 82..93): reference period vs current period
of the staging view, whole-table and per calendar month."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from skydrift.functions.frames import with_scalars
from skydrift.operators import drift as D
from skydrift.plans.oracle import with_fx
from skydrift.plans.registry import query
from skydrift.sources.fixtures import fx_predictions, fx_stg

SPLIT = "1999-01-01"
NUM = ["year", "quarter", "month", "day_of_month", "day_of_week", "origin_airport_id",
       "dest_airport_id", "crs_dep_time", "crs_elapsed_time", "distance", "distance_group",
       "flight_number_marketing_airline", "flight_number_operating_airline", "crs_arr_time"]
CAT = ["tail_number", "marketing_airline_network", "dep_time_blk"]
CHI2_COLS_NUM = ["quarter", "month", "day_of_week"]
CHI2_COLS_CAT = ["marketing_airline_network", "dep_time_blk"]


def _sides(spark, sf_dir):
    """Reference = before the split date, current = from it on; targets and
    ids dropped (OP-18/20)."""
    split = F.lit(SPLIT).cast("date")
    full = fx_stg(spark, sf_dir)
    ref = D.drop_present(full.filter(F.col("flight_date") < split))
    cur = D.drop_present(full.filter(F.col("flight_date") >= split))
    return ref, cur


def _labeled(spark, sf_dir):
    """One staging scan with a side label: before the split date is the
    reference, from it on the current period."""
    full = D.drop_present(fx_stg(spark, sf_dir).withColumn(
        D.SIDE, F.when(F.col("flight_date") < F.lit(SPLIT).cast("date"), "reference")
        .otherwise("current")))
    return full


def _counts(spark, sf_dir, num, cat, by=()):
    return D.value_counts(D.stack_labeled(_labeled(spark, sf_dir), num, cat, list(by)), list(by))


def _feature(df):
    return df.withColumnRenamed("column", "feature")


# ------------------------------------------------------------------ SQL twin
def _nsf(z: str) -> str:
    """Upper normal tail with the same rational erfc fit as the Spark side."""
    x = f"(abs({z}) / sqrt(2.0))"
    t = f"(1.0 / (1.0 + 0.5 * {x}))"
    coeffs = D.ERFC_COEFFICIENTS
    poly = f"{coeffs[-1]}"
    for c in reversed(coeffs[:-1]):
        poly = f"({c} + {t} * {poly})"
    upper = f"(0.5 * {t} * exp(-{x} * {x} + {poly}))"
    return f"(case when {z} >= 0 then {upper} else 1.0 - {upper} end)"


def drift_ctes(num, cat, by_sql: str = "", ref_where: str = f"flight_date < date '{SPLIT}'",
               cur_where: str = f"flight_date >= date '{SPLIT}'", boost: bool = False,
               cur_src: str = "fx_stg") -> str:
    """CTEs ``counts prof sel sh ks_final ws_final js ch_final z_final report``."""
    b = f"{by_sql} as grp, " if by_sql else ""
    g = "grp, " if by_sql else ""
    parts = []
    for side, where in (("reference", ref_where), ("current", cur_where)):
        boosted = boost and side == "current"
        src = cur_src if side == "current" else "fx_stg"
        for c in num:
            v = f"{c} * 10" if boosted else c
            parts.append(f"select {b}'{c}' as feature, true as is_num, '{side}' as side, "
                         f"cast({v} as double) as num, cast(null as varchar) as cat "
                         f"from {src} where {where}")
        for c in cat:
            v = f"'DRIFTED_' || cast({c} as varchar)" if boosted else f"cast({c} as varchar)"
            parts.append(f"select {b}'{c}' as feature, false as is_num, '{side}' as side, "
                         f"cast(null as double) as num, {v} as cat "
                         f"from {src} where {where}")
    long = "\nunion all\n".join(parts)
    pi2 = math.sqrt(2 * math.pi)
    nsf_rx = _nsf("sqrt(x)")
    return f"""long AS (select * from ({long}) u where num is not null or cat is not null),
counts AS (select {g}feature, is_num, num, cat,
                  cast(sum(case when side = 'reference' then 1 else 0 end) as double) as n_ref,
                  cast(sum(case when side = 'current' then 1 else 0 end) as double) as n_cur
           from long group by {g}feature, is_num, num, cat),
prof AS (select {g}feature, bool_or(is_num) as is_num, sum(n_ref) as tot_ref,
                sum(n_cur) as tot_cur, count(*) as n_unique
         from counts group by {g}feature),
sel AS (select *, case when tot_ref <= 1000 and is_num and n_unique > 5 then 'ks'
                       when tot_ref <= 1000 and n_unique <= 2 then 'z'
                       when tot_ref <= 1000 then 'chisquare'
                       when is_num and n_unique > 5 then 'wasserstein'
                       else 'jensenshannon' end as test from prof),
sh AS (select c.*, p.tot_ref, p.tot_cur,
              sum(n_ref) over (partition by {g}c.feature order by num
                               rows between unbounded preceding and current row) / p.tot_ref as fr,
              sum(n_cur) over (partition by {g}c.feature order by num
                               rows between unbounded preceding and current row) / p.tot_cur as gc,
              lead(num) over (partition by {g}c.feature order by num) as next_num
       from counts c join prof p using ({g}feature) where c.is_num),
ks AS (select {g}feature, max(abs(fr - gc)) as ks_stat,
              max(tot_ref) * max(tot_cur) / (max(tot_ref) + max(tot_cur)) as en
       from sh group by {g}feature),
ks_terms AS (select {g}feature,
                    sum(power(-1.0, k - 1) * exp(-2.0 * k * k * ks_stat * ks_stat * en)) as s
             from ks, range(1, 101) t(k) group by {g}feature),
ks_final AS (select {g}feature, ks_stat,
                    case when ks_stat * sqrt(en) <= 0 then 1.0
                         else least(greatest(2 * s, 0.0), 1.0) end as ks_p_value
             from ks join ks_terms using ({g}feature)),
ws AS (select {g}feature, sum(abs(fr - gc) * coalesce(next_num - num, 0.0)) as w1,
              sum(n_ref * num) as sx, sum(n_ref * num * num) as sxx, max(tot_ref) as n
       from sh group by {g}feature),
ws_final AS (select {g}feature, w1,
                    w1 / greatest(sqrt(greatest(sxx / n - (sx / n) * (sx / n), 0.0)), 0.001)
                      as wasserstein_norm from ws),
cs AS (select c.*, p.tot_ref, p.tot_cur, p.n_unique as k, c.n_ref / p.tot_ref as p_,
              c.n_cur / p.tot_cur as q_
       from counts c join prof p using ({g}feature)),
js AS (select {g}feature, sqrt(greatest(sum(
                 case when p_ > 0 then p_ * ln(p_ / ((p_ + q_) / 2)) else 0 end
               + case when q_ > 0 then q_ * ln(q_ / ((p_ + q_) / 2)) else 0 end) / 2, 0.0)) as js_distance
       from cs group by {g}feature),
ch AS (select {g}feature, sum(case when e > 0 then (n_cur - e) * (n_cur - e) / e
                                  when n_cur > 0 then cast('inf' as double) else 0 end) as x,
              max(k) - 1 as d
       from (select *, n_ref * (tot_cur / tot_ref) as e from cs) z group by {g}feature),
ch_ok AS (select * from ch where x > 0 and x < cast('inf' as double)),
ch_even AS (select {g}feature, sum(exp(j * ln(x / 2) - lgamma(j + 1))) as s
            from ch_ok, range(0, 1000000) t(j)
            where d % 2 = 0 and j <= floor(d / 2) - 1 group by {g}feature),
ch_odd AS (select {g}feature,
                  sum(exp((j - 0.5) * ln(x) - (lgamma(2 * j + 1) - j * ln(2) - lgamma(j + 1)))) as s
           from ch_ok, range(1, 1000000) t(j)
           where d % 2 = 1 and j <= floor((d - 1) / 2) group by {g}feature),
ch_final AS (select {g}feature, x as chi2_stat, d as chi2_dof,
                    case when x is null then null when x = cast('inf' as double) then 0.0
                         when x <= 0 then 1.0
                         when d % 2 = 0 then least(greatest(exp(-x / 2) * coalesce(e.s, 0.0), 0.0), 1.0)
                         else least(greatest(2 * {nsf_rx} + case when d > 1 then
                              2 * exp(-x / 2) / {pi2} * coalesce(o.s, 0.0) else 0 end, 0.0), 1.0)
                    end as chi2_p_value
             from ch left join ch_even e using ({g}feature) left join ch_odd o using ({g}feature)),
zf AS (select {g}feature, first(p_ order by num nulls first, cat nulls first) as p1,
              first(q_ order by num nulls first, cat nulls first) as p2,
              max(tot_ref) as n1, max(tot_cur) as n2
       from cs group by {g}feature),
zp AS (select *, (n1 * p1 + n2 * p2) / (n1 + n2) as pool from zf),
zs AS (select {g}feature,
              case when pool * (1 - pool) * (1 / n1 + 1 / n2) > 0
                   then (p1 - p2) / sqrt(pool * (1 - pool) * (1 / n1 + 1 / n2)) end as z_stat
       from zp),
z_final AS (select {g}feature, z_stat,
                   case when z_stat is null then 1.0 else 2 * {_nsf('abs(z_stat)')} end as z_p_value
            from zs),
report AS (select {g}feature, test, tot_ref, tot_cur, n_unique,
                  case test when 'ks' then ks_stat when 'z' then z_stat
                            when 'chisquare' then x_stat when 'wasserstein' then wasserstein_norm
                            else js_distance end as statistic,
                  case test when 'ks' then ks_p_value when 'z' then z_p_value
                            when 'chisquare' then chi2_p_value end as p_value,
                  case when test in ('ks', 'z', 'chisquare') then 0.05::double else 0.1::double end as threshold,
                  case when test in ('ks', 'z', 'chisquare')
                       then coalesce(case test when 'ks' then ks_p_value when 'z' then z_p_value
                                          else chi2_p_value end < 0.05, false)
                       else coalesce(case test when 'wasserstein' then wasserstein_norm
                                          else js_distance end >= 0.1, false) end as drifted
           from sel left join ks_final using ({g}feature) left join ws_final using ({g}feature)
                left join js using ({g}feature)
                left join (select {g}feature, chi2_stat as x_stat, chi2_p_value from ch_final) c2
                  using ({g}feature)
                left join z_final using ({g}feature))"""


def _sql(body: str, num, cat, by_sql: str = "") -> str:
    return with_fx(["fx_stg"], body, drift_ctes(num, cat, by_sql))


# ------------------------------------------------------------------ queries
@query("drift_profile_columns", _sql("select feature, is_num, tot_ref, tot_cur, n_unique from prof",
                                     NUM, CAT))
def q_profile(spark, sf_dir):
    """OP-20/21/82: targets and ids dropped, common columns profiled."""
    ref, cur = _sides(spark, sf_dir)
    cols = D.common_columns(ref, cur)
    num, cat = D.split_types(ref, cols)
    counts = D.value_counts(D.stack_labeled(_labeled(spark, sf_dir), num, cat))
    return _feature(D.column_profile(counts).select("column", "is_num", "tot_ref", "tot_cur",
                                                    "n_unique"))


@query("drift_test_selection", _sql("select feature, test from sel", NUM, CAT))
def q_selection(spark, sf_dir):
    """OP-93: test per column from type, distinct count and reference size."""
    counts = _counts(spark, sf_dir, NUM, CAT)
    return _feature(D.select_tests(D.column_profile(counts)).select("column", "test"))


@query("drift_ks", _sql("select feature, ks_stat, ks_p_value from ks_final", NUM, []))
def q_ks(spark, sf_dir):
    """OP-88: two-sample KS statistic and asymptotic p-value per column."""
    counts = _counts(spark, sf_dir, NUM, [])
    return _feature(D.ks_stats(D.cumulative_shares(counts)))


@query("drift_wasserstein", _sql("select feature, w1, wasserstein_norm from ws_final", NUM, []))
def q_wasserstein(spark, sf_dir):
    """OP-91: Wasserstein-1 and its reference-std normalisation."""
    counts = _counts(spark, sf_dir, NUM, [])
    return _feature(D.wasserstein_stats(D.cumulative_shares(counts)))


@query("drift_js", _sql("select feature, js_distance from js", NUM, CAT))
def q_js(spark, sf_dir):
    """OP-92: Jensen-Shannon distance of value shares per column."""
    return _feature(D.js_stats(_counts(spark, sf_dir, NUM, CAT)))


@query("drift_chi2_stat", _sql("select feature, chi2_stat, chi2_dof, chi2_p_value from ch_final",
                               CHI2_COLS_NUM, CHI2_COLS_CAT))
def q_chi2(spark, sf_dir):
    """OP-89: chi-square goodness of fit against scaled reference counts."""
    return _feature(D.chi2_stats(_counts(spark, sf_dir, CHI2_COLS_NUM, CHI2_COLS_CAT)))


@query("drift_ztest_stat", _sql("select feature, z_stat, z_p_value from z_final", [],
                                ["dep_time_blk"]))
def q_z(spark, sf_dir):
    """OP-90: two-proportion z-test of a binary column."""
    return _feature(D.z_stats(_counts(spark, sf_dir, [], ["dep_time_blk"])))


_REPORT_COLS = "feature, test, tot_ref, tot_cur, n_unique, statistic, p_value, threshold, drifted"


@query("drift_report", _sql(f"select {_REPORT_COLS} from report", NUM, CAT))
def q_report(spark, sf_dir):
    """OP-82: auto-selected test per column with its decision."""
    return _feature(D.drift_report_labeled(_labeled(spark, sf_dir), NUM, CAT))


@query("drift_near_constant_filter", with_fx(["fx_stg"], "select feature, std, std > 0.01 as keep "
                                             "from (" + " union all ".join(
    f"select '{c}' as feature, stddev_samp(cast({c} as double)) as std from fx_stg "
    f"where flight_date >= date '{SPLIT}'" for c in NUM) + ") s"))
def q_near_constant(spark, sf_dir):
    """OP-22: current-period std per numeric column, keep when > 0.01."""
    _, cur = _sides(spark, sf_dir)
    s = D.numeric_spread(cur, NUM)
    return _feature(s.withColumn("keep", F.col("std") > 0.01))


_MONTH_BODY = """, spread AS (
  select month as grp, feature, std from (""" + " union all ".join(
    f"select month, '{c}' as feature, stddev_samp(cast({c} as double)) as std from fx_stg "
    f"where flight_date >= date '{SPLIT}' group by month" for c in NUM) + """) s),
kept AS (select r.* from report r left join spread s using (grp, feature)
         where s.std is null or s.std > 0.01)
select grp as month, count(*) as n_columns, cast(sum(case when drifted then 1 else 0 end) as bigint)
         as n_drifted, avg(case when drifted then 1.0 else 0.0 end) as drift_score,
       avg(case when drifted then 1.0 else 0.0 end) > 0.5 as alarm,
       cast(coalesce(b.baseline, 0.10) as double) as baseline,
       avg(case when drifted then 1.0 else 0.0 end) > coalesce(b.baseline, 0.10) as above_baseline
from kept left join (select * from (values """ + ", ".join(
    f"({m}, {v})" for m, v in sorted(D.MONTHLY_BASELINES.items())) + """) v(month, baseline)) b
  on kept.grp = b.month
group by grp, b.baseline"""


def _month_sql():
    ctes = drift_ctes(NUM, CAT, "month")
    body = _MONTH_BODY
    first, rest = body.split("select grp as month", 1)
    return with_fx(["fx_stg"], "select grp as month" + rest, ctes + first)


@query("drift_score_by_month", _month_sql())
def q_score_by_month(spark, sf_dir):
    """OP-19/44/83..85: every calendar month's reference slice vs the same
    month of the current period, near-constant columns removed per month,
    share of drifted columns, alarm and monthly baseline -- one job."""
    from skydrift.session import materialize
    lab = materialize(_labeled(spark, sf_dir))  # read by the report and the spread
    rep = D.drift_report_labeled(lab, NUM, CAT, by=["month"])
    spread = D.numeric_spread(lab.filter(F.col(D.SIDE) == "current"), NUM, by=["month"])
    kept = rep.join(spread, ["month", "column"], "left") \
        .filter(F.col("std").isNull() | (F.col("std") > 0.01))
    scores = D.drift_score(kept, by=["month"])
    return D.with_alarm(scores, "month").select(
        "month", "n_columns", "n_drifted", "drift_score", "alarm", "baseline", "above_baseline")


_ALARM_SPREAD = """, spread AS (
  select feature, std from (""" + " union all ".join(
    f"select '{c}' as feature, stddev_samp(cast({c} as double)) as std from fx_stg "
    f"where flight_date >= date '{SPLIT}'" for c in NUM) + """) s),
kept AS (select r.* from report r left join spread s using (feature)
         where s.std is null or s.std > 0.01)"""


def _alarm_sql():
    ctes = drift_ctes(NUM, CAT) + _ALARM_SPREAD
    return with_fx(["fx_stg"], """
select count(*) as n_columns, cast(sum(case when drifted then 1 else 0 end) as bigint) as n_drifted,
       avg(case when drifted then 1.0 else 0.0 end) as drift_score,
       avg(case when drifted then 1.0 else 0.0 end) > 0.5 as alarm,
       (select cast(coalesce(month(max(ts)), 1) as integer) from events) as month
from kept""", ctes)


@query("drift_alarm", _alarm_sql())
def q_alarm(spark, sf_dir):
    """OP-22/83/84/86: near-constant columns removed (current std <= 0.01),
    whole-period drift score, alarm flag and the target month taken from the
    latest prediction timestamp. One labelled scan, materialised once."""
    from skydrift.session import materialize
    lab = materialize(_labeled(spark, sf_dir))
    keep_num, keep_cat = D.near_constant_filter(lab.filter(F.col(D.SIDE) == "current"),
                                                NUM, CAT)
    score = D.with_alarm(D.drift_score(D.drift_report_labeled(lab, keep_num, keep_cat)))
    return with_scalars(score, D.target_month(fx_predictions(spark, sf_dir), "ts"))


@query("drift_boosted", _sql("""select count(*) as n_columns,
  avg(case when drifted then 1.0 else 0.0 end) as drift_score from report""", NUM, CAT))
def q_boosted_baseline(spark, sf_dir):
    """OP-25 control: the unboosted whole-period score (the boosted one,
    ``drift_boosted_current``, must not be lower)."""
    return D.drift_score(D.drift_report_labeled(_labeled(spark, sf_dir), NUM, CAT)) \
        .select("n_columns", "drift_score")


@query("drift_boosted_current", with_fx(["fx_stg"], """select count(*) as n_columns,
  cast(sum(case when drifted then 1 else 0 end) as bigint) as n_drifted,
  avg(case when drifted then 1.0 else 0.0 end) as drift_score from report""",
    drift_ctes(NUM, CAT, boost=True)))
def q_boosted(spark, sf_dir):
    """OP-25: numerics x10 and strings prefixed on the current side only."""
    ref, cur = _sides(spark, sf_dir)
    return D.drift_score(D.drift_report(ref, D.boost(cur, NUM, CAT), NUM, CAT))


@query("drift_target_month", with_fx(["fx_predictions"], """
select cast(coalesce(month(max(ts)), 1) as integer) as month from fx_predictions"""))
def q_target_month(spark, sf_dir):
    """OP-86: month of the newest prediction (1 when the log is empty)."""
    return D.target_month(fx_predictions(spark, sf_dir), "ts")


_FLOW_NUM = ["origin_airport_id", "dest_airport_id", "crs_dep_time", "crs_elapsed_time", "distance"]
_FLOW_CAT = ["tail_number", "dep_time_blk"]


def _flow_sql():
    current = f"""target AS (select month(max(flight_date)) as month from fx_stg where flight_date >= date '{SPLIT}'),
cur_rows AS (select * from fx_stg where flight_date >= date '{SPLIT}' order by flight_date desc, flight_uid desc limit 5000),
"""
    ctes = current + drift_ctes(_FLOW_NUM, _FLOW_CAT, cur_src="cur_rows", cur_where="true",
                                ref_where=f"flight_date < date '{SPLIT}' and month = (select month from target)")
    ctes += """, spread AS (
  select feature, std from (""" + " union all ".join(
        f"select '{c}' as feature, stddev_samp(cast({c} as double)) as std from cur_rows" for c in _FLOW_NUM) + """) s),
kept AS (select r.* from report r left join spread s using (feature) where s.feature is null or s.std > 0.01),
baselines AS (select * from (values """ + ", ".join(
        f"({m}, {v})" for m, v in sorted(D.MONTHLY_BASELINES.items())) + """) v(month, baseline))"""
    return with_fx(["fx_stg"], """
select cast(t.month as integer) as month, n_columns, n_drifted, drift_score, drift_score > 0.5 as alarm,
       cast(coalesce(b.baseline, 0.10) as double) as baseline, drift_score > coalesce(b.baseline, 0.10) as above_baseline
from (select count(*) as n_columns, cast(sum(case when drifted then 1 else 0 end) as bigint) as n_drifted,
             avg(case when drifted then 1.0 else 0.0 end) as drift_score from kept) s,
     target t left join baselines b on t.month = b.month""", ctes)


@query("drift_flow_month", _flow_sql())
def q_flow_month(spark, sf_dir):
    """OP-14/19-22/67/82-87, the monthly flow as one: the month is that of the
    newest row of the predictions log; the reference is that month's slice of
    the reference table; the current side is the newest log rows, expanded from
    their JSON features by the reference's types. The two frames have different
    columns: targets and ids go, the common ones are compared, near-constant
    ones are left out; then report, score, alarm and monthly baseline."""
    from skydrift.operators.sampling import latest_n
    from skydrift.operators.scoring import expand_json
    from skydrift.plans.log_queries import LOG_FEATURES, _log
    split = F.lit(SPLIT).cast("date")
    table = fx_stg(spark, sf_dir).filter(F.col("flight_date") < split)
    log = _log(spark, sf_dir).filter(F.col("timestamp") >= split.cast("timestamp"))
    month = D.target_month(log, "timestamp")
    ref = D.drop_present(table.filter(F.col("month") == month.scalar()))
    types = {f.name: f.dataType.simpleString() for f in ref.schema.fields if f.name in LOG_FEATURES}
    newest = latest_n(log, "timestamp", "flight_uid", 5000)
    cur = expand_json(newest, "input_features", [], types)
    num, cat = D.split_types(ref, D.common_columns(ref, cur))
    keep_num, keep_cat = D.near_constant_filter(cur, num, cat)
    score = D.drift_score(D.drift_report(ref, cur, keep_num, keep_cat))
    return D.with_alarm(with_scalars(score, month), "month").select(
        "month", "n_columns", "n_drifted", "drift_score", "alarm", "baseline", "above_baseline")
