"""Feature preprocessing queries (OP-30, 45-54, 56): fit on the reference
period of the staging view, apply to every row."""

from __future__ import annotations

from pyspark.sql import functions as F

from skydrift.operators.features import (
    CategoryTable, Preprocessor, category_modes, class_weights, impute_statistics)
from skydrift.plans.oracle import with_fx
from skydrift.plans.registry import query
from skydrift.schemas import HIGH_CARD_FEATURES, LOW_CARD_FEATURES
from skydrift.session import written
from skydrift.sources.fixtures import fx_stg
from skydrift.sources.tables import read_table

TRAIN_END = "1999-01-01"
TRAIN_SQL = f"train AS (select * from fx_stg where flight_date < date '{TRAIN_END}')"
FOLD_SQL = "cast(('0x' || substr(md5(flight_uid), 1, 8)) as bigint) % 5"


def _train(stg):
    return stg.filter(F.col("flight_date") < F.lit(TRAIN_END).cast("date"))


@query("impute_stats", with_fx(["fx_stg"], """
select a.feature, a.median, a.mean, m.most_frequent from
  (select feature, median(v) as median, avg(v) as mean from long group by feature) a
  join (select feature, v as most_frequent from
         (select feature, v, row_number() over (partition by feature order by c desc, v) as rn
          from (select feature, v, count(*) as c from long group by feature, v) x) y
        where rn = 1) m on a.feature = m.feature""", """long AS (
  select * from (
    select 'crs_elapsed_time' as feature, cast(crs_elapsed_time as double) as v from fx_stg
    union all select 'distance', cast(distance as double) from fx_stg
    union all select 'crs_dep_time', cast(crs_dep_time as double) from fx_stg) u
  where v is not null)"""))
def q_impute_stats(spark, sf_dir):
    """OP-45: median (exact), mean and most frequent value per numeric column."""
    return impute_statistics(fx_stg(spark, sf_dir),
                             ["crs_elapsed_time", "distance", "crs_dep_time"])


@query("impute_cat_mode", with_fx(["fx_stg"], """
select feature, v as mode, c as count from (
  select feature, v, c, row_number() over (partition by feature order by c desc, nv, v) as rn
  from (select feature, v, nv, count(*) as c from long group by feature, v, nv) x) y
where rn = 1""", """long AS (
  select * from (
    select 'marketing_airline_network' as feature, marketing_airline_network as v,
           cast(null as double) as nv from fx_stg
    union all select 'dep_time_blk', dep_time_blk, cast(null as double) from fx_stg
    union all select 'tail_number', tail_number, cast(null as double) from fx_stg
    union all select 'dest_airport_id', cast(dest_airport_id as varchar),
                     cast(dest_airport_id as double) from fx_stg) u
  where v is not null)"""))
def q_impute_cat_mode(spark, sf_dir):
    """OP-46: most frequent category per column (smallest value on ties)."""
    m = category_modes(fx_stg(spark, sf_dir), ["marketing_airline_network", "dep_time_blk",
                                              "tail_number", "dest_airport_id"])
    return m.select(F.col("column").alias("feature"), "mode", "count")


_OH_LEVELS = {"marketing_airline_network": ["A", "N", "R"], "dep_time_blk": ["F", "O"],
              "month": list(range(1, 13))}


def _oh_sql():
    cols = []
    for c, levels in _OH_LEVELS.items():
        for v in levels:
            lit = f"'{v}'" if isinstance(v, str) else str(v)
            cols.append(f"case when {c} = {lit} then 1.0::double else 0.0::double end as {c}__{v}")
    return "select flight_uid, " + ", ".join(cols) + " from fx_stg"


@query("onehot_wide", with_fx(["fx_stg"], _oh_sql()))
def q_onehot(spark, sf_dir):
    """OP-47: one-hot, every level kept, unknown -> all zeros."""
    stg = fx_stg(spark, sf_dir)
    pre = Preprocessor(low_card_cols=list(_OH_LEVELS), low_card_strategy="onehot")
    fit = pre.fit(_train(stg))
    out = fit.transform(stg, assemble=False)
    return out.select("flight_uid", *fit.feature_names)


@query("ordinal_encode", with_fx(["fx_stg"], """
select f.flight_uid,
       coalesce(a.idx, -1.0) as origin_airport_id__ordinal,
       coalesce(b.idx, -1.0) as tail_number__ordinal
from fx_stg f
left join (select origin_airport_id, cast(row_number() over (order by origin_airport_id) - 1 as double) as idx
           from (select distinct origin_airport_id from train where origin_airport_id is not null) d) a
  on f.origin_airport_id = a.origin_airport_id
left join (select tail_number, cast(row_number() over (order by tail_number) - 1 as double) as idx
           from (select distinct tail_number from train where tail_number is not null) d) b
  on f.tail_number = b.tail_number""", TRAIN_SQL))
def q_ordinal(spark, sf_dir):
    """OP-48: sorted categories -> 0..k-1, unseen -> -1."""
    stg = fx_stg(spark, sf_dir)
    pre = Preprocessor(high_card_cols=["origin_airport_id", "tail_number"],
                       high_card_strategy="ordinal")
    fit = pre.fit(_train(stg))
    return fit.transform(stg, assemble=False).select("flight_uid", *fit.feature_names)


@query("ordinal_low_card", with_fx(["fx_stg"], """
select flight_uid,
       cast(case dep_time_blk when 'F' then 0 when 'O' then 1 else -1 end as double)
         as dep_time_blk__ord,
       cast(day_of_week - 1 as double) as day_of_week__ord
from fx_stg"""))
def q_ordinal_low(spark, sf_dir):
    """OP-48 for low-cardinality columns (inline CASE, no join)."""
    stg = fx_stg(spark, sf_dir)
    pre = Preprocessor(low_card_cols=["dep_time_blk", "day_of_week"],
                       low_card_strategy="ordinal")
    fit = pre.fit(_train(stg))
    return fit.transform(stg, assemble=False).select("flight_uid", *fit.feature_names)


@query("frequency_encode", with_fx(["fx_stg"], """
select f.flight_uid,
       coalesce(a.share, 0.0) as dest_airport_id__frequency,
       coalesce(b.share, 0.0) as tail_number__frequency
from fx_stg f
left join (select dest_airport_id, count(*) / (select count(*) from train) as share
           from train group by 1) a on f.dest_airport_id = a.dest_airport_id
left join (select tail_number, count(*) / (select count(*) from train) as share
           from train group by 1) b on f.tail_number = b.tail_number""", TRAIN_SQL))
def q_frequency(spark, sf_dir):
    """OP-50 + OP-30: value -> training share, unseen -> 0."""
    stg = fx_stg(spark, sf_dir)
    pre = Preprocessor(high_card_cols=["dest_airport_id", "tail_number"],
                       high_card_strategy="frequency")
    fit = pre.fit(_train(stg))
    return fit.transform(stg, assemble=False).select("flight_uid", *fit.feature_names)


_TE_ENC = """g AS (select avg(arr_delay_minutes) as gm, var_pop(arr_delay_minutes) as gv from train),
s AS (select cast(origin_airport_id as varchar) as k, count(*) as n,
             sum(arr_delay_minutes) as sy, sum(arr_delay_minutes * arr_delay_minutes) as syy
      from train group by 1),
e AS (select k, gm, gv * n as a, syy / n - (sy / n) * (sy / n) as vc, sy / n as mu from s, g),
enc AS (select k, case when a + vc = 0 then gm else (a / (a + vc)) * mu + (1 - a / (a + vc)) * gm end as value
        from e)"""


@query("target_encode_full", with_fx(["fx_stg"], """
select f.flight_uid, coalesce(enc.value, (select gm from g)) as origin_airport_id__target
from fx_stg f left join enc on cast(f.origin_airport_id as varchar) = enc.k""",
                                     TRAIN_SQL + ",\n" + _TE_ENC))
def q_target_full(spark, sf_dir):
    """OP-49: shrunk target mean per category; unseen -> global mean."""
    stg = fx_stg(spark, sf_dir)
    pre = Preprocessor(high_card_cols=["origin_airport_id"], high_card_strategy="target",
                       target="arr_delay_minutes")
    fit = pre.fit(_train(stg))
    return fit.transform(stg, assemble=False).select("flight_uid", *fit.feature_names)


_CF = f"""tf AS (select *, {FOLD_SQL} as fold, arr_delay_minutes as y from train),
per AS (select fold, cast(origin_airport_id as varchar) as k, count(*) as n, sum(y) as sy,
               sum(y * y) as syy from tf group by 1, 2),
tot AS (select k, sum(n) as tn, sum(sy) as tsy, sum(syy) as tsyy from per group by k),
fs AS (select fold, count(*) as fn, sum(y) as fsy, sum(y * y) as fsyy from tf group by fold),
al AS (select sum(fn) as an, sum(fsy) as asy, sum(fsyy) as asyy from fs),
gf AS (select fold, (asy - fsy) / (an - fn) as gm,
              (asyy - fsyy) / (an - fn) - ((asy - fsy) / (an - fn)) * ((asy - fsy) / (an - fn)) as gv
       from fs, al),
e AS (select p.fold, p.k, tn - n as o, tsy - sy as osy, tsyy - syy as osyy, gm, gv
      from per p join tot using (k) join gf using (fold)),
e2 AS (select fold, k, gm, case when o > 0 then gv * o else null end as a,
              case when o > 0 then osyy / o - (osy / o) * (osy / o) else null end as vc,
              case when o > 0 then osy / o else null end as mu from e),
enc AS (select fold, k, case when o_ok and a + vc <> 0
                            then (a / (a + vc)) * mu + (1 - a / (a + vc)) * gm else gm end as value
        from (select *, a is not null as o_ok from e2) z)"""


@query("target_encode_crossfit", with_fx(["fx_stg"], """
select t.flight_uid, enc.value as origin_airport_id__target
from tf t join enc on t.fold = enc.fold and cast(t.origin_airport_id as varchar) = enc.k""",
                                         TRAIN_SQL + ",\n" + _CF))
def q_target_crossfit(spark, sf_dir):
    """OP-49 on the training rows themselves: 5 md5 folds, each row encoded
    from the other four (category and global statistics out-of-fold)."""
    stg = fx_stg(spark, sf_dir)
    train = _train(stg)
    pre = Preprocessor(high_card_cols=["origin_airport_id"], high_card_strategy="target",
                       target="arr_delay_minutes", fold_key="flight_uid")
    fit = pre.fit(train)
    return fit.transform(train, training=True, assemble=False) \
        .select("flight_uid", *fit.feature_names)


_MIN = "(floor(crs_dep_time / 100) * 60 + (crs_dep_time - floor(crs_dep_time / 100) * 100))"


@query("cyclic_encode", with_fx(["fx_stg"], f"""
select flight_uid, sin(2 * pi() * {_MIN} / 1440.0) as crs_dep_time__sin,
       cos(2 * pi() * {_MIN} / 1440.0) as crs_dep_time__cos from fx_stg"""))
def q_cyclic(spark, sf_dir):
    """OP-51: HHMM -> minutes -> sin/cos on the 24 h circle."""
    stg = fx_stg(spark, sf_dir)
    fit = Preprocessor(cyclic_cols=["crs_dep_time"]).fit(_train(stg))
    return fit.transform(stg, assemble=False).select("flight_uid", *fit.feature_names)


@query("standard_scale", with_fx(["fx_stg"], """
select flight_uid,
       (coalesce(crs_elapsed_time, m) - mu) / (case when sd = 0 then 1 else sd end)
         as crs_elapsed_time__scaled
from fx_stg, med, st""", TRAIN_SQL + """,
med AS (select median(crs_elapsed_time) as m from train),
st AS (select avg(coalesce(crs_elapsed_time, m)) as mu,
              stddev_pop(coalesce(crs_elapsed_time, m)) as sd from train, med)"""))
def q_standard_scale(spark, sf_dir):
    """OP-45 + OP-52: median imputation, population-std scaling."""
    stg = fx_stg(spark, sf_dir)
    fit = Preprocessor(numeric_cols=["crs_elapsed_time"]).fit(_train(stg))
    return fit.transform(stg, assemble=False).select("flight_uid", *fit.feature_names)


@query("log_scale", with_fx(["fx_stg"], """
select flight_uid, (ln(1 + distance) - mu) / (case when sd = 0 then 1 else sd end)
         as distance__scaled
from fx_stg, st""", TRAIN_SQL + """,
st AS (select avg(ln(1 + distance)) as mu, stddev_pop(ln(1 + distance)) as sd from train)"""))
def q_log_scale(spark, sf_dir):
    """OP-53: log1p then population-std scaling."""
    stg = fx_stg(spark, sf_dir)
    fit = Preprocessor(skewed_numeric_cols=["distance"]).fit(_train(stg))
    return fit.transform(stg, assemble=False).select("flight_uid", *fit.feature_names)


@query("class_weights", with_fx(["fx_stg"], """
select arr_del15, count(*) as n_class,
       (select count(*) from fx_stg) / (2.0 * count(*)) as weight
from fx_stg group by arr_del15"""))
def q_class_weights(spark, sf_dir):
    """OP-56: balanced class weights N / (K * N_class)."""
    return class_weights(fx_stg(spark, sf_dir), "arr_del15")


@query("lookup_with_default", with_fx(["fx_stg"], """
select f.flight_uid, coalesce(s.s_nationkey, -1) as origin_nation
from fx_stg f left join supplier s on f.origin_airport_id = s.s_suppkey"""))
def q_lookup(spark, sf_dir):
    """OP-30: dictionary lookup with a default. The dictionary side is
    counted first and broadcast only under the bound."""
    sup = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("_k"),
        F.col("s_nationkey").cast("double").alias("value"))
    table = CategoryTable("origin_airport_id", sup, sup.count(), -1.0)
    out = table.lookup(fx_stg(spark, sf_dir), "origin_nation")
    return out.select("flight_uid", F.col("origin_nation").cast("int").alias("origin_nation"))


_LOW_SQL = " + ".join(f"count(distinct {c})" for c in LOW_CARD_FEATURES)
_KNOWN_SQL = " + ".join(f"case when {c} in (select {c} from train) then 1.0::double else 0 end" for c in LOW_CARD_FEATURES)


@query("feature_assembly", with_fx(["fx_stg"], f"""
select flight_uid, cast((select {_LOW_SQL} from train) + 5 + 4 + 1 + 1 as integer) as n_features,
       {_KNOWN_SQL} as known_levels,
       sin(2 * pi() * (crs_dep_time // 100 * 60 + crs_dep_time % 100) / 1440.0) as dep_sin,
       cos(2 * pi() * (crs_arr_time // 100 * 60 + crs_arr_time % 100) / 1440.0) as arr_cos,
       (ln(1 + distance) - (select avg(ln(1 + distance)) from train))
         / (select stddev_pop(ln(1 + distance)) from train) as scaled_distance,
       (coalesce(crs_elapsed_time, (select median(crs_elapsed_time) from train))
         - (select avg(coalesce(crs_elapsed_time, m)) from train, (select median(crs_elapsed_time) as m from train)))
         / (select stddev_pop(coalesce(crs_elapsed_time, m))
            from train, (select median(crs_elapsed_time) as m from train)) as scaled_elapsed
from fx_stg""", TRAIN_SQL))
def q_feature_assembly(spark, sf_dir):
    """OP-54: the 16 default features assembled into one vector, read back from
    its slots: the one-hot slots that are set (the levels known from training),
    then past the high-cardinality encodings the sines and cosines, and the two
    scaled numerics."""
    from pyspark.ml.functions import vector_to_array

    from skydrift.operators.models import default_preprocessor
    stg = written(fx_stg(spark, sf_dir), "staging")
    fit = default_preprocessor("arr_delay_minutes").fit(_train(stg), stored=True)
    v = F.col("v")
    levels = sum(len(fit.onehot_levels[c]) for c in LOW_CARD_FEATURES)
    out = fit.transform(stg, columns=False).select("flight_uid", vector_to_array("features").alias("v"))
    cyclic = levels + len(HIGH_CARD_FEATURES)
    return out.select(
        "flight_uid", F.size(v).alias("n_features"),
        F.aggregate(F.slice(v, 1, levels), F.lit(0.0), lambda a, x: a + x).alias("known_levels"),
        v[cyclic].alias("dep_sin"), v[cyclic + 3].alias("arr_cos"),
        v[cyclic + 5].alias("scaled_distance"), v[cyclic + 4].alias("scaled_elapsed"))
