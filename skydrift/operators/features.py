"""Feature preprocessing fitted on a training frame and applied anywhere
(OP-30, 45-54).

Five groups, assembled in this order: low-cardinality categoricals (one-hot
or ordinal), high-cardinality categoricals (target, ordinal or frequency
encoding), cyclic HHMM times (sin/cos), numeric (impute + population-std
scaling) and skewed numeric (impute + log1p + scaling).

Fitting takes few passes: one aggregate for all numeric statistics, one
grouped pass over the stacked ``(column, value)`` pairs for all category
counts and target sums. Only scalars reach the driver and, for the strategies
``onehot`` and ``ordinal``, the level lists; the strategy ``sparse`` is for columns of
any number of levels. Per-category tables stay DataFrames; how they are joined
is left to their size and the session's threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skydrift.functions.exprs import cyclic_cos, cyclic_sin, md5_bucket
from skydrift.functions.frames import with_scalars
from skydrift.operators.positions import (
    _median_expr, global_row_number, median_from_counts, running_totals)
from skydrift.session import materialize

LOW_CARD_STRATEGIES = ("onehot", "ordinal", "sparse")
HIGH_CARD_STRATEGIES = ("target", "ordinal", "frequency")
NUM_IMPUTE = ("median", "mean", "most_frequent")
NULL_KEY = "\u0000null"  # sentinel for a NULL category in keyed lookups


def _is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                           T.FloatType, T.DoubleType, T.DecimalType))


def stack_long(df: DataFrame, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Wide -> long ``(column, sval, nval, *extra)``: string and numeric view
    of every value, one row per (row, column). One narrow projection."""
    types = {f.name: f.dataType for f in df.schema.fields}
    pairs = []
    for c in cols:
        nval = F.col(c).cast("double") if _is_numeric(types[c]) else F.lit(None).cast("double")
        pairs.append(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("sval"),
                              nval.alias("nval")))
    return df.select(*extra, F.explode(F.array(*pairs)).alias("_kv")) \
        .select("_kv.column", "_kv.sval", "_kv.nval", *extra)


def category_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent non-NULL value per column (ties: smallest value, numeric
    order for numeric columns). One grouped pass over the stacked columns."""
    return _modes_from_counts(value_counts_long(df, cols))


def value_counts_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, sval, nval, cnt)`` for every non-NULL value of every listed
    column: one grouped pass, combined map-side."""
    return stack_long(df, cols).filter(F.col("sval").isNotNull()) \
        .groupBy("column", "sval", "nval").agg(F.count(F.lit(1)).cast("double").alias("cnt"))


def impute_statistics(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per numeric column: exact median, mean and most frequent value, all
    in one aggregate over the running totals of the per-value counts (one
    grouped pass, one range pass)."""
    counts = value_counts_long(df, cols).filter(F.col("nval").isNotNull())
    run = running_totals(counts.select("column", "nval", "sval", "cnt"), ["column"], ["nval"],
                         ["cnt"], prefix="_cum_", with_totals=True)
    return run.groupBy("column").agg(
        _median_expr("nval", "cnt").alias("median"),
        (F.sum(F.col("nval") * F.col("cnt")) / F.sum("cnt")).alias("mean"),
        F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("nval"))).alias("_m")) \
        .select(F.col("column").alias("feature"), "median", "mean",
                F.col("_m.nval").alias("most_frequent"))


def _modes_from_counts(counts: DataFrame) -> DataFrame:
    best = counts.groupBy("column").agg(F.min(F.struct(
        (-F.col("cnt")).alias("neg"), F.col("nval"), F.col("sval"))).alias("_b"))
    return best.select("column", F.col("_b.sval").alias("mode"),
                       F.col("_b.nval").alias("mode_num"),
                       (-F.col("_b.neg")).cast("bigint").alias("count"))


def numeric_impute_values(df: DataFrame, cols: Sequence[str], strategy: str) -> dict:
    """Fill value per numeric column from the training frame (scalars)."""
    if not cols:
        return {}
    if strategy not in NUM_IMPUTE:
        raise ValueError(f"unknown numeric imputation {strategy!r}")
    if strategy == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    if strategy == "most_frequent":
        return {r["column"]: r["mode_num"] for r in category_modes(df, cols).collect()}
    counts = value_counts_long(df, cols).select("column", "nval", "cnt")
    med = median_from_counts(counts, "nval", "cnt", ["column"], "median")
    return {r["column"]: r["median"] for r in med.collect()}


def _impute_exprs(df: DataFrame, values: dict, as_double: Sequence[str] = ()) -> dict:
    """``coalesce(col, fill)``; numeric feature columns become double (a
    median may be fractional), categoricals keep their type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c, v in values.items():
        if c in as_double:
            out[c] = F.col(c).cast("double") if v is None else \
                F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
        elif v is not None:
            out[c] = F.coalesce(F.col(c), F.lit(v).cast(types[c]))
    return out


def _key(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY))


@dataclass
class CategoryTable:
    """Per-category values of one high-cardinality column."""
    column: str
    frame: DataFrame          # (key string, value double) [+ fold]
    rows: int                 # number of categories
    default: float | Column

    def lookup(self, df: DataFrame, out: str, on_fold: str | None = None) -> DataFrame:
        # no hint: the join goes by the table's size in bytes and the session's
        # threshold; larger ones are shuffled, with a hot category split by AQE
        t = self.frame.withColumnRenamed("value", out)
        keys = ["_k"] + ([on_fold] if on_fold else [])
        j = df.withColumn("_k", _key(self.column)).join(t, keys, "left").drop("_k")
        d = self.default if isinstance(self.default, Column) else F.lit(float(self.default))
        return j.withColumn(out, F.coalesce(F.col(out), d))


def lookup_together(df: DataFrame, first: "FittedPreprocessor", second: "FittedPreprocessor") -> tuple[DataFrame, dict, dict]:
    """Rows as ``first`` imputes them, with the values of both for the
    high-cardinality columns of both: one join a column, with a table of both values,
    so that large rows are shuffled once for two models. Also returns which column
    holds which value. A column that only ``second`` would impute is left out: its
    key differs."""
    out, held = first.imputed(df), ({}, {})
    for c in first.spec.high_card_cols:
        if c not in second.spec.high_card_cols or (c in second.cat_fill and c not in first.cat_fill):
            continue
        tables = (first.tables[c], second.tables[c])
        a, b = names = [f"_looked_{c}_{i}" for i in range(2)]
        none = F.lit(None).cast("double")
        both = tables[0].frame.select("_k", F.col("value").alias(a), none.alias(b)) \
            .unionByName(tables[1].frame.select("_k", none.alias(a), F.col("value").alias(b)))
        table = both.groupBy("_k").agg(*[F.max(n).alias(n) for n in names])
        out = out.withColumn("_k", _key(c)).join(table, "_k", "left").drop("_k")
        out = out.withColumns({n: F.coalesce(F.col(n), F.lit(float(t.default))) for n, t in zip(names, tables)})
        held[0][c], held[1][c] = a, b
    return out, *held


def frequency_table(train: DataFrame, col: str, rows: int | None = None) -> CategoryTable:
    """value -> share of training rows; unseen -> 0.0 (NULL has its own key)."""
    total = train.agg(F.count(F.lit(1))).scalar()
    freq = train.groupBy(_key(col).alias("_k")).agg(F.count(F.lit(1)).alias("_c")) \
        .select("_k", (F.col("_c") / total).alias("value"))
    return CategoryTable(col, freq, rows if rows is not None else freq.count(), 0.0)


def ordinal_table(train: DataFrame, col: str, rows: int | None = None) -> CategoryTable:
    """Sorted distinct categories -> 0..k-1 (numeric order for numeric
    columns); unseen -> -1. Positions from range partitioning, not a
    one-partition window over the distinct set."""
    distinct = train.filter(F.col(col).isNotNull()).select(col).distinct()
    pos = global_row_number(distinct, [col], "_idx")
    t = pos.select(_key(col).alias("_k"), F.col("_idx").cast("double").alias("value"))
    return CategoryTable(col, t, rows if rows is not None else distinct.count(), -1.0)


def _shrunk(n, sy, syy, gm, gv) -> Column:
    """Empirical-Bayes shrinkage to the global mean ``gm`` with global
    population variance ``gv``: lambda = gv*n / (gv*n + var_cat)."""
    mean = F.try_divide(sy, n)
    var_cat = F.try_divide(syy, n) - mean * mean
    lam = F.try_divide(gv * n, gv * n + var_cat)
    return F.when((n > 0) & lam.isNotNull(), lam * mean + (F.lit(1.0) - lam) * gm) \
        .otherwise(gm)


def target_sums(train: DataFrame, cols: Sequence[str], y: str,
                fold: str | None = None) -> DataFrame:
    """``(column, [fold,] _k, n, sy, syy)`` for every listed column: one
    grouped pass over the stacked columns (combined map-side). Every
    target-encoding table -- full or cross-fitted, for every column -- and
    the per-fold global statistics derive from this small frame."""
    extra = [fold] if fold else []
    yv = F.col(y).cast("double")
    long = stack_long(train.withColumn("_y", yv), cols, extra=[*extra, "_y"])
    return long.groupBy("column", *extra, F.coalesce(F.col("sval"), F.lit(NULL_KEY))
                        .alias("_k")).agg(
        F.count("_y").alias("n"), F.coalesce(F.sum("_y"), F.lit(0.0)).alias("sy"),
        F.coalesce(F.sum(F.col("_y") * F.col("_y")), F.lit(0.0)).alias("syy"))


def _global(stats: DataFrame) -> DataFrame:
    """Mean and population variance from (n, sy, syy) rows."""
    g = stats.agg(F.sum("n").alias("_gn"), F.sum("sy").alias("_gsy"), F.sum("syy").alias("_gsyy"))
    mean = F.col("_gsy") / F.col("_gn")
    return g.select(mean.alias("gm"), (F.col("_gsyy") / F.col("_gn") - mean * mean).alias("gv"))


def target_table(sums: DataFrame, col: str, rows: int, global_mean: float,
                 fold: str | None = None) -> CategoryTable:
    """Full-fit target encoding (used for data not seen in training)."""
    s = sums.filter(F.col("column") == col)
    per_k = s.groupBy("_k").agg(F.sum("n").alias("n"), F.sum("sy").alias("sy"),
                                F.sum("syy").alias("syy")) if fold else \
        s.select("_k", "n", "sy", "syy")
    t = with_scalars(per_k, _global(per_k)).select(
        "_k", _shrunk(F.col("n"), F.col("sy"), F.col("syy"), F.col("gm"), F.col("gv"))
        .alias("value"))
    return CategoryTable(col, t, rows, global_mean)


def _fold_totals(sums: DataFrame, col: str, fold: str) -> DataFrame:
    """Per-fold (n, sy, syy): each row appears once per column, so one
    column's sums give the fold totals."""
    return sums.filter(F.col("column") == col).groupBy(fold).agg(
        F.sum("n").alias("fn"), F.sum("sy").alias("fsy"), F.sum("syy").alias("fsyy"))


def target_table_crossfit(sums: DataFrame, col: str, fold: str, rows: int) -> CategoryTable:
    """Out-of-fold encodings: per (fold, category) sums subtracted from the
    category totals; the global mean/variance are out-of-fold too."""
    per = sums.filter(F.col("column") == col).select(fold, "_k", "n", "sy", "syy")
    tot = per.groupBy("_k").agg(F.sum("n").alias("tn"), F.sum("sy").alias("tsy"),
                                F.sum("syy").alias("tsyy"))
    folds = _fold_totals(sums, col, fold)
    allg = folds.agg(F.sum("fn").alias("an"), F.sum("fsy").alias("asy"),
                     F.sum("fsyy").alias("asyy"))
    gfold = with_scalars(folds, allg).select(
        fold, (F.col("an") - F.col("fn")).alias("on"), (F.col("asy") - F.col("fsy")).alias("osy"),
        (F.col("asyy") - F.col("fsyy")).alias("osyy"))
    gfold = gfold.select(fold, (F.col("osy") / F.col("on")).alias("gm"),
                         (F.col("osyy") / F.col("on")
                          - (F.col("osy") / F.col("on")) ** 2).alias("gv"))
    # every (fold, category) pair seen in training: category totals minus this fold
    j = per.join(tot, "_k").join(F.broadcast(gfold), fold)
    n = F.col("tn") - F.col("n")
    t = j.select(fold, "_k", _shrunk(n, F.col("tsy") - F.col("sy"), F.col("tsyy") - F.col("syy"),
                                      F.col("gm"), F.col("gv")).alias("value"))
    return CategoryTable(col, t, rows, F.col("_fold_gm"))


@dataclass
class FittedPreprocessor:
    spec: "Preprocessor"
    num_fill: dict
    cat_fill: dict
    onehot_levels: dict = field(default_factory=dict)
    level_tables: dict = field(default_factory=dict)  # sparse one-hot: level -> index
    tables: dict = field(default_factory=dict)
    crossfit_tables: dict = field(default_factory=dict)
    fold_means: DataFrame | None = None
    scale: dict = field(default_factory=dict)
    feature_names: list = field(default_factory=list)

    def imputed(self, df: DataFrame) -> DataFrame:
        s = self.spec
        num_cols = list(s.cyclic_cols) + list(s.numeric_cols) + list(s.skewed_numeric_cols)
        return df.withColumns(_impute_exprs(df, {**self.num_fill, **self.cat_fill}, num_cols))

    def transform(self, df: DataFrame, training: bool = False,
                  assemble: bool = True, columns: bool = True, looked: dict | None = None) -> DataFrame:
        """Apply all learned statistics. ``training=True`` uses cross-fitted
        target encodings for the training rows themselves. Without ``columns``
        the assembled vector is the same, but a level has no column of its own.
        ``looked``: high-cardinality column -> the column that holds its value,
        where it is joined already (:func:`lookup_together`)."""
        s = self.spec
        out = self.imputed(df)
        names: list[str] = []
        held = {} if columns else _held_levels(out, s, self.onehot_levels)
        # the joins with category tables come first, while the rows are narrow
        fold = s.fold_col if s.high_card_strategy == "target" and s.high_card_cols and training and s.fold_key else None
        if fold:
            out = out.withColumn(fold, md5_bucket(s.fold_key, s.folds)).join(F.broadcast(self.fold_means), fold, "left")
        for c in s.high_card_cols:
            name = f"{c}__{s.high_card_strategy}"
            if c in (looked or {}):
                out = out.withColumn(name, F.col(looked[c]))
            else:
                out = self.crossfit_tables[c].lookup(out, name, on_fold=fold) if fold else self.tables[c].lookup(out, name)
        if fold:
            out = out.drop("_fold_gm", fold)
        # 1. low-cardinality
        if s.low_card_strategy == "sparse" and s.low_card_cols:
            for c in s.low_card_cols:
                out = self.level_tables[c].lookup(out, f"_level_{c}")
            out = _sparse_onehot(out, {f"_level_{c}": (f"{c}__onehot", max(1, self.level_tables[c].rows)) for c in s.low_card_cols})
            names += [f"{c}__onehot" for c in s.low_card_cols]
        if held:
            # one index a column, as an expression of one column a level is too
            # long for the JVM to compile once there are some dozen of them
            out = out.withColumns({f"_level_{c}": F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(c)), F.lit(0)) - 1,
                                                             F.lit(len(levels))).cast("double") for c, levels in held.items()})
            out = _sparse_onehot(out, {f"_level_{c}": (f"{c}__onehot", len(levels)) for c, levels in held.items()})
        for c in s.low_card_cols if s.low_card_strategy != "sparse" else ():
            levels = self.onehot_levels[c]
            if c in held:
                names += _level_names(c, levels)
                continue
            if s.low_card_strategy == "onehot":
                cols = {k: F.coalesce((F.col(c) == F.lit(v)).cast("double"), F.lit(0.0))
                        for k, v in zip(_level_names(c, levels), levels)}
            else:
                # one look-up in a literal map, whatever the number of levels
                cols = {f"{c}__ord": F.coalesce(F.element_at(F.create_map(
                    *[F.lit(x) for i, v in enumerate(levels) for x in (v, float(i))]), F.col(c)),
                    F.lit(-1.0)) if levels else F.lit(-1.0)}
            out = out.withColumns(cols)
            names += list(cols)
        # 2. high-cardinality
        names += [f"{c}__{s.high_card_strategy}" for c in s.high_card_cols]
        # 3. cyclic: all sines, then all cosines
        sines = {f"{c}__sin": cyclic_sin(c) for c in s.cyclic_cols}
        cosines = {f"{c}__cos": cyclic_cos(c) for c in s.cyclic_cols}
        out = out.withColumns({**sines, **cosines})
        names += list(sines) + list(cosines)
        # 4./5. numeric and skewed numeric
        scaled = {}
        for c in list(s.numeric_cols) + list(s.skewed_numeric_cols):
            mean, std = self.scale[c]
            x = F.log1p(F.col(c)) if c in s.skewed_numeric_cols else F.col(c).cast("double")
            scaled[f"{c}__scaled"] = (x - F.lit(mean)) / F.lit(std)
        out = out.withColumns(scaled)
        names += list(scaled)
        self.feature_names = names
        if assemble:
            first = {_level_names(c, levels)[0]: f"{c}__onehot" for c, levels in held.items()}
            rest = {n for c, levels in held.items() for n in _level_names(c, levels)[1:]}
            inputs = [first.get(n, n) for n in names if n not in rest]
            out = VectorAssembler(inputCols=inputs, outputCol=s.output_col,
                                  handleInvalid="keep").transform(out)
            if s.low_card_strategy == "sparse":
                out = out.withMetadata(s.output_col, {})
        return out


def _held_levels(df: DataFrame, spec: "Preprocessor", levels: dict) -> dict:
    """The levels of the one-hot columns of ``df`` that hold whole numbers or text as
    their levels do, where equal is the same in a list as in a comparison."""
    types = {f.name: f.dataType for f in df.schema.fields}
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

    def alike(c: str) -> bool:
        kinds = {type(v) for v in levels[c]}
        return kinds == {str} and isinstance(types[c], T.StringType) or kinds == {int} and isinstance(types[c], whole)

    return {c: levels[c] for c in spec.low_card_cols if alike(c)} if spec.low_card_strategy == "onehot" else {}


def _sparse_onehot(df: DataFrame, indices: dict[str, tuple[str, int]]) -> DataFrame:
    """Index columns -> (name, size): sparse 0/1 vectors of that size, all zeros for
    an index that is the size. One column each, and no name for each level in the
    plan, whatever their number."""
    spark = df.sparkSession
    # the encoder learns the sizes from a row of the largest indices
    largest = spark.createDataFrame([tuple(float(size - 1) for _, size in indices.values())], list(indices))
    encoder = OneHotEncoder(inputCols=list(indices), outputCols=[name for name, _ in indices.values()],
                            handleInvalid="keep", dropLast=True).fit(largest)
    out = encoder.transform(df).drop(*indices)
    for name, size in indices.values():
        out = out.withMetadata(name, {"ml_attr": {"num_attrs": size}})
    return out


def _safe(v) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in str(v))


def _level_names(col: str, levels: Sequence) -> list[str]:
    """One name per level; levels whose names would be the same (also but for
    the letters' case) get the level's number appended."""
    plain = [f"{col}__{_safe(v)}" for v in levels]
    times: dict[str, int] = {}
    for n in plain:
        times[n.lower()] = times.get(n.lower(), 0) + 1
    return [n if times[n.lower()] == 1 else f"{n}__{i}" for i, n in enumerate(plain)]


@dataclass
class Preprocessor:
    low_card_cols: Sequence[str] = ()
    high_card_cols: Sequence[str] = ()
    cyclic_cols: Sequence[str] = ()
    numeric_cols: Sequence[str] = ()
    skewed_numeric_cols: Sequence[str] = ()
    low_card_strategy: str = "onehot"
    high_card_strategy: str = "target"
    impute_num: str = "median"
    impute_cat: str = "most_frequent"
    target_type: str = "continuous"
    target: str | None = None
    fold_key: str | None = None       # row key hashed into cross-fit folds
    folds: int = 5
    fold_col: str = "_fold"
    output_col: str = "features"

    def __post_init__(self):
        if self.low_card_strategy not in LOW_CARD_STRATEGIES:
            raise ValueError(f"unknown low_card_strategy: {self.low_card_strategy}")
        if self.high_card_strategy not in HIGH_CARD_STRATEGIES:
            raise ValueError(f"unknown high_card_strategy: {self.high_card_strategy}")
        if self.impute_cat != "most_frequent":
            raise ValueError(f"unknown impute_cat: {self.impute_cat}")
        if self.impute_num not in NUM_IMPUTE:
            raise ValueError(f"unknown impute_num: {self.impute_num}")
        if self.target_type not in ("continuous", "binary"):
            raise ValueError(f"unknown target_type: {self.target_type}")

    def fit(self, train: DataFrame, stored: bool = False) -> FittedPreprocessor:
        """Few passes: modes (one grouped job), numeric fills (one), levels
        and category counts (one), all scalar statistics (one aggregate).
        ``stored``: the rows are a scan of files, and need not be computed once."""
        cat_cols = list(self.low_card_cols) + list(self.high_card_cols)
        num_cols = list(self.cyclic_cols) + list(self.numeric_cols) + \
            list(self.skewed_numeric_cols)
        types = {f.name: f.dataType for f in train.schema.fields}
        # every fitting job reads the training rows: compute them once
        needed = list(dict.fromkeys(cat_cols + num_cols + (
            [self.target] if self.target else []) + ([self.fold_key] if self.fold_key else [])))
        train = train.select(*needed) if stored else materialize(train.select(*needed))
        cat_fill = {}
        rows: dict = {}
        vc = None
        if cat_cols:
            # one grouped pass: per-value counts of every categorical column
            # (materialised; it is small) -> modes, category counts, levels
            vc = materialize(value_counts_long(train, cat_cols))
            best = vc.groupBy("column").agg(
                F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("nval"), F.col("sval")))
                .alias("_b"), F.count(F.lit(1)).alias("k"))
            for r in best.collect():  # one row per column
                c = r["column"]
                cat_fill[c] = r["_b"]["nval"] if _is_numeric(types[c]) else r["_b"]["sval"]
                rows[c] = r["k"]
        num_fill = numeric_impute_values(train, num_cols, self.impute_num)
        imputed = train.withColumns(_impute_exprs(train, {**num_fill, **cat_fill}, num_cols))
        fitted = FittedPreprocessor(self, num_fill, cat_fill)
        # imputation maps NULL to an existing value, so the distinct levels
        # of the raw counts are the levels after imputation
        if self.low_card_strategy == "sparse":
            for c in self.low_card_cols:
                n = rows.get(c, 0)
                table = materialize(ordinal_table(train, c, n).frame)
                fitted.level_tables[c] = CategoryTable(c, table, n, float(max(1, n)))
        elif self.low_card_cols and vc is not None:
            levels: dict = {c: [] for c in self.low_card_cols}
            low = vc.filter(F.col("column").isin(list(self.low_card_cols)))
            for r in low.orderBy("column", "nval", "sval").collect():  # all levels: for few
                c = r["column"]
                levels[c].append(r["nval"] if _is_numeric(types[c]) else r["sval"])
            for c in self.low_card_cols:
                lv = levels[c]
                if _is_numeric(types[c]) and not isinstance(types[c], (T.FloatType,
                                                                       T.DoubleType)):
                    lv = [int(v) for v in lv]
                fitted.onehot_levels[c] = lv
        # one aggregate: global target mean and every scaler statistic
        exprs = []
        if self.target and self.high_card_strategy == "target" and self.high_card_cols:
            exprs.append(F.avg(F.col(self.target).cast("double")).alias("__gm"))
        for c in list(self.numeric_cols) + list(self.skewed_numeric_cols):
            x = F.log1p(F.col(c)) if c in self.skewed_numeric_cols else F.col(c).cast("double")
            exprs += [F.avg(x).alias(f"{c}__m"), F.stddev_pop(x).alias(f"{c}__s")]
        row = imputed.agg(*exprs).first() if exprs else None
        for c in list(self.numeric_cols) + list(self.skewed_numeric_cols):
            std = row[f"{c}__s"]
            fitted.scale[c] = (row[f"{c}__m"], std if std else 1.0)
        sums = None
        if self.high_card_strategy == "target" and self.high_card_cols:
            if not self.target:
                raise ValueError("target encoding needs a target column")
            fold = self.fold_col if self.fold_key else None
            fr = imputed.withColumn(self.fold_col, md5_bucket(self.fold_key, self.folds)) \
                if fold else imputed
            # all columns, all folds: one grouped pass, materialised (small)
            sums = materialize(target_sums(fr, self.high_card_cols, self.target, fold))
        for c in self.high_card_cols:
            n = rows.get(c, 0) + 1  # + a possible NULL key
            if self.high_card_strategy == "frequency":
                fitted.tables[c] = frequency_table(imputed, c, n)
            elif self.high_card_strategy == "ordinal":
                fitted.tables[c] = ordinal_table(imputed, c, n)
            else:
                fitted.tables[c] = target_table(sums, c, n, row["__gm"],
                                                self.fold_col if self.fold_key else None)
                if self.fold_key:
                    fitted.crossfit_tables[c] = target_table_crossfit(
                        sums, c, self.fold_col, n * self.folds)
                    fitted.fold_means = _fold_means(sums, self.high_card_cols[0],
                                                    self.fold_col)
        return fitted


def _fold_means(sums: DataFrame, col: str, fold: str) -> DataFrame:
    """Out-of-fold global mean per fold (the default for a category unseen
    outside the row's own fold)."""
    f = _fold_totals(sums, col, fold)
    a = f.agg(F.sum("fn").alias("an"), F.sum("fsy").alias("asy"))
    return with_scalars(f, a).select(
        fold, ((F.col("asy") - F.col("fsy")) / (F.col("an") - F.col("fn"))).alias("_fold_gm"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights ``N / (K * N_class)`` from one grouped count."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    tot = per.agg(F.sum("n_class").alias("_n"), F.count(F.lit(1)).alias("_k"))
    return with_scalars(per, tot).select(
        label, "n_class", (F.col("_n") / (F.col("_k") * F.col("n_class"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    w = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(F.broadcast(w), label, "left")  # one row per class
