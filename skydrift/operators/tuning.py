"""Hyper-parameter search (OP-60) and the trial log (OP-61).

Int / float / log-float ranges plus fixed parameters, scored on the
*chronological* validation frame (Spark's TrainValidationSplit splits randomly,
so it is not used). The feature frame is computed once and shared by all
trials. The sampler is a seeded tree-structured Parzen estimator, or plain
seeded random search.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skydrift.operators.models import default_preprocessor, evaluate, feature_table, fit_model
from skydrift.session import temporaries

KINDS = ("int", "float", "logfloat")
#: Random trials before the estimator has enough to go by.
STARTUP = 8
#: Share of the trials that count as good, and candidates drawn for a trial.
GOOD, CANDIDATES = 0.25, 32

Space = dict[str, tuple[str, float, float]]


def _checked(space: Space) -> None:
    for name, (kind, lo, hi) in space.items():
        if kind not in KINDS:
            raise ValueError(f"unknown range kind {kind}")
        if not lo <= hi or kind == "logfloat" and lo <= 0:
            raise ValueError(f"bad range of {name}: {lo} to {hi}")


def _inner(kind: str, lo: float, hi: float) -> tuple[float, float]:
    """The range in which values are drawn evenly."""
    if kind == "logfloat":
        return math.log(lo), math.log(hi)
    return (lo - 0.5, hi + 0.5) if kind == "int" else (lo, hi)


def _value(kind: str, lo: float, hi: float, x: float):
    """The parameter of a drawn number."""
    if kind == "int":
        return int(min(hi, max(lo, math.floor(x + 0.5))))
    return min(hi, max(lo, math.exp(x) if kind == "logfloat" else x))


class _Parzen:
    """A mixture of normals around observed numbers, cut off at the range, and one
    wide normal for the range itself. A normal is as wide as the gap to its
    neighbours, so it narrows where trials gather."""

    def __init__(self, seen: Sequence[float], lo: float, hi: float):
        self.lo, self.hi = lo, hi
        span = hi - lo
        self.parts = [((lo + hi) / 2, span)]
        points = sorted(seen)
        least = span / min(100.0, 1.0 + len(points))
        for k, x in enumerate(points):
            left = x - (points[k - 1] if k else lo)
            right = (points[k + 1] if k + 1 < len(points) else hi) - x
            self.parts.append((x, min(span, max(left, right, least))))

    @staticmethod
    def _below(x: float, mean: float, width: float) -> float:
        return 0.5 * (1.0 + math.erf((x - mean) / (width * math.sqrt(2.0))))

    def draw(self, rng: random.Random) -> float:
        mean, width = rng.choice(self.parts)
        for _ in range(100):
            x = rng.gauss(mean, width)
            if self.lo <= x <= self.hi:
                return x
        return rng.uniform(self.lo, self.hi)

    def log_density(self, x: float) -> float:
        total = 0.0
        for mean, width in self.parts:
            inside = self._below(self.hi, mean, width) - self._below(self.lo, mean, width)
            total += math.exp(-0.5 * ((x - mean) / width) ** 2) / (width * math.sqrt(2.0 * math.pi)) / max(inside, 1e-12)
        return math.log(total / len(self.parts) + 1e-300)


class RandomSampler:
    """The same trials whatever the scores."""

    def __init__(self, space: Space, seed: int = 42):
        _checked(space)
        self.space, self._rng = space, random.Random(seed)

    def ask(self, history: Sequence[tuple[dict, float]]) -> dict:
        return {name: _value(kind, lo, hi, self._rng.uniform(*_inner(kind, lo, hi))) for name, (kind, lo, hi) in self.space.items()}


class TpeSampler:
    """Tree-structured Parzen estimator: among candidates drawn from the density of
    the good trials, the one whose ratio to the density of the others is highest,
    for each parameter by itself. Trial k depends on the seed, k and the trials
    before it only, so a search can be continued. ``history``: (parameters, score
    to be minimised)."""

    def __init__(self, space: Space, seed: int = 42, startup: int = STARTUP, good: float = GOOD, candidates: int = CANDIDATES):
        _checked(space)
        self.space, self.seed, self.startup, self.good, self.candidates = space, seed, startup, good, candidates

    def ask(self, history: Sequence[tuple[dict, float]]) -> dict:
        rng = random.Random(f"{self.seed}:{len(history)}")
        if len(history) < self.startup:
            return {name: _value(kind, lo, hi, rng.uniform(*_inner(kind, lo, hi))) for name, (kind, lo, hi) in self.space.items()}
        # a trial without a score (not a number) is the worst
        ranked = sorted(history, key=lambda t: math.inf if math.isnan(t[1]) else t[1])
        cut = max(2, math.ceil(self.good * len(ranked)))
        out = {}
        for name, (kind, lo, hi) in self.space.items():
            a, b = _inner(kind, lo, hi)
            seen = [math.log(p[name]) if kind == "logfloat" else float(p[name]) for p, _ in ranked]
            good, rest = _Parzen(seen[:cut], a, b), _Parzen(seen[cut:], a, b)
            drawn = [good.draw(rng) for _ in range(self.candidates)]
            out[name] = _value(kind, lo, hi, max(drawn, key=lambda x: good.log_density(x) - rest.log_density(x)))
        return out


SAMPLERS = {"tpe": TpeSampler, "random": RandomSampler}


def optimise(objective: Callable[[dict], float], space: Space, fixed: dict, n_trials: int, direction: str = "minimize",
             seed: int = 42, sampler: str = "tpe") -> list[tuple[dict, float]]:
    """The trials of a search, in order: all parameters and the score."""
    if direction not in ("minimize", "maximize"):
        raise ValueError(f"unknown direction {direction}")
    if sampler not in SAMPLERS:
        raise ValueError(f"unknown sampler {sampler!r}")
    source = SAMPLERS[sampler](space, seed)
    sign = 1.0 if direction == "minimize" else -1.0
    history: list[tuple[dict, float]] = []
    trials = []
    for _ in range(n_trials):
        drawn = source.ask(history)
        score = float(objective({**fixed, **drawn}))
        history.append((drawn, sign * score))
        trials.append(({**fixed, **drawn}, score))
    return trials


def sample_params(space: dict, fixed: dict, n_trials: int, seed: int = 42) -> list[dict]:
    """``space``: name -> ("int", lo, hi) | ("float", lo, hi) | ("logfloat", lo, hi)."""
    source = RandomSampler(space, seed)
    return [{**fixed, **source.ask(())} for _ in range(n_trials)]


def search(spark: SparkSession, train: DataFrame, val: DataFrame, model_type: str, label: str, space: dict, fixed: dict,
           n_trials: int, metric: str, direction: str = "minimize", seed: int = 42, prep=None, sampler: str = "tpe",
           stored: bool = False) -> DataFrame:
    """Run the trials; return the trial log with the best one marked. ``stored``:
    the training frame is a scan of files."""
    key = "flight_uid" if "flight_uid" in train.columns else None
    fitted = (prep or default_preprocessor(label, fold_key=key)).fit(train, stored)
    run_ids: list[str] = []

    def objective(params: dict) -> float:
        model = fit_model(train, model_type, params, label, prepared=fitted, feats=feats, feats_stored=True)
        with temporaries(spark):
            found = evaluate(model, val).first().asDict()
        if metric not in found:
            raise ValueError(f"unknown metric {metric!r}")
        run_ids.append(model.run_id)
        return float(found[metric])

    with temporaries(spark):
        feats = feature_table(fitted, train, label)
        trials = optimise(objective, space, fixed, n_trials, direction, seed, sampler)
    rows = [(i, {k: str(v) for k, v in params.items()}, score, run_ids[i]) for i, (params, score) in enumerate(trials)]
    schema = T.StructType([T.StructField("trial", T.IntegerType()),
                           T.StructField("params", T.MapType(T.StringType(), T.StringType())),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("run_id", T.StringType())])
    log = spark.createDataFrame(rows, schema)  # n_trials rows of metadata
    pick = F.min_by if direction == "minimize" else F.max_by
    best = log.agg(pick("trial", F.struct(F.col("score"), F.col("trial"))).alias("_best"))
    return log.withColumn("is_best", F.col("trial") == best.scalar())


def random_search(spark: SparkSession, train: DataFrame, val: DataFrame, model_type: str,
                  label: str, space: dict, fixed: dict, n_trials: int, metric: str,
                  direction: str = "minimize", seed: int = 42, prep=None, stored: bool = False) -> DataFrame:
    """:func:`search` by seeded random trials."""
    return search(spark, train, val, model_type, label, space, fixed, n_trials, metric, direction, seed, prep, "random", stored)
