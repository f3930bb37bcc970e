"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes give each host a beta posterior of its share of bad
pages, shrunk to that of its registered domain, which is shrunk to that of its
suffix, and that to the whole. The weight of each prior is estimated from the
data: the method of moments of a beta-binomial, over all groups of a level. A
host is blocked when the lower bound of its posterior is above a threshold."""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skydrift.llm.tables import written

# Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz",
                      "co.jp", "or.jp", "ne.jp", "com.br", "com.cn", "com.mx", "co.in", "co.za", "co.kr")
#: A prior weighs as much as so many pages.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1000.0


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the urls of a host and its subdomains whose path starts
    with ``path``; written as host + path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for a null url or one without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), ascii_uppercase, ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(rules: list[Rule], host: Column, path: Column, value) -> Column:
    """``value`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(value(rule))).otherwise(found)
    return found


def suffix_of(host: Column) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(*TWO_LABEL_SUFFIXES), last_two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def _weight(groups: DataFrame) -> float:
    """The weight s of the beta prior from groups (n, bad, prior), by moments:
    E[n (p - m)^2] = m (1 - m) (1 + (n - 1) / (s + 1))."""
    spread = F.col("prior") * (1 - F.col("prior"))
    share = F.col("bad") / F.col("n")
    got = groups.filter("n > 0").agg(
        F.sum(F.col("n") * (share - F.col("prior")) ** 2 - spread).alias("over"),
        F.sum(spread * (F.col("n") - 1)).alias("room")).first()
    if not got.room or got.over is None or got.over <= 0:
        return MOST_WEIGHT
    return min(MOST_WEIGHT, max(LEAST_WEIGHT, got.room / got.over - 1))


def reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """From outcomes (host, bad: 0, 1 or null where unlabelled): host, n, bad,
    mean and lower, the posterior mean less z standard deviations.

    Counts are combined before each shuffle. Only the three prior weights and
    the overall share reach the driver. An empty table gives no rows."""
    hosts = written(outcomes.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))), "hosts")
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    share = (whole.bad + 0.5) / (whole.n + 1.0) if whole.n is not None else 0.5

    def level(keys: list[str], priors: DataFrame | None) -> DataFrame:
        groups = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        groups = groups.withColumn("prior", F.lit(share)) if priors is None else groups.join(priors, keys[1:])
        s = _weight(groups)
        a = F.col("prior") * s + F.col("bad")
        total = F.lit(s) + F.col("n")
        mean = a / total
        return groups.withColumn("mean", mean).withColumn(
            "lower", mean - z * F.sqrt(mean * (1 - mean) / (total + 1)))

    def as_prior(groups: DataFrame, key: list[str]) -> DataFrame:
        return groups.select(*key, F.col("mean").alias("prior"))

    suffixes = level(["suffix"], None)
    domains = level(["domain", "suffix"], as_prior(suffixes, ["suffix"]))
    own = level(["host", "domain", "suffix"], as_prior(domains, ["domain", "suffix"]))
    return own.select("host", "n", "bad", "mean", "lower")


def judge(pages: DataFrame, rules: list[Rule], threshold: float = 0.5, z: float = 1.645) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of pages (page_id, url,
    bad): the longest fitting rule's verdict, else ``block`` where the host's
    lower bound is above the threshold, else ``allow``.

    A null url has an empty host and path and no reputation of its own to lose;
    null outcomes are unlabelled; repeated rows count, and are judged, each."""
    url = F.col("url")
    own = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.col("bad").cast("long").alias("bad"))
    rated = reputation(own.select("host", F.when(F.col("host") != "", F.col("bad")).alias("bad")), z)
    # written, so that the join's shuffle of the pages is one that Spark can split
    # where a host is large
    blocked = written(rated.filter(F.col("lower") > threshold).select("host", F.lit("block").alias("rated")), "blocked")
    host, path = F.col("host"), F.col("path")
    return own.join(blocked, "host", "left").select(
        "page_id", "host", "path", matched(rules, host, path, lambda r: r.text).alias("rule"),
        F.coalesce(matched(rules, host, path, lambda r: r.verdict), "rated", F.lit("allow")).alias("verdict"))
