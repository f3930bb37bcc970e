"""Secrets by patterns and by tests of randomness, in DataFrame functions only.

Three patterns give the base spans. Besides, each long run of the letters that
encodings use is a candidate. Its encoding is inferred (hexadecimal, base 32,
base 64; plain digits are none), and it is tested as a string of that alphabet:

* chi-squared uniformity of its letters (cube-root normal approximation), which
  rejects strings of too uneven or too even letters as not random;
* runs above and below the middle of the alphabet, and the serial correlation of
  neighbours, which reject counters, alphabets and patterns. Both are normal with
  a correlation of 3/4 between them, so together they give one chi-squared value.

What passes is random as far as order goes; but a short word passes easily. So
the null hypothesis of a discovery is ordinary text, in which two letters are
equal with a certain probability: the chi-squared statistic is then larger the
longer the string is, and how far it stays below that gives the string's p-value
(the normal tail's bound). False discoveries are controlled by Benjamini and
Hochberg's rule over all candidates of the corpus that have the same encoding and
about the same length, so that what is not surprising at its length is left out.
Only counts of p-values in bins leave the rows' own partitions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skydrift.llm.tables import written

# The patterns of the contract, and the least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
#: Kinds of spans in the order in which those that start together are listed.
KINDS = ("assign", "access", "hex", "random")

#: A candidate's least letters, and its most: a longer run is several candidates.
LEAST_RUN, MOST_RUN = 16, 1000
CANDIDATE = f"[A-Za-z0-9+/_-]{{{LEAST_RUN},{MOST_RUN}}}={{0,2}}"
_UPPER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: By the number of an encoding: its letters, and how often two letters of ordinary
#: text that could be taken for it are equal.
ALPHABETS = (_DIGITS + "abcdef", _UPPER + "234567", _UPPER + _UPPER.lower() + _DIGITS + "+/")
ORDINARY = (0.15, 0.08, 0.06)
#: Tests at this level reject a candidate as not random.
LEVEL = 0.01
CHI_LIMIT = 3.29
#: Share of ordinary text among the discoveries that is tolerated.
FALSE_SHARE = 0.01
#: p-values are counted in so many bins for each power of ten, and so many in all.
BINS, TOP_BIN = 20, 400
#: Positions are added up so many matches at a time.
_CHUNK = 256


def _structs(fields: str) -> Column:
    return F.array().cast(f"array<struct<{fields}>>")


def _running(sizes: Column, rest: tuple[str, ...] = ()) -> Column:
    """start and end of each match, from an array of ``gap`` (characters since the
    one before) and ``size``; the fields ``rest`` stay. In chunks: an array that
    grows one by one is copied each time."""
    kinds = "start:int,end:int" + "".join(f",{c}:int" for c in rest)

    def taken(got: Column, x: Column) -> Column:
        start = got["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["size"]).alias("end"), *[x[c].alias(c) for c in rest])
        return F.struct((start + x["size"]).alias("at"), F.concat(got["spans"], F.array(span)).alias("spans"))

    nothing = F.struct(F.lit(0).alias("at"), _structs(kinds).alias("spans"))
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(sizes) / _CHUNK).cast("int") - 1, F.lit(0)))
    local = F.transform(numbers, lambda k: F.aggregate(F.slice(sizes, k * _CHUNK + 1, F.lit(_CHUNK)), nothing, taken))
    ends = F.aggregate(local, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), lambda got, x: F.struct(
        (got["at"] + x["at"]).alias("at"), F.concat(got["all"], F.array(got["at"])).alias("all")))["all"]
    return F.flatten(F.zip_with(local, ends, lambda x, at: F.transform(x["spans"], lambda s: F.struct(
        (s["start"] + at).alias("start"), (s["end"] + at).alias("end"), *[s[c].alias(c) for c in rest]))))


def _matched(docs: DataFrame, name: str, pattern: str, of: str = "__text") -> DataFrame:
    """``<name>_hits`` and ``<name>_gaps``: the matches, and what lies between."""
    text = F.col(of)
    some = text.rlike(pattern)
    return docs.withColumn(f"{name}_hits", F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))) \
        .withColumn(f"{name}_gaps", F.when(F.size(f"{name}_hits") > 0, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>")))


def _value_length(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 2))


def _of_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _based(docs: DataFrame) -> DataFrame:
    """``__text`` and ``base``: (start, kind, end) of the patterns' matches."""
    parts = []
    for number, (pattern, least) in enumerate(((ASSIGN, LEAST_VALUE), (ACCESS, LEAST_ACCESS), (HEX, LEAST_HEX))):
        name = f"__{KINDS[number]}"
        # shorter runs of one class of letters need not be found, only to be dropped
        docs = _matched(docs, name, pattern if number == 0 else f"{pattern[:-1]}{{{least - (4 if number == 1 else 0)},}}")
        worth = _value_length if number == 0 else F.length
        sizes = F.filter(F.zip_with(f"{name}_hits", f"{name}_gaps", lambda h, g: F.struct(
            F.length(g).alias("gap"), F.length(h).alias("size"), worth(h).alias("worth"))), lambda x: x["size"].isNotNull())
        docs = docs.withColumn(f"{name}_sizes", sizes)
        spans = F.filter(_running(F.col(f"{name}_sizes"), ("worth",)), lambda s: s["worth"] >= least)
        docs = docs.withColumn(name, _of_kind(spans, number))
        docs = docs.drop(f"{name}_hits", f"{name}_gaps", f"{name}_sizes")
        parts.append(name)
    return docs.withColumn("base", F.array_sort(F.concat(*parts))).drop(*parts)


def _by_code(code: Column, values) -> Column:
    first, *rest = [F.lit(v) for v in values]
    out = F.when(code == 0, first)
    for number, value in enumerate(rest, 1):
        out = out.when(code == number, value)
    return out


def _tested(docs: DataFrame) -> DataFrame:
    """``candidates``: start, end, group (encoding and power of two of the length)
    and bin (of the p-value; -1 if not random) of each candidate."""
    def step(of: str, to: str, f) -> None:
        nonlocal docs
        docs = docs.withColumn(to, F.transform(of, f)).drop(*([] if of == "__run_hits" else [of]))

    docs = _matched(docs, "__run", CANDIDATE)
    step("__run_hits", "__t1", lambda h: F.struct(F.length(h).alias("size"), F.rtrim(h, F.lit("=")).alias("body")))
    step("__t1", "__t2", lambda x: F.struct(
        x["size"].alias("size"),
        F.when(x["body"].rlike("^[0-9]+$"), F.lit(-1)).when(x["body"].rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 0)
        .when(x["body"].rlike("^[A-Z2-7]+$"), 1).otherwise(2).alias("code"), x["body"].alias("body")))
    step("__t2", "__t3", lambda x: F.struct(
        x["size"].alias("size"), x["code"].alias("code"), F.length(x["body"]).alias("n"),
        _by_code(x["code"], ALPHABETS).alias("letters"), _by_code(x["code"], map(len, ALPHABETS)).alias("k"),
        F.when(x["code"] == 0, F.lower(x["body"])).when(x["code"] == 2, F.translate(x["body"], "-_", "+/")).otherwise(x["body"]).alias("body")))
    step("__t3", "__t4", lambda x: F.struct(
        *[x[c].alias(c) for c in ("size", "code", "n", "k")],
        F.aggregate(F.regexp_extract_all(x["letters"], F.lit("."), F.lit(0)), F.lit(0).cast("long"), lambda total, c: total + F.pow(
            x["n"] - F.length(F.replace(x["body"], c, F.lit(""))), 2).cast("long")).alias("squares"),
        F.transform(F.regexp_extract_all(x["body"], F.lit("."), F.lit(0)), lambda c: F.instr(x["letters"], c) - 1).alias("ranks")))
    # of neighbours: how many are on one side of the alphabet's middle, and the sum
    # of the products of their distances to it (both doubled, so whole numbers)
    step("__t4", "__t5", lambda x: F.struct(
        *[x[c].alias(c) for c in ("size", "code", "n", "k", "squares")],
        F.aggregate(F.zip_with(F.slice(x["ranks"], F.lit(1), x["n"] - 1), F.slice(x["ranks"], F.lit(2), x["n"] - 1), lambda a, b: F.struct(
            ((2 * a >= x["k"]) == (2 * b >= x["k"])).cast("long").alias("same"),
            ((2 * a - x["k"] + 1) * (2 * b - x["k"] + 1)).cast("long").alias("product"))),
            F.struct(F.lit(0).cast("long").alias("same"), F.lit(0).cast("long").alias("product")),
            lambda total, y: F.struct((total["same"] + y["same"]).alias("same"), (total["product"] + y["product"]).alias("product"))).alias("sums")))

    def scored(x: Column) -> Column:
        n, k = x["n"].cast("double"), x["k"].cast("double")
        u = k * x["squares"] / n - n
        spread = 2.0 / (9.0 * (k - 1.0))
        chi = (F.pow(F.greatest(u, F.lit(0.0)) / (k - 1.0), F.lit(1.0 / 3.0)) - (1.0 - spread)) / F.sqrt(spread)
        same = (2.0 * x["sums"]["same"] - (n - 1.0)) / F.sqrt(n - 1.0)
        serial = 3.0 * x["sums"]["product"] / ((k * k - 1.0) * F.sqrt(n - 1.0))
        order = (same * same - 1.5 * same * serial + serial * serial) / (2.0 * (1.0 - 0.5625))  # exp(-order) is its p-value
        excess = (n - 1.0) * (k * _by_code(x["code"], ORDINARY) - 1.0)
        below = F.greatest(k - 1.0 + excess - u, F.lit(0.0)) / F.sqrt(2.0 * (k - 1.0) + 4.0 * excess)
        told = F.floor(BINS * (math.log10(2.0) + math.log10(math.e) / 2.0 * below * below)).cast("int")  # of 0.5 * exp(-below ** 2 / 2)
        random = (x["code"] >= 0) & (F.abs(chi) <= CHI_LIMIT) & (order <= -math.log(LEVEL)) & (below > 0)
        return F.struct(x["size"].alias("size"), (x["code"] * 16 + F.length(F.bin(x["n"])) - 1).alias("group"),
                        F.when(random, F.least(told, F.lit(TOP_BIN))).otherwise(-1).alias("bin"))

    step("__t5", "__t6", scored)
    sizes = F.filter(F.zip_with("__t6", "__run_gaps", lambda x, g: F.struct(
        F.length(g).alias("gap"), x["size"].alias("size"), x["group"].alias("group"), x["bin"].alias("bin"))), lambda x: x["size"].isNotNull())
    docs = docs.withColumn("__sizes", sizes).drop("__run_hits", "__run_gaps", "__t6")
    return docs.withColumn("candidates", _running(F.col("__sizes"), ("group", "bin"))).drop("__sizes")


def _cuts(found: DataFrame, share: float) -> list[tuple[int, int]]:
    """For each group with discoveries, the least bin that is one: the p-value at
    its edge is at most the share of the group's candidates in it and beyond,
    times ``share``."""
    counts = found.select(F.explode("candidates").alias("c")).filter("c.group >= 0").groupBy(F.col("c.group").alias("group"), F.col("c.bin").alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n"))  # some hundred bins for each of some 40 groups
    beyond = F.sum("n").over(Window.partitionBy("group").orderBy(F.desc("bin")))
    whole = F.sum("n").over(Window.partitionBy("group"))
    held = counts.select("group", "bin", beyond.alias("beyond"), whole.alias("whole")) \
        .filter((F.col("bin") >= 0) & (F.pow(F.lit(10.0), -F.col("bin") / float(BINS)) * F.col("whole") <= share * F.col("beyond")))
    return [tuple(r) for r in held.groupBy("group").agg(F.min("bin")).collect()]


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), share: float = FALSE_SHARE) -> DataFrame:
    """``keep`` (any columns but those that follow) and two arrays of (start, kind,
    end), in the order of start and kind, for each row of ``docs`` (text): ``base``,
    the patterns' matches, and ``spans``, those and the random ones. Places are in
    characters, the end exclusive; kind is a number of ``KINDS``.

    A null text is empty; a long one is scanned whole; a run of more than
    ``MOST_RUN`` letters is several candidates, each tested by itself. Nulls, ties
    and repeated rows in ``keep`` pass through; an empty table gives no rows; other
    columns are not read. Nothing but some hundred counts is shuffled; the table of
    spans, without texts, is written once."""
    own = docs.select(*[F.col(f"`{c}`").alias(f"__keep{i}") for i, c in enumerate(keep)], F.coalesce("text", F.lit("")).alias("__text"))
    found = written(_tested(_based(own)).drop("__text"), "spans")
    cuts = _cuts(found, share)

    least = F.create_map(*[F.lit(v) for pair in sorted(cuts) for v in pair]) if cuts else None
    random = _structs("start:int,kind:int,end:int") if least is None else _of_kind(
        F.filter("candidates", lambda c: c["bin"] >= F.coalesce(F.try_element_at(least, c["group"]), F.lit(TOP_BIN + 1))), KINDS.index("random"))
    return found.select(*[F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)], "base", F.array_sort(F.concat("base", random)).alias("spans"))


def counted(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def shown(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
