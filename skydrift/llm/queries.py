"""The registered queries of the operators, with production parameters, and
the SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skydrift.functions.frames import join_null_safe
from skydrift.llm import (
    bloom_lm,
    bpe,
    conversation_repair,
    kk_packing,
    line_templates,
    pivot_search,
    quality_llr,
    secret_scan,
    simhash_dedup,
    style_tree,
    token_alignment,
    toxicity_chain,
    url_reputation,
)
from skydrift.sources.tables import read_table

#: Of the near-duplicate contract.
SHINGLE_WORDS = 3
MAX_BITS = 2


# The rules of the url contract.
URL_RULES = [url_reputation.Rule("com", "/", "allow"), url_reputation.Rule("example.com", "/en/", "block"),
             url_reputation.Rule("www.example.com", "/en/", "allow"), url_reputation.Rule("net", "/es/", "block"),
             url_reputation.Rule("net", "/fr/", "block")]


def op1_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.search(read_table(spark, sf_dir, "embeddings"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url and bad: 1 for a page whose document is labelled toxic or of
    low quality, 0 if labelled and neither, else null. The number in a url's
    path is the id of the page's document."""
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    number = F.expr("try_cast(nullif(regexp_extract(url, '://[^/?#]*/(?:[^?#]*/)?([0-9]{1,18})', 1), '') as bigint)")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", number.alias("doc_id"))
    return pages.join(labels, "doc_id", "left").select("page_id", "url", "bad")


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.judge(page_outcomes(spark, sf_dir), URL_RULES)


def op4_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    found = style_tree.extract(pages, url_reputation.host_of(F.col("url")))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id of the documents labelled as of good quality."""
    return read_table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op5_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_llr.judge(docs, trusted_ids(spark, sf_dir))


def op6_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(read_table(spark, sf_dir, "documents"))


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring(docs)


#: In the order of the chain.
CATEGORIES = ["low_quality", "toxic"]


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the categories."""
    return read_table(spark, sf_dir, "labels").select(
        "doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def op9_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity_chain.score(docs, toxicity_labels(spark, sf_dir), CATEGORIES)
    return scored.select("doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= toxicity_chain.THRESHOLD).alias("toxic"))


def op8_kk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return kk_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = simhash_dedup.near_duplicates(docs, SHINGLE_WORDS, MAX_BITS)
    return found.select("doc_id", simhash_dedup.hex_print(found.fp).alias("fingerprint"), "component_id")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the faults of the conversation contract."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
                                (F.crc32(name) % 20).alias("__fault")).filter("__fault <> 0")
    text = F.when(F.col("__fault") == 1, "").when(F.col("__fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("__fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("__fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("__copy")).drop("__copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    verdicts, _ = conversation_repair.repair(damaged(conversations))
    whole = join_null_safe(conversations.select("conv_id").distinct(), verdicts, ["conv_id"], "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return whole.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
                        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"))
    counts = [secret_scan.counted(found.base, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(secret_scan.shown(found.base), 256).alias("base_sha256"),
                        secret_scan.shown(found.spans).alias("spans"))


def op13_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = token_alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


PIVOT_SEARCH_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
  FROM v AS q JOIN v ON v.vec_id <> q.vec_id AND len(v.x) = len(q.x)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_TWO_LABELS = ", ".join(f"'{x}'" for x in url_reputation.TWO_LABEL_SUFFIXES)


def _rules_sql(value: str) -> str:
    """The rules as cases, the longest first."""
    cases = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
             f"THEN '{getattr(r, value)}'" for r in sorted(URL_RULES, key=lambda r: -len(r.text))]
    return f"CASE {' '.join(cases)} END"


def _level_sql(name: str, keys: str, prior: str, join: str) -> str:
    """Groups of a level with their prior, its weight, and the posterior."""
    return f"""
{name}_groups AS (SELECT {keys}, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
{name}_prior AS (SELECT g.*, {prior} AS prior FROM {name}_groups g {join}),
{name}_moments AS (
  SELECT sum(n * (bad / n - prior) ^ 2 - prior * (1 - prior)) AS over, sum(prior * (1 - prior) * (n - 1)) AS room
  FROM {name}_prior WHERE n > 0),
{name}_weight AS (
  SELECT CASE WHEN room IS NULL OR room = 0 OR over <= 0 THEN {url_reputation.MOST_WEIGHT}
         ELSE least({url_reputation.MOST_WEIGHT}, greatest({url_reputation.LEAST_WEIGHT}, room / over - 1)) END AS s
  FROM {name}_moments),
{name}_level AS (
  SELECT *, (prior * s + bad) / (s + n) AS mean, s + n AS total FROM {name}_prior, {name}_weight)"""


URL_REPUTATION_SQL = f"""
WITH split AS (
  SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest,
         TRY_CAST(regexp_extract(url, '://[^/?#]*/(?:[^?#]*/)?([0-9]{{1,18}})', 1) AS BIGINT) AS doc_id
  FROM pages),
outcomes AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, bad
  FROM split LEFT JOIN outcomes USING (doc_id)),
counted AS (
  SELECT host, count(bad) FILTER (host <> '') AS n, coalesce(sum(bad) FILTER (host <> ''), 0) AS bad FROM urls GROUP BY host),
labelled AS (
  SELECT *, string_split(host, '.') AS parts, array_to_string(string_split(host, '.')[-2:], '.') AS two FROM counted),
hosts AS (
  SELECT host, n::DOUBLE AS n, bad::DOUBLE AS bad,
         CASE WHEN two IN ({_TWO_LABELS}) THEN array_to_string(parts[-3:], '.') ELSE two END AS domain,
         CASE WHEN two IN ({_TWO_LABELS}) THEN two ELSE parts[-1] END AS suffix
  FROM labelled),
{_level_sql("suffix", "suffix", "(SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1) FROM hosts)", "")},
{_level_sql("domain", "domain, suffix", "p.mean", "JOIN suffix_level p USING (suffix)")},
{_level_sql("host", "host, domain, suffix", "p.mean", "JOIN domain_level p USING (domain, suffix)")},
blocked AS (SELECT host FROM host_level WHERE mean - 1.645::DOUBLE * sqrt(mean * (1 - mean) / (total + 1)) > 0.5)
SELECT page_id, host, path, {_rules_sql("text")} AS rule,
       coalesce({_rules_sql("verdict")}, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM urls
"""

#: No cheapest repair inserts a row (see the operator), so the letters of all ways
#: to a row are equally many, and the least prefix for each last role is enough.
CONVERSATION_REPAIR_SQL = """
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations),
coded AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda c: ord(c)::BIGINT)),
                lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))),
                4294967295) % 20 AS fault
  FROM named),
damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded WHERE fault <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, left(role, 1) AS initial
  FROM damaged),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM numbered),
ways(state, next, letter, price) AS (
  SELECT state, state, 'D', 2 FROM (VALUES ('n'), ('s'), ('u'), ('a')) t(state)
  UNION ALL
  SELECT state, next, letter, price
  FROM (VALUES ('n', 's'), ('n', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')) t(state, next), (VALUES ('K', 0), ('R', 1)) l(letter, price)
  WHERE letter = 'K' OR next <> 's'),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, 'n' AS state, {'cost': 0::BIGINT, 'audit': ''} AS best FROM judged GROUP BY conv_id
  UNION ALL
  SELECT s.conv_id, s.i + 1, w.next,
         min({'cost': s.best.cost + w.price + CASE WHEN j.fault = 'truncated' AND w.letter <> 'D' THEN 5 ELSE 0 END,
              'audit': s.best.audit || w.letter})
  FROM steps s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.i = s.i + 1
  JOIN ways w ON w.state = s.state AND (w.letter <> 'K' OR w.next = j.initial)
       AND (w.letter = 'D' OR j.fault NOT IN ('blank', 'duplicate'))
  GROUP BY s.conv_id, s.i, w.next),
found AS (
  SELECT s.conv_id, min(s.best) AS best
  FROM steps s JOIN (SELECT conv_id, max(i) AS n FROM judged GROUP BY conv_id) t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.n = s.i
  WHERE s.state IN ('n', 'a') GROUP BY s.conv_id),
kept AS (
  SELECT j.conv_id, j.i, j.role, j.text, j.initial, substr(f.best.audit, j.i::INTEGER, 1) AS letter,
         row_number() OVER w AS place, first_value(j.initial = 's' AND substr(f.best.audit, j.i::INTEGER, 1) = 'K') OVER w AS system
  FROM judged j JOIN found f ON f.conv_id IS NOT DISTINCT FROM j.conv_id
  WHERE substr(f.best.audit, j.i::INTEGER, 1) <> 'D'
  WINDOW w AS (PARTITION BY j.conv_id ORDER BY j.i)),
lines AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - system::INTEGER) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || text, chr(10) ORDER BY i) AS said
  FROM kept GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(f.best.cost, 0) AS cost,
       coalesce(f.best.audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM o.conv_id
"""

def _found_sql(kind: int, pattern: str, of: str = "texts") -> str:
    """Each match of a pattern in a row, with its place."""
    return f"""
  SELECT row, {kind} AS kind, hits[i] AS hit,
         list_sum(list_transform(gaps[1:i], lambda g: len(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: len(h))), 0) AS start
  FROM (SELECT row, regexp_extract_all(text, '{pattern}', 0) AS hits, string_split_regex(text, '{pattern}') AS gaps FROM {of}),
       unnest(range(1, len(hits) + 1)) AS r(i)"""


_EITHER_CASE = {w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")}
_VALUE_SQL = r"([A-Za-z0-9+/_.=-]+)"
_ASSIGN_SQL = f"(?:{'|'.join(_EITHER_CASE.values())})" + r"""["'']?\x20*[:=]\x20*["'']?""" + _VALUE_SQL
_CODES = ", ".join(f"({n}, '{letters}', {len(letters)}, {equal}::DOUBLE)" for n, (letters, equal) in enumerate(zip(secret_scan.ALPHABETS, secret_scan.ORDINARY)))
SECRET_SCAN_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
base AS (
  SELECT row, kind, start, start + len(hit) AS stop FROM ({_found_sql(0, _ASSIGN_SQL)})
  WHERE len(regexp_extract(hit, '{_ASSIGN_SQL}', 1)) >= {secret_scan.LEAST_VALUE}
  UNION ALL SELECT row, kind, start, start + len(hit) FROM ({_found_sql(1, secret_scan.ACCESS)}) WHERE len(hit) >= {secret_scan.LEAST_ACCESS}
  UNION ALL SELECT row, kind, start, start + len(hit) FROM ({_found_sql(2, secret_scan.HEX)}) WHERE len(hit) >= {secret_scan.LEAST_HEX}),
runs AS (
  SELECT row, start, start + len(hit) AS stop, rtrim(hit, '=') AS body,
         CASE WHEN regexp_matches(body, '^[0-9]+$') THEN -1 WHEN regexp_matches(body, '^(?:[0-9a-f]+|[0-9A-F]+)$') THEN 0
              WHEN regexp_matches(body, '^[A-Z2-7]+$') THEN 1 ELSE 2 END AS code
  FROM ({_found_sql(3, secret_scan.CANDIDATE)})),
coded AS (
  SELECT row, start, stop, code, len(body) AS n, letters, k, equal,
         CASE code WHEN 0 THEN lower(body) WHEN 2 THEN translate(body, '-_', '+/') ELSE body END AS body
  FROM runs JOIN (VALUES {_CODES}) c(code, letters, k, equal) USING (code)),
ranked AS (
  SELECT *, list_sum(list_transform(string_split(letters, ''), lambda c: (n - len(replace(body, c, ''))) ** 2))::BIGINT AS squares,
         list_transform(string_split(body, ''), lambda c: instr(letters, c) - 1) AS ranks
  FROM coded),
summed AS (
  SELECT *, list_sum(list_transform(range(1, n), lambda i: ((2 * ranks[i] >= k) = (2 * ranks[i + 1] >= k))::INTEGER))::BIGINT AS sames,
         list_sum(list_transform(range(1, n), lambda i: (2 * ranks[i] - k + 1) * (2 * ranks[i + 1] - k + 1)))::BIGINT AS products
  FROM ranked),
measured AS (
  SELECT *, k::DOUBLE * squares / n - n AS u, 2::DOUBLE / (9 * (k - 1)) AS spread, (2 * sames - (n - 1)) / sqrt(n - 1) AS same,
         3::DOUBLE * products / ((k * k - 1) * sqrt(n - 1)) AS serial, (n - 1) * (k * equal - 1) AS excess
  FROM summed),
scored AS (
  SELECT row, start, stop, code * 16 + len(bin(n)) - 1 AS grp,
         (greatest(u, 0) / (k - 1)) ** (1::DOUBLE / 3) AS root, spread, (same * same - 1.5::DOUBLE * same * serial + serial * serial) / 0.875::DOUBLE AS ordered,
         greatest(k - 1 + excess - u, 0) / sqrt(2 * (k - 1) + 4 * excess) AS below
  FROM measured),
binned AS (
  SELECT row, start, stop, grp,
         CASE WHEN abs((root - (1 - spread)) / sqrt(spread)) <= {secret_scan.CHI_LIMIT} AND ordered <= -ln({secret_scan.LEVEL}::DOUBLE) AND below > 0
              THEN least({secret_scan.TOP_BIN}, floor({secret_scan.BINS} * (log10(2::DOUBLE) + log10(exp(1::DOUBLE)) / 2 * below * below)))::INTEGER ELSE -1 END AS bin
  FROM scored),
counts AS (SELECT grp, bin, count(*) AS n FROM binned GROUP BY grp, bin),
beyond AS (
  SELECT grp, bin, sum(n) OVER (PARTITION BY grp ORDER BY bin DESC) AS held, sum(n) OVER (PARTITION BY grp) AS whole FROM counts),
cuts AS (
  SELECT grp, min(bin) AS cut FROM beyond
  WHERE bin >= 0 AND 10::DOUBLE ** (-bin / {secret_scan.BINS}::DOUBLE) * whole <= {secret_scan.FALSE_SHARE} * held GROUP BY grp),
spans AS (
  SELECT * FROM base UNION ALL SELECT row, 3, start, stop FROM binned JOIN cuts USING (grp) WHERE bin >= cut),
named AS (SELECT row, kind, start, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start || ':' || stop AS said FROM spans),
listed AS (
  SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(said, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(said, ',' ORDER BY start, kind) AS spans
  FROM named GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (row)
"""

QUERIES = {f.__name__: f for f in (
    op1_pivot_search, op2_byte_bpe, op3_url_reputation, op4_style_tree, op5_quality_llr, op6_bloom_lm,
    op7_line_templates, op8_kk_packing, op9_toxicity_chain, op10_simhash_dedup,
    op11_conversation_repair, op12_secret_scan, op13_lockstep_alignment)}
ORACLES = {"op1_pivot_search": PIVOT_SEARCH_SQL, "op3_url_reputation": URL_REPUTATION_SQL,
           "op11_conversation_repair": CONVERSATION_REPAIR_SQL,
           "op12_secret_scan": SECRET_SCAN_SQL}
