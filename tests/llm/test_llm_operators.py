"""Every operator and stage on small odd tables: nulls in any column, empty and
long texts, ties, repeated rows, no rows, extra columns of clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from skydrift.llm import (
    bloom_lm,
    bpe,
    components,
    kk_packing,
    line_templates,
    lookup,
    pivot_search,
    quality_llr,
    simhash_dedup,
    style_tree,
    toxicity_chain,
    url_reputation,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "the quick brown fox jumps over a lazy dog while seven wizards quietly brew potions near the river bank"
LONG = " ".join(f"word{k % 997} and{k % 89}" for k in range(60_000))
ROWS = [
    (1, PROSE), (1, PROSE), (2, None), (3, ""), (4, " \n\t"), (None, PROSE + " again"), (None, None), (5, LONG),
    (6, PROSE.replace("quick", "slow")), (7, "You utter idiot\n" + PROSE), (8, "A\n" + PROSE + "\nb c"),
    (9, PROSE.upper() + "!!"), (10, "ünï cödé ☃ 中文 \x85 x"), (11, "word"), (12, PROSE),
]
CLASHING = ("fp", "row", "key", "line", "__text", "__key", "__lines", "rest", "kept", "score", "n_words", "p_toxic", "n_dropped",
            "h", "c", "component_id", "lang", "a.b")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)]).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("1 = 0")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (7, 1, 1), (9, 0, None), (None, 0, 1), (99, 1, 1)], "doc_id long, good int, toxic int")


def same(got, want):
    key = repr
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_bpe(spark, docs, none):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    codec = bpe.codec(bpe.read_ranks(path), public_tokenizers.PATTERN)
    got = bpe.encode(docs, path, public_tokenizers.PATTERN, decoded=True)
    assert got.columns == ["doc_id", "ids", "decoded"]
    want = [(i, np.array(codec._encoding.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in ROWS]
    same([(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got.collect()], want)
    assert bpe.encode(none, path, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("cut", [True, False])
def test_packing(docs, none, cut):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = kk_packing.Tokenizer.from_file(path)
    got = kk_packing.pack(docs, path, with_ids=True, cut=cut).collect()
    want = Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in ROWS)
    by_sequence = {}
    for r in got:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096 and (not cut or at & (at - 1) == 0)
    pieces = Counter()
    for (i, ids), n in want.items():
        own = sorted({(r.start, bytes(r.ids)) for r in got if r.doc_id == i and r.doc_tokens == len(ids)})
        pieces[i] += n
        if n == 1 and Counter(x[0] for x in want)[i] == 1:
            assert b"".join(b for _, b in own) == np.array(ids, "<u4").tobytes()
    assert sum(r.length for r in got) == sum(len(ids) * n for (_, ids), n in want.items())
    assert kk_packing.pack(none, path).count() == 0


def fingerprint(t):
    w = words(t)
    shingles = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, none):
    prints = [fingerprint(t) for _, t in ROWS]
    root = list(range(len(ROWS)))
    for _ in ROWS:
        for a in range(len(ROWS)):
            for b in range(len(ROWS)):
                if (prints[a] ^ prints[b]).bit_count() <= 2:
                    root[a] = root[b] = min(root[a], root[b])
    least = {r: min((ROWS[k][0] is None, ROWS[k][0] or 0) for k in range(len(ROWS)) if root[k] == r) for r in root}
    want = [(i, f"{p:016x}", None if least[r][0] else least[r][1]) for (i, _), p, r in zip(ROWS, prints, root)]
    found = simhash_dedup.near_duplicates(docs)
    same(found.select("doc_id", simhash_dedup.hex_print(found.fp), "component_id").collect(), want)
    firsts = simhash_dedup.first_of_each(docs.select("doc_id", "text", F.struct("lang").alias("rest")))
    assert firsts.columns == ["doc_id", "text", "rest"] and firsts.count() == len(set(root))
    assert simhash_dedup.near_duplicates(none).count() == 0 and simhash_dedup.first_of_each(none.select("doc_id", "text")).count() == 0


@pytest.mark.parametrize("bits, segments", [(0, 4), (1, 4), (2, 4), (2, 3), (3, 5), (3, 8)])
def test_links_by_brute_force(spark, bits, segments):
    rng = np.random.default_rng(bits * 10 + segments)
    centres = rng.integers(0, 1 << 63, 6)
    prints = {int(c) for c in centres} | {0, (1 << 64) - 1 - 7, 7}
    for c in centres:
        for _ in range(30):
            prints.add(int(c) ^ sum(1 << int(b) for b in set(rng.integers(0, 64, 3))))
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    mask = (1 << 64) - 1
    want = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if ((a ^ b) & mask).bit_count() <= bits]
    same(simhash_dedup.links(df, bits, segments).collect(), want)


def test_components(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 200), (200, 100), (5, 5), (None, 7), (300, 100)]
    got = dict(map(tuple, components.components(spark.createDataFrame(chain, "u long, v long")).collect()))
    assert got == {k: 0 for k in range(61)} | {100: 100, 200: 100, 300: 100}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_pivot_search(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 6)]) for i in range(130)]
    rows += [(130, rows[3][1]), (131, rows[3][1]), (131, rows[3][1]), (200, [1e9] * 6), (None, rows[4][1]), (140, None), (141, [0.1, None] * 3),
             (142, [float("nan")] * 6), (143, [float("inf")] * 6), (150, [0.5, -0.25]), (151, [1.0, 1.0]), (152, []), (250, [])]
    rows += [(300, [-1e-20, 3e30, 1e200]), (301, [1e-20, 2.0 ** 60, -1e200]), (302, [-5e-324, -1.0, 3.0]), (303, [1e308, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("x", F.lit(2))
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(256 * x) for x in v)]
    want = []
    for q, x in ok:
        if q % 50 == 0:
            scores = sorted((-max(-1 << 63, min(sum(a * b for a, b in zip(x, y)), (1 << 63) - 1)), i) for i, y in ok if i != q and len(y) == len(x))
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])]
    same(pivot_search.search(df, pivots=8).collect(), want)
    assert pivot_search.search(df.filter("1 = 0")).count() == 0


def test_pivot_search_broadcasts_no_copies_of_queries(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(v) for v in rng.normal(size=4)]) for i in range(300)]
    found = pivot_search.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert found.count() == 5 * 6
    plan = found._jdf.queryExecution().executedPlan()
    found.collect()  # the final plan, by the sizes met
    assert "SortMergeJoin" in plan.toString() and "BroadcastExchange" not in plan.toString()


def test_url_rules_and_reputation(spark):
    rules = [url_reputation.Rule("com", "/", "allow"), url_reputation.Rule("bad.com", "/x/", "block")]
    spam = [(k, f"http://Spam.Farm.org/{k}", 1) for k in range(40)]
    fine = [(100 + k, f"https://ok{k % 5}.good.net/a?b#c", 0) for k in range(200)]
    odd = [(900, None, None), (901, "no scheme", 1), (902, "x://BAD.com/x/y?z", None), (903, "x://sub.bad.com/y", 1), (904, "a://?q", 0),
           (905, "://h#f://z/", None), (None, "http://spam.farm.org", None), (907, "http://new.farm.org/", None), (907, "http://new.farm.org/", None)]
    df = spark.createDataFrame(spam + fine + odd, "page_id long, url string, bad int").withColumn("host", F.lit("clash"))
    got = url_reputation.judge(df, rules).collect()
    out = {r.page_id: tuple(r)[1:] for r in got}
    assert len(got) == len(spam + fine + odd)
    assert out[0] == ("spam.farm.org", "/0", None, "block") and out[100] == ("ok0.good.net", "/a", None, "allow")
    assert out[900] == out[901] == ("", "", None, "allow")
    assert out[902] == ("BAD.com".lower(), "/x/y", "bad.com/x/", "block") and out[903] == ("sub.bad.com", "/y", "com/", "allow")
    assert out[904] == ("", "", None, "allow") and out[905] == ("h", "", None, "allow")
    assert out[None][3] == "block"
    # a host without labels is shrunk to its domain
    rated = {r.host: r for r in url_reputation.reputation(spark.createDataFrame(
        [("a.bad.org", 1)] * 30 + [("new.bad.org", None), ("b.ok.net", 0), ("new.ok.net", None)], "host string, bad int")).collect()}
    assert rated["new.bad.org"].mean > rated["new.ok.net"].mean and rated["a.bad.org"].mean > rated["new.bad.org"].lower
    assert url_reputation.judge(df.filter("1 = 0"), rules).count() == 0


def test_style_tree(spark):
    def page(k):
        return (f'<html><body><div class="top">Welcome to our site, visitor</div><div class="body">Story {k} of <i>many</i> &amp; more'
                f'<p>Told {k * 7}</div><div class="top">Welcome</div></body></html>')

    rows = [(k, "http://a.org/x", page(k)) for k in range(12)] + [(12, "http://a.org/x", page(3))]
    rows += [(20, "http://b.org", page(1)), (21, None, None), (None, "http://b.org", ""), (23, "http://c.org", "<article><p>same</article>")]
    rows += [(30 + k, "http://c.org", "<article><p>same</article>") for k in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("__low", F.lit(1)).withColumn("path", F.lit(1))
    got = {r.page_id: r.text for r in style_tree.extract(df, url_reputation.host_of(F.col("url"))).collect()}
    assert len(got) == len(rows)
    for k in range(12):  # the same on all pages of the host: template
        assert got[k] == f"Story {k} of many & more\n\nTold {k * 7}"
    assert got[12] == got[3]
    assert got[20].startswith("Welcome to our site")  # one page shows no template
    assert got[21] == got[None] == "" and got[23] == got[30] == "same"
    tree = style_tree.style_tree(df.select(url_reputation.host_of(F.col("url")).alias("host"), "html"))
    a = [r for r in tree.filter("host = 'a.org' and not sure").collect()]
    assert {r.pages for r in a} == {12} and min(r.importance for r in a) < 0.2 < max(r.importance for r in a)
    assert style_tree.extract(df.filter("1 = 0"), F.lit("h")).count() == 0


def test_names_are_a_prior(spark):
    def page(k):
        return (f'<html><body class="single sidebar"><div class="content-with-sidebar"><p>Told {k}</div><div id="search-committee"><p>Chair {k}</div>'
                f'<div class="related">Finding {k * 7}</div><div class="ad">Buy now</div></body></html>')

    df = spark.createDataFrame([(k, "http://a.org" if k < 9 else "http://b.org", page(k)) for k in range(10)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in style_tree.extract(df, url_reputation.host_of(F.col("url"))).collect()}
    for k in range(9):  # what differs on each page of the host overrules its name
        assert got[k] == f"Told {k}\n\nChair {k}\n\nFinding {k * 7}"
    assert got[9] == "Told 9\n\nChair 9"  # one page does not


def test_quality(spark, docs, none, labels):
    trusted = labels.filter("good = 1").select("doc_id")
    got = quality_llr.judge(docs, trusted).collect()
    for r in got:
        texts = [t for i, t in ROWS if i == r.doc_id]
        assert r.n_words in {len(WORD.findall(t or "")) for t in texts}
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.kept and r.base_failed)
    assert len(got) == len(ROWS)
    assert quality_llr.judge(none, trusted).count() == 0
    unlabelled = quality_llr.judge(docs, trusted.filter("1 = 0")).collect()
    assert all(r.score == 0 and r.kept != r.base_failed for r in unlabelled)


def test_quality_score_by_brute_force(spark):
    rows = [(k, " ".join(f"{'good' if k % 2 else 'BAD!!'}{(k * j) % 7} w{j % 5}" for j in range(30))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in quality_llr.judge(df, df.filter("doc_id % 2 = 1 and doc_id < 40").select("doc_id")).collect()}
    grams = {i: [*t.split(), *zip(t.split(), t.split()[1:])] for i, t in rows}
    raw, target = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i % 2 and i < 40:
            target.update(g)
    share, k = sum(target.values()) / sum(raw.values()), quality_llr.SMOOTHING
    for i, g in grams.items():
        want = sum(math.log((target[x] + k * share) / ((raw[x] + k) * share)) for x in g) / len(g)
        assert got[i].score == pytest.approx(want, abs=2e-3)  # a few buckets hold two n-grams
        assert got[i].kept == (i % 2 == 1) or got[i].base_failed


def test_quality_counts_all_trusted(spark):
    df = spark.range(50_400).select(F.col("id").alias("doc_id"), F.concat(F.lit("g"), F.col("id") % 20_000).alias("text"))
    table = quality_llr.fit(df, df.select("doc_id"), quality_llr.BUCKETS).toArrow()  # more than the former sample
    ratios = np.concatenate([np.frombuffer(x, "<f4") for x in table.column("ratios").to_pylist()])
    assert len(ratios) and abs(ratios).max() < 1e-6  # all are trusted: the two multinomials are one


def test_quality_trusted_texts_by_either_join(docs, labels):
    ids = labels.filter("doc_id is not null").select("doc_id").distinct()
    want = [(t,) for i, t in ROWS if i in (1, 7, 9)]
    for most in (0, 10):
        same(quality_llr._named(docs, ids, most).collect(), want)


def test_quality_counts_survive_packing():
    rng = np.random.default_rng(3)
    some = np.unique(rng.integers(0, 3 * quality_llr.SEGMENT, 5000))
    counts = np.where(rng.random(len(some)) < 0.1, 255 + rng.integers(0, 1 << 40, len(some)), rng.integers(1, 255, len(some)))
    table = pa.Table.from_batches([quality_llr._packed(1, 7, some, counts)])
    total = np.zeros(3 * quality_llr.SEGMENT, np.int64)
    total[some] = counts
    for k in range(3):
        one = table.slice(k, 1)
        assert (quality_llr._unpacked(one)[1] == total[k * quality_llr.SEGMENT: (k + 1) * quality_llr.SEGMENT]).all()
        merged = quality_llr._merged(pa.concat_tables([one, one]))
        assert merged.column("total")[0].as_py() == 2 * one.column("total")[0].as_py()


def test_quality_buckets_follow_the_corpus(spark, monkeypatch):
    rows = [(k, " ".join(f"{'good' if k % 2 else 'BAD!!'}{j % 300} own{k}x{j}" for j in range(600))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    distinct = 300 * 2 + 60 * 600 * 3
    monkeypatch.setattr(quality_llr.buckets_for, "__defaults__", (1 << 8,))
    n = quality_llr.buckets_for(df)
    assert distinct / n <= quality_llr.LOAD * 1.2 and n & (n - 1) == 0
    trusted = df.filter("doc_id % 2 = 1").select("doc_id")
    monkeypatch.setattr(lookup, "CHUNK_KEYS", 5000)
    shared, joined = ([tuple(r) for r in quality_llr.judge(df, trusted, most_shared=m).collect()] for m in (1 << 24, 1))
    same([(*r[:-2], round(r[-2], 6), r[-1]) for r in joined], [(*r[:-2], round(r[-2], 6), r[-1]) for r in shared])
    assert {r[0] for r in shared if r[-1] or r[-3]} >= {k for k, _ in rows if k % 2}


@pytest.mark.parametrize("frequent", [3, 1000])
def test_language_model(docs, none, frequent):
    got = bloom_lm.score(docs, frequent=frequent).collect()
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in ROWS}
    tokens = [(i, [*words(t), None]) for i, t in ROWS]
    c = Counter(x for i, t in tokens if not held[i] for x in t)
    n, v = sum(c.values()), len(c)
    want = []
    for i, t in tokens:
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
        want.append((i, held[i], len(t), sum(c[x] > 0 for x in t), n, round(base, 4)))
    same([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got], want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert sum(r.score for r in got if r.n_known == r.n_tokens) > sum(r.base_score for r in got if r.n_known == r.n_tokens)
    assert bloom_lm.score(none).count() == 0
    alone = bloom_lm.score(docs.filter("doc_id = 12 or doc_id is null")).collect()
    assert len(alone) == 3 and all(math.isfinite(r.base_score) for r in alone)


def test_language_model_beyond_the_broadcast(docs, monkeypatch):
    def scores(most_bytes):
        return [tuple(r) for r in bloom_lm.score(docs, most_bytes=most_bytes).collect()]

    monkeypatch.setattr(lookup, "CHUNK_KEYS", 40)
    got = scores(16)  # 0.0005 bits per level, were the filter to fit in it
    assert all(math.isfinite(r[-1]) for r in got)
    same([(*r[:-2], round(r[-2], 4), round(r[-1], 4)) for r in got],
         [(*r[:-2], round(r[-2], 4), round(r[-1], 4)) for r in scores(bloom_lm.MOST_BYTES)])


def test_line_templates(spark, docs, none):
    got = {(r.doc_id, r.text): r.n_dropped for r in line_templates.drop_recurring(docs.select("doc_id", "text", "lang")).collect()}
    assert (1, PROSE) in got and (12, "") in got and (2, None) in got and (None, None) in got
    assert (7, "You utter idiot") in got and got[(8, "A\nb c")] == 1 and (5, LONG) in got
    assert line_templates.drop_recurring(none.select("doc_id", "text")).count() == 0

    rows = [(k, f"own line number {'abcdefghij'[k]} {'klmnopqrst'[k]} of a document\nUser u{k} logged in at {k}:00 from host h{k}\nshort line") for k in range(6)]
    rows += [(50 + k, f"the committee met on {day} to vote on the budget of the city of Springfield\nanother {day} line altogether that "
              f"has nothing common {k} with others") for k, day in enumerate(["monday", "tuesday", "friday"])]
    out = {r.doc_id: r.text for r in line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0] == rows[0][1]                                  # the first keeps all
    assert all("logged in" not in out[k] and "short line" in out[k] for k in range(1, 6))   # fields with digits
    assert "committee" in out[50] and "committee" not in out[51] and "committee" not in out[52]  # another variable word


def test_lines_of_figures_stay(spark):
    rows = [(1, "12 34 56 78 90\n7 May 12:30 2 1\nthe river rose by 3 feet in spring"), (2, "1 2 3 4 5\n9 May 14:00 0 0"),
            (3, "12 34 56 78 91\nthe river rose by 4 feet in spring"), (4, "12 34 56 78 90")]
    out = {r.doc_id: r.text for r in line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1] == rows[0][1] and out[2] == rows[1][1]
    assert out[3] == "12 34 56 78 91" and out[4] == ""  # a field that varies; an equal row


@pytest.mark.parametrize("block", [line_templates.BLOCK, 3])
def test_lines_alike_by_share_of_words(spark, monkeypatch, block):
    monkeypatch.setattr(line_templates._templates, "__defaults__", (block,))
    base = "the council of the old town has agreed to build a new bridge over the river near mill".split()
    names, days = ["Ada", "Bob", "Cyd", "Dov"], ["monday", "tuesday", "friday"]
    rows = [(k, " ".join(x if j != 4 + k else f"edit{'abcdefghijkl'[k]}" for j, x in enumerate(base))) for k in range(12)]
    rows += [(100 + 10 * i + j, f"all members agree that {a} will lead the long meeting on {b} in the hall")
             for i, a in enumerate(names) for j, b in enumerate(days)]
    rows += [(200, "all members agree that nobody else may ever come there with some dog or big cat")]
    out = {r.doc_id: r.text for r in line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [k for k, t in out.items() if t and k < 100] == [0] and [k for k, t in out.items() if t and 100 <= k < 200] == [100]
    assert out[200] == rows[-1][1]


def test_toxicity(spark, docs, none, labels):
    categories = ["good", "toxic"]
    got = toxicity_chain.score(docs, labels, categories).collect()
    assert len(got) == len(ROWS) and all(0 <= r.p_toxic <= 1 for r in got)
    assert toxicity_chain.score(none, labels, categories).count() == 0
    assert all(r.p_toxic < 1e-9 for r in toxicity_chain.score(docs, labels.filter("1 = 0"), categories).collect())


def test_toxicity_held_out(spark):
    rng = np.random.default_rng(8)
    plain = [f"w{k}" for k in range(300)]
    rude = ["vilefolk", "vileness", "vilestuff", "vileoid"]
    rows, tags = [], []
    for i in range(800):
        toxic = i % 4 == 0
        text = [*rng.choice(plain, 40), *(rng.choice(rude, 2) if toxic else [])]
        rows.append((i, " ".join(rng.permutation(text))))
        tags.append((i, int(i % 3 == 0), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(tags[:500], "doc_id long, other int, toxic int")
    got = {r.doc_id: r.p_toxic for r in toxicity_chain.score(df, labels, ["other", "toxic"]).collect()}
    assert sum((got[i] >= 0.5) == bool(t) for i, _, t in tags[500:]) >= 295


@pytest.mark.parametrize("number", range(4))
def test_stage_keeps_the_columns(spark, docs, none, number, tmp_path):
    _, stage = corpus_pipeline.STAGES[number]
    spark.createDataFrame([(1, 1, 0), (7, 1, 1), (9, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, df, most in (("some", docs, len(ROWS)), ("none", none, 0)):
        df.write.parquet(str(tmp_path / name))
        read = spark.read.parquet(str(tmp_path / name))
        out = stage(spark, read, str(tmp_path))
        assert out.columns == docs.columns and out.schema["lang"].dataType == docs.schema["lang"].dataType
        kept = out.collect()
        assert len(kept) <= most and (not most or kept)
        assert all(r.lang == CLASHING.index("lang") and r["a.b"] == CLASHING.index("a.b") for r in kept)


def test_digest_is_of_the_bytes(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    one = bpe.encode(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), path, public_tokenizers.PATTERN, decoded=True)
    assert one.select(F.sha2("decoded", 256)).first()[0] == hashlib.sha256(b"abc").hexdigest()


def test_lines_keep_all_other_columns(docs):
    plain = {tuple(r) for r in line_templates.drop_recurring(docs.select("doc_id", "text")).collect()}
    got = line_templates.drop_recurring(docs)
    assert got.columns == [c for c in docs.columns if c != "n_dropped"] + ["n_dropped"]
    rows = got.collect()
    assert {(r.doc_id, r.text, r.n_dropped) for r in rows} == plain and len(rows) == len(ROWS)
    assert all(r[c] == i for r in rows for i, c in enumerate(CLASHING) if c != "n_dropped")


def test_near_copies_in_a_crowded_leaf(spark):
    import random
    rng = random.Random(12)
    rows = []
    for group in range(2000):  # one leaf: the same three words lead all lines
        line = ["as", "it", "were", *(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('klmnp')}{rng.choice('aeiou')}{rng.choice('rst')}{rng.choice('xyz')}" for _ in range(47))]
        for copy in range(5):
            words_ = list(line)
            for place in rng.sample(range(3, 50), 4 * (copy > 0)):
                words_[place] = "edited" + "abcdefghij"[copy] + rng.choice("uvw")
            rows.append((5 * group + copy, " ".join(words_)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = sum(r.n_dropped for r in line_templates.drop_recurring(df).collect())
    assert 0.985 * 8000 <= gone <= 8000, gone
    print("dropped", gone, "of 8000")


def _chained(rng):
    """Rows of one leaf: chains of lines in which each has four places, of 50, unlike
    the line before it, and pairs that differ in ten, as many as the threshold allows."""
    word = lambda: "".join(rng.choice("bcdfghklmn") + rng.choice("aeiou") for _ in range(4))
    lines = []
    for _ in range(30):
        line = ["as", "it", "were", *(word() for _ in range(47))]
        places = rng.sample(range(3, 50), 40)
        lines.append([line])
        for k in range(10):
            line = [word() if j in places[4 * k: 4 * k + 4] else x for j, x in enumerate(line)]
            lines[-1].append(line)
    for _ in range(60):
        line = ["as", "it", "were", *(word() for _ in range(47))]
        places = rng.sample(range(3, 50), 10)
        lines.append([line, [word() if j in places else x for j, x in enumerate(line)]])
    return [[" ".join(x) for x in group] for group in lines]


@pytest.mark.parametrize("block", [line_templates.BLOCK, 40])
def test_no_link_between_lines_is_left_out(spark, monkeypatch, block):
    import random
    monkeypatch.setattr(line_templates._templates, "__defaults__", (block,))
    rng = random.Random(5)
    groups = _chained(rng)
    owner = {x: g for g, lines in enumerate(groups) for x in lines}
    texts = sorted(owner)
    rng.shuffle(texts)
    out = {r.doc_id: r.text for r in line_templates.drop_recurring(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    first = {}
    for i, x in enumerate(texts):
        first.setdefault(owner[x], i)
    assert {i for i, x in out.items() if x} == set(first.values())


def test_lines_of_a_large_band_all_meet(spark, monkeypatch):
    monkeypatch.setattr(line_templates._templates, "__defaults__", (20,))
    # one of two bands is that of all lines, and lines of a kind meet in it only
    rows, kinds = [], 40
    for kind in range(kinds):
        for copy in range(6):
            name = "abcdefghij"[kind % 10] + "klmn"[kind // 10]
            line = ["as", "it", "were", "x", "y", "z", f"{name}p", "and", f"{name}q", *["same"] * 5, "edit" + "abcdef"[copy]]
            rows.append((kinds * copy + kind, " ".join(line)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_templates.drop_recurring(df, similarity=0.9).collect()}
    assert {i for i, x in out.items() if x} == set(range(kinds))


def test_pipeline_stage_leaves_no_link_out(spark):
    import random
    groups = _chained(random.Random(6))
    rows = [(i, f"{x}\nshort {i}") for i, x in enumerate(x for group in groups for x in group)]
    kept = corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert len(kept) == len(rows) and sum("as it were" in r.text for r in kept) == len(groups)


def test_pipeline_finds_copies_after_their_lines(spark):
    ours, other = "the whole town came to see the new bridge", "nobody knew where the old river had gone"
    rows = [(1, f"{other}\nthe mill"), (3, f"Too short.\n{ours}\n{other}\nAnd so."), (4, f"Too short.\n{ours}\n{other}\nAnd so."),
            (None, f"Too short.\n{ours}\n{other}\nAnd so."), (2, "And now.\nhe said that all of us would meet again"),
            (7, f"{ours}\nquite another end"), (8, "And now.\nhe said that all of us would meet again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lined = corpus_pipeline.line_dedup(spark, docs, "")
    out = {r.doc_id: r.text for r in lined.collect()}
    assert out[1] == rows[0][1] and out[2] == out[8] == rows[4][1] and out[7] == "quite another end"
    assert out[3] == out[4] == out[None] == f"Too short.\n{ours}\nAnd so."  # the first copy's lines, in each of them
    kept = {r.doc_id: r.text for r in corpus_pipeline.near_dedup(spark, lined, "").collect()}
    assert kept == {i: out[i] for i in (1, 2, 3, 7)}
    alone = {r.doc_id: r.text for r in line_templates.drop_recurring(docs).collect()}
    assert alone[3] == out[3] and alone[4] == alone[None] == "Too short.\nAnd so." and alone[8] == "And now."
