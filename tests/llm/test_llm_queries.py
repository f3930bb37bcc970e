"""The registered queries and the pipeline on the small tables, against plain
Python over the same tables."""

import html
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from skydrift.llm import bpe, queries
from tests.llm.test_llm_operators import WORD, fingerprint, same, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    docs = con.execute(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()
    labels = {i: (q, t) for i, q, t in con.execute(f"select doc_id, quality, toxic from '{SF}/labels.parquet'").fetchall()}
    pages = con.execute(f"select page_id, url, html from '{SF}/pages.parquet'").fetchall()
    return docs, labels, pages


def rows(spark, name):
    return E.queries()[name](spark, SF).collect()


def test_all_are_registered():
    assert [k for k in E.queries() if re.match(r"op\d+_|pipeline", k)] == [*queries.QUERIES, "pipeline"]
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == [*range(1, 14)]


def test_op2(spark, tables):
    import hashlib
    codec = bpe.codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    want = []
    for i, t in tables[0]:
        ids = codec._encoding.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    same(rows(spark, "op2_byte_bpe"), want)


def test_op4(spark, tables):
    got = {r.page_id: r for r in rows(spark, "op4_style_tree")}
    for i, url, page in tables[2]:
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = [re.sub(r"</?(?:b|p|h1)>", "", b.replace("<br>", " ")) for b in re.split(r"<p>|<h1>", article)]
        text = "\n\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)
        assert tuple(got[i]) == (i, url, text, len(text))


def test_op5(spark, tables):
    got = {r.doc_id: r for r in rows(spark, "op5_quality_llr")}
    docs, labels, _ = tables
    for i, t in docs:
        n = len(WORD.findall(t or ""))
        assert got[i].n_words == n and got[i].base_failed == (n < 10 or 100 * got[i].n_repeat_words > 20 * n)
        if not got[i].base_failed and i in labels and labels[i][0] == 1:
            assert got[i].kept


def test_op6(spark, tables):
    tokens = {i: [*words(t), None] for i, t in tables[0]}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    c = Counter(x for i, t in tokens.items() if not held[i] for x in t)
    n, v = sum(c.values()), len(c)
    for r in rows(spark, "op6_bloom_lm"):
        t = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(c[x] > 0 for x in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t))


def test_op7(spark, tables):
    before, after = (defaultdict(set) for _ in range(2))
    got = {r.doc_id: r for r in rows(spark, "op7_line_templates")}
    for i, t in tables[0]:
        kept = iter(got[i].text.split("\n"))
        lines = t.split("\n")
        assert len(got[i].text.split("\n")) + got[i].n_dropped in (len(lines), len(lines) + 1)
        assert not got[i].text or all(x in lines for x in kept)
        for lines, seen in ((lines, before), (got[i].text.split("\n"), after)):
            for x in lines:
                if len(WORD.findall(x)) >= 5:
                    seen[x].add(i)
    recurring = [x for x, ids in before.items() if len(ids) > 1]
    assert recurring
    for x in recurring:  # an equal line stays in one document at most, and then in the first
        assert len(after[x]) <= 1 and after[x] <= {min(before[x])}
    assert all(after[x] for x, ids in before.items() if len(ids) > 2)


def test_op8(spark, tables):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows(spark, "op8_kk_packing"):
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, t in tables[0]:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and at & (at - 1) == 0


def test_op10(spark, tables):
    prints = {i: fingerprint(t) for i, t in tables[0]}
    root = {i: i for i in prints}
    for _ in range(10):
        for a in prints:
            root[a] = min(root[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 2)
    same(rows(spark, "op10_simhash_dedup"), [(i, f"{p:016x}", root[i]) for i, p in prints.items()])


def test_pipeline_stages(spark, tables, tmp_path):
    docs, labels, _ = tables
    text = dict(docs)
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [set(text)]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, frame, SF).write.parquet(path)
        frame = spark.read.parquet(path)
        if name == "packing":
            break
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now = {r.doc_id: r for r in frame.collect()}
        assert set(now) <= kept[-1] and frame.count() == len(now)
        if name in ("quality rules", "toxicity"):
            assert all(now[i].text == text[i] for i in now)
        else:
            assert all(now[i].n_chars == len(now[i].text) for i in now)
        kept.append(set(now))
    clean = {i for i, (q, t) in labels.items() if q == 1 and t == 0 and len(WORD.findall(text[i])) >= 10}
    assert len(clean & kept[2]) >= 0.97 * len(clean)          # clean documents stay
    assert kept[3] == kept[2]                                  # line dedup drops lines only
    prints = {}
    for r in spark.read.parquet(str(tmp_path / "2")).collect():
        prints[r.doc_id] = fingerprint(r.text)
    root = {i: i for i in prints}
    for _ in range(10):
        for a in prints:
            root[a] = min(root[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 2)
    assert kept[4] == set(root.values())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    last = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "3")).collect()}
    packed = Counter()
    for r in frame.collect():
        packed[r.doc_id] += r.length
    assert packed == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in last.items()}
