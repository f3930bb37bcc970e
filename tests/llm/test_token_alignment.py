"""Alignment of two tokenizers against a merge token by token."""

import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as E
from skydrift.llm import lookup, token_alignment
from skydrift.llm.kk_packing import byte_letters
from tests.llm.test_llm_operators import ROWS, docs, none, same  # noqa: F401

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["  two  blanks ", " ", "\n", "a ", "tabs\tand\r\nlines\n\n  x", "▁ block", "x▁", "<|endoftext|> inside <s> text </s>", "no break",
       "é ́ mark", "\U0001f9d1‍\U0001f680 \U0001f600", "　wide　blank", "it's we'll 'tis", "中文 字符 テスト",
       "a" * 3000, " " * 700, "a b " * 2000 + "end", "\x00 nul \x00", "1 2 3 44 555", "e x y\u0085z w"]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {c: i for i, c in enumerate(byte_letters())}

    def tokens(text):
        if not text:
            return [], []
        left = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        want = (" " + text).encode()
        return (left, right) if b"".join(t for _, t in left) == want == b"".join(t for _, t in right) else ([], [])

    return tokens


def aligned(tokens):
    """Per text: groups of (A ids, B ids)."""
    a, b = tokens
    out, at, bt, x, y, i, j = [], 0, 0, 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if x <= y:
            x, i = x + len(a[i][1]), i + 1
        else:
            y, j = y + len(b[j][1]), j + 1
        if x == y:
            out.append(([t for t, _ in a[at:i]], [t for t, _ in b[bt:j]]))
            at, bt = i, j
    return out


def expected(rows, tokens):
    groups = [aligned(tokens(t)) for _, t in rows]
    count = Counter()
    for g in groups:
        count.update({(a, b) for x, y in g for a in x for b in y})
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for (i, _), g in zip(rows, groups):
        links = Counter((a, b) for x, y in g for a in x for b in y)
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(links.values()),
                    sum(n for k, n in links.items() if count[k] == top[k[0]]), sum(n * count[k] for k, n in links.items()), text))
    return out


def test_odd_texts(plain):
    own = token_alignment.pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert not own._whole
    texts = [t for _, t in ROWS] + ODD + [None, ""]
    flat = [(t or "").encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in flat])]).astype(np.int64)
    data = np.frombuffer(b"".join(flat), np.uint8)
    want = [";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in aligned(plain(t))) for t in texts]
    for whole in (False, True):
        own._whole = whole
        own._forget()
        got = token_alignment.shown(own.align(data, offsets))
        for t, g, w in zip(texts, got.to_pylist(), want):
            assert g == w, repr(t)[:60]
    own._whole = False
    assert "" in want[len(ROWS):-2] and sum(map(bool, want)) > 25  # some have no tokens


def test_wide_groups(monkeypatch):
    x = token_alignment.Aligned(np.array([5, 6, 5, 7]), np.array([1, 1, 2, 9]), np.array([0, 4]), np.array([0, 4]),
                                np.array([3, 4]), np.array([3, 4]), np.array([0, 2]))
    got = token_alignment.linked(x)
    monkeypatch.setattr(token_alignment, "WIDE_GROUP", 1)
    for a, b in zip(got, token_alignment.linked(x)):
        assert (a == b).all()
    assert got[2].sum() == 10 and token_alignment.shown(x).to_pylist() == ["5,6,5|1,1,2;7|9"]


def test_rows(spark, docs, none, plain, monkeypatch):  # noqa: F811
    monkeypatch.setattr(lookup, "CHUNK_KEYS", 300)
    want = expected(ROWS, plain)
    for most in (1 << 30, 10):  # counts broadcast, and looked up by segment
        got = token_alignment.align(docs, A, B, most_pairs=most)
        assert got.columns[0] == "doc_id" and got.columns[-1] == "groups"
        same(got.collect(), want)
    assert token_alignment.align(none, A, B).count() == 0
    kept = token_alignment.align(docs, A, B, keep=("__text", "text", "score")).collect()
    assert len(kept) == len(ROWS) and {r["score"] for r in kept} == {9}


def test_query(spark, plain):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in expected(rows, plain)]
    same(E.queries()["op13_lockstep_alignment"](spark, sf).collect(), want)
