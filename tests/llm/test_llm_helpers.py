"""The Spark-free helpers against plain Python."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from skydrift.llm import bloom_lm, bpe, kk_packing, line_templates, quality_llr, toxicity_chain
from skydrift.llm.pivot_search import PivotTable, _scores, as_kind
from skydrift.llm.style_tree import Page
from skydrift.llm.words import slices, split, text_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["Ab  cd\tab\nÉé x1", "", None, " \n\t ", "one", "a b c d e a b c d e", "x" * 5000, "a\x85b c\x1cd e"]


def plain(t):
    return WORD.findall(t or "")


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


@pytest.mark.parametrize("most", [1, 30, 1 << 20])
def test_words_and_hashes(most):
    seen = {}
    row = 0
    for a, b, w in slices(pa.array(TEXTS), most):
        assert a == row
        row = b
        data, h = w.data.tobytes(), w.hashes()
        for i in range(b - a):
            got = [data[w.starts[k]:w.ends[k]].decode() for k in range(w.first[i], w.first[i + 1])]
            assert got == plain(TEXTS[a + i])
            for word, x in zip(got, h[w.first[i]:w.first[i + 1]]):
                assert seen.setdefault(lowered(word), x) == x
    assert row == len(TEXTS)
    assert len(set(map(int, seen.values()))) == len(seen)


def test_words_of_a_slice_of_an_array():
    assert [len(plain(t)) for t in TEXTS[4:]] == split(*text_bytes(pa.array(TEXTS)[4:])).counts().tolist()


def test_prefix_hashes():
    w = split(*text_bytes(pa.array(["idiot idiots Idio x idi"])))
    some, h = w.prefix_hashes(4)
    assert some.tolist() == [0, 1, 2] and len(set(h.tolist())) == 1


@pytest.fixture(scope="module")
def codec():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.codec(ranks, public_tokenizers.PATTERN)


def test_bpe_safe_cuts(codec, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 17)
    rng = random.Random(3)
    letters = list("ab1 \n\t'sredt.,é 中!_-²")
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 300)))
        out = []
        codec._plain(text, out)
        assert np.concatenate(out).tolist() == codec._encoding.encode_ordinary(text)


@pytest.mark.parametrize("after", ["", "b", "  b", "\n.x", " 's"])
@pytest.mark.parametrize("run", [" ", "\n ", " "])
def test_bpe_long_white_space(codec, after, run):
    text = "x" + run * (40_000 // len(run)) + after
    ids = codec.encode(text)
    assert ids.tolist() == codec._encoding.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_bpe_beyond_the_matchers_stack(codec):
    text = "x" + " " * 1_500_000 + "y" * 100_000
    assert codec.decode(codec.encode(text)) == text.encode()


def test_word_tokenizer_is_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    own = kk_packing.WordTokenizer(open(path, encoding="utf-8").read())
    texts = ["Hello, WORLD!! it's don't 'tis 3.14 x²", "É É İstanbul ß Straße", "<|endoftext|> a<|ENDOFTEXT|>b", "",
             "a b c é ́x", "###&&& *** $$$ they'Re", "中文 テスト 😀😀 naïve co-op"] * 2
    for _, _, w in slices(pa.array(texts)):
        flat, begin = own.encode(w, 2)
        for i, t in enumerate(texts):
            assert flat[begin[i]:begin[i + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids + [2]


def test_differencing_is_near_equal_and_whole():
    rng = random.Random(5)
    sizes = [rng.randint(1, 900) for _ in range(400)]
    windows = kk_packing.karmarkar_karp(sizes, 40)
    assert sorted(i for w in windows for i in w) == list(range(400))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) - min(sums) <= 30
    assert kk_packing.karmarkar_karp([], 0) == [] and kk_packing.karmarkar_karp([3], 2) == [[0], []]


def test_window_count_rises():
    windows = kk_packing.whole_windows([(i, 0, 6) for i in range(4)], 10)  # 24 tokens fit 3 windows only in pieces
    assert len(windows) == 4


@pytest.mark.parametrize("final", [False, True])
def test_packed_pieces_fill_windows(final):
    rng = random.Random(7)
    for n in (0, 1, 5, 60):
        pieces = [(i, 0, rng.choice([1, 3, 64, 100, 300])) for i in range(n)]
        windows, rest = kk_packing.pack_pieces(pieces, 64, final)
        sums = [sum(b - a for _, a, b in w) for w in windows]
        assert all(s == 64 or final and s & (s - 1) == 0 for s in sums)
        assert not (final and rest)
        spans = sorted(p for w in [*windows, rest] for p in w)
        for doc, _, end in pieces:
            own = [(a, b) for d, a, b in spans if d == doc]
            assert own[0][0] == 0 and own[-1][1] == end and all(x[1] == y[0] for x, y in zip(own, own[1:]))


def test_pivot_bounds_and_search():
    rng = np.random.default_rng(1)
    rows = rng.integers(-60, 60, (500, 8)).astype(float)
    rows[10:20] = rows[3]
    norm = float(np.sqrt((rows ** 2).sum(1).max()))
    table = PivotTable(rows, rows[:12], norm)
    ids = rng.permutation(500)
    for q in (0, 3, 77):
        assert (table.bounds(rows[q]) >= rows @ rows[q]).all()
        found, scores = table.best(rows[q], ids == ids[q], ids, 5, -np.inf)
        exact = rows @ rows[q]
        exact[q] = -1e18
        want = np.lexsort((ids, -exact))[:5]
        assert found.tolist() == want.tolist() and scores.tolist() == exact[want].tolist()


def test_scores_beyond_float64():
    big, norm = np.array([[2.0 ** 40, 1.0], [2.0 ** 62, 2.0 ** 62]]), 2.0 ** 63
    assert _scores(as_kind(big, norm), as_kind(np.array([2.0 ** 20, 1.0]), norm)).tolist() == [2 ** 60 + 1, (1 << 63) - 1]


def test_base_counts_by_brute_force():
    texts = [*TEXTS, "a b\n\na b\n a b\nc #|", "w " * 30, "u v w x y z u v w x y"]
    for a, b, w in slices(pa.array(texts), 40):
        got = quality_llr.base(w, w.hashes(lower=False))
        for i, t in enumerate(texts[a:b]):
            words = plain(t)
            spans = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
            cover = {j for k, s in enumerate(spans) if spans.count(s) > 1 for j in range(k, k + 5)}
            lines = [x for x in (t or "").split("\n") if plain(x)]
            want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(cover))
            assert tuple(int(got[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want


def test_bloom_filter_reads_levels_back():
    rng = np.random.default_rng(2)
    grams = np.unique(rng.integers(0, 1 << 64, 20_000, dtype=np.uint64))
    counts = np.minimum(rng.geometric(0.2, len(grams)) ** 2, 5000)
    batch = bloom_lm._segmented(grams, counts, 16)
    segments = [b""] * 16
    for s, g, c in zip(*(x.to_pylist() for x in batch.columns)):
        six = np.frombuffer(g, np.uint8).reshape(-1, 6)
        low = np.zeros((len(six), 8), np.uint8)
        low[:, :6] = six
        held = np.frombuffer(c, np.uint8 if len(c) == len(six) else "<u8").astype(np.int64)
        segments[s] = bloom_lm.Filter.segment(low.view("<u8").ravel(), held, 8.0)
    made = bloom_lm.Filter(np.array([8 * len(x) for x in segments]), b"".join(segments))
    true = np.floor(np.log2(counts)).astype(int) + 1
    got = made.levels(grams)
    assert (got >= true).all() and (got == true).mean() > 0.95
    absent = rng.integers(0, 1 << 64, 20_000, dtype=np.uint64)
    assert (made.levels(absent) > 0).mean() < 0.05
    assert bloom_lm.Filter(np.zeros(16), b"").levels(absent).sum() == 0


def test_full_filter_ends_at_its_highest_level():
    made = bloom_lm.Filter(np.full(16, 64), b"\xff" * 128, np.full(16, 5))
    got = made.counts(np.arange(1 << 10, dtype=np.uint64) << np.uint64(54))
    assert (got == 24).all()


def test_lines():
    texts = ["a b c d e\n\nA b 12 d", None, "a b c d e", "x\n a  b 345 d e"]
    w = split(*text_bytes(pa.array(texts)))
    lines = line_templates.Lines(w)
    assert lines.text.tolist() == [0, 0, 2, 3, 3] and lines.number.tolist() == [0, 2, 0, 0, 1]
    assert lines.words.tolist() == [5, 4, 5, 1, 5]
    assert lines.whole[0] == lines.whole[2] and len(set(lines.whole.tolist())) == 4


def test_chain_learns_from_the_earlier_category():
    rng = np.random.default_rng(4)
    n = 600
    first = rng.random(n) < 0.4
    held = [(i, 0) for i in range(n) if first[i]] + [(i, 1) for i in range(n) if rng.random() < 0.5]
    rows, cols = map(np.array, zip(*sorted(held)))
    second = first & np.isin(np.arange(n), rows[cols == 1])
    models = toxicity_chain.fit_chain(rows, cols, n, 2, np.column_stack([first, second]))
    assert len(models[0]) == 3 and len(models[1]) == 4 and models[1][2] > 0
    p1 = toxicity_chain.predict(models[0], rows, cols, n, np.zeros((n, 0)))
    p2 = toxicity_chain.predict(models[1], rows, cols, n, p1[:, None])
    assert ((p1 > 0.5) == first).mean() > 0.98 and ((p2 > 0.5) == second).mean() > 0.95


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div class="cookie-notice">We use</div><nav><ul><li><a>x</a></ul></nav><main><article><header><h1>Title &amp; x</h1></header>
<p>One <b>two</b>three<br>four<p>Five&nbsp; six &lt;i&gt;<ul><li>a<li>b</ul><form>Name <input> </form><div class="ad">Buy</div>
<table><tr><td>1<td>2</table><section id="comments"><article>Bad</article></section></article></main><aside>side</aside>
<footer>f</footer><script>if(a<b){"</p>"}</script><!-- unclosed"""


@pytest.mark.parametrize("html, text", [
    (PAGE, "Title & x\n\nOne twothree four\n\nFive six <i>\n\na\n\nb\n\n1\n\n2"),
    ("<div>x<p>y</div>z", "x\n\ny\n\nz"),
    ("a < b &amp;&amp; c > d", "a < b && c > d"),
    ("<p class='x>y</p>", "y"),
    ("", ""),
    ("<script>", ""),
    ("<p>x</p><!-- a > b", "x"),
    ("<p>x</p>tail < end <a href='", "x\n\ntail < end"),
    ("no tags", "no tags"),
    ("<a " * 50_000 + "x", ""),
    ("<p>x" + "<a " * 50_000, "x"),
    ("<p>" * 3000 + "deep", "deep"),
])
def test_page_text(html, text):
    assert Page(html).text(set()) == text


@pytest.mark.parametrize("html, text", [
    ("<p><button>Copy</button>The paragraph</p>", "The paragraph"),
    ("<p>The <button>Copy</button>paragraph</p>", "The paragraph"),
    ("<p>The paragraph<button>Copy</button></p>", "The paragraph"),
    ("<p><span class='notice'>Update:</span> text <a class='share' href='x'>x</a></p><p>more", "text\n\nmore"),
    ("<table><tr><td><label>Name</label>Ada</table>", "Ada"),
    ("<nav>a<b>b</b></nav><button>c</button>d", "d"),
    ("<p>As <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds</p>", "As x=1 holds"),
])
def test_inline_noise_alone_is_left_out(html, text):
    assert Page(html).text(set()) == text


def test_crc_of_ids_is_little_endian():
    assert zlib.crc32(np.array([1, 2], "<u4")) == zlib.crc32(b"\x01\0\0\0\x02\0\0\0")
