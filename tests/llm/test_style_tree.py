"""The style tree without declarations to rely on, and its importance by brute force."""

import html as entities
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from skydrift.llm import style_tree, url_reputation


def _article(page):
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [re.sub(r"</?(?:b|p|h1)>", "", b.replace("<br>", " ")) for b in re.split(r"<p>|<h1>", article)]
    return "\n\n".join(b for b in (" ".join(entities.unescape(b).split()) for b in blocks) if b)


def _texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got, shuffled = ({r.page_id: r.text for r in style_tree.extract(df, url_reputation.host_of(F.col("url")), most_shared=n).collect()}
                     for n in (style_tree.MOST_SHARED, -1))
    assert got == shuffled  # by broadcast and by a join
    return got


@pytest.mark.parametrize("tags", ["article", "article|nav|footer"])
def test_without_declarations(spark, tags):
    """Every page of the table, its articles (and menus, footers and adverts)
    renamed to plain sections: entropy alone finds the same texts."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    plain = [(r.page_id, r.url, re.sub(rf"<(/?)(?:{tags})>", r"<\1div>", r.html)) for r in rows]
    if "nav" in tags:
        plain = [(i, u, h.replace('<div class="ad">', "<div>")) for i, u, h in plain]
    got = _texts(spark, plain)
    assert sum(got[r.page_id] == _article(r.html) for r in rows) >= 0.9 * len(rows)


def test_importance(spark):
    """Entropies over distinct pages, from the pages' own nodes."""
    rows = [("a", f"<body><div>{k % 3}</div><div><p>{k}</p>{'<p>x</p>' * (k % 4)}</div></body>") for k in range(11)]
    rows += [("b", "<body><div>1</div></body>"), ("a", rows[0][1]), (None, "<p>x"), ("a", None), ("a", "")]
    pages = {(host or "", html) for host, html in rows if html}
    content, layout = defaultdict(Counter), defaultdict(Counter)
    for host, html in pages:
        for path, (_, c, s, *_) in style_tree.Page(html).style_nodes().items():
            content[host, path][c] += 1
            layout[host, path][s] += 1

    def entropy(counts):
        m = sum(counts.values())
        return -sum(n / m * math.log(n / m) for n in counts.values()) / math.log(m) if m > 1 else 1.0

    want = {k: style_tree.CONTENT_SHARE * entropy(content[k]) + (1 - style_tree.CONTENT_SHARE) * entropy(layout[k]) for k in content}
    got = {(r.host, r.path % (1 << 64)): r for r in style_tree.style_tree(spark.createDataFrame(rows, "host string, html string")).collect()}
    assert got.keys() == want.keys()
    for k, r in got.items():
        assert r.importance == pytest.approx(want[k]) and r.pages == sum(content[k].values())


def test_beside_an_article(spark):
    """A section that varies as an article does is main text too; one that does
    not, or that is named for noise, is none, and one page shows nothing."""
    def page(k):
        told = "".join(f"<p>Told {k} {j}</p>" for j in range(k % 7 + 1))
        return (f'<body><article>{told}</article><div class="more">{told.replace("Told", "More")}</div><div class="shop">Buy {k}</div>'
                f'<div class="comment-list">{told.replace("Told", "Said")}</div><p>Odd {k}</p></body>')

    rows = [(k, "http://a.org/x", page(k)) for k in range(20)] + [(20, "http://b.org", page(3))]
    got = _texts(spark, rows)
    for k in range(20):
        lines = [f"{w} {k} {j}" for w in ("Told", "More") for j in range(k % 7 + 1)]
        assert got[k] == "\n\n".join(lines)
    assert got[20] == "\n\n".join(f"Told 3 {j}" for j in range(4))


def test_nodes_shared_over_hosts(spark):
    """Hosts of one page each: menus are known by what other hosts have."""
    def page(k):
        return (f"<body><div><ul><li>Go {k}</ul></div><div><h1>Of {k}</h1>" + "".join(f"<p>Told {k} {j}</p>" for j in range(k % 9 + 1)) + "</div></body>")

    got = _texts(spark, [(k, f"http://h{k}.org/", page(k)) for k in range(30)])
    for k in range(30):
        assert got[k] == "\n\n".join([f"Of {k}", *(f"Told {k} {j}" for j in range(k % 9 + 1))])
    few = _texts(spark, [(k, f"http://h{k}.org/", page(k)) for k in range(3)])
    assert few[0].startswith("Go 0\n\nOf 0")  # too few hosts to tell
