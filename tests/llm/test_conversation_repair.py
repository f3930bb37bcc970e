"""Conversation repair against a search over (cost, letters)."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pytest

import __spark_entry__ as E
from skydrift.llm import conversation_repair as cr
from skydrift.llm import queries

PATTERN = re.compile(r"(s?(ua)+)?")


def cheapest(initials, faults, most_inserts=3, insert=5):
    """(cost, letters) by trying all edits; a row pattern is kept only if it can still fit."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def rest(i, last, inserts):
        ways = []
        if inserts:
            ways += [(c + insert, "I" + t) for r in "ua" if r in follows[last] for c, t in [rest(i, r, inserts - 1)]]
        if i == len(initials):
            ways += [(0, "")] if last in ("", "a") else []
            return min(ways, default=(10 ** 9, ""))
        c, t = rest(i + 1, last, inserts)
        ways.append((c + 2, "D" + t))
        if faults[i] not in (cr.BLANK, cr.DUPLICATE):
            more = 5 * (faults[i] == cr.CUT_OFF)
            for r in follows[last]:
                c, t = rest(i + 1, r, inserts)
                if r == initials[i]:
                    ways.append((c + more, "K" + t))
                if r != "s":
                    ways.append((c + more + 1, "R" + t))
        return min(ways)

    return rest(0, "", most_inserts)


def expected(rows):
    """The verdict on rows of (turn, role, text) in order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    faults, seen = [], set()
    for _, r, x in rows:
        bare = x.strip(" \t\n\v\f\r")
        faults.append(cr.BLANK if not bare else cr.DUPLICATE if (r, x) in seen else cr.CUT_OFF if bare[-1] not in ".!?" else cr.SOUND)
        seen.add((r, x))
    initials = [r[:1] for _, r, _ in rows]
    cost, audit = cheapest(tuple(initials), tuple(faults))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    lines, last = [], ""
    at = 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else rows[at][1:]
        at += letter != "I"
        if letter == "D":
            continue
        if letter in "IR":
            role = "assistant" if last == "u" else "user"
        last = role[0]
        lines.append(f"{role}:{text}")
    assert PATTERN.fullmatch("".join(x[0] for x in lines))
    return (gaps, *(faults.count(f) for f in (cr.BLANK, cr.DUPLICATE, cr.CUT_OFF)), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, " " if r[1] is None else r[1], " " if r[2] is None else r[2]))


def test_weights_decide_as_the_search():
    rng = random.Random(5)
    for _ in range(400):
        n = rng.randint(0, 9)
        initials = "".join(rng.choice("suaatx-") for _ in range(n))
        faults = [rng.choice((0, 0, 0, 1, 2, 3)) for _ in range(n)]
        w, value = cr.best(initials, faults, cr.ENDS, inserts=True)
        assert (w.cost(value[0]), w.letters(value[0])) == cheapest(tuple(initials), tuple(faults))
        w, value = cr.best(initials, faults, cr.ENDS, inserts=False)
        assert (w.cost(value[0]), w.letters(value[0])) == cheapest(tuple(initials), tuple(faults), 0)


def test_insertions_where_they_pay(monkeypatch):
    monkeypatch.setattr(cr, "INSERT", 1)
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randint(0, 7)
        initials = "".join(rng.choice("suaat") for _ in range(n))
        faults = [rng.choice((0, 0, 0, 1, 2, 3)) for _ in range(n)]
        w, value = cr.best(initials, faults, cr.ENDS, inserts=True)
        assert (w.cost(value[0]), w.letters(value[0])) == cheapest(tuple(initials), tuple(faults), n + 2, 1)
    w, value = cr.best("sa", [0, 0], cr.ENDS, inserts=True)
    assert (w.cost(value[0]), w.letters(value[0])) == (1, "KIK")
    assert cr.edited("KIK", [("system", "x"), ("assistant", "y")]) == [("system", "x"), ("user", ""), ("assistant", "y")]


ROLES = ["user", "assistant", "system", "u", "tool", "", None]
TEXTS = ["Yes.", "No!", "Why?", "cut", "cut \n", "", " \t", None, "Yes.  ", "ünï.", "a\x85", "x" * 5000 + "."]


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(11)
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(rng.randint(1, 9)):
            rows += [(conv, rng.choice([None, *range(6)]), rng.choice(ROLES), rng.choice(TEXTS))] * rng.choice((1, 1, 2))
    for conv, n in ((7, 300), (100, 90)):
        rows += [(conv, k, rng.choice(ROLES[:4]), rng.choice(TEXTS[:4]) + str(rng.randint(0, 60)) + rng.choice(".!x")) for k in range(n)]
    return rows


@pytest.mark.parametrize("bits", [2, 10])
def test_rows(spark, talk, monkeypatch, bits):
    monkeypatch.setattr(cr, "BLOCK_BITS", bits)
    df = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 as place", "'x' as __own", "2 as number", "true as blank").repartition(3)
    verdicts, repaired = cr.repair(df, with_rows=True)
    got = {r.conv_id: tuple(r)[1:] for r in verdicts.collect()}
    lines = {}
    for r in sorted(repaired.collect(), key=lambda r: r.number):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    names = {r[0] for r in talk}
    assert set(got) == names and verdicts.count() == len(names)
    for conv in names:
        want, said = expected(in_order([r[1:] for r in talk if r[0] == conv]))
        assert got[conv] == want, conv
        assert lines.get(conv, []) == said
    verdicts, none = cr.repair(df.filter("1 = 0"))
    assert verdicts.count() == 0 and none is None


def faulty(conv, turn, role, text):
    role, text = " " if role is None else role, " " if text is None else text
    k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    if k == 0:
        return []
    if k == 4:
        role = "user"
    text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
    return [(turn, role, text)] * (2 if k == 3 else 1)


def test_damage(spark, talk):
    df = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, queries.damaged(df).collect()), key=repr)
    assert got == sorted(((c, *x) for c, t, r, s in talk for x in faulty(c, t, r, s)), key=repr)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    table = duckdb.sql(f"select conv_id, turn, role, text from '{sf}/conversations.parquet'").fetchall()
    got = {r.conv_id: tuple(r)[1:] for r in E.queries()["op11_conversation_repair"](spark, sf).collect()}
    assert set(got) == {r[0] for r in table}
    for conv in got:
        rows = in_order([x for r in table if r[0] == conv for x in faulty(*r)])
        assert got[conv] == expected(rows)[0]
