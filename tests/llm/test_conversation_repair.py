"""Repair against every possible list of edits, long conversations, edge rows."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tonflow.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, place string, summary string"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        core = text.strip(cr.BLANKS)
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def every_edit(rows):
    """The cheapest, ASCII-least edits, found by trying all with at most two insertions in a row."""
    kinds, best = faults(rows), None

    def go(i, roles, made, audit, cost, inserted):
        nonlocal best
        if cost > (3 * len(rows) if best is None else best[0]) or not re.fullmatch("s?(ua)*u?", roles):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, made)
        if inserted < 2:
            for role in ("user", "assistant"):
                go(i, roles + role[0], [*made, (role, "")], audit + "I", cost + 2, inserted + 1)
        if i == len(rows):
            return
        role, text = rows[i]
        go(i + 1, roles, made, audit + "D", cost + 3, 0)
        if kinds[i] in ("blank", "duplicate"):
            return
        extra = kinds[i] == "truncated"
        go(i + 1, roles + (role[:1] or "-"), [*made, rows[i]], audit + "K", cost + extra, 0)
        for new in ("user", "assistant"):
            go(i + 1, roles + new[0], [*made, (new, text)], audit + "R", cost + 2 + extra, 0)

    go(0, "", [], "", 0, 0)
    return best


def by_audit(rows, window=2):
    """Through the persistent program, settled as often as possible."""
    cr.WINDOW, held = window, cr.WINDOW
    try:
        one = cr._Conversation(0)
        made = []
        for i, (role, text) in enumerate(rows):
            one.add(i, role, text)
            letters = one.audit.settle()
            made += one.replay(letters) if letters else []
        cost, letters = one.audit.finish()
        made += one.replay(letters)
        return cost, one.summary(cost)["audit"], [(m[2], m[3]) for m in made], one
    finally:
        cr.WINDOW = held


turn = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["Yes.", "No", "Why?", " ", "x!"]))


@settings(max_examples=150, deadline=None)
@given(st.lists(turn, max_size=5), st.integers(1, 6))
def test_cheapest_and_least(rows, window):
    cost, audit, made, one = by_audit(rows, window)
    assert (cost, audit, made) == every_edit(rows)
    kinds = faults(rows)
    assert (one.blank, one.duplicate, one.truncated) == tuple(kinds.count(k) for k in ("blank", "duplicate", "truncated"))


@settings(max_examples=60, deadline=None)
@given(st.lists(turn, min_size=20, max_size=120))
def test_settling_changes_nothing(rows):
    assert by_audit(rows, 1)[:3] == by_audit(rows, 10**9)[:3]


@settings(max_examples=100, deadline=None)
@given(st.text("DIKR", max_size=40), st.text("DIKR", max_size=40))
def test_longest_common_prefix(one, two):
    known, ends = {}, []
    for word in (one, two):
        node = known.setdefault("", cr.Node(None, ""))
        for i, letter in enumerate(word):
            node = known.setdefault(word[: i + 1], None) or known.__setitem__(word[: i + 1], cr.Node(node, letter)) or known[word[: i + 1]]
        ends.append(node)
    shared = next((i for i, (x, y) in enumerate(zip(one, two)) if x != y), min(len(one), len(two)))
    assert cr.common_prefix(*ends) == shared
    assert cr.before(ends[0], "K", ends[1], "R") == (one + "K" < two + "R")


def test_colliding_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(cr, "_MODULUS", 1)
    rng = random.Random(3)
    for _ in range(40):
        rows = [(rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No", "", "x!"])) for _ in range(rng.randrange(6))]
        assert by_audit(rows)[:3] == every_edit(rows)


def summaries(df):
    return {r["conv_id"]: (r["summary"].asDict(), r["repaired_sha256"]) for r in cr.digests(df).collect()}


def test_edges(spark):
    rows = [
        (1, 0, "user", "Hello.", "", ""), (1, 1, "assistant", "Hi.", "", ""),
        (2, None, "user", "First.", "", ""), (2, 5, None, None, "", ""), (2, 9, "assistant", "Cut off", "", ""),
        (None, 1, "user", "Nobody's.", "", ""), (3, 2, "user", "Dropped.", "", ""),
        (4, 1, "user", "Same.", "", ""), (4, 1, "user", "Same.", "", ""), (4, 4, "assistant", "Ok.", "", ""),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = summaries(cr.repair(df, present=df["conv_id"].isNull() | (df["conv_id"] != 3)))

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    def row(gaps, blank, duplicate, truncated, illegal, cost, audit):
        return dict(gaps=gaps, blank=blank, duplicate=duplicate, truncated=truncated, illegal=illegal, cost=cost, audit=audit)

    assert out == {
        1: (row(0, 0, 0, 0, 0, 0, "KK"), digest("user:Hello.\nassistant:Hi.")),
        2: (row(3, 1, 0, 1, 2, 4, "KDK"), digest("user:First.\nassistant:Cut off")),
        3: (row(0, 0, 0, 0, 0, 0, ""), digest("")),
        4: (row(2, 0, 1, 0, 1, 3, "KDK"), digest("user:Same.\nassistant:Ok.")),
        None: (row(0, 0, 0, 0, 0, 2, "KI"), digest("user:Nobody's.\nassistant:")),
    }
    assert summaries(cr.repair(df.limit(0))) == {}
    turns = cr.repair(df).where("conv_id = 4 AND summary IS NULL").orderBy("place").collect()
    assert [(t["place"], t["edit"], t["role"], t["text"]) for t in turns] == [(0, "K", "user", "Same."), (1, "K", "assistant", "Ok.")]


def test_long_conversation_streams(spark):
    """Thirty thousand turns in one conversation, long texts, a window of edits at a time."""
    df = spark.range(30_000).selectExpr(
        "7L AS conv_id", "id AS turn", "CASE WHEN id % 11 = 0 THEN 'tool' WHEN id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role",
        "concat('Turn ', id, CASE WHEN id % 5 = 0 THEN ' cut' ELSE '.' END, repeat(' ', id % 50)) AS text",
    )
    rows = [(r["role"], r["text"]) for r in df.orderBy("turn").collect()]
    cost, audit, made, _ = by_audit(rows, 10**9)
    summary, digest = summaries(cr.repair(df))[7]
    assert (summary["cost"], summary["audit"]) == (cost, audit)
    assert digest == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()


@pytest.mark.parametrize("roles", ["ua" * 150, "s" + "ua" * 150, "uaxua" * 60, "uaaua" * 60])
def test_window_shrinks(roles):
    """Audits share all but a short end, so few letters wait."""
    name = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    *_, one = by_audit([(name[r], f"Turn {i}.") for i, r in enumerate(roles)], 8)
    assert len(one.letters[-1]) < 120
