"""Conversation repair against all edits in the order of their costs."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from weftline.llm import conversations as conv
from weftline.llm import queries

SF = "/root/testdata/sf0.001"
GRAMMAR = re.compile(r"(s?(ua)+)?")
EMPTY = hashlib.sha256().hexdigest()


def damage(rows):
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        label = ":".join(" " if x is None else str(x) for x in (c, t))
        harm = zlib.crc32(label.encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub(r"[.!?]", "", text) if harm == 2 else text
        row = (c, t, "user" if harm == 4 else role, text)
        yield from [row] * (2 if harm == 3 else 1)


def plan(rows):
    """(cost, audit, role and text rows) by dynamic programming over whole prefixes."""
    seen, faults = set(), []
    for role, text in rows:
        rest = text.strip(" \t\n\x0b\x0c\r")
        if not rest:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("truncated" if rest[-1] not in ".!?" else None)
        seen.add((role, text))
    # Prefixes of the grammar, by what stands last; the best (cost, audit, rows) of each.
    grow = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}

    def inserted(states):
        for _ in range(3):
            for last, (cost, audit, out) in list(states.items()):
                for role in ("user", "assistant"):
                    if (last, role[0]) in grow:
                        new = (cost + 5, audit + "I", [*out, (role, "")])
                        states[role[0]] = min(states.get(role[0], new), new)
        return states

    states = inserted({"": (0, "", [])})
    for (role, text), fault in zip(rows, faults, strict=True):
        after = {}

        def put(last, new, after=after):
            after[last] = min(after.get(last, new), new)

        for last, (cost, audit, out) in states.items():
            put(last, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            cost += 5 * (fault == "truncated")
            if (last, role[:1]) in grow:
                put(role[:1], (cost, audit + "K", [*out, (role, text)]))
            for name in ("user", "assistant"):
                if (last, name[0]) in grow:
                    put(name[0], (cost + 1, audit + "R", [*out, (name, text)]))
        states = inserted(after)
    best = min(x for last, x in states.items() if last in ("", "a"))
    assert GRAMMAR.fullmatch("".join(r[0] for r, _ in best[2]))
    return faults, best


def digest(c, rows, key):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], key(r[3])))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, (cost, audit, out) = plan([r[2:] for r in rows])
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    text = "\n".join(f"{role}:{text}" for role, text in out)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (c, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def digests(rows, key=lambda text: hashlib.sha256(text.encode()).digest()):
    by = defaultdict(list)
    for r in damage(rows):
        by[r[0]].append(r)
    return {digest(c, by[c], key) for c in {r[0] for r in rows}}


def random_rows(rng, convs, longest):
    texts = ["Yes.", "No!", "Why?", "cut off", " \n", "", "A. b", "Ok. ", None, "é."]
    roles = ["user"] * 4 + ["assistant"] * 4 + ["system", "tool", "", None, "unknown", "User"]
    for c in convs:
        for t in range(rng.randint(1, longest)):
            if rng.random() < 0.5:
                row = [c, t + 2 * (rng.random() < 0.05), roles[4 * (t % 2)], f"Text {t} of {c}."]
            else:
                row = [c, t, rng.choice(roles), rng.choice(texts)]
            yield tuple([*row[:1], None if rng.random() < 0.03 else row[1], *row[2:]])


def test_search_from_both_ends_is_cheapest():
    rng = random.Random(2)
    for _ in range(600):
        rows = [r[2:] for r in damage(random_rows(rng, [rng.randrange(10**6)], 9))]
        faults, (cost, audit, out) = plan(rows)
        turns = [conv.Turn(r, t, f) for (r, t), f in zip(rows, faults, strict=True)]
        ends = [(len(turns), s) for s in conv.ENDS]
        assert conv.cheapest(conv.row_steps(turns, True), (0, conv.START), ends) == (cost, audit)
        assert list(conv.apply_edits(turns, audit, conv.START)) == out


def test_no_path():
    assert conv.cheapest([(0, 0, 1, 1, 0, "K")], (0, 0), [(1, 2)]) is None
    assert conv.cheapest([], (0, 0), [(0, 0)]) == (0, "")


SCHEMA = "conv_id long, turn long, role string, text string, fault string, key string"


@pytest.mark.parametrize("rows_of_chunk", [256, 3])
def test_query_on_odd_rows(spark, monkeypatch, rows_of_chunk):
    monkeypatch.setattr(conv, "CHUNK_ROWS", rows_of_chunk)
    monkeypatch.setattr(conv, "FAN", 3)
    rng = random.Random(rows_of_chunk)
    rows = list(random_rows(rng, [*range(60), None, -1], 8))
    rows += list(random_rows(rng, [100], 150)) + list(random_rows(rng, [101], 400))
    rows += [(102, None, "user", "Same.")] * 40 + [(103, 5, None, None)] * 3
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = conv.repair_digest(df).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {tuple(r) for r in got} == digests(rows)
    assert conv.repair_digest(df.limit(0)).count() == 0


def test_repaired_turns(spark, monkeypatch):
    monkeypatch.setattr(conv, "CHUNK_ROWS", 4)
    rows = list(random_rows(random.Random(9), range(40), 30))
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    done, turns = conv.repair_conversations(df)
    done = {r["conv_id"]: r for r in done.collect()}
    lines = defaultdict(list)
    for r in turns.orderBy("conv_id", "part", "chunk", "line").collect():
        lines[r["conv_id"]].append((r["role"], r["text"]))
    assert set(done) == {r[0] for r in rows}
    for c, r in done.items():
        text = "\n".join(f"{role}:{text}" for role, text in lines[c])
        assert GRAMMAR.fullmatch("".join(role[0] for role, _ in lines[c]))
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]


def test_one_conversation_with_most_rows(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}." if t % 7 else "same") for t in range(6000)]
    rows += [(c, t, "user", "Hi.") for c in range(2, 300) for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    [got] = conv.repair_digest(df).where("conv_id = 1").collect()
    assert tuple(got) == next(x for x in digests(rows) if x[0] == 1)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = {tuple(r) for r in queries.QUERIES["op13_conversation_repair"](spark, SF).collect()}
    assert got == digests(rows)
