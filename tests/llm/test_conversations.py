"""Conversation repair against a plain recursion over rows and states, segments and all."""

import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_repair as cr

EMPTY = hashlib.sha256(b"").hexdigest()


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(x for x in text if x not in ".!?")
        elif kind == 4:
            role = "user"
        out += [] if kind == 0 else [(c, t, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = text.rstrip(cr.SPACES)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(roles, bad):
    """(cost, letters) of the best repair; the state is the initial that stands last."""
    nxt = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, q, left):
        found = []
        if i == len(roles):
            if q in ("", "a"):
                found.append((0, ""))
        else:
            step = lambda cost, letter, state: found.append((cost + best(i + 1, state, 2)[0], letter + best(i + 1, state, 2)[1]))
            step(3, "D", q)
            if bad[i] not in ("blank", "duplicate"):
                more = bad[i] == "truncated"
                if roles[i] == nxt[q] or (roles[i], q) == ("s", ""):
                    step(more, "K", roles[i])
                step(2 + more, "R", nxt[q])
        if left:
            c, x = best(i, nxt[q], left - 1)
            found.append((c + 2, "I" + x))
        return min(found, default=(10**9, ""))

    return best(0, "", 2)


def brute(rows, every):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = []
    for c in {r[0] for r in every} | set(groups):
        own = sorted(groups[c], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        if not own:
            out.append((c, 0, 0, 0, 0, 0, 0, "", EMPTY))
            continue
        bad, initials = faults(own), [r[2][:1] for r in own]
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit = cheapest(tuple(initials), tuple(bad))
        full, q, i = [], "", 0
        nxt = {"": "user", "s": "user", "u": "assistant", "a": "user"}
        for x in audit:
            if x in "IR":
                full.append((nxt[q], "" if x == "I" else own[i][3]))
                q = nxt[q][0]
            elif x == "K":
                full.append((own[i][2], own[i][3]))
                q = initials[i]
            i += x != "I"
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in full).encode()).hexdigest()
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"), illegal, cost, audit, digest))
    return out


def conversations(seed=1, n=250):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "why?", "cut off", " \t\n", "", None, "Fine. \n", "é", "a.b", *[f"text {i}." for i in range(30)]]
    roles = ["user", "assistant"] * 6 + ["system", "tool", "", None, "User", "umpire"]
    rows = []
    for c in range(n):
        turn = rnd.randint(-3, 3)
        for k in range(rnd.randint(1, 14)):
            turn += rnd.choice([0, 1, 1, 1, 1, 2])
            role = ["user", "assistant"][k % 2] if rnd.random() < 0.6 else rnd.choice(roles)
            rows.append((c, None if rnd.random() < 0.05 else turn, role, rnd.choice(texts)))
    rows += [(None, 0, "user", "hi."), (None, None, None, None), (900, None, "user", "x."), (901, 2**40, "user", "z" * 300_000 + "."), (901, 2**40 + 1, "assistant", "ok."), *[(902, 5, "user", "same.")] * 40]
    return rows


def of(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumn("at", F.lit("clash")).withColumn("code", F.lit(1)).withColumn("kind", F.lit(2)).repartition(3)


def plain(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_damage(spark):
    rows = conversations()
    assert plain(cr.damage(of(spark, rows))) == sorted(damaged(rows), key=repr)
    assert len({zlib.crc32(f"{c}:{t}".encode()) % 20 for c, t, *_ in rows}) == 20


@pytest.mark.parametrize("bits", [12, 2])  # segments of 4 rows cut most conversations
def test_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(cr, "SEGMENT_BITS", bits)
    rows = conversations()
    got = cr.report(cr.damage(of(spark, rows)), every=of(spark, rows))
    assert plain(got) == sorted(brute(damaged(rows), rows), key=repr)


def test_repaired_rows(spark):
    rows = conversations(2, 60)
    got = defaultdict(list)
    for r in sorted(cr.repair(of(spark, rows)).collect(), key=lambda r: r.place):
        assert r.place == len(got[r.conv_id])
        got[r.conv_id].append(f"{r.role}:{r.text}")
    fixed = [(c, t, " " if role is None else role, " " if text is None else text) for c, t, role, text in rows]
    want = {r[0]: r[8] for r in brute(fixed, [])}
    for c, digest in want.items():
        assert hashlib.sha256("\n".join(got.get(c, [])).encode()).hexdigest() == digest
        initials = "".join(x[0] for x in got.get(c, []))
        assert initials.removeprefix("s") == "ua" * (len(initials) // 2)


def test_a_long_conversation_is_cut(spark, monkeypatch):
    monkeypatch.setattr(cr, "SEGMENT_BITS", 6)
    rnd = random.Random(7)
    rows = [(1, k, rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice(["a.", f"{k}!", "cut", ""])) for k in range(250)]
    assert plain(cr.report(of(spark, rows))) == sorted(brute(rows, []), key=repr)


def test_least_paths_by_enumeration():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        codes = rnd.integers(0, 16, rnd.integers(1, 8))
        roles, bad = ["", "s", "u", "a"], [None, "blank", "duplicate", "truncated"]
        leads, pieces = cr.least_paths(codes, np.array([0]), cr.ENDS[None, :])
        cost, audit = cheapest(tuple(roles[c // 4] for c in codes), tuple(bad[c % 4] for c in codes))
        assert pieces[0][0] + cr.CLOSERS[leads[0, 0]] == audit
        assert (cr.to_the_end(codes, np.full(len(codes), len(codes)))[0, 0] + cr.ENDS).min() == cost


def test_text_ids_and_empty(spark):
    df = spark.createDataFrame([("a", 1, "user", "hi."), ("n", 1, "user", "x."), (None, 1, "user", "y.")], "conv_id string, turn int, role string, text string")
    assert {(r.conv_id, r.cost, r.audit) for r in cr.report(df).collect()} == {("a", 2, "KI"), ("n", 2, "KI"), (None, 2, "KI")}
    assert cr.report(df.where("false")).collect() == []
    assert [tuple(r) for r in cr.report(df.where("false"), df.limit(1)).collect()] == [("a", 0, 0, 0, 0, 0, 0, "", EMPTY)]
