"""Lexical search against a brute-force version, and the ball tree's bounds and pruning."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lexical_search as ls

TERM = re.compile(ls.TERM)


def terms_of(text):
    return TERM.findall((text or "").translate(str.maketrans(ls.UPPER, ls.LOWER)))


def brute(docs, items, limit):
    counted = [(d, Counter(terms_of(t))) for d, t in docs if terms_of(t)]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counted:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms_of(text)) if c[t])
            if s > 0:
                scores.append((-s, -(2**63) if d is None else d, d, s))
        out += [(item, i + 1, d, s) for i, (_, _, d, s) in enumerate(sorted(scores, key=lambda x: x[:2])[:limit])]
    return out


def text_of(rnd, words, n):
    return "".join(rnd.choice(words) + rnd.choice([" ", ", ", "\n", "--", "\x00", "_"]) for _ in range(n))


def tables(seed=3, n=600):
    rnd = random.Random(seed)
    words = ["Ab", "ab", "é", "naïve", "ÀB", "àb", "x1", "007", "日本", "\x80", "z"] + ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 4))) for _ in range(300)]
    docs = [(i, text_of(rnd, words, rnd.randint(1, 80))) for i in range(n)]
    passage = text_of(rnd, words, 30)
    docs += [(2000 + i, docs[4][1]) for i in range(150)]  # a large group of copies: ties beyond the limit
    docs += [(3000 + i, text_of(rnd, words, 9) + passage) for i in range(5)]
    docs += [(4000, None), (4001, ""), (4002, " .,-"), (None, docs[4][1]), (7, docs[7][1]), (4003, "ab " * 600_000 + "end007")]
    items = [(i, text_of(rnd, words, rnd.randint(1, 25))) for i in range(25)]
    items += [(100, passage), (101, docs[4][1]), (102, None), (103, ""), (104, "nowhere-found"), (None, "ab"), (100, passage), (105, "END007")]
    return docs, items


def run(spark, docs, items, limit):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("terms", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("score", F.lit(2))
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("k", F.lit("clash")).withColumn("rank", F.lit(5))
    return sorted([tuple(r) for r in ls.search(d.repartition(5), q, limit).collect()], key=repr)


@pytest.mark.parametrize("limit", [1, 20])
def test_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(ls, "BALL_DOCS", 150)
    docs, items = tables()
    assert run(spark, docs, items, limit) == sorted(brute(docs, items, limit), key=repr)


def test_blocks_of_items(spark, monkeypatch):
    docs, items = tables(5, 200)
    monkeypatch.setattr(ls, "BLOCK_ITEMS", 12)
    assert run(spark, docs, items, 10) == sorted(brute(docs, items, 10), key=repr)


def test_empty_tables(spark):
    docs, items = tables(5, 20)
    assert run(spark, docs, items[:0] or [(1, None)], 5) == []
    assert run(spark, [(1, None)], items, 5) == []


def test_a_long_text_is_split_at_gaps(monkeypatch):
    numbers = {b"ab": 0, "é".encode(): 1, b"cd9": 2}
    text = ("AB, é cd9\x00" * 50 + "ab" * 40).encode()
    whole = ls.count_terms(text, numbers)
    assert whole == (151, Counter({0: 50, 1: 50, 2: 50}))
    for piece in (1, 2, 3, 7, 64):
        monkeypatch.setattr(ls, "PIECE", piece)
        assert ls.count_terms(text, numbers) == whole


def random_ball(rnd, n, dims):
    ids = rnd.permutation(10 * n)[:n].astype(np.int64)
    size = rnd.integers(1, 12, n)
    topic = rnd.integers(0, 20, n)
    terms = np.concatenate([np.sort(rnd.choice(np.arange(t * dims // 20, min(dims, t * dims // 20 + 40)), s, replace=False)) for s, t in zip(size, topic, strict=True)]).astype(np.int32)
    return ids, terms, rnd.integers(1, 900_000, len(terms)), np.append(0, np.cumsum(size))


def test_bounds_hold_and_prune():
    rnd = np.random.default_rng(4)
    dims, n = 800, 3000
    ids, terms, x, off = random_ball(rnd, n, dims)
    ball = ls.Ball(ids, terms, x, off, dims)
    items = np.zeros((30, dims), np.int64)
    for i in range(30):
        t = int(rnd.integers(0, 20))
        items[i, rnd.choice(np.arange(t * 40, t * 40 + 40), 25, replace=False)] = rnd.integers(0, 12_000, 25)
    dense = np.zeros((n, dims), np.int64)
    dense[np.repeat(np.arange(n), np.diff(off)), terms] = x
    scores = dense @ items.T
    place = {int(i): k for k, i in enumerate(ids)}
    bounds = ball.bounds(items.astype(float))
    for k, (a, z) in enumerate(ball.spans):
        own = scores[[place[int(i)] for i in ball.ids[a:z]]]
        assert (bounds[k] >= own.max(axis=0)).all()
    best = [ls.Best(10, 0) for _ in items]
    leaves = sum(c is None for c in ball.children)
    scored = ls.search_ball(ball, items, best)
    for i, found in enumerate(best):
        want = sorted((-int(s), int(d)) for s, d in zip(scores[:, i], ids, strict=True) if s > 0)[:10]
        assert [(-int(s), int(d)) for s, d in zip(found.scores, found.ids, strict=True)] == want
    assert scored < 0.5 * leaves * len(items)  # subtrees were left out


def test_copies_make_exact_balls():
    n = 500
    ids = np.arange(n, dtype=np.int64)[::-1].copy()
    ball = ls.Ball(ids, np.tile(np.array([1, 5], np.int32), n), np.tile(np.array([7, 900_000]), n), np.arange(n + 1) * 2, 9)
    items = np.zeros((1, 9), np.int64)
    items[0, 5] = 3
    best = [ls.Best(4, 0)]
    scored = ls.search_ball(ball, items, best)
    assert best[0].ids.tolist() == [0, 1, 2, 3] and scored <= 16 and not ball.radii.any()
