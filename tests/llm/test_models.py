"""Quality, toxicity, licences, fingerprints and encoding."""

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, fingerprint, license_scan, quality, queries, toxicity

SF = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.1")
random.seed(8)
WORDS = ["".join(random.choice("aeioulmnrst") for _ in range(random.randint(2, 8))) for _ in range(500)]
text_of = lambda n: " ".join(random.choice(WORDS) for _ in range(n))
ODD = [(9000, None), (9001, ""), (9002, " \n"), (9003, "q" * 50_000), (None, "a b c"), (9004, "same"), (9004, "same")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit("clash")).withColumn("score", F.lit(0)).withColumn("features", F.lit(1))


def test_quality(spark):
    rows = [(i, (text_of(60).capitalize() + ".") if i % 3 else " ".join([random.choice(WORDS)] * 60)) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)] + [(None, 1), (3, None)], "doc_id long, quality int")
    d = frame(spark, [*rows, *ODD])
    got = quality.score_quality(d, labels).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 600 and r.held_out]
    assert len(held) > 60 and all(quality.is_held_out(r.doc_id) for r in held)
    assert np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.97
    # labels of held-out rows are never used
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.score_quality(d, flipped).collect()
    assert sorted((r.doc_id or -1, r.score) for r in got) == sorted((r.doc_id or -1, r.score) for r in again)
    assert {r.score for r in quality.score_quality(d, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(d.limit(0), labels).count() == 0


def test_toxicity(spark):
    bad = ["grumbolt", "grumbleth", "snarkish"]
    rows = [(i, text_of(50) + (" " + " ".join(random.choices(bad, k=1 + i % 7)) if i % 4 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(1, 0), (None, 1)], "doc_id long, toxic int")
    d = frame(spark, [*rows, *ODD])
    model = toxicity.train(d.select("doc_id", "text"), labels)
    assert sorted(model["thresholds"]) == model["thresholds"]
    graded = toxicity.grade(d, model)
    assert graded.columns == [*d.columns, "p_toxic", "severity", "grade", "_toxic"] and {r.toxic for r in graded.collect()} == {"clash"}
    got = toxicity.grade(d.drop("toxic"), model).collect()
    unseen = {r.doc_id: r for r in got if r.doc_id is not None and 400 <= r.doc_id < 600}
    assert np.mean([r.toxic == (i % 4 == 0) for i, r in unseen.items()]) > 0.98
    light, heavy = ([r.severity for i, r in unseen.items() if i % 4 == 0 and i % 7 in k] for k in ((0, 1), (5, 6)))
    assert np.mean(heavy) > np.mean(light)
    assert not any(r.toxic for r in got if r.doc_id is None or r.doc_id >= 9000)
    kept = toxicity.drop_toxic(d, model)
    assert kept.columns == d.columns and kept.where("doc_id >= 9000 or doc_id is null").count() == len(ODD)
    mine = d.withColumn("grade", F.lit("seven")).withColumn("__toxic", F.lit(5))
    assert {(r.toxic, r.grade, r["__toxic"]) for r in toxicity.drop_toxic(mine, model).collect()} == {("clash", "seven", 5)}
    assert not any(r.toxic for r in toxicity.grade(d.drop("toxic"), toxicity.train(d.select("doc_id", "text"), labels.limit(0))).collect())
    assert toxicity.grade(d.limit(0), model).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")
def test_held_out_figures(spark):
    """Both classifiers on labelled rows that they haven't seen: a fifth by crc32 for quality, half by parity of the id for toxicity."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    q = quality.score_quality(docs, labels.select("doc_id", "quality")).where("held_out").join(labels, "doc_id").collect()
    assert len(q) > 50 and np.mean([r.predicted == r.quality for r in q]) >= 0.97
    model = toxicity.train(docs, labels.where("doc_id % 2 = 0").select("doc_id", "toxic"))
    t = toxicity.grade(docs, model).join(labels.where("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("y")), "doc_id").collect()
    caught, false = [r.toxic for r in t if r.y == 1], [r.toxic for r in t if r.y == 0]
    assert len(caught) > 5 and np.mean(caught) >= 0.9 and np.mean(false) <= 0.02, (np.mean(caught), np.mean(false))


def test_quality_scores_are_those_of_the_tables(spark):
    """The fitted tables added up by hand give the scores, and a tree's tables are those of a plain search."""
    g, h = np.array([3.0, 2.5, -1.0, -2.0, 0.5, 0.4]), np.ones(6)
    out, gain = quality._tree(g, h, 2, 1.0, 0.0)
    best = max(range(1, 6), key=lambda m: g[:m].sum() ** 2 / m + g[m:].sum() ** 2 / (6 - m))
    assert np.allclose(out, [g[:best].mean()] * best + [g[best:].mean()] * (6 - best)) and gain > 0
    m = quality.AdditiveModel(0.1, [[0.5], [1.0, 2.0]], [[-1.0, 1.0], [0.0, 0.2, 0.4]], [(0, 1)], [[0.5], [1.5]], [[[0.0, 0.1], [0.2, 0.3]]])
    x = np.array([[0.0, 0.0], [0.7, 1.7], [0.5, 2.0]])
    want = [0.1 - 1 + 0 + 0, 0.1 + 1 + 0.2 + 0.3, 0.1 + 1 + 0.4 + 0.3]
    assert np.allclose(m.logit(x), want) and np.allclose(m.score(x), 1 / (1 + np.exp(-np.array(want))))


def test_licences(spark):
    rows = [(i, text_of(20) + "\n" + license_scan.TEMPLATES[i][1] + "\n" + text_of(9)) for i in range(len(license_scan.TEMPLATES))]
    other = [(500 + i, t) for i, t in enumerate(license_scan.OTHER)]
    d = frame(spark, [*rows, *other, *ODD, *[(700 + i, "Released under the MIT License.") for i in range(40)]])
    model = license_scan.train(d.select("doc_id", "text"))
    got = {r.doc_id: r.families for r in license_scan.scan_documents(d, model).collect()}
    right = sum(got[i] == f for i, (f, _) in enumerate(license_scan.TEMPLATES))
    assert right >= len(license_scan.TEMPLATES) - 2
    assert all(got[i] == "" for i, _ in [*other, *ODD]) and got[700] == "mit"
    rows = license_scan.scan_documents(d, model)
    assert rows.count() == d.count() and license_scan.scan_documents(d.limit(0), model).count() == 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_licence_lines_without_a_licence_word(spark):
    lines = {
        "Available under CC BY 4.0.": "cc-by", "Distributed under CC BY-SA 4.0.": "cc-by-sa", "Available under CC0 1.0.": "cc0", "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: Apache-2.0": "apache",
        "you may not use this file except in compliance with the": "apache", "and associated documentation files, to deal in the Software without restriction": "mit", "// SPDX-License-Identifier: GPL-2.0-only": "gpl",
    }
    plain = ["mit", "Mit", "the", "2", "the of", "available under the bridge", "It may be used in the following year.", text_of(3), text_of(30)]
    rows = [*enumerate(lines), *[(100 + i, t) for i, t in enumerate(plain)], *[(500 + i, text_of(20)) for i in range(300)]]
    got = {r.doc_id: r.families for r in license_scan.scan_documents(frame(spark, rows)).collect()}
    assert [got[i] for i in range(len(lines))] == list(lines.values())
    assert not any(f for i, f in got.items() if i >= 100)


def test_every_line_that_a_template_can_confirm_is_scored(spark):
    cut_up = [" ".join(w[i : i + n]) for _, t in license_scan.TEMPLATES for w in [t.split()] for n in (1, 2, 4, 9) for i in range(0, len(w), 7)]
    rows = [(i, " ".join([*t.split(), *text_of(i % 9).split()])) for i, t in enumerate(cut_up)]
    known = license_scan.neighbour_hashes(spark)
    got = {r.doc_id: (r.ok, set(r.g)) for r in frame(spark, rows).select("doc_id", license_scan.has_neighbours(F.col("text"), known).alias("ok"), license_scan.word_ngrams(F.col("text")).alias("g")).collect()}

    def grams(t):
        w = re.findall("[a-z0-9]+", t.lower())
        return {" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)}

    long = lambda t: {g for g in grams(t) if " " in g}
    shapes = [(f, long(t)) for f, t in license_scan.TEMPLATES]
    want = {}
    for i, t in rows:
        for f, x in shapes:
            if n := len(long(t) & x):
                want.setdefault(i, {})[f] = max(want.get(i, {}).get(f, 0), n / max(3, min(len(long(t)), len(x))))
        assert got[i] == (i in want, grams(t))
    shares = {r.line: r.shares for r in license_scan._wordings(license_scan._cases(frame(spark, rows).select("doc_id", "text"))).collect()}
    for i, t in rows:
        assert {k: pytest.approx(v) for k, v in want.get(i, {}).items()} == shares.get(t, {})


def test_licences_in_other_wordings_and_unknown_licences(spark):
    unseen = {
        "This file is licensed under the Apache License, Version 2.0 (the \"License\").": "apache", "Licensed under the MIT License, see the file for details.": "mit", "Code released under the MIT license": "mit",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY": "mit",
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.": "bsd",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3": "gpl",
        "You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation": "gpl",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.": "cc-by-sa", "This program is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl",
    }
    unknown = ["Licensed under the Open Software License version 3.0", "All rights reserved by the office of the town.", "Copyright 2021 the authors of the paper", "Distributed under the Boost Software License, Version 1.0.", "This software is the property of its owner.", "A licence from the council is needed to sell food in the street."]
    rows = [*enumerate(unseen), *[(100 + i, t) for i, t in enumerate(unknown)], *[(500 + i, text_of(20)) for i in range(200)]]
    got = {r.doc_id: r.families for r in license_scan.scan_documents(frame(spark, rows)).collect()}
    assert sum(got[i] == f for i, f in enumerate(unseen.values())) >= len(unseen) - 1, {t: got[i] for i, t in enumerate(unseen)}
    assert sum(got[100 + i] == "" for i in range(len(unknown))) >= len(unknown) - 1, {t: got[100 + i] for i, t in enumerate(unknown)}
    assert not any(f for i, f in got.items() if i >= 500)


def paragraphs(t):
    return Counter(re.findall(r"[^\n]{1,256}", t))


def likeness(a, b):
    x, y = paragraphs(a), paragraphs(b)
    n = sum(x.values()) + sum(y.values())
    return 1.0 if not n else 1 - (sum((x - y).values()) + sum((y - x).values())) / n


def test_fingerprints(spark):
    rows = [(i * 3, "\n".join(text_of(random.randint(1, 60)) for _ in range(random.randint(0, 12)))) for i in range(40)]
    rows += [(200, None), (201, ""), (202, "ü" * 999), (203, "same\nsame\n\nsame"), (204, "same\nsame\n\nsame"), (205, "\n".join(map(str, range(900)))), (206, "\n".join(map(str, range(5, 900))))]
    rows += [(300, "b\nc" * 9), (300, "b\nc" * 9), (300, "b\nc" * 9), (301, "\n".join(f"{i % 999} a" for i in range(60_000)) + "x" * 90_000), (302, "end")]
    # columns whose names the operator uses inside must do no harm
    d = frame(spark, rows).withColumn("a", F.lit("x")).withColumn("h", F.lit(0)).withColumn("n", F.lit(0)).withColumn("kid", F.lit(1)).withColumn("kind", F.lit(1))
    got = {}
    for r in fingerprint.fingerprints(d).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    want = {}
    for (i, t), (_, nxt) in zip(rows, [*rows[1:], rows[0]], strict=True):
        t, nxt = t or "", nxt or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        want.setdefault(i, []).append((len(t), hashlib.sha256(edited.encode()).hexdigest(), round(likeness(t, edited), 9), round(likeness(t, nxt), 9)))
    for i, w in want.items():
        assert sorted(w) == sorted((r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got[i])
    assert got[203][0].fingerprint == got[204][0].fingerprint != got[205][0].fingerprint
    one = fingerprint.fingerprints(frame(spark, [(None, "a\nb"), (None, "a\nb")])).collect()
    assert len(one) == 2 and all(r.near_next == 1.0 for r in one)
    assert fingerprint.fingerprints(frame(spark, rows).limit(0)).count() == 0


def test_fingerprints_subtract(spark):
    numbers = random.Random(1).sample(range(1, 2**62), 60)
    a, b = numbers[:30], numbers[20:]
    r = fingerprint.sketches(spark.createDataFrame([(1, a, b)], "k int, a array<long>, b array<long>"), ["k"], {"a": "x", "b": "y"}).first()

    def cells(s):
        size, body = s.split("=")
        out = {}
        for c in body.split(","):
            at, n, k, chk = c.split(":")
            out[int(at, 16)] = (int(n), int(k, 16), int(chk, 16))
        return int(size), out

    (m, x), (_, y) = cells(r.x), cells(r.y)
    assert m == fingerprint.CELLS and sum(n for n, _, _ in x.values()) == 3 * len(a)
    zero = (0, 0, 0)
    diff = {c: tuple((p - q) if i == 0 else p ^ q for i, (p, q) in enumerate(zip(x.get(c, zero), y.get(c, zero), strict=True))) for c in {*x, *y}}
    pure = {k for n, k, _ in diff.values() if abs(n) == 1}
    assert pure & ({*a} ^ {*b}) and not pure & ({*a} & {*b})


def test_peeling_recovers_the_digests(spark, monkeypatch):
    a, b = list(range(1, 400)), list(range(300, 420))
    df = spark.createDataFrame([(1, a, b), (2, [], []), (3, None, [7])], "k int, a array<long>, b array<long>")
    r = fingerprint.differences(df, ["k"]).orderBy("k").collect()
    assert (list(r[0].gone_a), list(r[0].gone_b)) == (list(range(1, 300)), list(range(400, 420))) and r[0].cells > fingerprint.CELLS
    assert r[1].likeness == 1.0 and r[2].likeness == 0.0 and list(r[2].gone_b) == [7]
    monkeypatch.setattr(fingerprint, "ROUNDS", 1)  # no size is enough: compared digest by digest
    r = fingerprint.differences(df, ["k"]).orderBy("k").first()
    assert (list(r.gone_a), list(r.gone_b), r.cells) == (list(range(1, 300)), list(range(400, 420)), 0)


def test_encoding_is_that_of_the_public_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.tokenizer_path()
    known = tokenizers.Tokenizer.from_file(path)
    known.no_truncation()
    known.no_padding()
    letters = [chr(c) for c in [*range(1, 0x250), *range(0x391, 0x3CA), 0x2028, 0x3042, 0x4E00, 0x1F600, 0x130, 0x301, 0xB2, 0x2160]]
    rows = [(i, "".join(random.choice(letters) for _ in range(random.randint(0, 80)))) for i in range(300)]
    rows += [(400, "<|startoftext|>Hi<|endoftext|> <|ENDOFTEXT|>'s they've"), (401, "a" * 5000 + " " + "aaa " * 300), (402, "ΑΣ ΣΑΣ"), *ODD]
    for r, (i, t) in zip(sorted(bpe.encode(frame(spark, rows), path).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0)), sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)), strict=True):
        want = known.encode(t or "", add_special_tokens=False).ids
        assert r.doc_id == i and list(r.ids) == want and r.n_tokens == len(want) and r.decoded == known.decode(want, skip_special_tokens=False)
    assert bpe.encode(frame(spark, rows).limit(0), path).count() == 0
