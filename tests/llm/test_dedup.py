"""Line, substring, MinHash and embedding deduplication against brute force on small tables."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, embedding_dedup, line_dedup, minhash_dedup, substring_dedup

STRIP = " \t\n\x0b\x0c\r"
random.seed(4)
WORDS = ["".join(random.choice("abcdefghijklmnop") for _ in range(random.randint(2, 8))) for _ in range(400)]


def sentence(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


def docs_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # columns whose names operators use inside must do no harm
    return df.withColumn("pos", F.lit("x")).withColumn("rep", F.lit(1)).withColumn("keys", F.lit(2)).withColumn("label", F.lit(3))


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute_lines(rows, min_chars=40, min_docs=5):
    held = defaultdict(set)
    key = lambda x: lower(x.strip(STRIP))
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held[key(x)].add(-(2**63) if d is None else d)
    best = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if key(x) not in best or best[key(x)] == (-(2**63) if d is None else d)]
        out.append((d, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return out


def line_rows():
    hot, other = sentence(12), sentence(15)
    rows = []
    for i in range(150):
        lines = [sentence(random.randint(1, 12)) for _ in range(random.randint(0, 6))]
        if i % 3 == 0:
            lines.insert(random.randint(0, len(lines)), "  " + hot.upper() + "\t")
        if i % 31 == 0:
            lines += [other, other]
        rows.append((i, "\n".join(lines)))
    return [*rows, (1000, None), (1001, ""), (1002, "\n\n"), (1003, hot + "\n" + "é" * 39 + "\n" + "é" * 40), (None, hot), (7, hot + "\nsecond row"), (7, hot + "\nsecond row"), (2000, "y" * 300_000 + "\n" + hot)]


@pytest.mark.parametrize("parts", [1, 9])
def test_lines(spark, parts):
    rows = line_rows()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that a hot line spans partitions
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        d = docs_of(spark, rows)
        got = line_dedup.kept_digests(d, line_dedup.line_keep_bitmaps(d)).collect()
        kept = line_dedup.drop_repeated_lines(d)
        assert kept.columns == d.columns and kept.count() == len(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_lines(rows)))
    assert line_dedup.line_keep_bitmaps(docs_of(spark, rows).limit(0)).count() == 0


def brute_classes(rows, width, need):
    sets = {}
    for d, t in rows:
        w = lower(t or "").encode().split()
        s = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
        sets[d] = s
    ids = sorted(sets)
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            u = len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= need * u:
                p, q = sorted((top(a), top(b)))
                up[q] = p
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.mark.parametrize("width", [4, 5])
def test_minhash(spark, width):
    rows = []
    for g in range(12):
        base = [random.choice(WORDS) for _ in range(random.randint(30, 200))]
        for _ in range(random.randint(1, 9)):
            w = list(base)
            for _ in range(random.randint(0, len(w) // 60 + 1)):
                w[random.randrange(len(w))] = random.choice(WORDS)
            rows.append((len(rows) * 7 % 1000 + g * 1000, " ".join(w)))
    rows += [(50_000 + i, " ".join(WORDS[:100])) for i in range(30)]
    rows += [(60_000, None), (60_001, ""), (60_002, " \n\t"), (60_003, "One two"), (60_004, "oNE  two"), (60_005, "one"), (60_006, "w " * 30_000)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.classes(docs_of(spark, rows), width).collect()}
    assert got == brute_classes(rows, width, 80)
    kept = minhash_dedup.drop_near_copies(docs_of(spark, [*rows, (None, "x y z")]), width)
    assert kept.where("doc_id >= 50000 and doc_id < 60000").count() == 1 and kept.where("doc_id is null").count() == 1
    assert minhash_dedup.classes(docs_of(spark, rows).limit(0)).count() == 0


def test_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 8)
    base = [random.choice(WORDS) for _ in range(150)]
    rows = []
    for i in range(60):
        w = list(base)
        w[random.randrange(150)] = f"n{i}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.classes(docs_of(spark, rows), 4).collect()}
    assert got == brute_classes(rows, 4, 80)


def test_weakly_alike_documents(spark):
    # many documents of similarity 0.2 to 0.5 with one another, and some true pairs among them
    rng = random.Random(6)
    fresh = lambda n: [f"x{rng.randrange(10**9)}" for _ in range(n)]
    shared = fresh(60)
    rows = []
    for i in range(120):
        k = rng.randint(22, 40)
        rows.append((i, " ".join(shared[:k] + fresh(60 - k // 2))))
    for i in range(0, 120, 10):
        rows.append((1000 + i, rows[i][1] + " tail"))
    want = brute_classes(rows, 4, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.classes(docs_of(spark, rows), 4).collect()}
    assert got == want and len({c for _, c in want.values()}) == 120


def test_a_group_in_which_not_all_link_with_the_smallest(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 6)
    rng = random.Random(2)
    fresh = lambda n: [f"y{rng.randrange(10**9)}" for _ in range(n)]
    words, rows = fresh(300), []
    for i in range(30):  # each is a few words on from the one before, so the ends don't link
        words = [*words[8:], *fresh(8)]
        rows.append(((i * 37) % 101, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.classes(docs_of(spark, rows), 4).collect()}
    assert got == brute_classes(rows, 4, 80)


def test_components_of_a_long_chain(spark):
    ids = list(range(200))
    random.shuffle(ids)
    # a chain of shuffled ids, one of ascending ids, a star
    pairs = [*zip(ids[:120], ids[1:120], strict=False), *[(i, i + 1) for i in range(1000, 2500)], *[(5000, 5001 + i) for i in range(300)], (500, 500), (None, 3)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {got[i] for i in ids[:120]} == {min(ids[:120])} and {got[i] for i in range(1000, 2501)} == {1000} and {got[5001 + i] for i in range(300)} == {5000}
    assert not {500, 3} & got.keys() - set(ids[:120])


def test_join_of_frequent_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 4)
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    left = spark.createDataFrame([(1, i) for i in range(60)] + [(k, k) for k in range(2, 40)], "k int, x int")
    right = left.groupBy("k").agg(F.count("*").alias("n")).where("k <> 7")
    assert sorted(map(tuple, common.join_counted(left, right, ["k"], "n").select("k", "x", "n").collect())) == sorted(map(tuple, left.join(right, "k").select("k", "x", "n").collect()))


def brute_vectors(x, labels, threshold):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = (u @ u.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(link, False)
    label = np.arange(len(x))
    while True:
        low = np.minimum(label, np.where(link, label[None, :], len(x)).min(1))
        low = low[low]
        if (low == label).all():
            return link.sum(1), label
        label = low


@pytest.mark.parametrize("two_levels", [False, True])
def test_many_cells_lose_no_link(spark, monkeypatch, two_levels):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    monkeypatch.setattr(embedding_dedup, "TILE", 50)
    if two_levels:
        monkeypatch.setattr(embedding_dedup, "TOP", 16)
    rng = np.random.default_rng(9)
    base = rng.normal(size=(700, 64))
    near = base[:600] + rng.normal(size=(600, 64)) * np.linalg.norm(base[:600], axis=1)[:, None] * rng.uniform(0.02, 0.06, 600)[:, None]
    x = np.concatenate([base, near, np.repeat(base[:3], 40, 0)]).astype(np.float32).astype(float)
    labels = np.concatenate([np.arange(700) % 2, np.arange(600) % 2, np.repeat(np.arange(3) % 2, 40)])
    df = spark.createDataFrame([(i, [float(c) for c in v], int(y)) for i, (v, y) in enumerate(zip(x, labels, strict=True))], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.link_vectors(df, 0.93, per_cell=6).collect()}
    n, comp = brute_vectors(x, labels, 0.93)
    assert n.sum() > 2000 and got == {i: (int(n[i]), int(comp[i])) for i in range(len(x))}


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 16))
    x = np.concatenate([x, x[:40] + rng.normal(size=(40, 16)) * 0.08, np.repeat(x[:1], 30, 0)])
    rows = [(i, [float(np.float32(v)) for v in r], int(i % 2)) for i, r in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] + [1.0] * 15, 1), (904, rows[0][1], None), (905, [1e-200] * 16, 0), (906, [2e-200] * 16, 0), (907, [1.0, 2.0], 0), (908, [], 0), (909, [2.0, 4.0], 0), (910, [5.0, -1.0], 0), (911, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("v", F.lit(1)).withColumn("cell", F.lit(2))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.link_vectors(df, 0.93, per_cell=20).collect()}
    fine = [(i, np.array(v) / np.max(np.abs(v)), y) for i, v, y in rows if i < 900 or i in (905, 906, 907, 909, 910, 911)]
    up = {r[0]: r[0] for r in rows}
    n = dict.fromkeys(up, 0)

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, v, y in fine:
        for b, w, z in fine:
            if a < b and y == z and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                n[a] += 1
                n[b] += 1
                p, q = sorted((top(a), top(b)))
                up[q] = p
    assert got == {i: (n[i], top(i), top(i) == i) for i in up}
    assert embedding_dedup.link_vectors(df.limit(0)).count() == 0


def test_gear_hash_is_the_rolling_one():
    raw = np.frombuffer(np.random.default_rng(0).bytes(3000), np.uint8)
    h, want = 0, []
    for b in raw:
        h = ((h << 1) + int(substring_dedup.GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    assert substring_dedup.gear_hashes(raw).tolist() == want
    # what lies before an insertion and some bytes after it is cut as before
    a = substring_dedup.cuts(raw)
    b = substring_dedup.cuts(np.concatenate([raw[:1000], raw[50:57], raw[1000:]]))
    assert set(a[a < 900]) == set(b[b < 900]) and {x + 7 for x in a if x > 1700} - {len(raw) + 7} <= set(b)


def words_of(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.mark.parametrize("seed", range(4))
def test_passages(spark, seed):
    rng = random.Random(seed)
    say = lambda n: words_of(rng, n)
    passage = say(90)
    rows = [(i, say(60) + "\n" + (say(7) + " " + passage + " " + say(9) if i in (3, 11, 20) else say(40))) for i in range(30)]
    rows += [(100, None), (101, ""), (None, passage), (102, "é" * 5000), (103, "z" * 100_000), (5, rows[5][1])]
    d = docs_of(spark, rows)
    got = substring_dedup.repeated_passages(d).collect()
    text = {i: t.encode() for i, t in rows if t}
    assert sorted((r.doc_id or -1, r.removed) for r in got) == [(-1, False), (3, True), (11, True), (20, True)]
    for r in got:
        part = text[r.doc_id][r.start : r.start + r.n_bytes]
        assert part in text[r.other_doc_id] and part.decode() in passage + " "
        if r.removed:
            assert part.decode().strip() == passage  # up to its true ends
    clean = {r.doc_id: r.text for r in substring_dedup.remove_repeats(d).collect()}
    assert clean[None] == passage and passage not in clean[11] and len(clean[11]) >= len(rows[11][1]) - len(passage) - 2 and clean[7] == rows[7][1] and clean[100] is None
    assert substring_dedup.repeated_passages(d.limit(0)).count() == 0


def test_many_passages_are_found_whole(spark):
    """Recall and covered share by length, each passage in two documents of random words (README has the figures)."""
    rng = random.Random(12)
    rows, planted = [], {}
    for n_bytes in (200, 300, 600):
        for _ in range(120):
            p = words_of(rng, n_bytes // 5)[:n_bytes].strip()
            i = len(rows)
            rows += [(i, words_of(rng, 40) + " " + p + " " + words_of(rng, 40)), (i + 1, words_of(rng, 30) + "\n" + p + "\n" + words_of(rng, 50))]
            planted[i + 1] = (n_bytes, p.encode())
    got = substring_dedup.repeated_passages(docs_of(spark, rows)).where("removed").collect()
    text = dict(rows)
    for n_bytes in (200, 300, 600):
        own = {i: p for i, (n, p) in planted.items() if n == n_bytes}
        share = []
        for i, p in own.items():
            at = text[i].encode().index(p)
            held = {x for r in got if r.doc_id == i for x in range(r.start, r.start + r.n_bytes)}
            assert held <= set(range(at - 1, at + len(p) + 1))
            share.append(len(held & set(range(at, at + len(p)))) / len(p))
        found = [x for x in share if x]
        print(n_bytes, len(found) / len(share), sum(share) / len(share), min(found))
        assert len(found) >= 0.9 * len(share) and min(found) >= 0.95
    assert {r.doc_id for r in got} <= set(planted)


@pytest.mark.parametrize("hot", [1_000, 2])  # rows of a window from which on it is split
def test_no_text_is_lost(spark, monkeypatch, hot):
    """Overlapping passages of many documents: whatever goes from a document stays in a smaller one."""
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    rng = random.Random(3)
    pool = [words_of(rng, 60) + rng.choice(["é", "日本", ""]) for _ in range(6)]
    rows = [(i, "é".join(rng.choice(pool) if rng.random() < 0.6 else words_of(rng, 25) for _ in range(rng.randint(1, 5)))) for i in range(60)]
    rows += [(7, rows[3][1]), (7, rows[7][1]), (90, rows[8][1])]
    d = docs_of(spark, rows)
    got = substring_dedup.repeated_passages(d).collect()
    text = {i: t for i, t in rows[:60]} | {90: rows[-1][1]}
    by_doc = defaultdict(list)
    for r in got:
        if r.doc_id != 7:
            by_doc[r.doc_id].append((r.start, r.start + r.n_bytes))
            text[r.doc_id].encode()[r.start : r.start + r.n_bytes].decode()  # no character is split
    for spans in by_doc.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    clean = [r.text for r in substring_dedup.remove_repeats(d).collect()]
    assert len(clean) == len(rows)
    left = "\x00".join(clean)
    for p in pool:
        pieces = [p[i : i + 20] for i in range(0, len(p) - 20, 10)]
        assert all(x in left for x in pieces)
        assert left.count(p[100:200]) <= 3  # the first copy, and those of the repeated id at most


def test_passage_whose_pieces_stand_elsewhere(spark):
    rng = random.Random(7)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))
    passage = words(90)
    w = passage.split()
    rows = [(i, words(30) + " " + " ".join(w[3 * i : 3 * i + 9]) + " " + words(30)) for i in range(28)]  # pieces too short to count
    rows += [(100, words(40) + " " + passage + " " + words(40)), (101, words(50) + " " + passage + " " + words(9))]
    rows += [(50, words(9) + " " + " ".join(w[20:70]) + " " + words(9))]  # a piece that counts, in a smaller document
    got = substring_dedup.repeated_passages(docs_of(spark, rows)).collect()
    text = {i: t.encode() for i, t in rows}
    assert {r.doc_id for r in got} == {50, 100, 101}
    for d in (100, 101):
        held = {x for r in got if r.doc_id == d for x in range(r.start, r.start + r.n_bytes)}
        a = text[d].index(passage.encode())
        assert held <= set(range(a - 1, a + len(passage) + 1)) and len(held) >= len(passage) - (150 if d == 100 else 4)
        assert len(held) == max(held) - min(held) + 1
    assert any(r.removed and r.other_doc_id == 50 for r in got if r.doc_id == 100)
    clean = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs_of(spark, rows)).collect()}
    assert clean[50] == rows[-1][1] and len(clean[101]) < len(rows[-2][1]) - len(passage) + 150
