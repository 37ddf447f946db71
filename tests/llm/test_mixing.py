import random

from pyspark.sql import functions as F

from tidemark.llm import mixing as M


def fill(budget, kids):
    """Brute force: raise the level until the budget is used."""
    give = {k: 0.0 for k in kids}
    open_ = {k for k, (w, c) in kids.items() if w > 0 and c > 0}
    left = budget
    while open_ and left > 1e-9:
        total = sum(kids[k][0] for k in open_)
        full = [k for k in open_ if give[k] + left * kids[k][0] / total >= kids[k][1] - 1e-9]
        if not full:
            for k in open_:
                give[k] += left * kids[k][0] / total
            break
        step = min((kids[k][1] - give[k]) / kids[k][0] for k in open_)
        for k in open_:
            give[k] += step * kids[k][0]
        left -= step * total
        open_ = {k for k in open_ if give[k] < kids[k][1] - 1e-9}
    return give


def test_water_fill_against_brute_force(spark):
    random.seed(3)
    for _ in range(3):
        kids = {f"k{i}": (random.choice([0.0, 0.5, 1.0, 3.0]), float(random.randint(0, 50))) for i in range(7)}
        budget = 90.0
        rows = spark.createDataFrame([("p", k, w, c, budget) for k, (w, c) in kids.items()], "p string, k string, weight double, cap double, budget double")
        got = {r.k: r.give for r in M.water_fill(rows, ["p"], "k").collect()}
        want = fill(budget, kids)
        assert all(abs(got[k] - want[k]) < 1e-6 for k in kids), (kids, got, want)


def test_mix_keeps_budgets_and_odd_rows(spark):
    rows = [(i, "w " * (i % 7 + 1), "en" if i % 3 else "de", f"src{i % 4}") for i in range(400)]
    rows += [(None, "a b", "en", "src1"), (1000, None, None, None), (1001, "", "fr", "nowhere"), (5, "w w", "en", "src1"), (5, "w w", "en", "src1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("domain", F.lit("clash")).withColumn("copies", F.lit(1))
    w = M.default_weights(docs)
    out = M.mix(docs, w, share=0.5, epochs=2).collect()
    total = sum(max(1, len((t or "").split())) for _, t, _, _ in rows)
    used = sum(r.n_tokens * r.copies for r in out)
    leaves = {(r.domain, r.lang, r.source): r.leaf_budget for r in out}
    assert abs(sum(leaves.values()) - total / 2) < 7 * len(leaves)
    for leaf, b in leaves.items():
        took = sum(r.n_tokens * r.copies for r in out if (r.domain, r.lang, r.source) == leaf)
        assert b - 1e-6 <= took < b + 8
    assert used >= total / 2 - 8
    again = M.mix(docs, w, share=0.5, epochs=2).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert M.mix(docs.limit(0), w).count() == 0
    kept = M.keep_mixed(docs, w, 1.0)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def brute_tree(leaves, weights, budget, epochs):
    """Budgets of leaves by recursion: {path: tokens} and {(level, name): weight}."""
    w = lambda d, name: weights.get((M.LEVELS[d], name), 1.0)

    def cap(path):
        if w(len(path) - 1, path[-1]) <= 0:
            return 0.0
        if len(path) == 3:
            return float(leaves[path] * epochs)
        return sum(cap(k) for k in {p[: len(path) + 1] for p in leaves if p[: len(path)] == path})

    out = {}

    def share(path, give):
        if len(path) == 3:
            out[path] = give
            return
        kids = sorted({p[: len(path) + 1] for p in leaves if p[: len(path)] == path})
        for k, g in fill(min(give, sum(map(cap, kids))), {k: (w(len(path), k[-1]), cap(k)) for k in kids}).items():
            share(k, g)

    share((), float(budget))
    return out


def test_budgets_of_three_levels_against_brute_force(spark):
    rng = random.Random(9)
    for _ in range(2):
        leaves = {(f"d{a}", f"l{b}", f"s{c}"): rng.randint(1, 2000) for a in range(3) for b in range(3) for c in range(4) if rng.random() < 0.7}
        weights = {("domain", "d0"): 3.0, ("lang", "l1"): 0.0, ("lang", "l2"): 5.0, ("source", "s0"): rng.choice([0.0, 2.0]), ("source", "s3"): 0.5}
        for share in (0.3, 0.9, 1.5):
            budget = share * sum(leaves.values())
            want = brute_tree(leaves, weights, budget, 1)
            got = M.budgets(spark.createDataFrame([(*k, float(v)) for k, v in leaves.items()], "domain string, lang string, source string, tokens double"), spark.createDataFrame([(*k, v) for k, v in weights.items()], "level string, name string, weight double"), budget, 1)
            have = {(r.domain, r.lang, r.source): r.budget for r in got.collect()}
            assert have.keys() == want.keys() and all(abs(have[k] - want[k]) < 1e-6 * (1 + want[k]) for k in want)


def test_what_a_source_of_weight_0_leaves_goes_to_the_others(spark):
    # a domain with a source of weight 0 must not hold back tokens that it can't give
    rows = [(i, "w " * 100, "en", "src0") for i in range(10)] + [(50, "w " * 50, "en", "src3")] + [(100 + i, "w " * 100, "en", "src1") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    weights = spark.createDataFrame([("source", "src0", 0.0)], "level string, name string, weight double")
    out = M.mix(docs, weights, share=0.5, epochs=1).collect()
    took = sum(r.n_tokens for r in out)
    assert 1525 <= took < 1525 + 100 and not any(r.source == "src0" for r in out)


def test_chosen_prefixes_against_brute_force(spark):
    import hashlib

    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(1, 30), rng.choice(["en", "de", "fr"]), f"src{rng.randint(0, 5)}") for i in range(500)]
    rows += [(7, rows[7][1], rows[7][2], rows[7][3]), (600, "w " * 60_000, "en", "src1"), (601, None, "en", "src0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("o", F.lit("x")).withColumn("place", F.lit(0)).withColumn("row_hash", F.lit(1))
    n = lambda t: max(1, len((t or "").split()))
    number = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    path = lambda r: (f"domain{int(r[3][3:]) % 3}", r[2], r[3])
    leaves = {}
    for r in rows:
        leaves[path(r)] = leaves.get(path(r), 0) + n(r[1])
    weights = {(a, b): w for a, b, w in M.WEIGHTS}
    plan = brute_tree(leaves, weights, 0.5 * sum(leaves.values()), 2)
    want = []
    for leaf, budget in plan.items():
        whole = int(budget / leaves[leaf] + 1e-12)
        rest, turn, before = budget - whole * leaves[leaf], number(f"11|epoch|{whole}"), 0
        mine = [(number(f"11|{r[0]}|" + hashlib.md5((r[1] or "").encode()).hexdigest()) ^ turn, r) for r in rows if path(r) == leaf]
        for _, r in sorted(mine, key=lambda x: (x[0], x[1][0])):
            if whole + (before < rest):
                want.append((r[0], n(r[1]), whole + (before < rest)))
            before += n(r[1])
    got = [(r.doc_id, r.n_tokens, r.copies) for r in M.mix(docs, M.default_weights(docs), share=0.5, epochs=2, seed=11).collect()]
    assert sorted(got) == sorted(want)
