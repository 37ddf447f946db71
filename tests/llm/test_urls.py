"""The url filter against a brute-force version, links and all, and against its SQL."""

import random
import re
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from tidemark.llm import url_filter
from tidemark.llm.search_queries import url_filter_sql

LINK = re.compile(r"""href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)""", re.I)
UP = str.maketrans(url_filter.UPPER, url_filter.LOWER)


def split(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(UP), m[2]) if m else ("", "")


def rule(host, path, rules):
    fits = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, default=None)


def brute(rows, rules=url_filter.RULES, rounds=url_filter.ROUNDS):
    seen, links = defaultdict(lambda: [0, 0]), defaultdict(int)
    for _, url, html in rows:
        host, path = split(url)
        if not host:
            continue
        best = rule(host, path, rules)
        if best:
            seen[host][best[1] == "block"] += 1
        for dst in {x.translate(UP) for x in LINK.findall(html or "")} - {host}:
            links[host, dst] += 1
    ranks = []
    for bad in (0, 1):
        seeds = {h: url_filter.SEED * n[bad] // sum(n) for h, n in seen.items()}
        ways = {(b, a) if bad else (a, b): n for (a, b), n in links.items()}
        out = defaultdict(int)
        for (a, _), n in ways.items():
            out[a] += n
        r = dict(seeds)
        for _ in range(rounds if links else 0):
            new = defaultdict(int, seeds)
            for (a, b), n in ways.items():
                new[b] += r.get(a, 0) // out[a] * n * 17 // 20
            r = new
        ranks.append(r)
    res = []
    for i, url, _ in rows:
        host, path = split(url)
        best, t, d = rule(host, path, rules), ranks[0].get(host, 0) if host else 0, ranks[1].get(host, 0) if host else 0
        res.append((i, host, path, best[2] if best else None, best[1] if best else "block" if d >= url_filter.TRACE and d > t else "allow", t, d))
    return res


def page_rows(seed=5, n=400):
    rnd = random.Random(seed)
    hosts = ["a.org", "b.org", "Example.ORG", "x.example.org", "c.com", "d.com", "e.com", "hub.net", *[f"h{i}.net" for i in range(12)]]
    rows = []
    for i in range(n):
        h = "hub.net" if i % 3 == 0 else rnd.choice(hosts)
        to = [rnd.choice(hosts).upper() if k else rnd.choice(hosts) for k in range(rnd.randint(0, 3))]
        html = "".join(f"<a {rnd.choice(['href', 'HREF'])}={q}{s}//{x}/p{q}>" for x in to for q, s in [(rnd.choice(["'", '"']), rnd.choice(["http:", "https:", ""]))])
        rows.append((i, f"https://{h}/{rnd.choice(['fr', 'de', 'es', 'en'])}/{rnd.randint(1, 30)}{rnd.choice(['', '?q=1', '#x'])}", html or None))
    rows += [(1000, None, "<a href='//a.org/'>"), (1001, "no host", None), (1002, "://", ""), (1003, "http://ORG", "x"), (1004, "a://b://c.org/es/", None), (None, "http://x.com/fr/" + "y" * 100_000, "z" * 100_000), (5, rows[5][1], rows[5][2])]
    return rows


def of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("n", F.lit(7)).withColumn("trust", F.lit("x"))


def plain(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_brute_force(spark):
    rows = page_rows()
    got = url_filter.judge(of(spark, rows))
    want = brute(rows)
    assert plain(got) == sorted(want, key=repr)
    by_method = [r for r in want if r[3] is None and r[1]]
    assert {r[4] for r in by_method} == {"allow", "block"}  # links decide both ways
    kept = url_filter.keep_allowed(of(spark, rows))
    assert kept.columns == of(spark, rows).columns
    assert sorted([r.page_id for r in kept.collect()], key=str) == sorted([r[0] for r in want if r[4] == "allow"], key=str)


def test_sql(spark):
    rows = page_rows(8)
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows)
    rel = con.sql("select page_id, host, path, rule, verdict, trust, distrust from (" + url_filter_sql() + ")")
    assert sorted([tuple(r) for r in rel.fetchall()], key=repr) == plain(url_filter.judge(of(spark, rows)))


def test_a_hot_host_is_spread(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.common.HOT_ROWS", 5)  # most hosts are hot then
    rows = page_rows(9, 200)
    assert plain(url_filter.judge(of(spark, rows))) == sorted(brute(rows), key=repr)


def test_rules(spark):
    rules = [("allow", "a.b", "/"), ("block", "a.b", "/"), ("block", "b", "/long/er"), ("allow", "x.a.b", "/l")]
    rows = [(1, "http://a.b/q", None), (2, "http://x.a.b/long/er", None), (3, "http://xa.b/long/erst", None), (4, "http://X.A.B/lo", None), (5, "http://a.b", None), (6, "http://b.c/", None)]
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(of(spark, rows), rules).collect()}
    assert got == {1: ("a.b/", "block"), 2: ("b/long/er", "block"), 3: ("b/long/er", "block"), 4: ("x.a.b/l", "allow"), 5: (None, "block"), 6: (None, "allow")}


def test_native_and_empty(spark):
    df = url_filter.judge(of(spark, page_rows()))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert url_filter.judge(of(spark, page_rows()).where("false")).collect() == []
