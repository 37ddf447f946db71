"""Allow or block urls: rules for hosts and paths first, else the host's standing in the link graph.

Hosts that allow rules reach are trusted seeds, hosts that block rules reach
are distrusted seeds.  Trust flows along links (a trusted host vouches for
those it links to), distrust flows against them (who links to a bad host is
suspect): two personalised PageRanks over host edges.  A host whose distrust
exceeds its trust, and isn't a trace, is blocked.

Ranks are whole numbers of billionths of a seed, and every division rounds
down, so results don't depend on the order in which parts are added.
Everything is DataFrame functions; a step never gathers all rows of a host.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_counted, written

#: (verdict, host, start of the path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
MOST_RULES = 1_000  # rules become part of the plan
SEED = 1_000_000_000  # the rank that a seed with rules of one kind only gives in each round
DAMPING = (17, 20)  # of a rank passes on
ROUNDS = 12  # 0.85 ** 12 = 0.14 of a seed's rank is still on its way then
TRACE = 1_000_000  # distrust below this doesn't block

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits as a struct (length, verdict, rule), null if none does; of equal rules with two verdicts, block."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; they become part of the plan, so give {MOST_RULES} at most")
    fits = []
    for verdict, h, start in rules:
        found = ((host == h) | host.endswith(f".{h}")) & path.startswith(start)
        fits.append(F.when(found, F.struct(F.lit(len(h + start)).alias("length"), F.lit(verdict).alias("verdict"), F.lit(h + start).alias("rule"))))
    none = F.lit(None).cast("struct<length:int,verdict:string,rule:string>")
    return F.greatest(none, none, *fits)


def host_links(pages: DataFrame, host: str = "__host", html: str = "html") -> DataFrame:
    """(src, dst, n): n pages of host src link to the other host dst by a url with a host; a page counts once for a dst."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)), lambda x: F.translate(x, UPPER, LOWER)))
    links = pages.select(F.col(host).alias("src"), F.explode(found).alias("dst")).where((F.col("src") != "") & (F.col("src") != F.col("dst")))
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) from ``seeds`` (host, trust, distrust) over ``links`` (src, dst, n).

    In each round a host gives 17/20 of its trust to the hosts it links to, by
    the numbers of pages, and as much of its distrust to those that link to
    it; every seed gives its own again.  Hosts that only links name count too.
    A hub with a third of all links is joined where its links are
    (``join_counted``), and what arrives is added up before it's shuffled.
    """
    ways = []
    for kind, a, b in (("trust", "src", "dst"), ("distrust", "dst", "src")):
        ways.append(links.select(F.lit(kind).alias("kind"), F.col(a).alias("at"), F.col(b).alias("to"), "n"))
    ways = written(ways[0].unionByName(ways[1]))
    out = written(ways.groupBy("kind", "at").agg(F.sum("n").alias("out"), F.count("*").alias("ways")))
    start = written(seeds.select("host", F.explode(F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))).alias("kind", "rank")).where("rank > 0"))
    ranks = start
    for _ in range(0 if ways.isEmpty() else rounds):
        # as many rows as hosts that pass something on; unique by (kind, at)
        share = written(out.join(ranks.withColumnRenamed("host", "at"), ["kind", "at"]).select("kind", "at", F.expr("rank div out").alias("share"), "ways").where("share > 0"))
        moved = join_counted(ways, share, ["kind", "at"], "ways").select("kind", F.col("to").alias("host"), F.expr(f"share * n * {DAMPING[0]} div {DAMPING[1]}").alias("rank"))
        ranks = written(moved.unionByName(start).groupBy("kind", "host").agg(F.sum("rank").alias("rank")))
    by = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0)).alias(k) for k in ("trust", "distrust")}
    return ranks.groupBy("host").agg(by["trust"], by["distrust"])


def host_standing(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, rounds: int = ROUNDS, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, n, trust, distrust) of every host with pages, n of them; rows without a host are left out.

    A host's seed is the share of its pages with a rule that are allowed
    (trust) or blocked (distrust).
    """
    p = pages.select(host_of(F.col(url_col)).alias("__host"), path_of(F.col(url_col)).alias("path"), F.col(html_col).alias("html")).where("__host <> ''")
    seen = p.select("__host", longest_rule(F.col("__host"), F.col("path"), rules)["verdict"].alias("v")).groupBy("__host")
    hosts = written(seen.agg(F.count("*").alias("n"), F.count(F.when(F.col("v") == "allow", 1)).alias("good"), F.count(F.when(F.col("v") == "block", 1)).alias("bad")).withColumnRenamed("__host", "host"))
    part = lambda c: F.expr(f"coalesce({SEED} * {c} div nullif(good + bad, 0), 0)")
    ranks = propagate(hosts.select("host", part("good").alias("trust"), part("bad").alias("distrust")), host_links(p), rounds)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return written(hosts.select("host", "n").join(ranks, "host", "left").select("host", "n", zero("trust"), zero("distrust")))


def _with_standing(pages: DataFrame, standing: DataFrame) -> DataFrame:
    """``pages`` with trust and distrust of the host in ``__host``; a page without a host has none of either."""
    both = standing.select(F.col("host").alias("__host"), F.col("n").alias("__n"), F.col("trust").alias("__trust"), F.col("distrust").alias("__distrust"))
    none = F.lit(0).cast("long")
    named = join_counted(pages.where("__host <> ''"), both, ["__host"], "__n").drop("__n")
    return named.unionByName(pages.where("__host = ''").select("*", none.alias("__trust"), none.alias("__distrust")))


def _verdict(best: Column) -> Column:
    blocked = (F.col("__distrust") >= TRACE) & (F.col("__distrust") > F.col("__trust"))
    return F.coalesce(best["verdict"], F.when(blocked, "block").otherwise("allow"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, rounds: int = ROUNDS, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every page with host, path, rule, verdict, trust and distrust of its host.

    The longest rule that fits decides; without one the host does: ``block``
    if its distrust is at least ``TRACE`` and exceeds its trust, else
    ``allow``.

    Edge cases: a null url, or one without ``://``, has an empty host and path,
    fits no rule, has no standing and is allowed; null html links nowhere;
    repeated rows stay and count again in seeds and links; of rules of one
    length that fit, block wins, and equal distrust and trust allow; long urls
    and pages are read whole; other columns are ignored; an empty table gives
    no rows.
    """
    standing = host_standing(pages, rules, rounds, url_col, html_col)
    p = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("__host"), path_of(F.col(url_col)).alias("path"))
    p = _with_standing(p.withColumn("best", longest_rule(F.col("__host"), F.col("path"), rules)), standing)
    return p.select("page_id", F.col("__host").alias("host"), "path", F.col("best.rule").alias("rule"), _verdict(F.col("best")).alias("verdict"), F.col("__trust").alias("trust"), F.col("__distrust").alias("distrust"))


def keep_allowed(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, rounds: int = ROUNDS, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The rows of ``pages`` that ``judge`` allows, repeated rows and rows without a host among them, all columns as they are."""
    standing = host_standing(pages, rules, rounds, url_col, html_col)
    p = _with_standing(pages.withColumn("__host", host_of(F.col(url_col))), standing)
    return p.where(_verdict(longest_rule(F.col("__host"), path_of(F.col(url_col)), rules)) == "allow").select(*[F.col(f"`{c}`") for c in pages.columns])
