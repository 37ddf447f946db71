"""Mixing sources to target weights by hierarchical budgets, in DataFrame functions only.

Leaves of the tree are (domain, language, source).  What a subtree can give is
added up from the leaves (tokens times the allowed epochs; nothing below a
weight of 0).  A budget of tokens then goes down the tree by the weights of the
children, and no child gets more than its subtree can give: what it can't use
goes to its siblings by their weights (water-filling), and only what all
siblings together can't use went to the parent's own siblings, as shares are
capped by whole subtrees from the top.  A leaf reads its documents in a seeded
order, epoch by epoch, and keeps the prefix that reaches its budget.

Prefix sums are taken in two steps, over slices of the seeded order and inside
a slice, so that a source with a third of all documents is spread over many
tasks; the number of slices grows with the largest leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import cut

LEVELS = ("domain", "lang", "source")
ORDER_BITS = 60  # of a place in the seeded order
SLICE_ROWS = 1 << 16  # documents aimed at for a slice of the largest leaf


def domain_of(source: Column) -> Column:
    """Fixed rule of the synthetic sources: the number at the end of the name modulo 3 names the domain."""
    n = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(n == "", "other").otherwise(F.concat(F.lit("domain"), (n.try_cast("bigint") % 3).cast("string")))


def _bits(*parts: Column) -> Column:
    """A number of ``ORDER_BITS`` bits from an md5, the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, ORDER_BITS // 4), 16, 10).cast("long")


def water_fill(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """``give`` for each row of (parent..., child, weight, cap, budget): shares of ``budget`` by weight, none above ``cap``.

    Children with weight 0 get nothing.  With children sorted by cap / weight,
    let the first k be full: the rest then has a level, (budget - their caps) /
    (weights of the rest).  No such level is above the one at which all shares
    add up to the budget, and the right k has it, so it is the largest.
    """
    some = F.col("weight") > 0
    w = Window.partitionBy(*parent).orderBy(F.when(some, F.col("cap") / F.col("weight")).asc_nulls_last(), child)
    full = F.coalesce(F.sum(F.when(some, F.col("cap"))).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(w.rowsBetween(0, Window.unboundedFollowing))
    rows = children.withColumn("level", F.when(some, (F.col("budget") - full) / rest))
    level = F.max("level").over(Window.partitionBy(*parent))
    give = F.when(some, F.least(F.col("cap"), F.greatest(F.col("weight") * level, F.lit(0.0)))).otherwise(0.0)
    return rows.withColumn("give", give).drop("level")


def budgets(leaves: DataFrame, weights: DataFrame, budget: float, epochs: float) -> DataFrame:
    """domain, lang, source, tokens, budget of every leaf.

    ``leaves`` has domain, lang, source, tokens; ``weights`` has level
    ("domain", "lang" or "source"), name and weight; a child that it doesn't
    list has weight 1, one that it lists twice the larger.
    """
    below = leaves.withColumn("cap", F.col("tokens") * F.lit(float(epochs)))
    tree: list[DataFrame] = []
    for i in reversed(range(len(LEVELS))):  # from the leaves up: what each subtree can give
        level, path = LEVELS[i], list(LEVELS[: i + 1])
        own = weights.where(F.col("level") == level).groupBy(F.col("name").alias(level)).agg(F.max("weight").cast("double").alias("weight"))
        kids = below.groupBy(*path).agg(F.sum("cap").alias("cap")).join(own, level, "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
        below = kids.select(*path, "weight", F.when(F.col("weight") > 0, F.col("cap")).otherwise(0.0).alias("cap"))
        tree.insert(0, below)
    top = tree[0].withColumn("top", F.lit(0))
    possible = F.sum("cap").over(Window.partitionBy("top"))
    given = water_fill(top.withColumn("budget", F.least(F.lit(float(budget)), possible)), ["top"], LEVELS[0]).drop("top")
    for i in range(1, len(LEVELS)):  # and down: who gets what
        above = list(LEVELS[:i])
        given = water_fill(tree[i].join(given.select(*above, F.col("give").alias("budget")), above), above, LEVELS[i])
    return given.join(leaves, list(LEVELS)).select(*LEVELS, "tokens", F.col("give").alias("budget"))


def mix(docs: DataFrame, weights: DataFrame, share: float = 0.5, epochs: int = 2, seed: int = 11, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row_hash, domain, lang, source, n_tokens, copies, leaf_budget of the chosen documents.

    The budget is ``share`` of all tokens (words, runs of other than ASCII
    white space; one for every text at least).  ``copies`` says in how many
    epochs the document is read; it is kept in the last epoch if the tokens
    before it in the epoch's order are below what the leaf has left to take.

    Edge cases: a null lang or source is a leaf of its own, named "none"; null
    and empty texts count one token; a very long text is one document, which
    may exceed what the leaf has left; rows that repeat id and text are ordered
    side by side and chosen each; a null id is chosen like any other; weight 0
    takes nothing; other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    tokens = F.greatest(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(1)).cast("long")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("none")).alias("lang"), F.coalesce(F.col("source").cast("string"), F.lit("none")).alias("source"), F.md5(text).alias("row_hash"), tokens.alias("n_tokens"))
    o = _bits(F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.col("row_hash"))
    d = cut(d.withColumn("domain", domain_of(F.col("source"))).withColumn("o", o))
    leaves = cut(d.groupBy(*LEVELS).agg(F.sum("n_tokens").cast("double").alias("tokens"), F.count("*").alias("n_docs")))
    whole_corpus = leaves.agg(F.sum("tokens").alias("t"), F.max("n_docs").alias("n")).first()
    goals = cut(budgets(leaves.drop("n_docs"), weights, share * (whole_corpus.t or 0.0), epochs))
    whole = F.floor(F.col("budget") / F.col("tokens") + 1e-12)
    plan = goals.withColumn("whole", whole.cast("int")).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    # every epoch has an order of its own: the seeded hash of the row, turned by a hash of the epoch's number
    plan = plan.withColumnRenamed("budget", "leaf_budget").withColumn("turn", _bits(F.lit(f"{seed}|epoch"), F.col("whole").cast("string")))
    bits = min(24, max(8, ((whole_corpus.n or 0) // SLICE_ROWS).bit_length()))
    d = d.withColumn("slice", F.shiftright("o", ORDER_BITS - bits).cast("int"))
    per = d.groupBy(*LEVELS, "slice").agg(F.sum("n_tokens").cast("double").alias("t"))
    per = per.join(plan, list(LEVELS)).withColumn("turned", F.col("slice").bitwiseXOR(F.shiftright("turn", ORDER_BITS - bits).cast("int")))
    run = Window.partitionBy(*LEVELS).orderBy("turned").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(per.withColumn("start", F.coalesce(F.sum("t").over(run), F.lit(0.0))).select(*LEVELS, "slice", "start", "turn", "whole", "rest", "leaf_budget"))
    rows = d.join(starts, [*LEVELS, "slice"]).withColumn("place", F.col("o").bitwiseXOR(F.col("turn")))
    within = Window.partitionBy(*LEVELS, "slice").orderBy("place", "doc_id", "row_hash").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    chosen = rows.withColumn("copies", (F.col("whole") + (before < F.col("rest")).cast("int")).cast("int")).where("copies > 0")
    return chosen.select("doc_id", "row_hash", *LEVELS, "n_tokens", "copies", "leaf_budget")


# Target weights by level and name; what isn't listed has weight 1.
WEIGHTS = [("domain", "domain0", 2.0), ("domain", "domain1", 1.0), ("domain", "domain2", 1.0), ("lang", "en", 4.0), ("lang", "de", 2.0), ("lang", "fr", 1.0), ("lang", "es", 1.0)]


def default_weights(docs: DataFrame) -> DataFrame:
    """``WEIGHTS`` as rows level, name, weight."""
    return docs.sparkSession.range(1).select(F.inline(F.array(*[F.struct(F.lit(a).alias("level"), F.lit(b).alias("name"), F.lit(w).alias("weight")) for a, b, w in WEIGHTS])))


def keep_mixed(docs: DataFrame, weights: DataFrame, share: float, seed: int = 11) -> DataFrame:
    """The rows of ``docs`` chosen in one epoch at most, with all their columns."""
    got = mix(docs, weights, share, 1, seed).groupBy(F.coalesce("doc_id", F.lit(-(2**63))).alias("__id"), F.col("row_hash").alias("__row")).agg(F.count("*").alias("__n"))
    d = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))).withColumn("__row", F.md5(F.coalesce("text", F.lit(""))))
    return d.join(got, ["__id", "__row"], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
