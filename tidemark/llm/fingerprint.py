"""Document fingerprints: invertible Bloom lookup sketches of paragraphs, in DataFrame functions only.

A text is the multiset of its paragraphs: the lines, long ones in pieces of
``PIECE`` code points, each as a digest numbered by occurrence.  A sketch has
three sub-tables; a digest falls into one cell of each, where counts are added
and digests and check sums are joined by exclusive or.  Sketches of two texts
subtract cell by cell, so that what both hold vanishes.  Peeling then takes the
sub-tables in turn: a cell that holds one digest alone gives it away, and it
leaves its other cells.  A pair whose cells aren't all empty in the end is done
again with a sketch ``GROWTH`` times as large.

All cells of a document stay in the partition that its text came to, so neither
sketching nor peeling shuffles anything; the rows of a pair are bounded by its
own paragraphs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import cut, cut_as_dealt, written

PIECE = 256
NO_ID = -(2**63)  # stands for a null id
CELLS = 96  # of a fingerprint; also the first size for peeling
GROWTH = 8
ROUNDS = 6  # sizes tried; pairs that no size peels are compared digest by digest
SWEEPS = 4  # times that each sub-table is peeled; more would lengthen the plan, and a larger sketch needs fewer


def paragraph_digests(text: Column) -> Column:
    """Digests of the paragraphs of ``text``, ascending; the n-th copy of a paragraph has a digest of its own."""
    sorted_ = F.array_sort(F.transform(F.regexp_extract_all(text, F.lit("([^\\n]{1,%d})" % PIECE), F.lit(1)), lambda u: F.xxhash64(u)))
    # a copy's number is its place in the run of equal digests; outer transforms name the array and the starts of
    # its runs, so that each is computed once and all is linear in the number of paragraphs
    opens = lambda a: F.filter(F.transform(a, lambda x, i: F.when((i == 0) | (a[F.greatest(i - 1, F.lit(0))] != x), i)), lambda i: i.isNotNull())
    run = lambda a, at, i, j: F.transform(F.sequence(F.lit(0), F.coalesce(F.get(at, j + 1), F.size(a)) - i - 1), lambda k: F.xxhash64(a[i], k))
    number = lambda a: F.transform(F.array(opens(a)), lambda at: F.flatten(F.transform(at, lambda i, j: run(a, at, i, j))))
    return F.flatten(F.flatten(F.transform(F.array(sorted_), number)))


def _cell(el: str, m: int, j: int) -> str:
    return f"cast({j * (m // 3)} + pmod(xxhash64({el}, {j + 11}), {m // 3}) as int)"


def cell_rows(df: DataFrame, keys: list[str], sides: list[str], m: int) -> DataFrame:
    """Sketches of the digest arrays ``sides`` with ``m`` cells: keys, _cell and, of each side i, _n{i}, _k{i}, _c{i}.

    A cell that no side uses has no row; a null array is empty.  ``keys`` must be unique and not null.
    """
    marked = ", ".join(f"transform(coalesce({s}, array()), e -> struct(e as _el, {i} as _side))" for i, s in enumerate(sides))
    places = ", ".join(_cell("_el", m, j) for j in range(3))
    rows = df.selectExpr(*keys, f"inline(concat({marked}))").selectExpr(*keys, "_el", "_side", "xxhash64(_el, 99) as _chk", f"explode(array({places})) as _cell")
    aggs = []
    for i in range(len(sides)):
        own = lambda c, i=i: F.when(F.col("_side") == i, c).otherwise(F.lit(0).cast("long"))
        aggs += [F.sum(own(F.lit(1).cast("long"))).alias(f"_n{i}"), F.bit_xor(own(F.col("_el"))).alias(f"_k{i}"), F.bit_xor(own(F.col("_chk"))).alias(f"_c{i}")]
    return rows.groupBy(*keys, "_cell").agg(*aggs)


def _shown(i: int, m: int, name: str) -> Column:
    """The cells in use of side ``i`` as text: ``cells=`` and ``cell:count:digest:check`` for each."""
    one = F.concat_ws(":", F.lpad(F.hex("_cell"), 4, "0"), F.col(f"_n{i}").cast("string"), F.lower(F.hex(f"_k{i}")), F.lower(F.hex(f"_c{i}")))
    return F.concat(F.lit(f"{m}="), F.concat_ws(",", F.array_sort(F.collect_list(F.when(F.col(f"_n{i}") != 0, one))))).alias(name)


def sketches(df: DataFrame, keys: list[str], sides: dict[str, str], cells: int = CELLS) -> DataFrame:
    """``keys`` and a fingerprint for each digest array (``sides``: array column to name); rows without any digest are left out."""
    return cell_rows(df, keys, list(sides), cells).groupBy(*keys).agg(*[_shown(i, cells, name) for i, name in enumerate(sides.values())])


def _peeled(rows: DataFrame, keys: list[str], m: int, sweeps: int) -> DataFrame:
    """``keys``, gone_a, gone_b (digests only in the first, only in the second), open (cells that stay) from cells (keys, _cell, _n, _k, _c) of differences."""
    cells = rows.withColumn("_found", F.lit(None).cast("long"))
    third = m // 3
    for r in range(3 * sweeps):
        t = r % 3
        pure = f"_cell >= {t * third} and _cell < {(t + 1) * third} and abs(_n) = 1 and _c = xxhash64(_k, 99)"
        own = "struct(_cell, _n, _k, _c, _found)"
        out = ", ".join(f"struct({_cell('_k', m, j)} as _cell, -_n as _n, _k, _c, _found)" for j in range(3))
        took = "struct(-1 as _cell, _n, 0L as _k, 0L as _c, _k as _found)"
        cells = cells.selectExpr(*keys, f"inline(case when {pure} then array({own}, {out}, {took}) else array({own}) end)")
        cells = cells.groupBy(*keys, "_cell", "_found").agg(F.sum("_n").alias("_n"), F.bit_xor("_k").alias("_k"), F.bit_xor("_c").alias("_c"))
        cells = cells.where("_cell = -1 or _n <> 0 or _k <> 0 or _c <> 0")
    side = lambda sign: F.array_sort(F.collect_list(F.when((F.col("_cell") == -1) & (F.col("_n") == sign), F.col("_found"))))
    return cells.groupBy(*keys).agg(side(1).alias("gone_a"), side(-1).alias("gone_b"), F.sum(F.when(F.col("_cell") >= 0, 1).otherwise(0)).alias("open"))


def _tried(df: DataFrame, keys: list[str], sides: list[str], m: int, sweeps: int) -> DataFrame:
    """Sketches of ``sides``, the first minus each other one, peeled: keys, _kind (which other one, from 0), gone_a, gone_b, open."""
    less = ", ".join(f"struct({i} as _kind, _n0 - _n{i + 1} as _n, _k0 ^ _k{i + 1} as _k, _c0 ^ _c{i + 1} as _c)" for i in range(len(sides) - 1))
    rows = cell_rows(df, keys, sides, m).selectExpr(*keys, "_cell", f"inline(array({less}))").where("_n <> 0 or _k <> 0 or _c <> 0")
    return _peeled(rows, [*keys, "_kind"], m, sweeps)


def differences(pairs: DataFrame, keys: list[str], cells: int = CELLS, sweeps: int = SWEEPS, digests: bool = True, sides: tuple[str, ...] = ("a", "b")) -> DataFrame:
    """What the digest array ``a`` and each other of ``sides`` have apart, found by peeling: keys, kind, gone_a, gone_b, cells, likeness.

    ``kind`` counts the other arrays from 0; ``cells`` is the size at which
    peeling came to an end (0: compared digest by digest, after ``ROUNDS``
    sizes); likeness is 1 - differing / all paragraphs of both (two empty
    texts: 1).  ``keys`` must be unique and not null; null arrays count as
    empty.  Failed pairs go on with sketches ``GROWTH`` times as large.
    Without ``digests`` the number ``gone`` stands for the two arrays.
    """
    none = F.array().cast("array<bigint>")
    todo = pairs.select(*keys, *[F.coalesce(F.col(c), none).alias(c) for c in sides])
    every = todo.select(*keys, F.inline(F.array(*[F.struct(F.lit(i).alias("_kind"), (F.size(sides[0]) + F.size(s)).alias("total")) for i, s in enumerate(sides[1:])])))
    if not digests:
        size = F.size("gone_a") + F.size("gone_b")
    shown = ["gone_a", "gone_b"] if digests else ["gone"]
    done: list[DataFrame] = []
    m = cells
    for _ in range(ROUNDS):
        out = _tried(todo, keys, list(sides), m, sweeps)
        out = written(out.select(*keys, "_kind", *(shown if digests else [size.alias("gone")]), "open", F.lit(m).alias("cells")))
        done.append(out.where("open = 0"))
        failed = out.where("open > 0").select(*keys).distinct()
        if failed.limit(1).count() == 0:
            break
        todo = todo.join(failed, keys, "left_semi")
        m *= GROWTH
    else:
        apart = lambda x, y: F.array_sort(F.array_except(x, y))
        kinds = [F.struct(F.lit(i).alias("_kind"), apart(sides[0], s).alias("gone_a"), apart(s, sides[0]).alias("gone_b")) for i, s in enumerate(sides[1:])]
        rest = todo.select(*keys, F.inline(F.array(*kinds)))
        done.append(rest.select(*keys, "_kind", *(shown if digests else [size.alias("gone")]), F.lit(0).cast("long").alias("open"), F.lit(0).alias("cells")))
    # a pair of which one kind failed is done again whole: the larger sketch says the same of the other kind
    found = reduce(DataFrame.unionByName, done).groupBy(*keys, "_kind").agg(F.max_by(F.struct(*shown, "cells"), "cells").alias("x")).select(*keys, "_kind", "x.*")
    out = every.join(found, [*keys, "_kind"], "left")
    gone = F.size(F.coalesce("gone_a", none)) + F.size(F.coalesce("gone_b", none)) if digests else F.coalesce("gone", F.lit(0))
    likeness = F.when(F.col("total") == 0, 1.0).otherwise(1 - gone / F.greatest("total", F.lit(1)))
    kept = [F.coalesce(c, none).alias(c) for c in shown] if digests else []
    return out.select(*keys, F.col("_kind").alias("kind"), *kept, F.coalesce("cells", F.lit(cells)).alias("cells"), likeness.alias("likeness"))


def numbered(ids: DataFrame) -> DataFrame:
    """``ids`` (kid, h, ...) with ``rn``, the place from 0 in ascending order, and ``total``.

    Ids are range-partitioned and sorted; a row's place is its place in the
    partition plus the sizes of the partitions before, which are two numbers
    for each partition.
    """
    by = ["kid", "h"]
    ordered = cut(ids.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    sizes = ordered.groupBy(part.alias("__part")).agg(F.count("*").alias("__size"))
    w = Window.orderBy("__part")
    starts = sizes.select("__part", F.coalesce(F.sum("__size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__start"), F.sum("__size").over(Window.partitionBy()).alias("total"))
    out = ordered.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return out.withColumn("rn", F.col("__start") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__part", "__start", "__at")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text has the last floor(n / 2) code points replaced by the first
    as many (or all) of the next document in ascending id; after the last
    document comes the first.

    Edge cases: a null text is empty; rows that repeat an id are ordered by a
    hash of the text, and of rows that repeat id and text each is the next one
    of another, all but the last; a null id comes first; a single document is
    its own next; a very long text is one row of one task (Spark's limit is 2
    GB), and its work grows with its paragraphs; other columns are ignored; an
    empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # dealt out while texts are whole rows, into four times the session's partitions, as each becomes a few hundred cells in place
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["kid", "h"]
    d = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("kid"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    ids = d.select(*key, F.length("text").alias("n")).groupBy(*key).agg(F.max("n").alias("n"), F.count("*").alias("c"))
    order = written(numbered(ids))
    before = order.select(F.expr("pmod(rn + 1, total)").alias("rn"), F.col("kid").alias("p_kid"), F.col("h").alias("p_h"), F.expr("n div 2").cast("int").alias("p_need"))
    links = order.join(before, "rn").select(*key, "c", "p_kid", "p_h", "p_need")
    # both uses below take the same columns of it, so that texts are shuffled once
    once = d.repartition(n, *key).dropDuplicates(key)
    heads = once.join(links, key).select(F.col("p_kid").alias("kid"), F.col("p_h").alias("h"), F.expr("substring(text, 1, p_need)").alias("head"), paragraph_digests(F.col("text")).alias("next_a"))
    # of c equal rows all but the last have another of them as their next, so there may be a second edited text
    both = once.join(heads.repartition(n, *key), key).join(order.select(*key, "c").repartition(n, *key), key).withColumn("n", F.length("text"))
    edited = "concat(substring(text, 1, n - (n div 2)), head)"
    itself = "case when c > 1 then concat(substring(text, 1, n - (n div 2)), substring(text, 1, n div 2)) end"
    base = both.selectExpr("*", f"{edited} as edited", f"{itself} as itself").select(*key, "c", F.col("n").cast("long").alias("n_chars"), F.unhex(F.sha2("edited", 256)).alias("sha"), F.unhex(F.sha2("itself", 256)).alias("sha_self"), paragraph_digests(F.col("text")).alias("a"), paragraph_digests(F.col("edited")).alias("b"), "next_a", paragraph_digests(F.col("itself")).alias("b_self"))
    base = cut_as_dealt(base)
    of = lambda k, name: F.max(F.when(F.col("kind") == k, F.col("likeness"))).alias(name)
    near = differences(base, key, digests=False, sides=("a", "b", "next_a", "b_self")).groupBy(*key).agg(of(0, "edited"), of(1, "next"), of(2, "self"))
    shown = sketches(base, key, {"a": "fp", "b": "fp_edited", "b_self": "fp_self"})
    out = base.select(*key, "c", "n_chars", "sha", "sha_self").join(near, key, "left").join(shown, key, "left")
    each = lambda times, sha, fp, e, x: F.array_repeat(F.struct(F.lower(F.hex(sha)).alias("edited_sha256"), F.col("fp").alias("fingerprint"), F.col(fp).alias("edited_fingerprint"), F.col(e).alias("near_edited"), x.alias("near_next")), times)
    rows = F.concat(each(F.lit(1), "sha", "fp_edited", "edited", F.col("next")), each((F.col("c") - 1).cast("int"), "sha_self", "fp_self", "self", F.lit(1.0)))
    rows = out.withColumn("doc_id", F.when(F.col("kid") != NO_ID, F.col("kid"))).select("doc_id", "n_chars", F.inline(rows))
    empty = F.lit(f"{CELLS}=")
    return rows.select("doc_id", "n_chars", "edited_sha256", F.coalesce("fingerprint", empty).alias("fingerprint"), F.coalesce("edited_fingerprint", empty).alias("edited_fingerprint"), "near_edited", "near_next")
