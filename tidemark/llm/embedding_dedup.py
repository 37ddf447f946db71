"""Near-duplicate vectors: spherical k-means cells and blocked cosine products.

Vectors that are equal become one representative with a multiplicity.  A group
(label and length) with more representatives than fit a cell is cut into cells
by spherical k-means, as many as its size asks for; centres are fitted on a
bounded sample.  Every unit vector has a home cell, that of its nearest centre,
and visits each further cell whose border is near: cell j is visited when
x.(c_home - c_j) <= slack * |c_home - c_j|.  The homes of partners of cosine >=
t lie apart by at most their difference, of length sqrt(2 - 2t); if neither
visited the other's home at a ``slack`` of half of that, they would lie further
apart than that along the border's normal.  So the default, just this half,
loses nothing.

Groups beyond ``TOP`` cells are cut twice: what is left of a vector after the
centre of a cell is taken away falls into a second set of cells, shared by all
first ones, again with visits to near ones (residents to half the length,
visitors from another first cell to the whole), so the number of centres stays
bounded and cells don't grow with the input.

Inside a cell the vectors that visit (those at home do, too) meet those at
home, in blocks: one task gets a block of each and multiplies them.  Only
counts and a spanning forest of the links leave a task.  A visitor counts every
resident that it links with; the resident counts the visitor as well if it
doesn't visit the visitor's home itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, join_counted, spanning_edges, stream_by, written
from tidemark.llm.minhash_dedup import forest

SAMPLE = 20_000  # vectors of one length that centres are fitted on, at most
PER_CELL = 2_048  # representatives aimed at for a cell
TOP = 1_024  # centres of one set, at most
BLOCK = 4_096  # residents, and visitors, that one task gets
TILE = 1_024  # multiplied at once
SCORES = 4_000_000  # of vectors with centres, held at once


def fit_centres(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Spherical k-means: unit centres that follow the mean direction of their vectors."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        new = np.zeros_like(c)
        np.add.at(new, np.argmax(x @ c.T, 1), x)
        size = np.linalg.norm(new, axis=1)
        ok = size > 1e-9
        c[ok] = new[ok] / size[ok, None]
    return c


def fit_remainders(x: np.ndarray, centres: np.ndarray, k: int, rounds: int = 12, seed: int = 6) -> np.ndarray:
    """Plain k-means on what is left of ``x`` after its nearest centre is taken away."""
    r = x - centres[np.argmax(x @ centres.T, 1)]
    rng = np.random.default_rng(seed)
    e = r[rng.choice(len(r), min(k, len(r)), replace=False)].copy()
    for _ in range(rounds):
        near = np.argmax(r @ e.T - (e * e).sum(1) / 2, 1)
        n = np.bincount(near, minlength=len(e))
        new = np.zeros_like(e)
        np.add.at(new, near, r)
        e[n > 0] = new[n > 0] / n[n > 0, None]
    return e


def _matrix(col: pa.Array) -> np.ndarray:
    """Unit rows in double precision, scaled by their largest component first, so that squares neither vanish nor overflow."""
    n = len(col)
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    x = x / np.abs(x).max(1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _distances(c: np.ndarray) -> np.ndarray:
    n = (c * c).sum(1)
    return np.sqrt(np.maximum(n[:, None] + n[None, :] - 2 * (c @ c.T), 0))


def _near(score: np.ndarray, gap: np.ndarray, slack: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
    """Home of each row (largest score) and which cells it visits."""
    at = np.arange(len(score))
    home = np.argmax(score, 1)
    visit = score[at, home][:, None] - score <= slack * gap[home] + 1e-9
    visit[at, home] = True
    return home, visit


class Cells:
    """Centres of one number of cells, and the remainders' centres if there are two levels."""

    def __init__(self, centres: np.ndarray, remainders: np.ndarray | None):
        self.centres, self.remainders = centres, remainders

    def place(self, x: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home of each row of ``x``, and (row, cell) of all visits, homes included, by row."""
        gap = _distances(self.centres)
        far = None if self.remainders is None else _distances(self.remainders)
        homes, rows, cells = [], [], []
        step = max(1, SCORES // len(self.centres))
        for a in range(0, len(x), step):
            part = x[a : a + step]
            home, visit = _near(part @ self.centres.T, gap, slack)
            row, cell = np.nonzero(visit)
            if far is not None:
                home, row, cell = self._second(part, home, row, cell, far, slack)
            homes.append(home)
            rows.append(row + a)
            cells.append(cell)
        return np.concatenate(homes), np.concatenate(rows), np.concatenate(cells)

    def _second(self, x, home, row, cell, far, slack):
        e = self.remainders
        own = cell == home[row]
        out_row, out_cell, second = [], [], np.zeros(len(x), dtype=np.int64)
        step = max(1, SCORES // len(e))
        for a in range(0, len(row), step):
            r, c, o = row[a : a + step], cell[a : a + step], own[a : a + step]
            rest = x[r] - self.centres[c]
            h, visit = _near(rest @ e.T - (e * e).sum(1) / 2, far, np.where(o, slack, 2 * slack)[:, None])
            second[r[o]] = h[o]
            p, q = np.nonzero(visit)
            out_row.append(r[p])
            out_cell.append(c[p] * len(e) + q)
        return home * len(e) + second, np.concatenate(out_row), np.concatenate(out_cell)


def _placed(models: dict[tuple[int, int], Cells], slack: float):
    """Homes and visits of the representatives of batches (rep, mult, label, d, k, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, k = b.column(3).to_numpy(), b.column(4).to_numpy()
            for dim, cells in sorted({*zip(d.tolist(), k.tolist(), strict=True)}):
                one = b.filter(pa.array((d == dim) & (k == cells)))
                n = one.num_rows
                if cells > 1:
                    home, row, cell = models[dim, cells].place(_matrix(one.column(5)), slack)
                else:
                    home, row, cell = np.zeros(n, np.int64), np.arange(n), np.zeros(n, np.int64)
                off = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
                yield pa.record_batch([one.column(0), one.column(1), one.column(2), one.column(3), one.column(5), pa.array(home.astype(np.int32)), pa.ListArray.from_arrays(pa.array(off), pa.array(cell.astype(np.int32)))], names=["rep", "mult", "label", "d", "v", "home", "cells"])

    return run


def _links(threshold: float):
    """Links between a block of visitors and one of residents: counts (to the vector itself) and a forest."""

    def run(g: pa.Table) -> pa.RecordBatch | None:
        b = g.combine_chunks().to_batches()[0]
        here = b.column("resident").to_numpy(zero_copy_only=False)
        if not here.any() or here.all():
            return None
        r, v = (b.filter(pa.array(k)) for k in (here, ~here))
        r_id, v_id, r_n, v_n = (x.column(c).to_numpy() for c in ("rep", "mult") for x in (r, v))
        homes, at = np.unique(v.column("home").to_numpy(), return_inverse=True)
        returns = np.zeros((len(r_id), len(homes)), dtype=bool)  # does the resident visit that home
        flat, length = r.column("cells").flatten().to_numpy(), r.column("cells").value_lengths().to_numpy()
        where = np.minimum(np.searchsorted(homes, flat), len(homes) - 1)
        hit = homes[where] == flat
        returns[np.repeat(np.arange(len(r_id)), length)[hit], where[hit]] = True
        x, y = _matrix(v.column("v")), _matrix(r.column("v"))
        n_v, n_r = np.zeros(len(v_id), np.int64), np.zeros(len(r_id), np.int64)
        edges: list[tuple[np.ndarray, np.ndarray]] = []
        for i in range(0, len(x), TILE):
            for j in range(0, len(y), TILE):
                p, q = slice(i, i + TILE), slice(j, j + TILE)
                link = (x[p] @ y[q].T >= threshold) & (v_id[p, None] != r_id[None, q])
                rows, cols = np.flatnonzero(link.any(1)), np.flatnonzero(link.any(0))
                if not len(rows):
                    continue
                link = link[np.ix_(rows, cols)]
                rows, cols = rows + i, cols + j
                n_v[rows] += link @ r_n[cols]
                n_r[cols] += v_n[rows] @ (link & ~returns[np.ix_(cols, at[rows])].T)
                ids, number = np.unique(np.concatenate([v_id[rows], r_id[cols]]), return_inverse=True)
                both = np.zeros((len(ids), len(ids)), dtype=bool)
                both[np.ix_(number[: len(rows)], number[len(rows) :])] = link
                edges.append(forest(both | both.T, ids))
        if not edges:
            return None
        a, z = spanning_edges(*(np.concatenate(e) for e in zip(*edges, strict=True)))
        ids = np.concatenate([v_id[n_v > 0], r_id[n_r > 0]])
        n = np.concatenate([n_v[n_v > 0], n_r[n_r > 0]])
        return pa.record_batch([pa.array(np.concatenate([ids, a])), pa.array(np.concatenate([n, np.zeros(len(a), np.int64)])), pa.array(np.concatenate([ids, z]))], names=["rep", "n", "to"])

    return run


def _fit(reps: DataFrame, groups: DataFrame, sample: int) -> dict[tuple[int, int], Cells]:
    """Cells for each vector length and number of cells that a group asks for; a handful of both."""
    models: dict[tuple[int, int], Cells] = {}
    wanted: dict[int, list[int]] = {}
    for row in groups.where("k > 1").groupBy("d").agg(F.collect_set("k").alias("ks"), F.sum("n").alias("n")).collect():
        wanted[row.d] = sorted(row.ks)
        # the hash range holds a little more than the sample, so that no task sends rows that the limit would drop
        some = reps.where(F.col("d") == row.d).where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < int(min(1.0, 1.3 * sample / row.n + 1e-5) * (1 << 20)))
        x = _matrix(pa.array(some.select("v", "rep").orderBy(F.xxhash64("rep"), "rep").limit(sample).select("v").toPandas()["v"].tolist()))
        for k in wanted[row.d]:
            c = fit_centres(x, min(k, TOP))
            models[row.d, k] = Cells(c, fit_remainders(x, c, k // TOP) if k > TOP else None)
    return models


def link_vectors(vectors: DataFrame, threshold: float = 0.93, slack: float | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", per_cell: int = PER_CELL, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector.

    Vectors of equal, non-null label and equal length link where the cosine,
    in double precision, is at least ``threshold``.  ``component_id`` is the
    smallest id reachable; ``kept`` marks it.

    Edge cases: vectors that are null, empty, zero or hold a null or
    non-finite component, and rows without a label, link with nothing; vectors
    of different lengths never link; equal vectors are rows of their own, each
    a link of the others; ids must be unique (rows that repeat an id are taken
    as one vector, the largest by label, then components); a null id links
    with nothing and is kept; ties don't matter; other columns are ignored; an
    empty table gives no rows.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v"))
    sound = F.expr("v is not null and size(v) > 0 and forall(v, e -> e is not null and not isnan(e) and abs(e) < double('inf')) and exists(v, e -> e <> 0)")
    usable = v.where("id is not null and label is not null").where(sound).groupBy("id").agg(F.max(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v")
    same = ["label", "d", "h1", "h2"]
    usable = written(usable.select("id", "label", F.size("v").alias("d"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), "v"))
    reps = written(usable.groupBy(*same).agg(F.min_by(F.struct("id", "v"), "id").alias("x"), F.count("*").alias("mult")).select(*same, F.col("x.id").alias("rep"), "mult", F.col("x.v").alias("v")))
    groups = written(reps.groupBy("label", "d").agg(F.count("*").alias("n")).withColumn("k", F.pow(F.lit(2), F.greatest(F.ceil(F.log2(F.col("n") / per_cell)), F.lit(0))).cast("int")))
    if slack is None:
        slack = math.sqrt(max(0.0, 2 - 2 * threshold)) / 2
    kind = dict(usable.dtypes)["v"]
    sized = join_counted(reps, groups, ["label", "d"], "n").select("rep", "mult", "label", "d", "k", "v")
    placed = written(sized.mapInArrow(_placed(_fit(reps, groups, sample), slack), f"rep long, mult long, label long, d int, v {kind}, home int, cells array<int>"))
    cell = ["label", "d", "cell"]
    visits = placed.withColumn("cell", F.explode("cells"))
    size = visits.groupBy(*cell).agg(F.ceil(F.count_if(F.col("cell") == F.col("home")) / BLOCK).cast("int").alias("blocks"), F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"), F.count("*").alias("n"))
    dealt = join_counted(visits, written(size), cell, "n").where("blocks > 0").withColumn("h", F.xxhash64("rep"))
    one = [*cell, "i", "j", "rep", "mult", "home", "cells", "v"]
    block, part = F.expr("cast(pmod(h, blocks) as int)"), F.expr("cast(pmod(shiftright(h, 20), parts) as int)")
    residents = dealt.where("cell = home").withColumn("i", block).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*one, F.lit(True).alias("resident"))
    visitors = dealt.withColumn("j", part).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*one, F.lit(False).alias("resident"))
    found = written(stream_by(residents.unionByName(visitors), [*cell, "i", "j"], _links(threshold), "rep long, n long, to long"))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    comp = components(found.where("rep <> to"), "rep", "to").withColumnRenamed("node", "rep")
    about = written(reps.select(*same, "rep", "mult").join(counts, "rep", "left").join(comp, "rep", "left"))
    links = F.coalesce("n", F.lit(0)) + F.col("mult") - 1
    known = join_counted(usable.select("id", *same), about, same, "mult").select("id", links.cast("long").alias("links"), F.coalesce("component", "rep").alias("component"))
    out = v.select("id").join(known, "id", "left")
    c = F.coalesce("component", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), c.alias("component_id"), F.coalesce(c == F.col("id"), F.lit(True)).alias("kept"))
