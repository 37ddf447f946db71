"""Near-duplicate documents by MinHash with tensored banding, confirmed on full shingle sets.

1. One pass makes the distinct word shingles of every text, a digest of the
   set, and two small collections of band keys (``m`` keys of ``r`` minima
   each).  Documents with equal sets collapse to one representative.
2. The keys of the ``m * m`` tables pair a key of the first collection with
   one of the second, so ``2 * m * r`` minima serve ``m * m`` tables of
   ``2 * r`` minima.  In each table a representative meets the smallest id
   that has its key (a star, not all pairs); the stars' components are the
   candidate groups.
3. Within a group, blocks of representatives compare their full sets exactly
   (inverted index over the block pair's shingles); of the links found, only
   a spanning forest leaves the task.  A large group is cut into blocks and
   block pairs, so no task holds more than two blocks.
4. The components of the confirmed links give the classes.

A pair of similarity s shares no table with probability about
1 - (1 - (1 - s**r)**m)**2: 0.0004 at s = 0.8 for r = 4 and m = 16, 0.00002 at
s = 0.85.  As all pairs of a group are compared, a pair that shares no table
is found still if others of its group link them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, components, cut, join_counted, join_null_safe, stream_by, written
from tidemark.llm.hashing import PLACE, mix, shingle_sets

BANDS, ROWS = 16, 4
BLOCK = 256
COLUMNS = 4096  # shingles counted at once
PART = 400  # texts hashed at once; bounds a worker's memory

_rng = np.random.Generator(np.random.PCG64(77))
_A = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**64, 256, dtype=np.uint64)


def _band_keys(flat: np.ndarray, off: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """2 * bands keys for each set that isn't empty."""
    out = np.empty((len(off) - 1, 2 * bands), dtype=np.uint64)
    for band in range(2 * bands):
        key = np.full(len(off) - 1, band, dtype=np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            least = np.minimum.reduceat((flat * _A[k] + _B[k]) >> np.uint64(8), off[:-1])
            key = mix(key * PLACE[0] + least)
        out[:, band] = key
    return out


def _digests(flat: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each non-empty set, independent of order."""
    return np.add.reduceat(mix(flat + PLACE[2]), off[:-1]), np.add.reduceat(mix(flat + PLACE[3]), off[:-1])


def _signatures(width: int, bands: int, rows: int):
    names = ["doc_id", "n_shingles", "d1", "d2", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PART):
                b = whole.slice(at, PART)
                flat, off = shingle_sets(b.column(1), width)
                n = np.diff(off)
                full = np.flatnonzero(n > 0)
                short = np.concatenate([off[:-1][full], off[-1:]])
                d = np.zeros((2, len(n)), dtype=np.int64)
                keys = np.zeros((0, 2 * bands), dtype=np.uint64)
                if len(full):
                    for k, x in enumerate(_digests(flat, short)):
                        d[k, full] = x.view(np.int64)
                    keys = _band_keys(flat, short, bands, rows)
                to = np.concatenate([[0], np.cumsum(np.where(n > 0, 2 * bands, 0))]).astype(np.int32)
                yield pa.record_batch([b.column(0), pa.array(n), pa.array(d[0]), pa.array(d[1]), pa.ListArray.from_arrays(pa.array(to), pa.array(keys.ravel().view(np.int64)))], names=names)

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PART):
                b = whole.slice(at, PART)
                flat, off = shingle_sets(b.column(1), width)
                raw = flat.tobytes()
                sets = pa.array([raw[i * 8 : j * 8] for i, j in zip(off[:-1], off[1:], strict=True)], pa.binary())
                yield pa.record_batch([b.column(0), sets, *b.columns[2:]], names=["rep", "set", "grp", "blocks"])

    return run


def linked(sets: list[np.ndarray], need: int, out_of: int, apart: np.ndarray | None = None) -> np.ndarray:
    """Boolean matrix of pairs with out_of * intersection >= need * union, counted exactly."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), size)
    o = np.argsort(flat, kind="stable")
    flat, row = flat[o], row[o]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    col = np.cumsum(new) - 1
    often = np.bincount(col) > 1  # a shingle in one set only adds to no intersection
    keep = often[col]
    row, col = row[keep], (np.cumsum(often) - 1)[col[keep]]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    last = int(col[-1]) + 1 if len(col) else 0
    for a in range(0, last, COLUMNS):
        i, j = np.searchsorted(col, [a, a + COLUMNS])
        x = np.zeros((len(sets), min(COLUMNS, last - a)), dtype=np.float32)
        x[row[i:j], col[i:j] - a] = 1
        common += x @ x.T
    both = common.astype(np.int64)  # whole numbers below 2**24 are exact
    return out_of * both >= need * (size[:, None] + size[None, :] - both)


def forest(link: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smaller node of its component) that connect what ``link`` connects."""
    label = np.arange(len(ids))
    while True:
        low = np.where(link, label[None, :], len(ids)).min(1)
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != np.arange(len(ids)))
    return ids[at], ids[label[at]]


def _compare(need: int, out_of: int):
    def run(group: pa.Table) -> pa.RecordBatch | None:
        if group.num_rows < 2:
            return None
        order = np.argsort(group.column("rep").to_numpy())
        ids = group.column("rep").to_numpy()[order]
        raw = group.column("set").to_pylist()
        link = linked([np.frombuffer(raw[i], dtype=np.uint64) for i in order], need, out_of)
        a, b = forest(link, ids)
        return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def classes(docs: DataFrame, width: int = 5, need: int = 80, out_of: int = 100, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lowered, a
    document's set its distinct shingles of ``width`` words (with fewer words
    the whole sequence); documents link where out_of * |intersection| >= need *
    |union|; ``component_id`` is the smallest id reachable and ``kept`` marks it.

    Edge cases: texts without words (null, empty, blank) link with nothing and
    are kept; equal sets always link, whatever their number; a very long text
    is hashed whole in slices, its set is one row of one task; rows that repeat
    an id are one document for the classes and each gets the class; rows with a
    null id get a null component and are kept; ties don't matter; other columns
    are ignored; an empty table gives no rows.
    """
    d = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sig = written(d.mapInArrow(_signatures(width, bands, rows), "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>"))
    n = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a representative becomes over a hundred rows in place
    named = sig.where("doc_id is not null and n_shingles > 0")
    same = ["d1", "d2", "n_shingles"]
    one = named.groupBy(*same).agg(F.min_by(F.struct("doc_id", "keys"), "doc_id").alias("x"), F.count("*").alias("copies"))
    reps = cut(one.select(*same, "copies", F.col("x.doc_id").alias("rep"), F.col("x.keys").alias("keys")).repartition(n, "rep"))
    # a table's key is shared only if both keys that it pairs are, so others needn't become rows
    singles = reps.select("rep", F.posexplode("keys").alias("at", "half"))
    several = lambda df, key: df.groupBy(key).agg(F.min("rep").alias("root"), F.max("rep").alias("most"), F.count("*").alias("n")).where("root < most").drop("most")
    halves = join_counted(singles, written(several(singles, "half").select("half", "n")), ["half"], "n").drop("n")
    lists = written(halves.groupBy("rep").agg(F.collect_list(F.when(F.col("at") < bands, F.col("half"))).alias("a"), F.collect_list(F.when(F.col("at") >= bands, F.col("half"))).alias("b")).where("size(a) > 0 and size(b) > 0"))
    # a half tells its place in its collection, too
    entries = lists.repartition(n, "rep").select("rep", F.explode(F.expr("flatten(transform(a, x -> transform(b, y -> xxhash64(x, y))))")).alias("key"))
    roots = written(several(entries, "key"))
    stars = join_counted(entries, roots, ["key"], "n").where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")).distinct()
    groups = written(components(stars))
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n"))
    sized = join_counted(groups, sizes, ["component"], "n").select(F.col("node").alias("doc_id"), F.col("component").alias("grp"), "blocks")
    # at any size the same join, of texts with the ids that have candidates
    texts = d.where("doc_id is not null").join(sized.hint("merge"), "doc_id").select("doc_id", "text", "grp", "blocks")
    sets = texts.mapInArrow(_sets(width), "rep long, set binary, grp long, blocks int").where(F.length("set") > 0)
    own = F.expr("pmod(xxhash64(rep), blocks)").cast("int")
    pairs = sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "set")
    joined = components(stream_by(pairs, ["grp", "i", "j"], _compare(need, out_of), "a long, b long"))
    known = written(reps.select(*same, "copies", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(*same, "copies", F.coalesce("component", "rep").alias("component")))
    doc_class = join_counted(named.select("doc_id", *same), known, same, "copies").select(F.col("doc_id").alias("a"), "component")
    doc_class = doc_class.groupBy("a").agg(F.min("component").alias("component")).withColumnRenamed("a", "doc_id")
    out = join_null_safe(sig.select("doc_id", "n_shingles"), doc_class, ["doc_id"], "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, width: int = 5) -> DataFrame:
    """One document of each group of near copies, the smallest id; all columns stay.  Rows that repeat a kept id all stay."""
    out = classes(docs, width).where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(out, docs["doc_id"] == out["__gone"], "left_anti")
