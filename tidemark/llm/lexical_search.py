"""Ranked lexical search: exact inner products of sparse vectors, found through ball trees.

A document is a sparse vector of whole numbers over the terms that the items
ask for, an item is one of term weights; the score is their inner product.
Documents are dealt out by their strongest term, so that like ones meet, and
each task arranges blocks of them in ball trees: a node has a centre c and a
radius r that covers its documents, so none of them scores more for an item q
than q.c + |q'| r, where q' is q on the terms that the node's documents have
(elsewhere they and the centre are 0).  A search takes nodes best bound first, scores leaves in
exact integers, and leaves the rest as soon as no bound reaches the last of the
best scores so far.  A first pass over a sixteenth of the documents gives every
task a floor to begin with; it changes what is pruned, never what is found.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")  # the same in UTF-8
GAP_BYTES = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE = 1 << 20  # bytes of a long text that are split into terms at once
BLOCK_TERMS = 16_384  # terms, and
BLOCK_ITEMS = 256  # items that a pass over the documents looks for, on average
BALL_DOCS = 4_096  # documents, and
BALL_ENTRIES = 1_000_000  # entries of vectors in one tree, at most (one document at least)
LEAF = 32
FLOOR_PART = 16  # one in so many documents gives the floors
SAFE = 1 + 1e-9  # far above what rounding takes away in 2**20 additions
NO_ID = -(2**63)


def count_terms(raw: bytes, numbers: dict[bytes, int]) -> tuple[int, Counter]:
    """How many terms ``raw`` has, and how often those in ``numbers`` occur, by number."""
    n, tf, at = 0, Counter(), 0
    while at < len(raw):
        end = at + PIECE
        if end < len(raw):
            gap = GAP_BYTES.search(raw, end)
            end = gap.start() if gap else len(raw)
        terms = TERM_BYTES.findall(raw[at:end].lower())  # lower() of bytes is A-Z only
        n += len(terms)
        tf.update(numbers[t] for t in terms if t in numbers)
        at = end
    return n, tf


def _vectors(numbers: dict[bytes, int]):
    """doc, n, terms and tf of the documents that have a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, lengths, terms, tfs = [], [], [], []
            for doc, raw in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
                if not raw.is_valid:
                    continue
                n, tf = count_terms(raw.as_py(), numbers)
                if n:
                    own = sorted(tf)
                    docs.append(NO_ID if doc is None else doc)
                    lengths.append(n)
                    terms.append(own)
                    tfs.append([tf[t] for t in own])
            yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], names=["doc", "n", "terms", "tf"])

    return run


def flat(b: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    c = b.column(b.schema.get_field_index(name))
    off = c.offsets.to_numpy()
    return c.values.to_numpy(zero_copy_only=False)[off[0] : off[-1]], off - off[0]


def _values(n_docs: int, n_terms: int, weights: np.ndarray):
    """Vectors with their values, and the term that counts most in each, of those with any term that is asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms, off = flat(b, "terms")
            tf, _ = flat(b, "tf")
            size = np.diff(off)
            b = b.filter(pa.array(size > 0))
            if not b.num_rows:
                continue
            size = size[size > 0]
            start = np.cumsum(size) - size
            n = b.column(b.schema.get_field_index("n")).to_numpy()
            m = np.repeat(50 + (50 * n * n_docs) // n_terms, size)
            x = (1_000_000_000 * tf) // (1000 * tf + 20 * m)
            part = x * weights[terms]
            top = np.repeat(np.maximum.reduceat(part, start), size)
            strong = np.minimum.reduceat(np.where(part == top, terms, 2**31 - 1), start)
            lists = pa.array(np.append(start, len(terms)).astype(np.int32))
            yield pa.record_batch(
                [pa.array(strong.astype(np.int32)), b.column(b.schema.get_field_index("doc")), pa.ListArray.from_arrays(lists, pa.array(terms)), pa.ListArray.from_arrays(lists, pa.array(x))],
                names=["strong", "doc", "terms", "x"],
            )

    return run


class Ball:
    """A ball tree over sparse vectors of whole numbers (terms, x between the offsets off); ids are the documents."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray, x: np.ndarray, off: np.ndarray, n_dims: int):
        self.dims = n_dims
        order, spans = np.arange(len(ids)), [(0, len(ids))]
        self.children: list[tuple[int, int] | None] = []
        size = np.diff(off)
        k = 0
        while k < len(spans):
            a, z = spans[k]
            if z - a <= LEAF:
                self.children.append(None)
            else:
                order[a:z] = self._split(order[a:z], terms, x, off, size)
                self.children.append((len(spans), len(spans) + 1))
                spans += [(a, (a + z) // 2), ((a + z) // 2, z)]
            k += 1
        at = self._entries(order, off, size)
        self.spans, self.ids, self.terms, self.x = spans, ids[order], terms[at], x[at]
        self.off = np.append(0, np.cumsum(size[order]))
        self.least_id = [int(self.ids[a:z].min()) for a, z in spans]
        self._bound()

    @staticmethod
    def _entries(rows: np.ndarray, off: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Places of the entries of ``rows``, in their order."""
        n = size[rows]
        return np.arange(n.sum()) + np.repeat(off[rows] - (np.cumsum(n) - n), n)

    def _split(self, rows, terms, x, off, size) -> np.ndarray:
        """``rows`` ordered from one of two far documents to the other."""
        at = self._entries(rows, off, size)
        t, v = terms[at], x[at].astype(np.float64)
        start = np.cumsum(size[rows]) - size[rows]
        own = np.add.reduceat(v * v, start)

        def far(i: int) -> tuple[np.ndarray, np.ndarray]:
            dense = np.zeros(self.dims)
            a = slice(start[i], start[i] + size[rows[i]])
            dense[t[a]] = v[a]
            return own + own[i] - 2 * np.add.reduceat(v * dense[t], start), dense

        one = int(np.argmax(far(0)[0]))
        d_one, _ = far(one)
        d_two, _ = far(int(np.argmax(d_one)))
        return rows[np.argsort(d_one - d_two, kind="stable")]

    def _bound(self) -> None:
        """Centres (rounded means, as entries) and radii that are surely large enough."""
        self.centres, self.radii = [], np.zeros(len(self.spans))
        square = np.add.reduceat(self.x.astype(np.float64) ** 2, self.off[:-1])
        for k, (a, z) in enumerate(self.spans):
            e = slice(self.off[a], self.off[z])
            total = np.bincount(self.terms[e], weights=self.x[e], minlength=self.dims)
            c = np.rint(total / (z - a))  # any centre is right; whole numbers make a ball of copies exact
            at = np.flatnonzero(c)
            dist = square[a:z] + (c[at] ** 2).sum() - 2 * np.add.reduceat(self.x[e] * c[self.terms[e]], self.off[a:z] - self.off[a])
            # sums are of whole numbers, but may exceed what doubles hold exactly: allow for rounding in what was subtracted
            slack = 1e-12 * (square[a:z].max() + (c[at] ** 2).sum())
            worst = dist.max() + slack
            same = (self.off[a + 1 : z + 1] - self.off[a:z] == len(at)).all() and (np.tile(at, z - a) == self.terms[e]).all() and (np.tile(c[at], z - a) == self.x[e]).all()
            self.radii[k] = 0.0 if same else math.sqrt(max(worst, 0.0)) * SAFE + 1
            self.centres.append((at, c[at]))

    def bounds(self, items: np.ndarray) -> np.ndarray:
        """The most that a document of a node can score for an item: (node, item)."""
        out = np.empty((len(self.spans), len(items)))
        reach = np.empty_like(out)
        square = (items**2).T
        step = max(1, 2_000_000 // self.dims)
        for k in range(0, len(self.spans), step):
            dense = np.zeros((min(step, len(self.spans) - k), self.dims))
            held = np.zeros_like(dense)
            for i, (a, z) in enumerate(self.spans[k : k + step]):
                at, c = self.centres[k + i]
                dense[i, at] = c
                held[i, self.terms[self.off[a] : self.off[z]]] = 1
            out[k : k + step] = dense @ items.T
            reach[k : k + step] = held @ square
        exact = (self.radii == 0)[:, None] & (out < 2**52)
        return np.where(exact, out, out * SAFE + self.radii[:, None] * np.sqrt(reach) * SAFE + 1)

    def score(self, leaf: int, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact scores of a leaf's documents and their ids."""
        a, z = self.spans[leaf]
        e = slice(self.off[a], self.off[z])
        return np.add.reduceat(self.x[e] * item[self.terms[e]], self.off[a:z] - self.off[a]), self.ids[a:z]


class Best:
    """The ``limit`` best (score, id) of one item, smaller ids first among equals; none below ``floor`` or 1."""

    def __init__(self, limit: int, floor: int):
        self.limit, self.floor, self.worst_id = limit, max(1, floor), None
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def hopeless(self, bound: float, least_id: int) -> bool:
        return bound < self.floor or (bound == self.floor and self.worst_id is not None and least_id > self.worst_id)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        new = scores >= self.floor
        if not new.any():
            return
        s, d = np.append(self.scores, scores[new]), np.append(self.ids, ids[new])
        top = np.lexsort((d, -s))[: self.limit]
        self.scores, self.ids = s[top], d[top]
        if len(top) == self.limit:
            self.floor, self.worst_id = int(self.scores[-1]), int(self.ids[-1])


def search_ball(ball: Ball, items: np.ndarray, best: list[Best]) -> int:
    """Best-first search of one tree for all items; returns how many leaves were scored."""
    bounds = ball.bounds(items.astype(np.float64))
    scored = 0
    for i, found in enumerate(best):
        column = bounds[:, i].tolist()
        queue = [(-column[0], 0)]
        while queue:
            minus, k = heapq.heappop(queue)
            if -minus < found.floor:
                break  # the others are no better
            if found.hopeless(-minus, ball.least_id[k]):
                continue
            if ball.children[k] is None:
                found.add(*ball.score(k, items[i]))
                scored += 1
            else:
                for child in ball.children[k]:
                    if not found.hopeless(column[child], ball.least_id[child]):
                        heapq.heappush(queue, (-column[child], child))
    return scored


def _search(wanted: list[tuple[list[int], int]], weights: np.ndarray, limit: int):
    """(item, score, doc) of the best documents of a task for the items ``wanted``: terms and floor of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = np.zeros((len(wanted), len(weights)), dtype=np.int64)
        for i, (terms, _) in enumerate(wanted):
            items[i, terms] = weights[terms]
        best = [Best(limit, floor) for _, floor in wanted]
        held: list[pa.RecordBatch] = []
        docs = entries = 0

        def close() -> None:
            if held:
                t = pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=None)[0]
                terms, off = flat(t, "terms")
                x, _ = flat(t, "x")
                search_ball(Ball(t.column(t.schema.get_field_index("doc")).to_numpy(), terms, x, off, len(weights)), items, best)
                held.clear()

        for b in batches:
            off = b.column(b.schema.get_field_index("terms")).offsets.to_numpy().astype(np.int64)
            a = 0
            while a < b.num_rows:
                z = int(np.searchsorted(off, off[a] + BALL_ENTRIES - entries, side="right")) - 1
                z = min(max(z, a + (not held)), b.num_rows, a + BALL_DOCS - docs)
                if z > a:
                    held.append(b.slice(a, z - a))
                    docs, entries, a = docs + z - a, entries + int(off[z] - off[a]), z
                if a < b.num_rows:
                    close()
                    docs = entries = 0
        close()
        for i, found in enumerate(best):
            if len(found.ids):
                yield pa.record_batch([pa.array(np.full(len(found.ids), i, np.int32)), pa.array(found.scores), pa.array(found.ids)], names=["item", "score", "doc"])

    return run


FOUND = "item int, score long, doc long"


def _best(found: DataFrame, limit: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def _search_block(docs: DataFrame, asked: list[list[str]], limit: int) -> DataFrame:
    """(item, rank, doc, score) of the items with the terms ``asked``, numbered by place."""
    numbers = {t.encode(): i for i, t in enumerate(sorted({t for terms in asked for t in terms}))}
    vectors = written(docs.mapInArrow(_vectors(numbers), "doc long, n long, terms array<int>, tf array<long>"))
    total = vectors.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    weights = np.zeros(len(numbers), dtype=np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():  # a row for each term asked for
        weights[r.t] = math.floor(1000 * math.log((2 * total.docs + 2) / (2 * r.df + 1)))
    valued = vectors.mapInArrow(_values(total.docs, total.terms, weights), "strong int, doc long, terms array<int>, x array<long>")
    wanted = [[numbers[t.encode()] for t in terms] for terms in asked]
    some = valued.where(F.pmod(F.xxhash64("doc"), F.lit(FLOOR_PART)) == 0).mapInArrow(_search([(w, 0) for w in wanted], weights, limit), FOUND)
    floors = {r["item"]: r["score"] for r in _best(some, limit).where(F.col("rank") == limit).collect()}  # a row for each item
    dealt = valued.repartitionByRange("strong", "doc")
    return _best(dealt.mapInArrow(_search([(w, floors.get(i, 0)) for i, w in enumerate(wanted)], weights, limit), FOUND), limit)


def search(docs: DataFrame, items: DataFrame, limit: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``limit`` best documents of each item: item_id, rank, doc_id, score.

    Terms are runs of code points that are no ASCII signs, spaces or controls,
    A-Z lower-cased.  With N documents that have a term, L terms in all, n in
    the document, df documents that hold the term and tf occurrences in one, a
    term weighs w = floor(1000 ln((2 N + 2) / (2 df + 1))), and the score is
    the sum over the item's different terms of w * (10**9 tf div (1000 tf + 20
    m)), m = 50 + 50 n N div L.  Only scores above 0 count; equal scores rank
    by ascending doc_id.

    Items are taken in blocks of about ``BLOCK_ITEMS`` items and
    ``BLOCK_TERMS`` terms, whose terms go to every task; each block is a pass
    over all documents.

    Edge cases: null and empty texts have no terms, so such documents aren't
    counted and such items get no rows; a null doc_id comes first among equal
    scores; rows that repeat a doc_id are documents of their own, and rows that
    repeat an item_id are items of their own, each with its ranks from 1; a
    very long text is split into terms piece by piece; other columns are
    ignored; without documents or items there are no rows.
    """
    d = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    terms = F.array_distinct(F.regexp_extract_all(F.translate(F.col(item_text), UPPER, LOWER), F.lit(TERM), F.lit(0)))
    q = written(items.select(F.col(item_col).alias("item_id"), terms.alias("terms"), F.monotonically_increasing_id().alias("k")).where(F.size("terms") > 0))
    size = q.agg(F.count("*").alias("items"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    blocks = max(1, -(-size["items"] // BLOCK_ITEMS), -(-size["terms"] // BLOCK_TERMS))
    parts = []
    for block in range(blocks):
        own = q.where(F.pmod(F.xxhash64("k"), F.lit(blocks)) == block)
        rows = own.select("k", "terms").collect()
        if not rows and (parts or block + 1 < blocks):
            continue
        found = _search_block(d, [r.terms for r in rows], limit)
        keys = docs.sparkSession.createDataFrame([(i, r.k) for i, r in enumerate(rows)], "item int, k long")
        part = found.join(keys, "item").join(own.select("k", "item_id"), "k")
        part = part.select("item_id", "rank", F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "score")
        parts.append(written(part) if blocks > 1 else part)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
