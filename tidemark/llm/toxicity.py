"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are hashed openings of words (4 to 7 bytes, and the whole word), so a
stem is met whatever its ending.  A first aggregation counts in how many toxic
and clean sample documents each feature stands; the most telling ones are kept
(a fixed number).  One weight for each feature is shared by all thresholds of
the ordered grades; the result is P(grade >= k) for every k and the expected
grade.

``labels.toxic`` is 0 or 1, so the grades of toxic rows for training come from
elsewhere: the sample is cut in two by a hash, the log odds of features are
counted in each half, and a toxic row's severity is the sum of the other half's
odds over the telling features it holds, each once.  The thirds of that severity among the
toxic rows are the grades 1 to 3.  So no row has a part in its own grade, and
the regression's weights have none at all; but a grade still says how much
telling language a text has, as no human has graded it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import bounded_batches, cut
from tidemark.llm.hashing import BYTE, LOWER, PLACE, SPACE, mix, powers, row_slices, text_bytes

OPENINGS = (4, 5, 6, 7)
BITS = 44  # of a feature's hash, so that it fits beside a row's number
LEVELS = 3  # grades above 0
SAMPLE = 2000  # toxic rows that a model is fitted on, at most; clean ones: CLEAN times as many
CLEAN = 3
KEPT = 2048  # features kept
TOXIC_AT = 0.4  # P(grade >= 1) from which a text is called toxic; on labelled rows outside the sample clean texts stay below 0.14 in 999 of 1000 cases
ODDS = 2.0  # least absolute log odds of a feature; common words, near 0, would add up in long texts


def word_features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of slices of rows: first row, row number of each feature occurrence within the slice, feature hash."""
    raw, off = text_bytes(texts)
    for i, j in row_slices(off):
        part, o = raw[off[i] : off[j]], off[i : j + 1] - off[i]
        n = len(part)
        if not n:
            continue
        solid = ~SPACE[part]
        opening, closing = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        opening[1:], closing[:-1] = ~solid[:-1], ~solid[1:]
        opening[o[:-1][o[:-1] < n]] = True
        closing[o[1:][o[1:] > 0] - 1] = True
        starts, ends = np.flatnonzero(solid & opening), np.flatnonzero(solid & closing) + 1
        row = np.searchsorted(o, starts, side="right") - 1
        up, down = powers(n)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE[LOWER[part]] * up[:n], out=total[1:])
        rows, hashes = [], []
        for k in (*OPENINGS, 0):
            fits = ends - starts >= k if k else np.ones(len(starts), dtype=bool)
            a = starts[fits]
            b = a + k if k else ends[fits]
            hashes.append(mix((total[b] - total[a]) * down[a] + PLACE[40 + k]))
            rows.append(row[fits])
        yield i, np.concatenate(rows), np.concatenate(hashes) >> np.uint64(64 - BITS)


def _row_counts(row: np.ndarray, column: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cell, count = np.unique(row * width + column, return_counts=True)
    return cell // width, cell % width, count


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean rows of the batch each feature stands, and in how many of the second half."""
    for b in batches:
        y, half = (b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in (2, 3))
        for i, row, h in word_features(b.column(1)):
            both = np.unique((row.astype(np.uint64) << np.uint64(BITS)) | h)
            f, at = np.unique(both & np.uint64(2**BITS - 1), return_inverse=True)
            row = i + (both >> np.uint64(BITS)).astype(np.int64)
            counts = [np.bincount(at, w[row], len(f)).astype(np.int64) for w in (y, 1 - y, y * half, (1 - y) * half)]
            yield pa.record_batch([pa.array(f.view(np.int64)), *map(pa.array, counts)], names=["f", "toxic", "clean", "toxic2", "clean2"])


def _vectors(kept: np.ndarray):
    """Sparse vectors over the sorted feature hashes ``kept``: columns and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list[int]] = [[] for _ in range(b.num_rows)]
            counts: list[list[int]] = [[] for _ in range(b.num_rows)]
            for part in _counts(b.column(1), kept):
                for r, c, n in zip(*(x.tolist() for x in part), strict=True):
                    cols[r].append(c)
                    counts[r].append(n)
            yield pa.record_batch([b.column(2), b.column(3), pa.array(cols, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))], names=["y", "half", "cols", "counts"])

    return run


def _counts(texts: pa.Array, kept: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, column in ``kept`` and count of every kept feature that stands in a text."""
    maybe = np.zeros(1 << 20, dtype=bool)
    maybe[kept >> np.uint64(BITS - 20)] = True
    for i, row, h in word_features(texts):
        few = maybe[h >> np.uint64(BITS - 20)]
        row, h = row[few], h[few]
        at = np.minimum(np.searchsorted(kept, h), len(kept) - 1)
        hit = kept[at] == h
        r, c, n = _row_counts(row[hit], at[hit], len(kept))
        yield i + r, c, n


def fit_ordinal(x: np.ndarray, grade: np.ndarray, levels: int, steps: int = 1000, rate: float = 0.1, l2: float = 3e-6) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of P(grade >= k) = sigmoid(x.w - t_k), by full-batch Adam on the likelihood."""
    p = np.concatenate([np.zeros(x.shape[1]), [1.0], np.full(levels - 1, np.log(1.5))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    k = levels
    back = np.ascontiguousarray(x.T)
    for step in range(1, steps + 1):
        w, t = p[: x.shape[1]], np.cumsum(np.concatenate([p[-k:][:1], np.exp(p[-k:][1:])]))
        s = (x @ w.astype(x.dtype)).astype(float)
        above = 1 / (1 + np.exp(-np.clip(s[:, None] - t, -30, 30)))  # P(grade >= 1..k)
        full = np.concatenate([np.ones((len(s), 1)), above, np.zeros((len(s), 1))], 1)
        at = np.arange(len(s))
        prob = np.maximum(full[at, grade] - full[at, grade + 1], 1e-9)
        slope = above * (1 - above)
        pad = np.concatenate([np.zeros((len(s), 1)), slope, np.zeros((len(s), 1))], 1)
        gs = -(pad[at, grade] - pad[at, grade + 1]) / prob / len(s)
        gt = np.zeros(k)
        np.add.at(gt, grade[grade > 0] - 1, (pad[at, grade] / prob / len(s))[grade > 0])
        np.add.at(gt, grade[grade < k], -(pad[at, grade + 1] / prob / len(s))[grade < k])
        free = np.concatenate([[1.0], np.exp(p[-k:][1:])])
        g = np.concatenate([(back @ gs.astype(x.dtype)).astype(float) + l2 * w, np.cumsum(gt[::-1])[::-1] * free])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[: x.shape[1]], np.cumsum(np.concatenate([p[-k:][:1], np.exp(p[-k:][1:])]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Fit on at most ``sample`` toxic and ``CLEAN * sample`` clean labelled rows, those with the smallest hash of their id.

    Without rows of both classes the model says grade 0 for every text.
    """
    none = {"features": [], "weights": [], "thresholds": [30.0, 31.0, 32.0]}
    y = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic"))
    ids = None
    for c in (0, 1):
        one = y.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample if c else CLEAN * sample)
        ids = one if ids is None else ids.union(one)
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 1
    rows = cut(docs.select("doc_id", "text").join(F.broadcast(cut(ids)), "doc_id").select("doc_id", "text", "toxic", half.alias("half")))  # (1 + CLEAN) * sample ids at most
    n = {(int(r.toxic), bool(r.half)): r.n for r in rows.groupBy("toxic", "half").agg(F.count("*").alias("n")).collect()}
    n_of = lambda c: n.get((c, False), 0) + n.get((c, True), 0)
    if not n_of(0) or not n_of(1):
        return none
    seen = rows.mapInArrow(_presence, "f long, toxic long, clean long, toxic2 long, clean2 long").groupBy("f").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"), F.sum("toxic2").alias("a2"), F.sum("clean2").alias("b2"))
    odds = F.log((F.col("a") + 0.5) / (n_of(1) + 1)) - F.log((F.col("b") + 0.5) / (n_of(0) + 1))
    best = seen.where(F.col("a") + F.col("b") >= 5).withColumn("odds", odds).where(F.abs("odds") >= ODDS).withColumn("z", F.abs("odds") / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))).orderBy(F.desc("z"), "f").limit(KEPT).drop("z", "odds").toPandas()
    if best.empty:
        return none
    h = best["f"].to_numpy().astype(np.int64).view(np.uint64)
    o = np.argsort(h)
    kept = h[o]
    got = rows.select("doc_id", "text", "toxic", "half").mapInArrow(_vectors(kept), "y double, half boolean, cols array<int>, counts array<int>").toPandas()
    x = np.zeros((len(got), len(kept)), dtype=np.float32)
    for r, (c, k) in enumerate(zip(got["cols"], got["counts"], strict=True)):
        x[r, np.asarray(c, int)] = np.log1p(np.asarray(k, float))
    count = {c: best[c].to_numpy()[o].astype(float) for c in ("a", "b", "a2", "b2")}
    severity = _other_half(x > 0, got["half"].to_numpy().astype(bool), count, n)
    toxic = got["y"].to_numpy() > 0
    edges = np.quantile(severity[toxic], [k / LEVELS for k in range(1, LEVELS)])
    grades = np.where(toxic, 1 + (severity[:, None] > edges).sum(1), 0).astype(int)
    w, t = fit_ordinal(x, grades, LEVELS)
    return {"features": kept.view(np.int64).tolist(), "weights": w.tolist(), "thresholds": t.tolist()}


def _other_half(held: np.ndarray, half: np.ndarray, count: dict[str, np.ndarray], n: dict[tuple[int, bool], int]) -> np.ndarray:
    """Sum over the features of each row of their positive log odds in the half that the row isn't in."""
    second = np.log((count["a2"] + 0.5) / (n.get((1, True), 0) + 1)) - np.log((count["b2"] + 0.5) / (n.get((0, True), 0) + 1))
    first = np.log((count["a"] - count["a2"] + 0.5) / (n.get((1, False), 0) + 1)) - np.log((count["b"] - count["b2"] + 0.5) / (n.get((0, False), 0) + 1))
    return np.where(half, held @ np.maximum(first, 0), held @ np.maximum(second, 0))


RESULTS = {"p_toxic": "double", "severity": "double", "grade": "integer", "toxic": "boolean"}


def grade(docs: DataFrame, model: dict, text_col: str = "text", names: dict[str, str] | None = None) -> DataFrame:
    """All columns of ``docs`` and p_toxic (grade 1 or more), severity (expected grade, 0 to 3), grade (most likely), toxic (p_toxic >= TOXIC_AT).

    A null or empty text has no features and so the model's base grade, 0; a
    very long text is read whole, in one task; every row is graded by itself,
    ties and repeated rows alike; a column of ``docs`` keeps its values, and a
    result of the same name gets ``_`` before it (or what ``names`` says); an
    empty table gives no rows.
    """
    spec = json.dumps(model)
    ours = []
    for name in RESULTS:
        name = (names or {}).get(name, name)
        while name in docs.columns:
            name = f"_{name}"
        ours.append(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = json.loads(spec)
        kept, w, t = np.array(m["features"], dtype=np.int64).view(np.uint64), np.array(m["weights"]), np.array(m["thresholds"])
        for b in batches:
            s = np.zeros(b.num_rows)
            if len(kept):
                for r, c, n in _counts(b.column(b.schema.get_field_index(text_col)), kept):
                    np.add.at(s, r, w[c] * np.log1p(n))
            above = 1 / (1 + np.exp(-np.clip(s[:, None] - t, -30, 30)))
            full = np.concatenate([np.ones((len(s), 1)), above, np.zeros((len(s), 1))], 1)
            results = [pa.array(above[:, 0]), pa.array(above.sum(1)), pa.array(np.argmax(full[:, :-1] - full[:, 1:], 1).astype(np.int32)), pa.array(above[:, 0] >= TOXIC_AT)]
            yield pa.record_batch([*b.columns, *results], names=[*b.schema.names, *ours])

    schema = StructType(list(bounded_batches(docs).schema.fields))
    for name, kind in zip(ours, RESULTS.values(), strict=True):
        schema = schema.add(name, kind)
    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` that aren't toxic, with its columns as they are."""
    names = {n: f"__{n}" for n in RESULTS}
    out = grade(docs, model, names=names)
    return out.where(~F.col(out.columns[-1])).select(*[F.col(f"`{c}`") for c in docs.columns])
