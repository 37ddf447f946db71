"""Quality classifier: a generalised additive model with pairwise interactions.

Numeric features of the text are cut into bins.  Rounds of boosting go through
the features in turn; each time a shallow tree over the ordered bins is fitted
to the gradient and added to the feature's lookup table.  Then the pairs of
features with the largest gain get tables of their own in the same way.  A
score is the sum of table entries, looked up for whole batches at once.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, cut
from tidemark.llm.hashing import PLACE, row_slices, text_bytes, word_hashes

FEATURES = [
    "log_bytes", "log_words", "word_length", "distinct_words", "repeated_next", "upper", "digits", "marks", "symbols", "bars",
    "log_lines", "line_repeats", "spaces", "non_ascii", "repeated_fours", "ends_in_mark", "short_words", "top_word", "line_length", "ends_in_symbol",
]

_CLASS = np.zeros((7, 256), dtype=bool)
_CLASS[0, 65:91] = True
_CLASS[1, 48:58] = True
_CLASS[2, [ord(c) for c in ".,;:?"]] = True
_CLASS[3, [ord(c) for c in "!#$%&*@^~<>{}[]\\=+_"]] = True
_CLASS[4, ord("|")] = True
_CLASS[5, [9, 10, 11, 12, 13, 32]] = True
_CLASS[6, 128:] = True


def _share_repeated(x: np.ndarray) -> float:
    return 1 - len(np.unique(x)) / len(x) if len(x) else 0.0


def text_features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text; an empty or null text gives zeros."""
    raw, off = text_bytes(texts)
    out = np.zeros((len(off) - 1, len(FEATURES)))
    for i, j in row_slices(off):
        part, o = raw[off[i] : off[j]], off[i : j + 1] - off[i]
        words, first = word_hashes(part, o)
        if not len(part):
            continue
        sums = np.zeros((8, len(part) + 1), dtype=np.int64)
        for k in range(7):
            np.cumsum(_CLASS[k][part], out=sums[k, 1:])
        solid = ~_CLASS[5][part]
        edge = np.ones(len(part), dtype=bool)
        edge[:-1] = _CLASS[5][part[1:]]
        edge[o[1:][o[1:] > 0] - 1] = True
        ending = solid & edge
        np.cumsum(ending & _CLASS[2][part], out=sums[7, 1:])
        symbol_end = np.concatenate([[0], np.cumsum(ending & _CLASS[3][part])])
        end_at = np.flatnonzero(ending)
        opening = np.ones(len(part), dtype=bool)
        opening[1:] = ~solid[:-1]
        opening[o[:-1][o[:-1] < len(part)]] = True
        starts = np.flatnonzero(solid & opening)
        length = end_at - starts + 1
        short = np.concatenate([[0], np.cumsum(length <= 3)])
        same = np.concatenate([[0, 0], np.cumsum(words[1:] == words[:-1])]) if len(words) else np.zeros(1, np.int64)
        fours = sum((words[k : len(words) - 3 + k] * PLACE[k] for k in range(1, 4)), words[: len(words) - 3] * PLACE[0]) if len(words) > 3 else words[:0]
        for r in range(j - i):
            a, b, w0, w1 = o[r], o[r + 1], first[r], first[r + 1]
            n, nw = b - a, w1 - w0
            if not n:
                continue
            c = (sums[:, b] - sums[:, a]) / n
            lines = part[a:b].tobytes().split(b"\n")
            held, count = np.unique(words[w0:w1], return_counts=True)
            per = max(nw, 1)
            out[i + r] = [
                np.log1p(n), np.log1p(nw), (n - (sums[5, b] - sums[5, a])) / per, len(held) / per, (same[w1] - same[w0 + 1]) / max(nw - 1, 1) if nw > 1 else 0,
                c[0], c[1], c[2], c[3], c[4], np.log1p(len(lines)), 1 - len(set(lines)) / len(lines), c[5], c[6],
                _share_repeated(fours[w0 : max(w0, w1 - 3)]), (sums[7, b] - sums[7, a]) / per, (short[w1] - short[w0]) / per,
                (count.max() / per) if nw else 0, np.log1p(n / len(lines)), (symbol_end[b] - symbol_end[a]) / per,
            ]
    return out


@dataclass
class AdditiveModel:
    """Bin edges and tables; ``pairs`` hold coarse bins (every ``coarse``-th edge) of two features."""

    base: float
    edges: list[list[float]]
    tables: list[list[float]]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[list[float]] = field(default_factory=list)
    pair_tables: list[list[list[float]]] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        s = np.full(len(x), self.base)
        for f, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            s += np.asarray(t)[np.searchsorted(np.asarray(e), x[:, f], side="right")]
        for (f, g), t in zip(self.pairs, self.pair_tables, strict=True):
            at = [np.searchsorted(np.asarray(self.pair_edges[k]), x[:, k], side="right") for k in (f, g)]
            s += np.asarray(t)[at[0], at[1]]
        return s

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -35, 35)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float, l2: float) -> tuple[np.ndarray, float]:
    """Values of a shallow tree over ordered bins with gradient sums ``g`` and curvature ``h``, and its gain."""
    cuts = [(0, len(g))]
    gain = 0.0
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    part = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + l2)
    while len(cuts) < leaves:
        best = (1e-9, None)
        for a, b in cuts:
            for m in range(a + 1, b):
                if ch[m] - ch[a] >= least and ch[b] - ch[m] >= least and (d := part(a, m) + part(m, b) - part(a, b)) > best[0]:
                    best = (d, (a, m, b))
        if best[1] is None:
            break
        a, m, b = best[1]
        cuts.remove((a, b))
        cuts += [(a, m), (m, b)]
        gain += best[0]
    out = np.zeros(len(g))
    for a, b in cuts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + l2)
    return out, gain


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 60, rate: float = 0.15, pairs: int = 6, pair_bins: int = 6, pair_rounds: int = 30, l2: float = 2.0, least: float = 2.0) -> AdditiveModel:
    """Fit on features ``x`` and 0/1 labels ``y``; with one class only, its share (smoothed) is every score."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = AdditiveModel(float(np.log(share / (1 - share))), [[] for _ in range(x.shape[1])], [[0.0] for _ in range(x.shape[1])])
    if len(y) == 0 or y.min() == y.max():
        return model
    edges = [_edges(x[:, f], bins) for f in range(x.shape[1])]
    at = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    s = np.full(len(y), model.base)
    slope = lambda: (y - (p := 1 / (1 + np.exp(-s))), np.maximum(p * (1 - p), 1e-6))
    for _ in range(rounds):
        for f in range(x.shape[1]):
            g, h = slope()
            t, _gain = _tree(np.bincount(at[f], g, len(tables[f])), np.bincount(at[f], h, len(tables[f])), 4, least, l2)
            tables[f] += rate * t
            s += rate * t[at[f]]
    coarse = [_edges(x[:, f], pair_bins) for f in range(x.shape[1])]
    cat = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]
    size = [len(e) + 1 for e in coarse]
    g, h = slope()
    gains = []
    for f in range(x.shape[1]):
        for k in range(f + 1, x.shape[1]):
            cell = cat[f] * size[k] + cat[k]
            gg, hh = np.bincount(cell, g, size[f] * size[k]), np.bincount(cell, h, size[f] * size[k])
            gains.append((float((gg**2 / (hh + l2)).sum()), f, k))
    chosen = [(f, k) for _, f, k in sorted(gains, key=lambda z: (-z[0], z[1:]))[:pairs]]
    pair_tables = [np.zeros((size[f], size[k])) for f, k in chosen]
    for _ in range(pair_rounds):
        for n, (f, k) in enumerate(chosen):
            g, h = slope()
            cell = cat[f] * size[k] + cat[k]
            gg, hh = (np.bincount(cell, v, size[f] * size[k]).reshape(size[f], size[k]) for v in (g, h))
            rows, gain = _tree(gg.sum(1), hh.sum(1), 2, least, l2)  # first cut along one feature, then each side along the other
            step = np.zeros_like(gg)
            for v in np.unique(rows):
                side = rows == v
                step[side] = _tree(gg[side].sum(0), hh[side].sum(0), 2, least, l2)[0]
            pair_tables[n] += rate * step
            s += rate * step.ravel()[cell]
    model.edges, model.tables = [e.tolist() for e in edges], [t.tolist() for t in tables]
    model.pairs, model.pair_edges, model.pair_tables = chosen, [e.tolist() for e in coarse], [t.tolist() for t in pair_tables]
    return model


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, features (array of double in the order of ``FEATURES``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = text_features(b.column(1))
            off = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(off, pa.array(x.ravel()))], names=["doc_id", "features"])

    return bounded_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, features array<double>")


def held_out(id_col: str = "doc_id"):
    """True for the fifth of the ids that is never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(known: DataFrame, labels: DataFrame, sample: int = 20_000) -> AdditiveModel:
    """Fit on at most ``sample`` labelled rows that aren't held out, those with the smallest hash of their id."""
    rows = known.where(~held_out()).join(labels.where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id")
    rows = cut(rows.select("doc_id", "features", "quality", F.xxhash64("doc_id").alias("h")))
    # the hash range holds a little more than the sample, so that no task sends rows that the limit would drop
    rows = rows.where(F.pmod("h", F.lit(1 << 20)) < int(min(1.0, 1.3 * sample / max(1, rows.count()) + 1e-5) * (1 << 20)))
    got = rows.orderBy("h", "doc_id", "features").limit(sample).toPandas()
    x = np.array(got["features"].tolist(), dtype=float).reshape(len(got), len(FEATURES))
    return fit(x, got["quality"].to_numpy(dtype=float))


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    The score is the probability of label 1; ``labels`` (doc_id, quality) give
    the training rows and nothing else.  Null or empty texts score as a text
    whose features are all zero; a null id is scored and never learnt from;
    repeated rows are scored each; a very long text is read whole, in one
    task; a score of exactly 0.3 is predicted 1; an empty ``labels`` gives 0.5
    everywhere; other columns are ignored; an empty table gives no rows.
    """
    known = cut(features(docs))
    model = json.dumps(asdict(train(known, labels, sample)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = AdditiveModel(**json.loads(model))
        for b in batches:
            x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            s = m.score(x)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return known.select("doc_id", held_out().alias("held_out"), "features").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
