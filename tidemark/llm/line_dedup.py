"""Repeated-line removal by sorted hashes and keep bitmaps.

Hashes of long lines are range-partitioned by (hash, document) and sorted by
(hash, document descending, position).  Every partition is streamed: a hash
that enough documents hold keeps its lines in the first document met, the one
with the largest id.  As the range boundaries include the document, lines of a
very frequent hash spread over many partitions; only the first and the last
run of a partition can continue elsewhere, and their summaries (two rows a
partition at most) are what the driver adds up.  No text is shuffled for the
decision: the result is a compressed keep bitmap for every document.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.llm.common import bounded_batches, cut, join_null_safe

STRIP = " \t\n\x0b\x0c\r"
NO_ID = -(2**63)  # stands for a null id inside tasks


def line_key(line: str) -> bytes:
    """The line without white space at its ends, A-Z in lower case."""
    return line.strip(STRIP).encode().lower()


def _line_rows(min_chars: int):
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("doc", pa.int64()), ("row_hash", pa.int64()), ("pos", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, rows, places = [], [], []
            for r, text in enumerate(b.column(2)):
                t = text.as_py()
                if not t or len(t) < min_chars:
                    continue
                for p, line in enumerate(t.split("\n")):
                    if len(line) >= min_chars and len(s := line.strip(STRIP)) >= min_chars:
                        keys.append(xxhash.xxh3_128_digest(s.encode().lower()))
                        rows.append(r)
                        places.append(p)
            if keys:
                k = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
                at = pa.array(rows, pa.int32())
                doc = b.column(0).fill_null(NO_ID).take(at)
                yield pa.record_batch([pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()), doc, b.column(1).take(at), pa.array(places, pa.int32())], schema=schema)

    return run


def _columns(b: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in b.columns]


def _starts(k1: np.ndarray, k2: np.ndarray, *more: np.ndarray) -> np.ndarray:
    new = np.ones(len(k1), dtype=bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    for x in more:
        new[1:] |= x[1:] != x[:-1]
    return new


def _edge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the partition's first and last run of one hash: documents in it and the largest."""
    first = now = None
    for b in batches:
        k1, k2, doc, _, _ = _columns(b)
        if not len(k1):
            continue
        at = np.flatnonzero(_starts(k1, k2))
        ends = np.append(at[1:], len(k1))
        fresh = _starts(k1, k2, doc)
        ends_of = [(at[x], ends[x]) for x in sorted({0, len(at) - 1})]
        for i, j in ends_of:
            run = {"key": (int(k1[i]), int(k2[i])), "n": int(fresh[i:j].sum()), "doc": int(doc[i]), "last": int(doc[j - 1])}
            if now and now["key"] == run["key"]:
                now["n"] += run["n"] - (now["last"] == run["doc"])
                now["last"] = run["last"]
            else:
                first, now = first or now, run
    rows = [r for r in (first, now) if r]
    if rows:
        yield pa.record_batch([pa.array(list(c), pa.int64()) for c in zip(*[(*r["key"], r["n"], r["doc"]) for r in rows], strict=True)], names=["k1", "k2", "n", "doc"])


def _drops(min_docs: int, edges: dict[tuple[int, int], tuple[int, int]]):
    """Lines that go, streaming sorted rows; an open run is held only until it has enough documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        settled: tuple[int, int, int] | None = None  # hash of the open run that has enough documents, and its largest document

        def out(doc: np.ndarray, row: np.ndarray, pos: np.ndarray, go: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(doc[go]), pa.array(row[go]), pa.array(pos[go])], names=["doc", "row_hash", "pos"])

        def decide(cols: list[np.ndarray], final: bool):
            nonlocal held, settled
            k1, k2, doc, row, pos = cols
            at = np.flatnonzero(_starts(k1, k2))
            ends = np.append(at[1:], len(k1))
            docs = np.flatnonzero(_starts(k1, k2, doc))
            per = np.diff(np.append(np.searchsorted(docs, at), len(docs)))
            best = doc[at].copy()
            enough = per >= min_docs
            for x in {0, len(at) - 1}:
                key = (int(k1[at[x]]), int(k2[at[x]]))
                if key in edges:
                    n, best[x] = edges[key]
                    enough[x] = n >= min_docs
                elif settled and settled[:2] == key:
                    enough[x], best[x] = True, settled[2]
            if final or (int(k1[-1]), int(k2[-1])) in edges:
                upto, settled = len(k1), None
            elif enough[-1]:
                upto, settled = len(k1), (int(k1[-1]), int(k2[-1]), int(best[-1]))
            else:
                upto, settled = int(at[-1]), None
            held = [c[upto:] for c in cols] if upto < len(k1) else None
            run_of = np.repeat(np.arange(len(at)), ends - at)[:upto]
            go = enough[run_of] & (doc[:upto] != best[run_of])
            return out(doc[:upto], row[:upto], pos[:upto], go) if go.any() else None

        for b in batches:
            if not b.num_rows:
                continue
            cols = _columns(b)
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if (got := decide(cols, False)) is not None:
                yield got
        if held is not None and (got := decide(held, True)) is not None:
            yield got

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for n, drop in zip(b.column(2).to_pylist(), b.column(3), strict=True):
            keep = np.ones(n, dtype=bool)
            if drop.is_valid:
                keep[drop.values.to_numpy()] = False
            out.append((int(n - keep.sum()), zlib.compress(np.packbits(keep).tobytes(), 6)))
        dropped, maps = zip(*out, strict=True) if out else ((), ())
        yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())], names=["doc_id", "row_hash", "n_lines", "n_dropped", "keep_bitmap"])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row_hash"), text.alias("text"))


def line_keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per document: doc_id, row_hash, n_lines, n_dropped, keep_bitmap.

    A line whose key (white space stripped at its ends, A-Z lowered) has at
    least ``min_chars`` code points and occurs in at least ``min_docs``
    documents goes from all but the largest document id that holds it.
    ``keep_bitmap`` is a zlib-compressed bit for every line, 1 to keep.

    Edge cases: a null or empty text is one empty line that stays; rows with a
    null id count as one document, smaller than all others; rows that repeat an
    id and a text get the same decision, rows that repeat only the id are told
    apart by ``row_hash`` and count once for the frequency; of equal lines in
    the largest document all stay; a very long text is split whole, in one
    task, and its bitmap has a bit for each line; other columns of ``docs`` are
    ignored; an empty table gives no rows.
    """
    rows = _rows(docs, id_col, text_col)
    lines = rows.mapInArrow(_line_rows(min_chars), "k1 long, k2 long, doc long, row_hash long, pos int")
    by = ["k1", "k2", F.desc("doc")]
    ordered = cut(lines.repartitionByRange(*by).sortWithinPartitions(*by, "pos"))
    edges: dict[tuple[int, int], tuple[int, int]] = {}
    for r in ordered.mapInArrow(_edge_runs, "k1 long, k2 long, n long, doc long").collect():  # two rows a partition at most
        n, doc = edges.get((r.k1, r.k2), (0, NO_ID))
        edges[r.k1, r.k2] = (n + r.n, max(doc, r.doc))
    gone = ordered.mapInArrow(_drops(min_docs, edges), "doc long, row_hash long, pos int")
    gone = gone.groupBy(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "row_hash").agg(F.collect_set("pos").alias("drop"))
    info = rows.select("doc_id", "row_hash", (F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"))
    info = join_null_safe(info, gone, ["doc_id", "row_hash"], "left").select("doc_id", "row_hash", "n_lines", "drop")
    return info.mapInArrow(_bitmaps, "doc_id long, row_hash long, n_lines long, n_dropped long, keep_bitmap binary")


def kept_text(text: str, bitmap: bytes) -> str:
    lines = text.split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[: len(lines)]
    return text if keep.all() else "\n".join(x for x, k in zip(lines, keep, strict=True) if k)


def _marked(docs: DataFrame, bitmaps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the bitmap of each row that loses lines as ``__map``."""
    d = docs.withColumn("__id", F.col(id_col).cast("long")).withColumn("__row", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    marks = bitmaps.where("n_dropped > 0").groupBy(F.col("doc_id").alias("__id"), F.col("row_hash").alias("__row")).agg(F.max("n_dropped").alias("__dropped"), F.max("keep_bitmap").alias("__map"))
    return join_null_safe(d, marks, ["__id", "__row"], "left")


@F.pandas_udf(StringType())
def _keep(texts: pd.Series, maps: pd.Series) -> pd.Series:
    return pd.Series([t if m is None or t is None else kept_text(t, m) for t, m in zip(texts, maps, strict=True)], dtype=object)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that the bitmaps drop taken out of the text; all rows and the other columns stay."""
    j = _marked(docs, bitmaps, id_col, text_col).withColumn("__kept", _keep(F.col(text_col), F.col("__map")))
    return j.select(*[F.col("__kept").alias(n) if n == text_col else F.col(f"`{n}`") for n in docs.columns])


def kept_digests(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    j = _marked(docs.select(F.col(id_col), text.alias(text_col)), bitmaps, id_col, text_col)
    lines = F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1
    return j.select(F.col("__id").alias("doc_id"), lines.cast("long").alias("n_lines"), F.coalesce("__dropped", F.lit(0)).cast("long").alias("n_dropped"), F.sha2(_keep(F.col(text_col), F.col("__map")), 256).alias("kept_sha256"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` without repeated lines; every row and column stays, only the text changes."""
    return apply_bitmaps(docs, line_keep_bitmaps(docs, id_col, text_col, min_chars, min_docs), id_col, text_col)
