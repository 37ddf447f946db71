"""Repeated passages by content-defined chunks under a gear rolling hash.

A text's bytes are cut where the gear hash of the last 16 bytes falls below a
bound, unless another such place lies less than ``LEAST`` bytes before; the
rule looks at near bytes only, so chunks find themselves again after an
insertion.  From every chunk on, the shortest run of chunks that spans
``WINDOW`` bytes is a window; windows are grouped by digest, and those that two
documents hold are repeated, whichever documents hold the chunks alone.

Cuts near the ends of a passage depend on what surrounds it.  So where a
smaller document holds a run of windows, its ends are compared byte by byte
with the places of that document, and the run is extended to where they really
part.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from tidemark.llm.common import join_counted, join_null_safe, written
from tidemark.llm.hashing import BYTE, mix, powers, row_slices, text_bytes

MEAN = 24  # bytes to the next cut, beyond LEAST
LEAST = 12
MOST = 512
WINDOW = 72  # bytes that a window spans at least
RUN = 128  # bytes of a passage that counts
AROUND = 256  # bytes beyond each end that are compared; between cuts lie some dozen
NO_ID = -(2**63)
GEAR = (BYTE >> np.uint64(17)).astype(np.uint32)


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[raw[i - k]] << k over the last 32 bytes, modulo 2**32: the value of the rolling gear hash after byte i."""
    h = GEAR[raw]
    step = 1
    while step < 32:  # the window doubles: a run of 2s bytes is two of s, the older one shifted
        older = np.zeros_like(h)
        older[step:] = h[:-step] << np.uint32(step)
        h = h + older
        step *= 2
    return h


def cuts(raw: np.ndarray, mean: int = MEAN, least: int = LEAST, most: int = MOST) -> np.ndarray:
    """Ends of the chunks of one text, the last is its length; no cut is within a UTF-8 character."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64)
    # the low 16 bits of the hash come from the last 16 bytes
    at = np.flatnonzero((gear_hashes(raw) & np.uint32(0xFFFF)) < 2**16 // mean) + 1
    if len(at):
        at = at[np.diff(at, prepend=-least) >= least]
    ends = np.append(at[at < n], n)
    length = np.diff(ends, prepend=0)
    if (length > most).any():
        pieces = -(-length // most)
        begin = np.repeat(ends - length, pieces)
        k = np.arange(len(begin)) - np.repeat(np.cumsum(pieces) - pieces, pieces) + 1
        ends = np.minimum(begin + k * most, np.repeat(ends, pieces))
    for _ in range(3):
        inside = ends < n
        inside[inside] = (raw[ends[inside]] & 0xC0) == 0x80
        ends = ends + inside
    return ends[np.diff(ends, prepend=0) > 0]


def _windows(least: int):
    """Digests of the shortest runs of chunks that span ``least`` bytes from each chunk on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = text_bytes(b.column(2))
            doc = b.column(0).fill_null(NO_ID).to_numpy()
            own = b.column(1).to_numpy()
            for i, j in row_slices(off):
                part = raw[off[i] : off[j]]
                up, down = powers(len(part))
                total = np.zeros(len(part) + 1, dtype=np.uint64)
                np.cumsum(BYTE[part] * up[: len(part)], out=total[1:])
                starts, ends, rows = [], [], []
                for r in range(i, j):
                    a, z = off[r] - off[i], off[r + 1] - off[i]
                    e = cuts(part[a:z])
                    ends.append(e + a)
                    starts.append(np.concatenate([[0], e[:-1]]) + a if len(e) else e)
                    rows.append(np.full(len(e), r, dtype=np.int64))
                s, e, r = np.concatenate(starts), np.concatenate(ends), np.concatenate(rows)
                if not len(s):
                    continue
                on = np.searchsorted(e, s + least)
                fits = on < len(s)
                fits[fits] = r[on[fits]] == r[fits]
                if not fits.any():
                    continue
                s, e, r = s[fits], e[on[fits]], r[fits]
                digest = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
                place = ((s - (off[r] - off[i])).astype(np.int64) << 32) | (e - s)
                yield pa.record_batch([pa.array(digest.view(np.int64)), pa.array(doc[r]), pa.array(own[r]), pa.array(place)], names=["digest", "doc", "row_hash", "place"])

    return run


SPANS = "doc long, row_hash long, start int, stop int, first long, first_at int, first_doc long, last long, last_at int, last_doc long, removed boolean"


def _unions(cols: list[np.ndarray], removed: bool) -> pa.RecordBatch | None:
    """Unions of the windows that a smaller document holds (``removed``) or of all, with the digest, end and holder of the first and last window."""
    doc, row, place, other, digest = (c[cols[3] < cols[0]] for c in cols) if removed else cols
    if not len(doc):
        return None
    text = np.ones(len(doc), dtype=bool)
    text[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])
    base = np.cumsum(text) << 32
    start = base + (place >> 32)
    stop = start + (place & 0xFFFFFFFF)
    far = np.maximum.accumulate(stop)
    new = text.copy()
    new[1:] |= start[1:] > far[:-1]
    at = np.flatnonzero(new)
    # windows by place end by place, too
    z = np.append(at[1:], len(doc)) - 1
    small = lambda x: pa.array((x & 0xFFFFFFFF).astype(np.int32))
    return pa.record_batch(
        [pa.array(doc[at]), pa.array(row[at]), small(start[at]), small(far[z]), pa.array(digest[at]), small(start[at]), pa.array(other[at]), pa.array(digest[z]), small(stop[z]), pa.array(other[z]), pa.array(np.full(len(at), removed))],
        names=[c.split()[0] for c in SPANS.split(", ")],
    )


def _spans():
    """``_unions`` of both kinds from windows sorted by document, row and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            before = (cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1])
            last = int(np.flatnonzero(before)[-1]) + 1 if before.any() else 0
            held = [c[last:] for c in cols]
            if last:
                yield from (x for kind in (True, False) if (x := _unions([c[:last] for c in cols], kind)) is not None)
        if held is not None:
            yield from (x for kind in (True, False) if (x := _unions(held, kind)) is not None)

    return run


@F.pandas_udf(ArrayType(StructType([StructField("at", IntegerType()), StructField("side", IntegerType()), StructField("bytes", BinaryType())])))
def _surroundings(texts: pd.Series, asked: pd.Series) -> pd.Series:
    """Up to ``AROUND`` bytes before (side 0) or from (side 1) each place asked for."""
    out = []
    for t, places in zip(texts, asked, strict=True):
        raw = t.encode()
        out.append([{"at": p["at"], "side": p["side"], "bytes": raw[p["at"] : p["at"] + AROUND] if p["side"] else raw[max(0, p["at"] - AROUND) : p["at"]]} for p in places])
    return pd.Series(out, dtype=object)


@F.pandas_udf(IntegerType())
def _alike(own: pd.Series, other: pd.Series, side: pd.Series) -> pd.Series:
    """How many bytes next to an end are equal, cut so that no character is."""
    out = []
    for a, b, s in zip(own, other, side, strict=True):
        n, most = 0, min(len(a), len(b))
        if s:
            while n < most and a[n] == b[n]:
                n += 1
            while 0 < n < len(a) and a[n] & 0xC0 == 0x80:
                n -= 1
            if n == len(a) == AROUND:  # the next byte is out of sight
                while n and a[n - 1] & 0xC0 == 0x80:
                    n -= 1
                n = max(0, n - 1)
        else:
            while n < most and a[len(a) - 1 - n] == b[len(b) - 1 - n]:
                n += 1
            while n and a[len(a) - n] & 0xC0 == 0x80:
                n -= 1
        out.append(n)
    return pd.Series(out)


def _to_true_ends(spans: DataFrame, first: DataFrame, rows: DataFrame) -> DataFrame:
    """``spans`` (doc, row_hash, start, stop, ...) that a smaller document holds, as far as it holds them; ``first`` has its places of windows."""
    ends = spans.select(
        "doc", "row_hash", "start",
        F.explode(F.array(
            F.struct(F.lit(0).alias("side"), F.col("first").alias("digest"), F.col("first_at").alias("at"), F.col("first_doc").alias("holder")),
            F.struct(F.lit(1).alias("side"), F.col("last").alias("digest"), F.col("last_at").alias("at"), F.col("last_doc").alias("holder")),
        )).alias("e"),
    ).select("doc", "row_hash", "start", "e.*")
    # a window of the smallest document that holds it stands at one place, here the first; a frequent passage has many ends
    n = ends.groupBy("digest", "holder").agg(F.count("*").alias("n"))
    place = first.groupBy("digest", F.col("doc").alias("holder")).agg(F.min(F.struct("row_hash", "place")).alias("w")).join(n, ["digest", "holder"])
    place = place.select("digest", "holder", "n", F.col("w.row_hash").alias("h_row"), F.shiftright("w.place", 32).cast("int").alias("w_at"), F.col("w.place").bitwiseAND(0xFFFFFFFF).cast("int").alias("w_size"))
    met = written(join_counted(ends, written(place), ["digest", "holder"], "n").drop("n").withColumn("h_at", F.col("w_at") + F.when(F.col("side") == 1, F.col("w_size")).otherwise(0)))
    own = met.select("doc", "row_hash", "at", "side")
    theirs = met.select(F.col("holder").alias("doc"), F.col("h_row").alias("row_hash"), F.col("h_at").alias("at"), "side")
    asked = own.unionByName(theirs).distinct().groupBy("doc", "row_hash").agg(F.collect_list(F.struct("at", "side")).alias("asked"))
    # rows that repeat an id and its text are one text
    texts = rows.select("doc", "row_hash", "text").join(asked, ["doc", "row_hash"])
    around = texts.select("doc", "row_hash", F.explode(_surroundings("text", "asked")).alias("a")).select("doc", "row_hash", "a.*").groupBy("doc", "row_hash", "at", "side").agg(F.first("bytes").alias("bytes"))
    around = written(around)
    key = ["h_doc", "h_row", "h_at", "side"]
    often = met.groupBy(F.col("holder").alias("h_doc"), "h_row", "h_at", "side").agg(F.count("*").alias("n"))
    theirs = around.select(F.col("doc").alias("h_doc"), F.col("row_hash").alias("h_row"), F.col("at").alias("h_at"), "side", F.col("bytes").alias("h_bytes")).join(often, key)
    both = join_counted(met.withColumnRenamed("holder", "h_doc"), written(theirs), key, "n").join(around, ["doc", "row_hash", "at", "side"])
    more = both.select("doc", "row_hash", "start", "side", _alike("bytes", "h_bytes", "side").alias("more")).groupBy("doc", "row_hash", "start")
    more = more.agg(F.max(F.when(F.col("side") == 0, F.col("more"))).alias("left"), F.max(F.when(F.col("side") == 1, F.col("more"))).alias("right"))
    return spans.join(more, ["doc", "row_hash", "start"]).select("doc", "row_hash", (F.col("start") - F.col("left")).alias("start"), (F.col("stop") + F.col("right")).alias("stop"), F.col("first_doc").alias("other"), F.lit(True).alias("removed"))


FOUND = "doc long, row_hash long, start int, n_bytes int, other long, removed boolean"


def _final(least: int):
    """Passages of each text, sorted by kind and start: removed ones put together, and what they leave of the others."""

    def of(doc: int, row: int, spans: list[tuple[bool, int, int, int]]) -> list[tuple]:
        out: list[list] = []
        for removed, a, z, other in spans:  # removed ones first
            if removed and out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], z)
            elif removed:
                out.append([a, z, other])
        res = [(doc, row, a, z - a, other, True) for a, z, other in out if z - a >= least]
        gone = [(a, a + n) for _, _, a, n, *_ in res]
        k = 0
        for removed, a, z, other in spans:
            if removed:
                continue
            while k < len(gone) and gone[k][1] <= a:
                k += 1
            i, whole = k, z - a
            while a < z:
                stop = min(z, gone[i][0]) if i < len(gone) else z
                if whole >= least and stop - a >= min(least, LEAST):  # less is what lies between cuts and true ends
                    res.append((doc, row, a, stop - a, other, False))
                a, i = (max(a, gone[i][1]), i + 1) if i < len(gone) else (z, i)
        return res

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, out = [], None, []

        def batch() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=[c.split()[0] for c in FOUND.split(", ")])

        for b in batches:
            for doc, row, start, stop, other, removed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (doc, row) != key:
                    if held:
                        out += of(*key, held)
                    held, key = [], (doc, row)
                held.append((removed, start, stop, other))
            if len(out) >= 1_000:
                yield batch()
                out.clear()
        if held:
            out += of(*key, held)
        if out:
            yield batch()

    return run


def repeated_passages(docs: DataFrame, least_bytes: int = RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each repeated passage: doc_id, row_hash, start, n_bytes, other_doc_id, removed.

    ``start`` and ``n_bytes`` count UTF-8 bytes and never split a character.
    Rows of a text don't overlap.  A ``removed`` passage stands in documents of
    smaller ids too, up to its true ends (``AROUND`` bytes beyond the chunks at
    most); the others are what their largest holders find by whole chunks, and
    show where the first copy stands.  Passages of fewer than ``least_bytes``
    aren't reported; what removed ones leave of a longer one is, from
    ``LEAST`` bytes on.  ``other_doc_id`` is a hint: the smallest id that holds
    the passage's first window, or for that document itself the largest; it
    need not hold the whole passage.

    Edge cases: null and empty texts have no passage; a passage must stand in
    two ids, so rows that repeat an id don't make one (``row_hash`` tells their
    texts apart); rows with a null id count as one document, smaller than all
    others; a very long text is cut whole, in slices of some MB, and its
    windows are sorted in one task; other columns are ignored; an empty table
    gives no rows.
    """
    window = min(WINDOW, least_bytes)
    rows = docs.where(F.col(text_col).isNotNull()).select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text_col).alias("row_hash"), F.col(text_col).alias("text"))
    windows = rows.mapInArrow(_windows(window), "digest long, doc long, row_hash long, place long")
    shared = written(windows.groupBy("digest").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("n")).where("lo <> hi"))
    partner = F.when(F.col("doc") != F.col("lo"), F.col("lo")).otherwise(F.col("hi"))
    met = written(join_counted(windows, shared, ["digest"], "n").select("doc", "row_hash", "place", partner.alias("other"), "digest"))
    by = ["doc", "row_hash"]
    spans = written(met.repartition(*by).sortWithinPartitions(*by, "place").mapInArrow(_spans(), SPANS))
    gone = _to_true_ends(spans.where("removed"), met.where("other > doc"), rows)
    seen = spans.where("not removed").select(*by, "start", "stop", F.col("first_doc").alias("other"), "removed")
    both = gone.unionByName(seen).repartition(*by).sortWithinPartitions(*by, F.desc("removed"), "start")
    out = both.mapInArrow(_final(least_bytes), FOUND)
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(real("doc").alias("doc_id"), "row_hash", "start", "n_bytes", real("other").alias("other_doc_id"), "removed")


@F.pandas_udf(StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for t, s in zip(texts, spans, strict=True):
        if t is None or s is None:
            out.append(t)
            continue
        raw, keep, at = t.encode(), [], 0
        for x in sorted(s, key=lambda x: x["start"]):
            keep.append(raw[at : x["start"]])
            at = max(at, x["start"] + x["n_bytes"])
        out.append(b"".join([*keep, raw[at:]]).decode())
    return pd.Series(out, dtype=object)


def remove_repeats(docs: DataFrame, least_bytes: int = RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every passage gone that a smaller id holds; all rows and other columns stay."""
    found = repeated_passages(docs, least_bytes, id_col, text_col).where("removed").groupBy(F.col("doc_id").alias("__id"), F.col("row_hash").alias("__row")).agg(F.collect_set(F.struct("start", "n_bytes")).alias("__spans"))
    d = docs.withColumn("__id", F.col(id_col).cast("long")).withColumn("__row", F.xxhash64(F.col(text_col)))
    j = join_null_safe(d, found, ["__id", "__row"], "left").withColumn("__text", _without(F.col(text_col), F.col("__spans")))
    return j.select(*[F.col("__text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
