"""Cheapest repair of conversations: an optional system row, then user and assistant in turn.

Rows are ordered once over the whole table and numbered; segments of 4,096
numbered rows of a conversation carry one byte a row (role and fault).  A
segment is a 4 x 4 matrix of costs between the states before and after it;
matrices of a conversation combine from its end, which gives the cost of what
follows each segment.  Then every segment, alone, links its nodes (row, state)
by arcs that a cheapest repair may take, ranks the nodes by the letters of
their next 1, 2, 4, ... edits, and reads the least path off the doubled
pointers, for each state that it may begin in.  Long conversations are thus
spread over tasks; only what leaves a conversation as one cell (its edits, one
letter a row, and its SHA-256, which can't be cut) passes one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

SPACES = " \t\n\x0b\x0c\r"
SEGMENT_BITS = 12
STRIDE = 40  # bits of a row's number within its task
CHUNK = 32_768  # rows that are linked at once, about
NEVER = 10**9

START, SYSTEM, USER, ASSISTANT = range(4)  # states: the role that stands last
NEXT = np.array([USER, USER, ASSISTANT, USER])  # the role that an inserted or changed row gets
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
LETTERS = "DIKR"  # delete 3, insert 2, keep 0, change the role 2
ENDS = np.array([0, 4, 2, 0])  # cost of what the end still lacks
CLOSERS = ["", "II", "I", ""]
ROLE = {USER: "user", ASSISTANT: "assistant"}


def _arcs() -> tuple[np.ndarray, np.ndarray]:
    """Target state and cost by (letter, code of the row, state); code = 4 * role + fault, role as a state or 0."""
    to = np.zeros((4, 16, 4), dtype=np.int64)
    cost = np.full((4, 16, 4), NEVER, dtype=np.int64)
    for code in range(16):
        role, fault = divmod(code, 4)
        for q in range(4):
            to[:, code, q] = q, NEXT[q], role, NEXT[q]
            cost[:2, code, q] = 3, 2
            if fault not in (BLANK, DUPLICATE):
                extra = int(fault == TRUNCATED)
                if role and (role == NEXT[q] or (role == SYSTEM and q == START)):
                    cost[2, code, q] = extra
                cost[3, code, q] = 2 + extra
    return to, cost


TO, COST = _arcs()


def _steps() -> np.ndarray:
    """Least cost of passing a row, inserts before it and all, by (code, state before, state after)."""
    out = np.full((16, 4, 4), NEVER, dtype=np.int64)
    for code in range(16):
        for q in range(4):
            at, before = q, 0
            for _ in range(3):  # a third insert would come back to a state
                for letter in (0, 2, 3):
                    p = TO[letter, code, at]
                    out[code, q, p] = min(out[code, q, p], before + COST[letter, code, at])
                at, before = NEXT[at], before + 2
    return np.minimum(out, NEVER)


STEPS = _steps()


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Costs of passing ``a`` and then ``b``, arrays of 4 x 4."""
    return np.minimum((a[:, :, :, None] + b[:, None, :, :]).min(axis=2), NEVER)


def to_the_end(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each row the costs of passing it and all others up to the end of its segment (``ends``, exclusive, by row)."""
    m, step, row = STEPS[codes], 1, np.arange(len(codes))
    while step < (ends - row).max(initial=0):
        more = np.flatnonzero(row + step < ends)
        new = m.copy()
        new[more] = combine(m[more], m[more + step])
        m, step = new, step * 2
    return m


def least_paths(codes: np.ndarray, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, list[list[str]]]:
    """State after, and letters of the least cheapest path through, each segment from each state before.

    Segments begin at the rows ``first``; ``after[g, q]`` is the cost of all
    that follows segment g from state q.
    """
    n, n_seg = len(codes), len(first)
    seg = np.cumsum(np.bincount(first, minlength=n)) - 1
    ends = np.append(first[1:], n)
    total = (to_the_end(codes, ends[seg]) + after[seg][:, None, :]).min(axis=2)  # from (row, state) to the conversation's end
    rest = np.concatenate([total, after]).ravel()  # nodes: 4 a row, then 4 for what follows each segment
    beyond = np.where(np.arange(n) + 1 < ends[seg], np.arange(1, n + 1), n + seg)
    state = np.arange(4)
    target = np.stack([4 * (np.arange(n)[:, None] if k == 1 else beyond[:, None]) + TO[k][codes] for k in range(4)])  # (letter, row, state)
    cheapest = COST[:, codes, :] + rest[target] == total
    # ranks: the least next letter first, then the ranks of as many letters more, over and over
    own = 4 * n + 4 * n_seg
    rank, step = np.zeros(own, dtype=np.int64), np.arange(own)
    rank[: 4 * n] = np.argmax(cheapest, axis=0).ravel() + 1
    step[: 4 * n] = np.take_along_axis(target, np.argmax(cheapest, axis=0)[None], axis=0).ravel()
    jumps = [step]
    length = 1
    while length < 3 * int((ends - first).max(initial=0)):
        rank = np.unique(rank * (own + 1) + rank[jumps[-1]], return_inverse=True)[1]
        jumps.append(jumps[-1][jumps[-1]])
        length *= 2
    # of the cheapest arcs of a node the one of least rank: its letter, then the rank of where it leads (letters
    # differ between the arcs of a node, so the pointers above follow these very arcs)
    order = np.where(cheapest, np.arange(4)[:, None, None] * (own + 1) + rank[target], np.iinfo(np.int64).max)
    letter = np.argmin(order, axis=0).ravel()
    begin = (4 * first[:, None] + state).ravel()
    # how many edits until the segment is left: jumps that stay inside, from the longest on
    at, edits = begin.copy(), np.zeros(len(begin), dtype=np.int64)
    for k in range(len(jumps) - 1, -1, -1):
        inside = jumps[k][at] < 4 * n
        edits += inside * (1 << k)
        at = np.where(inside, jumps[k][at], at)
    leaves = jumps[0][at] - 4 * n - 4 * np.repeat(np.arange(n_seg), 4)
    edits += 1
    path = np.repeat(begin, edits)
    nth = np.arange(len(path)) - np.repeat(np.cumsum(edits) - edits, edits)
    for k, jump in enumerate(jumps):
        path = np.where(nth >> k & 1, jump[path], path)
    text = np.frombuffer(LETTERS.encode(), np.uint8)[letter[path]].tobytes().decode()
    stops = np.cumsum(edits).tolist()
    pieces = [text[a:z] for a, z in zip([0, *stops[:-1]], stops, strict=True)]
    return leaves.reshape(n_seg, 4), [pieces[4 * g : 4 * g + 4] for g in range(n_seg)]


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their place ``at``, in the order of tasks and rows."""
    at = TaskContext.get().partitionId() << STRIDE
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.arange(at, at + b.num_rows))], names=[*b.schema.names, "at"])
        at += b.num_rows


def _starts(b: pa.Table, keys: list[str]) -> np.ndarray:
    """Rows of sorted ``b`` at which any of ``keys`` changes."""
    new = np.zeros(b.num_rows, dtype=bool)
    new[:1] = True
    for k in keys:
        c = b.column(k)
        new[1:] |= pc.not_equal(c.slice(1), c.slice(0, max(0, b.num_rows - 1))).to_numpy()
    return np.flatnonzero(new)


def _whole(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of sorted ``keys``, and where the groups start; one group and a batch are held."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        t = pa.Table.from_batches(held).combine_chunks()
        at = _starts(t, keys)
        if len(at) > 1:
            yield t.slice(0, at[-1]), at[:-1]
            held = t.slice(at[-1]).to_batches()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, _starts(t, keys)


SEGMENTS = "conv string, seg long, codes binary, cost array<long>, counts array<long>, low long, high long, turns long"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a segment from its rows, each after the mark of a first occurrence if it is one."""
    for t, _ in _whole(batches, ["conv", "seg"]):
        at, mark = t.column("at").to_numpy(), t.column("code").is_null().to_numpy()
        is_row = ~mark
        fresh = np.append(False, mark[:-1])[is_row]  # a mark stands directly before its row
        t = t.filter(pa.array(is_row))
        start = _starts(t, ["conv", "seg"])
        code = t.column("code").to_numpy().astype(np.int64)
        code = np.where((code % 4 != BLANK) & ~fresh, code // 4 * 4 + DUPLICATE, code)
        ends = np.append(start[1:], len(code))
        seg = np.cumsum(np.bincount(start, minlength=len(code))) - 1
        cost = to_the_end(code, ends[seg])[start]
        role = code // 4
        fair = np.zeros((4, 4), dtype=bool)
        fair[SYSTEM, USER] = fair[USER, ASSISTANT] = fair[ASSISTANT, USER] = True
        odd = np.append(False, ~fair[role[:-1], role[1:]])
        odd[start] = False
        turn = t.column("turn")
        known = turn.is_valid().to_numpy()
        value = turn.fill_null(0).to_numpy()
        new = known & np.append(True, ~known[:-1] | (value[1:] != value[:-1]))
        new[start] |= known[start]
        add = lambda x: np.add.reduceat(x.astype(np.int64), start)
        counts = np.stack([add(code % 4 == k) for k in (BLANK, DUPLICATE, TRUNCATED)] + [add(odd)], axis=1)
        big = np.iinfo(np.int64).max
        low, high = np.minimum.reduceat(np.where(known, value, big), start), np.maximum.reduceat(np.where(known, value, -big), start)
        some = pa.array(add(known) == 0)
        blob = code.astype(np.uint8).tobytes()
        yield pa.record_batch(
            [
                t.column("conv").take(pa.array(start)).combine_chunks(),
                t.column("seg").take(pa.array(start)).combine_chunks(),
                pa.array([blob[a:z] for a, z in zip(start, ends, strict=True)], pa.binary()),
                pa.array(list(cost.reshape(-1, 16)), pa.list_(pa.int64())),
                pa.array(list(counts), pa.list_(pa.int64())),
                pc.if_else(some, pa.scalar(None, pa.int64()), pa.array(low)),
                pc.if_else(some, pa.scalar(None, pa.int64()), pa.array(high)),
                pa.array(add(new)),
            ],
            names=["conv", "seg", "codes", "cost", "counts", "low", "high", "turns"],
        )


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each segment the cost of all after it; for each conversation (seg -1) gaps, faults, illegal pairs and cost.

    Holds a summary a segment, of one conversation: some hundred bytes for every 4,096 rows.
    """
    for t, start in _whole(batches, ["conv"]):
        conv, seg, cost, counts = (t.column(c).to_pylist() for c in ("conv", "seg", "cost", "counts"))
        low, high, turns, ends = (t.column(c).to_pylist() for c in ("low", "high", "turns", "ends"))
        out = []
        for a, z in zip(start, np.append(start[1:], len(conv)), strict=True):
            rest = ENDS
            for k in range(z - 1, a - 1, -1):
                out.append((conv[k], seg[k], rest.tolist(), None))
                rest = (np.array(cost[k]).reshape(4, 4) + rest).min(axis=1)
            total = np.sum([counts[k] for k in range(a, z)], axis=0)
            known = [k for k in range(a, z) if turns[k]]
            gaps = 0
            if known:
                shared = sum(high[i] == low[j] for i, j in zip(known, known[1:], strict=False))
                gaps = high[known[-1]] - low[known[0]] + 1 - (sum(turns[k] for k in known) - shared)
            legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
            across = sum((ends[i] % 16 // 4, ends[i + 1] // 64) not in legal for i in range(a, z - 1))
            out.append((conv[a], -1, None, [gaps, *total[:3].tolist(), int(total[3]) + across, int(rest[START])]))
        yield pa.record_batch(
            [pa.array([r[0] for r in out]), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.list_(pa.int64())), pa.array([r[3] for r in out], pa.list_(pa.int64()))],
            names=["conv", "seg", "rest", "stats"],
        )


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each segment leads and its edits, from every state, some segments at a time."""
    for b in batches:
        blobs = b.column(b.schema.get_field_index("codes")).to_pylist()
        rest = b.column(b.schema.get_field_index("rest")).to_pylist()
        a = 0
        while a < len(blobs):
            z, n = a, 0
            while z < len(blobs) and (z == a or n + len(blobs[z]) <= CHUNK):
                n += len(blobs[z])
                z += 1
            first = np.cumsum([0, *[len(x) for x in blobs[a : z - 1]]])
            leads, pieces = least_paths(np.frombuffer(b"".join(blobs[a:z]), np.uint8).astype(np.int64), first, np.array(rest[a:z]))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(b.schema.get_field_index(c)).slice(a, z - a) for c in ("conv", "seg")], pa.array(list(leads), pa.list_(pa.int64())), pa.array(pieces, pa.list_(pa.string()))],
                names=["conv", "seg", "leads", "pieces"],
            )
            a = z


def _edited(batches: Iterator[pa.RecordBatch]):
    """Streams a task's conversations: ("row", conv, edit, role, text) for each edit, then ("end", conv, stats, edits)."""
    conv = stats = None
    state, pieces, piece, at = START, [], "", 0

    def inserts(letters: str):
        nonlocal state
        for _ in letters:
            state = int(NEXT[state])
            yield "row", conv, "I", ROLE[state], ""

    def close():
        closer = CLOSERS[state]
        yield from inserts(closer)
        yield "end", conv, stats, "".join(pieces) + closer

    for b in batches:
        for r in b.to_pylist():
            if r["conv"] != conv:
                if conv is not None:
                    yield from close()
                conv, stats, state, pieces, piece, at = r["conv"], None, START, [], "", 0
            if r["kind"] == 0:
                stats = r["stats"] or stats
            elif r["kind"] == 1:
                piece, at = r["pieces"][state], 0
                pieces.append(piece)
            else:
                run = at
                while piece[run] == "I":
                    run += 1
                yield from inserts(piece[at:run])
                edit, at, role = piece[run], run + 1, r["role"]
                if edit == "R":
                    state = int(NEXT[state])
                    role = ROLE[state]
                elif edit == "K":
                    state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                yield "row", conv, edit, role, r["text"]
    if conv is not None:
        yield from close()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, place = [], 0
    names = ["conv", "place", "edit", "role", "text"]

    def batch() -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    for what, conv, *x in _edited(batches):
        if what == "end":
            place = 0
        elif x[0] != "D":
            out.append((conv, place, *x))
            place += 1
            if len(out) >= 1_000:
                yield batch()
                out.clear()
    if out:
        yield batch()


REPORT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, started, out = hashlib.sha256(), False, []

    def batch() -> pa.RecordBatch:
        types = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=[c.split()[0] for c in REPORT.split(", ")])

    for what, conv, *x in _edited(batches):
        if what == "end":
            out.append((conv, *(x[0] or [0] * 6), x[1], digest.hexdigest()))
            digest, started = hashlib.sha256(), False
            if len(out) >= 1_000:
                yield batch()
                out.clear()
        elif x[0] != "D":
            digest.update((b"\n" if started else b"") + f"{x[1]}:{x[2]}".encode())
            started = True
    if out:
        yield batch()


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """conv_id, turn, role, text with faults by crc32(``conv_id:turn``) % 20, for trials of the repair.

    0 drops the row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` from
    it, 3 repeats the row, 4 makes it the user's.  A null id or turn is one
    space in the sum, a null role or text becomes one space.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part(conv_col), F.lit(":"), part(turn_col)).cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    d = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        kind.alias("__kind"),
    ).where("__kind <> 0")
    return d.withColumn("__twice", F.explode(F.when(F.col("__kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("__kind", "__twice")


def _key(c: Column) -> Column:
    """Ids as text that is never null."""
    return F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n"))


def _edits(rows: DataFrame) -> DataFrame:
    """Rows, edits and totals of all conversations as one table, dealt out by conversation and in order."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    solid = F.rtrim(F.col("text"), F.lit(SPACES))
    role = F.element_at(F.create_map(F.lit("s"), F.lit(SYSTEM), F.lit("u"), F.lit(USER), F.lit("a"), F.lit(ASSISTANT)), F.substring("role", 1, 1))
    fault = F.when(solid == "", BLANK).when(F.substring(solid, -1, 1).isin(".", "!", "?"), NONE).otherwise(TRUNCATED)
    r = rows.select(_key(F.col("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    r = r.withColumn("code", (4 * F.coalesce(role, F.lit(0)) + fault).cast("int"))
    # equal rows may go to several tasks
    order = ["conv", F.asc_nulls_first("turn"), "role", "text"]
    r = r.withColumn("any", F.monotonically_increasing_id())
    ordered = r.repartitionByRange(*order, "any").sortWithinPartitions(*order).drop("any")
    numbered = written(ordered.mapInArrow(_numbered, "conv string, turn long, role string, text string, code int, at long"))
    seg = F.shiftright("at", SEGMENT_BITS).alias("seg")
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    slim = written(numbered.select("conv", "turn", "code", "at", said.alias("said"), seg))
    marks = slim.groupBy("conv", "said").agg(F.min("at").alias("at")).select("conv", seg, "at", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("int").alias("code"))
    both = marks.unionByName(slim.drop("said")).repartition("conv", "seg").sortWithinPartitions("conv", "seg", "at", F.asc_nulls_first("code"))
    segments = written(both.mapInArrow(_segments, SEGMENTS))
    two = F.conv(F.hex(F.concat(F.substring("codes", 1, 1), F.substring("codes", -1, 1))), 16, 10).cast("int")
    short = segments.select("conv", "seg", "cost", "counts", "low", "high", "turns", (F.shiftright(two, 8) * 16 + two % 256).alias("ends"))  # first code * 16 + last code
    rest = written(short.repartition("conv").sortWithinPartitions("conv", "seg").mapInArrow(_conversations, "conv string, seg long, rest array<long>, stats array<long>"))
    paths = segments.select("conv", "seg", "codes").join(rest.where("seg >= 0").select("conv", "seg", "rest"), ["conv", "seg"]).mapInArrow(_paths, "conv string, seg long, leads array<long>, pieces array<string>")
    empty = {"at": F.lit(-1).cast("long"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "pieces": F.lit(None).cast("array<string>"), "stats": F.lit(None).cast("array<long>")}
    part = lambda df, kind, **own: df.select("conv", F.lit(kind).alias("kind"), *[own.get(c, x).alias(c) for c, x in empty.items()])
    headers = part(rest.where("seg = -1"), 0, stats=F.col("stats"))
    edits = part(paths, 1, at=F.shiftleft("seg", SEGMENT_BITS), pieces=F.col("pieces"))
    texts = part(numbered, 2, at=F.col("at"), role=F.col("role"), text=F.col("text"))
    return headers.unionByName(edits).unionByName(texts)


def _streams(rows: DataFrame, every: DataFrame | None) -> DataFrame:
    parts = _edits(rows)
    if every is not None:
        ids = every.select(_key(F.col("conv_id")).alias("conv")).distinct()
        parts = parts.unionByName(ids.select("conv", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("at")), allowMissingColumns=True)
    return parts.repartition("conv").sortWithinPartitions("conv", "at", "kind")


def _id(rows: DataFrame) -> Column:
    return F.when(F.col("conv") != "n", F.expr("substring(conv, 2)")).cast(rows.schema["conv_id"].dataType).alias("conv_id")


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), role, text.

    See ``report`` for the rules and edge cases; deleted rows are left out.
    """
    return _streams(rows, None).mapInArrow(_rows, "conv string, place long, edit string, role string, text string").select(_id(rows), "place", "edit", "role", "text")


def report(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row a conversation of ``rows`` (and of ``every``, if given): faults, cost, edits and digest of the repaired one.

    Rows go by turn (nulls first), of one turn by role and text.  A row's first
    fault counts: blank (nothing but spaces), duplicate (its role and text
    stood earlier) or truncated (doesn't end in ``.``, ``!`` or ``?``).  Edits
    are Keep (0), Rerole to user or assistant (2), Delete (3, a must for blank
    and duplicate rows) and Insert an empty row of either (2); truncated rows
    that stay add 1.  The cheapest edits that leave nothing, or an optional
    system row and then user and assistant in turn, are the audit; of equally
    cheap ones the ASCII-least.

    Edge cases: null ids are one conversation, of id null; null roles and texts
    are one space, a null turn counts in no gap; roles with other initials
    can't be kept; repeated rows are duplicates; equal turns don't matter
    beyond their order; a very long text is read whole, alone; a long
    conversation is spread over tasks but for its edits and digest; other
    columns are ignored; an id of ``every`` without rows has zeros, no edits
    and the digest of nothing; an empty table gives no rows but those.
    """
    return _streams(rows, every).mapInArrow(_report, REPORT).select(_id(rows), *[c.split()[0] for c in REPORT.split(", ")[1:]])
