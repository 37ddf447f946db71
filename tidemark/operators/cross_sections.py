"""Ranks of many columns within groups, made in Arrow batches of rows that lie by group.

A task reads its groups in turn.  Of a group it holds the columns as blocks of
doubles: ``HELD`` bytes in memory, the rest in temporary files, from which one
column at a time is ranked.  So memory grows by a column of a group, not by
the group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HELD = 1 << 26  # bytes of a group in memory; in files beyond


def ranked_rows(rows: DataFrame, values: str, key: list[str], partition: list[str], specs: dict[str, tuple[float, float] | None], guard: int, own: bool) -> DataFrame:
    """``key`` and {name}_rank of each of ``specs`` (after the value itself with ``own``); ``values`` is the array of them, rows lie by ``partition``."""
    ends = ("", "_rank") if own else ("_rank",)
    names = [x + end for x in specs for end in ends]
    kinds = dict(rows.dtypes)
    held, pins, n_own = _held_groups(values, partition, HELD), list(specs.values()), len(specs) if own else 0
    null, ranked = _null(), _ranker(guard)

    def rank(batches):
        import numpy as np
        import pyarrow as pa

        for keys, blocks in held(batches, key, own):
            for i, pin in enumerate(pins):
                x = np.concatenate([b[i] for b in blocks])
                there = x.view(np.int64) != null
                r = np.full(len(x), null).view(np.float64)
                u, at, n = np.unique(x[there], return_inverse=True, return_counts=True)
                got = ranked(u, n, pin)
                if got is not None:
                    r[there] = got[at]
                for b, part in zip(blocks, np.split(r, np.cumsum([b.shape[1] for b in blocks])[:-1])):
                    b[i] = part
            order = [k for i in range(len(pins)) for k in ((len(pins) + i, i) if n_own else (i,))]
            at, block = 0, iter(blocks)
            now = next(block, None)
            for k in keys:
                while k.num_rows:
                    if at == now.shape[1]:
                        now, at = next(block), 0
                    few = min(k.num_rows, now.shape[1] - at)
                    cols = [now[c, at : at + few] for c in order]
                    cols = [pa.array(c, mask=np.ascontiguousarray(c).view(np.int64) == null) for c in cols]
                    yield pa.RecordBatch.from_arrays([*k.slice(0, few).columns, *cols], names=[*key, *names])
                    k, at = k.slice(few), at + few

    return rows.sortWithinPartitions(*partition).mapInArrow(rank, ", ".join([*[f"`{c}` {kinds[c]}" for c in key], *[f"`{n}` double" for n in names]]))


def rank_counts(rows: DataFrame, values: str, partition: list[str], specs: dict[str, tuple[float, float] | None], guard: int) -> DataFrame:
    """``partition``, i (the column's number), value, n, raw, size, first: how many rows of the group have a rank that rounds to ``value``.

    Ranks are rounded to 6 places, halves up, as F.round does; ``raw`` is the
    smallest value among them, ``size`` the ranked rows of the column in the
    group, ``first`` 1 for one row of each (group, column) and else 0.
    """
    kinds = dict(rows.dtypes)
    held, pins = _held_groups(values, partition, HELD), list(specs.values())
    null, ranked, rounded = _null(), _ranker(guard), _rounder()

    def count(batches):
        import numpy as np
        import pyarrow as pa

        for keys, blocks in held(batches, partition, False):
            group = keys[0].slice(0, 1)
            for i, pin in enumerate(pins):
                x = np.concatenate([b[i] for b in blocks])
                u, n = np.unique(x[x.view(np.int64) != null], return_counts=True)
                r = ranked(u, n, pin)
                if r is None:
                    continue
                value, at = np.unique(rounded(r), return_inverse=True)
                raw = np.full(len(value), np.nan)
                np.fmin.at(raw, at, u)
                first = np.zeros(len(value), np.int32)
                first[0] = 1
                each = np.zeros(len(value), np.int64)
                cols = [np.full(len(value), i, np.int32), value, np.bincount(at, n, len(value)).astype(np.int64), raw, np.full(len(value), n.sum(), np.int64), first]
                table = group.take(pa.array(each))
                yield pa.RecordBatch.from_arrays([*table.columns, *map(pa.array, cols)], names=[*partition, "i", "value", "n", "raw", "size", "first"])

    return rows.sortWithinPartitions(*partition).mapInArrow(count, ", ".join([*[f"`{c}` {kinds[c]}" for c in partition], "i int, value double, n long, raw double, size long, first int"]))


def array_of(names: list[str]):
    return F.array(*[F.col(c).cast("double") for c in names])


# The functions below are made where the plan is and travel to the tasks whole.


def _null() -> int:
    """The bits that stand for null among doubles: a NaN that no arithmetic gives."""
    return 0x7FF80000000000AA


def _held_groups(values: str, by: list[str], most: int):
    """A function of batches that gives, for each run of rows that are equal in ``by``, batches of the columns ``key`` and writable blocks (column, row) of ``values``, with every column twice if ``twice``."""
    null = _null()

    def groups(batches, key: list[str], twice: bool):
        import tempfile

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def starts(b):
            """Places of ``b`` where a row differs from the one before."""
            new = np.zeros(max(b.num_rows - 1, 0), bool)
            for c in by:
                x = b.column(c)
                old, now = x.slice(0, len(x) - 1), x.slice(1)
                new |= (pc.is_null(old).to_numpy(False) != pc.is_null(now).to_numpy(False)) | pc.fill_null(pc.not_equal(old, now), False).to_numpy(False)
            return np.flatnonzero(new) + 1

        def block(b):
            flat = b.column(values).flatten()
            m = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=True)
            if flat.null_count:
                m[flat.is_null().to_numpy(False)] = np.array([null]).view(np.float64)[0]
            m = np.ascontiguousarray(m.reshape(b.num_rows, -1).T)
            return np.concatenate([m, m]) if twice else m

        def filed(blocks):
            """The blocks as one that lies in a file."""
            with tempfile.TemporaryFile() as f:
                out = np.memmap(f, np.float64, "w+", shape=(blocks[0].shape[0], sum(b.shape[1] for b in blocks)))
            np.concatenate(blocks, axis=1, out=out)
            return out

        keys, told, blocks, size, last = [], [], [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.select(by)
            go_on = last is not None and not len(starts(pa.Table.from_batches([last, own.slice(0, 1)]).combine_chunks()))
            cuts = [0, *starts(own), batch.num_rows]
            for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                if (k or not go_on) and keys:
                    yield keys, [*told, *blocks]
                    keys, told, blocks, size = [], [], [], 0
                part = batch.slice(lo, hi - lo)
                keys.append(part.select(key))
                blocks.append(block(part))
                size += blocks[-1].nbytes
                if size > most:
                    told.append(filed(blocks))
                    blocks, size = [], 0
            last = own.slice(batch.num_rows - 1, 1)
        if keys:
            yield keys, [*told, *blocks]

    return groups


def _ranker(guard: int):
    """A function of distinct values in ascending order (NaN last), how many there are of each and a pin: their ranks, or None below ``guard`` values."""

    def ranked(u, n, pin):
        import numpy as np

        if not len(u) or n.sum() < guard:
            return None

        def share(n):
            """percent_rank of sorted values: rows below over all but one."""
            total = n.sum()
            return (np.cumsum(n) - n) / float(total - 1) if total > 1 else np.zeros(len(n))

        if pin is None:
            return share(n)
        at, to = pin
        r = np.full(len(u), float(to))
        below, above, none = u < at, u > at, np.isnan(u)
        r[below] = share(n[below]) * to
        r[above] = to + (1 - to) * share(n[above])
        r[none] = to + (1 - to) * share(n[none])
        return r

    return ranked


def _rounder():
    """A function that rounds to 6 places as F.round does: by the decimal digits of a number, halves up."""

    def rounded(x):
        from decimal import ROUND_HALF_UP, Decimal

        import numpy as np

        scaled = x * 1e6
        low = np.floor(scaled)
        out = np.floor(scaled + 0.5) / 1e6
        near = np.flatnonzero(np.abs(scaled - low - 0.5) < 1e-3)
        out[near] = [float(Decimal(repr(float(v))).quantize(Decimal("0.000001"), ROUND_HALF_UP)) for v in x[near]]
        return out

    return rounded
