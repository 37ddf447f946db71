"""Helpers shared by the operators: checkpoints, streamed groups, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _shared_folder(df: DataFrame) -> str:
    """``spark.checkpoint.dir`` of the session, as its context uses it.

    Only a local session (tests, a laptop) that has none gets a temporary
    folder; on a cluster that would lose data with its machine, so it's an error.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        set_to = sc.getConf().get("spark.checkpoint.dir", None)
        if set_to is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(set_to or tempfile.mkdtemp(prefix="tidemark-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` materialised by a checkpoint, its partitions and their order as they are."""
    _shared_folder(df)
    return df.checkpoint(eager=True)


ADAPTIVE = "spark.sql.adaptive.enabled"


def cut_as_dealt(df: DataFrame) -> DataFrame:
    """``cut`` of rows that stay dealt out by their keys: later steps on the same keys shuffle nothing.

    An adaptive plan doesn't tell how its result is dealt out, so the plan of
    this one step isn't adaptive; ``df`` should fix its number of partitions.
    """
    conf = df.sparkSession.conf
    before = conf.get(ADAPTIVE)
    conf.set(ADAPTIVE, "false")
    try:
        return cut(df.select("*"))
    finally:
        conf.set(ADAPTIVE, before)


def written(df: DataFrame) -> DataFrame:
    """``df`` materialised as a Parquet table beside the checkpoints.

    Its size is then known: a checkpoint keeps the optimiser's guess, which
    every join multiplies, so that loops of joins would end in numbers of
    millions of digits.  Partitions and their order aren't kept.
    """
    path = f"{_shared_folder(df)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(df: DataFrame, rows: int = 2_000) -> DataFrame:
    """``df``, with the session's Arrow batches lowered to ``rows`` rows if they are larger, for whatever it runs from now on.

    Spark's own limit of 10,000 rows fits numbers; as many texts would take a
    hundred MB and more of each worker, and as much of the JVM beside its heap.
    """
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_ROWS)) > rows or int(conf.get(BATCH_ROWS)) <= 0:
        conf.set(BATCH_ROWS, str(rows))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which a null key matches a null key; keeps the left keys."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = None
    for k in keys:
        one = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = one if cond is None else cond & one
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def streamed_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal ``keys`` from batches sorted by them; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(b.schema.get_field_index(k)).to_pylist() for k in keys]
        rows = list(zip(*cols, strict=True))
        start = 0
        for i, row in enumerate(rows):
            if row != last:
                if i > start:
                    held.append(b.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, row
        held.append(b.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def stream_by(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to each group of ``keys``, streaming sorted partitions.

    Callers bound the size of a group beforehand (blocks), so one task never
    holds more than one block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in streamed_groups(batches, keys):
            out = fn(group)
            if out is not None and out.num_rows:
                yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


HOT = 1_000  # a key with more than a HOT-th of all rows is joined by broadcast; there are fewer than HOT such keys
HOT_ROWS = 1_000  # but none with fewer rows than these


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Inner equi-join with ``right``, unique by ``keys``, whose column ``count`` is at least the number of left rows of a key.

    Keys with more than a ``HOT``-th of all rows are joined where their left
    rows are, by a broadcast of fewer than ``HOT`` rows; the others are
    shuffled.  So no task gets all rows of a frequent key.  Both sides may be
    read twice and should be written or cheap.
    """
    top = right.agg(F.sum(count).alias("all"), F.max(count).alias("most")).first()
    bound = max(HOT_ROWS, (top["all"] or 0) / HOT)
    if (top["most"] or 0) <= bound:
        return left.join(right, keys)
    hot = right.where(F.col(count) > bound)
    often = left.join(F.broadcast(hot), keys)
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(right.where(F.col(count) <= bound), keys)
    return often.unionByName(rest)


def spanning_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the edges (a, b) connect."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while True:
        p, q = label[u], label[v]
        if (p == q).all():
            break
        low = np.minimum(p, q)
        np.minimum.at(label, p, low)
        np.minimum.at(label, q, low)
        while (label[label] != label).any():
            label = label[label]
    node = np.flatnonzero(label != np.arange(len(ids)))
    return ids[node], ids[label[node]]


BY_ID = 2  # rounds of components


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges`` as (node, component).

    ``component`` is the smallest node reachable.  In every round each node
    points to the first of itself and its neighbours; pointers are followed
    once more, and the graph is contracted along them: edges get the pointed-to
    ends, and those within one node go.  The first ``BY_ID`` rounds go by id,
    which settles stars around small ids, the others by hash, a new one for
    each round: whatever ids a long chain has, such a round leaves a fraction.
    Every round takes at least the neighbours of the first node away, so the
    rounds end.  Self-loops and null ends are ignored.  An empty input gives no
    rows.
    """
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    e = written(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    rounds: list[DataFrame] = []
    while not rounds or not e.isEmpty():
        turn = F.lit(len(rounds))
        order = lambda c, t=turn, h=len(rounds) >= BY_ID: F.struct((F.xxhash64(c, t) if h else F.lit(0)).alias("o"), F.col(c).alias("x"))
        both = e.union(e.select("v", "u"))
        near = both.groupBy("u").agg(F.min(order("v")).alias("m"), F.count("*").alias("n"))
        near = written(near.select(F.col("u").alias("node"), F.least(F.col("m"), order("u"))["x"].alias("p"), "n"))
        # at most the neighbours of a node and itself point to it
        far = near.select(F.col("node").alias("p"), F.col("p").alias("to"), (F.col("n") + 1).alias("m"))
        point = written(join_counted(near, far, ["p"], "m").select("node", "to", "n"))
        rounds.append(point)
        ends = [point.select(F.col("node").alias(x), F.col("to").alias(f"to_{x}"), "n") for x in ("u", "v")]
        moved = join_counted(join_counted(e, ends[0], ["u"], "n").drop("n"), ends[1], ["v"], "n").where("to_u <> to_v")
        e = written(moved.select(F.least("to_u", "to_v").alias("u"), F.greatest("to_u", "to_v").alias("v")).distinct())
    # from the last round back: where a node of each round ends
    n_rounds = len(rounds)
    labels = rounds.pop().select("node", F.col("to").alias("component"))
    for point in reversed(rounds):
        sizes = point.groupBy("to").agg(F.count("*").alias("n"))
        ends_at = sizes.join(labels.select(F.col("node").alias("to"), "component"), "to", "left").select("to", "n", F.coalesce("component", "to").alias("component"))
        labels = written(join_counted(point.select("node", "to"), ends_at, ["to"], "n").select("node", "component"))
    if n_rounds <= BY_ID:
        return labels  # the smallest node never pointed elsewhere
    least = written(labels.groupBy("component").agg(F.min("node").alias("least"), F.count("*").alias("n")))
    return join_counted(labels, least, ["component"], "n").select("node", F.col("least").alias("component"))
