"""Helpers shared by the llm operators: tables written to the shared folder, Arrow text access, components."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package

#: Text bytes that one vectorised numpy step handles (a longer text is its own step).
CHUNK_BYTES = 1 << 18
#: Rows of a (long, long) table that may be broadcast: 16 MB of ids, checked by a count before each use.
BROADCAST_ROWS = 1_000_000
#: Rows of an Arrow batch of whole texts: a batch is held several times over, by the JVM and by the Python worker.
TEXT_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Cuts the lineage: one write to the shared folder, which its owner cleans, and a read back.
materialize = cut_lineage


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows meanwhile: long texts in large batches cost the JVM direct memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_STORE: list = []


def only_store(name: Hashable, make: Callable):
    """This worker's store of that name, made if it has none. Spark uses a worker again for later stages, so it keeps one
    store of all operators: another one takes its place."""
    if not _STORE or _STORE[0] != name:
        _STORE.clear()
        _STORE.extend((name, make()))
    return _STORE[1]


def no_store() -> None:
    """Drops this worker's store, in tasks that have none of their own."""
    _STORE.clear()


def small_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint only if the counted rows are within BROADCAST_ROWS; else Spark's shuffled join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column without copying the texts; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes; one longer text is a range of its own."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix style)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def is_star_forest(edges: DataFrame) -> bool:
    """True if every u has one edge and no v is a u: with v < u throughout, v is then its component's smallest node."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out")).union(edges.select(F.col("v").alias("x"), F.lit(0).alias("out")))
    return ends.groupBy("x").agg(F.sum("out").alias("n"), F.min("out").alias("least")).where("n > 1 or (n = 1 and least = 0)").isEmpty()


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the undirected edges.

    Alternates the large-star and small-star steps on the edge table (each a group-by with a map-side
    minimum and a join), so no neighbour list is ever held; every step is written to the shared folder.
    Stops as soon as the edges are a forest of stars.
    """
    e = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .where("u <> v").distinct(), "cc")
    for _ in range(max_rounds):
        if is_star_forest(e):
            break
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = materialize(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "cc")
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("u"), "v").distinct()
    return e.union(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))


def join_components(known: DataFrame, edges: DataFrame, a: str, b: str) -> DataFrame:
    """``known`` (node, component) with more edges: only the edges between different components, by their labels, go
    through ``components``."""
    label = lambda side: known.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).join(label("a"), "a", "left").join(label("b"), "b", "left")
    met = materialize(components(ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")), "a", "b"), "cc-labels")
    moved = known.join(met.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    return moved.select("node", F.coalesce("to", "component").alias("component")).union(met.join(known, "node", "left_anti").select("node", "component"))
