"""Embedding near-duplicates by collision-counting projections.

Vectors are scaled to unit length; equal ones are one node with a count. For two unit vectors at cosine c, a
random projection's values differ by a normal deviate of deviation sqrt(2 - 2c), so the values of linked
vectors collide (fall within a window of half-width w centred at the query) far more often than others'.

* Shards: a table is the sign pattern of ``bits`` projections (which half of each sorted projection a vector
  lies in); ``bits`` grows with log2(n / SHARD_ROWS), and as many tables are used as keep a pair at the
  threshold together at least once with probability RECALL. So work grows as about n^1.25, not n^2.
* In a shard, PROJECTIONS further projections are sorted; around each query its window holds the vectors
  that collide there; collisions are counted per pair, and pairs with at least ``needed`` collisions (the
  largest count that a pair at the threshold reaches with probability RECALL) are verified by cosine in
  double precision. Links are never false.
* A pair is handled in the first table that puts it together only, so counts need no distinct step.

A shard of more than TILE rows is worked off in pairs of blocks of at most TILE rows, one task group each,
whatever its size; no pair rows are written: a tile returns each vector's number of links and its
least linked neighbour. Links of a dense group are counted in full, but only a spanning forest is shuffled.

Defined results: null, zero, or non-finite vectors (or such components) link with nothing. Vectors of another
length are compared with their like only. Null ids: null component, not kept, never linked. Repeated ids:
one result per row; rows of one id count as other vectors, and share a component. Labels and extra columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import components, materialize

SHARD_ROWS, TILE, PROJECTIONS, RECALL, SEED = 1000, 1500, 24, 0.998, 20240607


def plan(n: int, threshold: float) -> tuple[int, int, float, int]:
    """(bits, tables, half-width, needed collisions) for n vectors."""
    bits = min(24, max(0, math.ceil(math.log2(max(1, n) / SHARD_ROWS))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    tables = 1 if bits == 0 else math.ceil(math.log(1 - RECALL) / math.log(1 - same))
    width = math.sqrt(2 - 2 * threshold)
    hit = math.erf(1 / math.sqrt(2))  # of a pair at the threshold, with a half-width of one deviation
    needed, tail = PROJECTIONS, 0.0
    while needed > 0:
        tail += math.comb(PROJECTIONS, needed) * hit ** needed * (1 - hit) ** (PROJECTIONS - needed)
        if tail >= RECALL:
            break
        needed -= 1
    return bits, tables, width, needed


def directions(dim: int, count: int, salt: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim, salt]).standard_normal((dim, count))


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, unit vector in binary, or null)."""
    for batch in batches:
        out = []
        for v in batch.column("v"):
            x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64) if v.is_valid else np.zeros(0)
            top = np.abs(x).max() if len(x) and v.values.null_count == 0 and np.isfinite(x).all() else 0.0
            if top > 0:
                x = x / top
                x = x / math.sqrt(float(x @ x))
                out.append((x + 0.0).tobytes())
            else:
                out.append(None)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], ["id", "unit"])


def _codes(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = [np.frombuffer(u.as_py()) for u in batch.column("unit")]
            out: list = [None] * len(unit)
            for dim in {len(u) for u in unit}:
                at = [i for i, u in enumerate(unit) if len(u) == dim]
                sign = (np.stack([unit[i] for i in at]) @ directions(dim, bits * tables, 1) > 0) if bits else np.zeros((len(at), 0), bool)
                code = (sign.reshape(len(at), tables, bits) * (1 << np.arange(bits))).sum(2)
                for i, c in zip(at, code):
                    out[i] = c
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("copies"), batch.column("unit"), pa.array([len(u) for u in unit], pa.int32()),
                                              pa.array(out, pa.list_(pa.int64()))], ["node", "copies", "unit", "dim", "codes"])
    return run


def collisions(p: np.ndarray, q: np.ndarray, width: float) -> np.ndarray:
    """Number of projections in which each column vector of q lies in the window centred at each row of p."""
    count = np.zeros((len(p), len(q)), np.uint8)
    for k in range(p.shape[1]):
        order = np.argsort(q[:, k])
        values = q[order, k]
        lo = np.searchsorted(values, p[:, k] - width)
        hi = np.searchsorted(values, p[:, k] + width, side="right")
        step = np.zeros((len(p), len(q) + 1), np.int8)
        np.add.at(step, (np.arange(len(p)), lo), 1)
        np.add.at(step, (np.arange(len(p)), hi), -1)
        count[:, order] += np.cumsum(step[:, :-1], 1, dtype=np.int8).view(np.uint8)
    return count


def _tile(threshold: float, width: float, needed: int):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        table, dim, left, right = key[0].as_py(), key[1].as_py(), key[3].as_py(), key[4].as_py()
        block = t.column("block").to_numpy()
        node, copies = t.column("node").to_numpy(), t.column("copies").to_numpy()
        unit = np.frombuffer(b"".join(t.column("unit").to_pylist()), np.float64).reshape(-1, dim)
        codes = np.array(t.column("codes").to_pylist(), np.int64).reshape(len(node), -1)
        order = np.argsort(node, kind="stable")
        a, b = order[block[order] == left], order[block[order] == right]
        to = directions(dim, PROJECTIONS, 2)
        near = collisions(unit[a] @ to, unit[b] @ to, width) >= needed
        if left == right:
            near &= np.arange(len(a))[:, None] < np.arange(len(b))
        for u in range(table):  # pairs that an earlier table has put together
            near &= codes[a, u][:, None] != codes[b, u]
        i, j = np.nonzero(near)
        ok = np.zeros(len(i), bool)
        for k in range(0, len(i), 100_000):
            s = slice(k, k + 100_000)
            ok[s] = np.einsum("ij,ij->i", unit[a[i[s]]], unit[b[j[s]]]) >= threshold
        x, y = a[i[ok]], b[j[ok]]
        links = np.bincount(x, weights=copies[y], minlength=len(node)) + np.bincount(y, weights=copies[x], minlength=len(node))
        least = node.copy()
        # the least node of each linked group of the tile, so that edges are one per vector
        while len(x):
            low = np.minimum(least[x], least[y])
            before = least.copy()
            np.minimum.at(least, x, low)
            np.minimum.at(least, y, low)
            if (before == least).all():
                break
        at = np.flatnonzero(links)
        return pa.table({"node": pa.array(node[at]), "links": pa.array(links[at].astype(np.int64)), "least": pa.array(least[at])})
    return run


def embedding_near_dups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    ship_package(vectors.sparkSession)
    units = materialize(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
                        .mapInArrow(_unit, "id long, unit binary"), "unit-vectors")
    nodes = materialize(units.where("id is not null and unit is not null").groupBy("unit").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")), "vector-nodes")
    n = nodes.count()
    bits, tables, width, needed = plan(n, threshold)
    coded = materialize(nodes.mapInArrow(_codes(bits, tables), "node long, copies long, unit binary, dim int, codes array<long>"), "vector-codes")
    shards = coded.select("dim", "node", F.posexplode("codes").alias("table", "code"))
    sizes = (shards.groupBy("table", "dim", "code").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
             .withColumn("blocks", F.ceil(F.col("rows") / TILE).cast("int")))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = (coded.select("*", F.posexplode("codes").alias("table", "code")).join(sizes, ["table", "dim", "code"]).withColumn("block", block)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("left", F.least("block", "other")).withColumn("right", F.greatest("block", "other")))
    tiles = (placed.select("table", "dim", "code", "left", "right", "block", "node", "copies", "unit", "codes")
             .groupBy("table", "dim", "code", "left", "right").applyInArrow(_tile(threshold, width, needed), "node long, links long, least long"))
    found = materialize(tiles, "vector-links")
    twice = (units.where("id is not null and unit is not null").join(nodes, "unit").select("id", "node").where("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b")))
    edges = found.select(F.col("node").alias("a"), F.col("least").alias("b")).union(twice)
    comps = materialize(components(edges, "a", "b"), "vector-components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_node = nodes.join(links, "node", "left").select("unit", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = units.join(per_node, "unit", "left").join(comps, units.id == comps.node, "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias("vec_id"), F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
