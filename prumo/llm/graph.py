"""Connected components of edges: packed edges, contraction inside tasks, then star steps over all of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prumo.llm.common import discard, materialize

#: Edges that one task joins at most (16 bytes each); more are joined by star steps over many tasks.
LOCAL_EDGES = 1 << 22


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node reachable) with the same components as the edges a-b."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (p := parent.get(root, root)) != root:
            root = p
        while (p := parent.get(x, x)) != root:
            parent[x] = root
            x = p
        return root

    if len(a):
        a, b = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
    nodes = np.array([x for x in parent if find(x) != x], np.int64)
    return nodes, np.array([find(x) for x in nodes.tolist()], np.int64)


def to_blob(a: np.ndarray, b: np.ndarray) -> bytes:
    return np.stack([a, b]).astype(np.int64).tobytes()


def from_blobs(blobs: list[bytes]) -> np.ndarray:
    """Both ends of the edges in some blobs, as two rows."""
    return np.concatenate([np.frombuffer(x, np.int64).reshape(2, -1) for x in blobs] or [np.zeros((2, 0), np.int64)], axis=1)


def _pack(batches):
    for batch in batches:
        a, b = local_forest(batch.column("a").to_numpy(), batch.column("b").to_numpy())
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array([to_blob(a, b)], pa.binary())], ["blob"])


def packed(edges: DataFrame) -> DataFrame:
    """Edges (a, b) as blobs of forests."""
    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(_pack, "blob binary")


def _join(table: pa.Table) -> pa.Table:
    nodes, roots = local_forest(*from_blobs(table.column("blob").to_pylist()))
    return pa.table({"node": pa.array(nodes, pa.int64()), "root": pa.array(roots, pa.int64())})


def _unpack(batches):
    """Edges of the blobs, one blob at a time and a bounded number of rows at once."""
    for batch in batches:
        for blob in batch.column("blob"):
            both = from_blobs([blob.as_py()])
            for k in range(0, both.shape[1], 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(both[0, k : k + (1 << 16)]), pa.array(both[1, k : k + (1 << 16)])], ["u", "v"])


def components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """node, root for every node that isn't the smallest of its component; edges: column blob, see packed().

    Up to local_edges edges, counted first, are joined by one task. More are joined by alternating steps in which every
    node points its larger neighbours (large star), then its smaller ones (small star), at its smallest neighbour.
    Smallest neighbours come from a grouped minimum and a join, never from gathered lists, so a node with very many
    neighbours is a skewed join key only. Rounds go on until nothing changes; they are logarithmic in practice.
    """
    held = materialize(edges.select("blob"), "edges")
    if (held.agg(F.sum(F.length("blob"))).first()[0] or 0) <= 16 * local_edges:
        return materialize(held.groupBy(F.lit(0).alias("_one")).applyInArrow(_join, "node long, root long"), "roots")
    now = materialize(held.mapInArrow(_unpack, "u long, v long").filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    discard(held)
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct()
        old, now = now, materialize(small, "edges")
        discard(old)
        state = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
