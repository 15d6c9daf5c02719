"""Connected components by repeated contraction, with no link ever on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace


def _drawn(ids: np.ndarray, turn: int) -> np.ndarray:
    """An order of the nodes drawn anew for each turn."""
    x = ids.astype(np.uint64) + np.uint64(turn + 1) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Edges that one task solves, in some 100 MB.
FEW_EDGES = 1_000_000


def _local_roots(edges: DataFrame, turn: int | None) -> DataFrame:
    """(node, rank, root) of the components within each partition's edges; rank orders the roots. With no turn the smallest
    node is the root."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.stack([b.column(k).to_numpy() for k in (0, 1)]) for b in batches if b.num_rows]
        if not parts:
            return
        nodes, at = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
        at, order = at.reshape(2, -1), np.arange(len(nodes), dtype=np.uint64) if turn is None else _drawn(nodes, turn)
        parent = list(range(len(nodes)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for a, b in zip(*at.tolist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                first, second = (a, b) if order[a] < order[b] else (b, a)
                parent[second] = first
        root = np.array([find(k) for k in range(len(nodes))])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(order[root].view(np.int64)), pa.array(nodes[root])], names=["node", "rank", "root"])

    return edges.mapInArrow(solve, "node long, rank long, root long")


def contract(work: Workspace, links: DataFrame, name: str, few: int = FEW_EDGES) -> DataFrame:
    """(node, root) for every node of the staged links (a, b): root is the smallest node of its component.

    In each turn every partition joins what its own edges connect. A node that got different roots in different partitions
    takes the first in an order drawn for the turn, and links its other roots to that one: these are the edges of the next
    turn, among roots only. Once there are few edges, one task joins what is left. Large graphs shrink by a share each turn. A
    partition's edges are what one task holds; a node with very many edges is spread over partitions like any other.
    """
    edges, parents, turn = links.select("a", "b").where("a <> b"), [], 0
    while edges.count() > few:
        roots = work.stage(_local_roots(edges, turn), f"{name}-roots-{turn}")
        first = roots.groupBy("node").agg(F.min_by("root", "rank").alias("parent"))
        parents.append(first)
        # min_by is by rank; equal ranks are equal roots.
        more = roots.join(first, "node").where("root <> parent").select(F.col("root").alias("a"), F.col("parent").alias("b")).distinct()
        edges = work.stage(more, f"{name}-edges-{turn}")
        turn += 1
    last = work.stage(_local_roots(edges.coalesce(1), None).select("node", "root"), f"{name}-last")
    if not parents:
        return last
    labels = parents[0].select("node", F.col("parent").alias("root"))
    for above in [*(p.select(F.col("node").alias("root"), F.col("parent").alias("_up")) for p in parents[1:]), last.select(F.col("node").alias("root"), F.col("root").alias("_up"))]:
        labels = labels.join(above, "root", "left").select("node", F.coalesce("_up", "root").alias("root"))
    smallest = labels.groupBy("root").agg(F.min("node").alias("_least"))
    return labels.join(smallest, "root").select("node", F.col("_least").alias("root"))
