"""Exact top-k by inner product with M-trees and best-first search.

With one more component that fills all vectors up to the same length M, the largest inner product is
the smallest Euclidean distance: d2 = |q|2 + M2 - 2 q.x. Vectors are dealt to shards of bounded size; each shard is
bulk-loaded as an M-tree: nodes with a routing vector, a covering radius and the distance to the
parent's vector, and leaf pages with the distance of each row to the page's vector. Queries visit nodes in
the order of the best score that a node can hold. The triangle inequality over the stored distances
tells which children and rows needn't be computed. Scores are integer products, exact in doubles below
2 ** 53 and computed in integers above.

Query blocks meet every shard, and a task's results are at most k rows a query; the best k of all
shards are the answer.

Cases: vectors that are null, empty or hold null or non-finite components take no part; a shorter vector counts
as filled with zeros; rows with the query's own id are no candidates; repeated rows are candidates each; ties
go to the smaller id; fewer candidates give fewer rows; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rollspan.session import with_scalars

#: Rows of a leaf page, children of a node, rows of a shard, queries of a block.
PAGE, FANOUT, SHARD, BLOCK = 256, 16, 8192, 256


@dataclass
class Node:
    vector: np.ndarray
    radius: float
    to_parent: float
    children: list | None = None
    rows: np.ndarray | None = None
    to_vector: np.ndarray | None = None  # of each child or row


class MTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, seed: int = 1):
        self.ids, self.vectors = ids, vectors
        x = vectors.astype(np.float64)
        norms = (x * x).sum(1)
        self.m2 = float(norms.max(initial=0.0))
        self.x = np.hstack([x, np.sqrt(np.maximum(self.m2 - norms, 0))[:, None]])
        self.page, self.random = page, np.random.default_rng(seed)
        self.most = float(np.abs(vectors).max(initial=0))
        self.root = self._build(np.arange(len(ids)), None)
        del self.random

    def _distance(self, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.x[rows] - vector) ** 2).sum(1))

    def _build(self, rows: np.ndarray, parent: np.ndarray | None) -> Node:
        middle = rows[self._distance(rows, self.x[rows].mean(0)).argmin()]
        vector = self.x[middle]
        d = self._distance(rows, vector)
        node = Node(vector, float(d.max()), 0.0 if parent is None else float(np.sqrt(((vector - parent) ** 2).sum())))
        if len(rows) <= self.page:
            node.rows, node.to_vector = rows, d
            return node
        seeds = self.random.choice(rows, min(FANOUT, len(rows)), replace=False)
        nearest = np.stack([self._distance(rows, self.x[s]) for s in seeds]).argmin(0)
        parts = [rows[nearest == i] for i in range(len(seeds))]
        parts = [p for p in parts if len(p)]
        if len(parts) == 1:  # equal vectors
            parts = np.array_split(rows, -(-len(rows) // self.page))
        node.children = [self._build(p, vector) for p in parts]
        node.to_vector = np.array([c.to_parent for c in node.children])
        return node

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """(score, id) of the best ``k``, best first."""
        q = np.zeros(self.x.shape[1])
        q[:len(query)] = query[:len(q) - 1] if len(query) >= len(q) else query
        wide = np.zeros(self.vectors.shape[1], np.int64)
        wide[:min(len(query), len(wide))] = query[:len(wide)]
        exact = self.most * float(np.abs(query).max(initial=0)) * len(wide) < 2 ** 53
        top = float((query.astype(np.float64) ** 2).sum()) + self.m2
        slack = 1e-9 * top + 1e-6
        best: list[tuple[int, int]] = []  # heap of (score, -id), worst first

        def bound(distance):
            """Best score at this distance or more."""
            return (top - np.maximum(distance, 0) ** 2) / 2 + slack

        todo = [(-np.inf, 0, self.root, float(np.sqrt(((q - self.root.vector) ** 2).sum())))] if self.root else []
        counter = 0
        while todo:
            negative, _, node, d = heapq.heappop(todo)
            if len(best) == k and -negative < best[0][0]:
                break
            kth = best[0][0] if len(best) == k else -np.inf
            if node.children is not None:
                radii = np.array([c.radius for c in node.children])
                for i in np.flatnonzero(bound(np.abs(d - node.to_vector) - radii) >= kth):
                    child = node.children[i]
                    dc = float(np.sqrt(((q - child.vector) ** 2).sum()))
                    can = float(bound(dc - child.radius))
                    if can >= kth:
                        counter += 1
                        heapq.heappush(todo, (-can, counter, child, dc))
                continue
            rows = node.rows[bound(np.abs(d - node.to_vector)) >= kth]
            rows = rows[self.ids[rows] != own]
            scores = (self.x[rows, :-1] @ wide.astype(np.float64)).astype(np.int64) if exact else self.vectors[rows] @ wide
            if len(best) == k:
                rows, scores = rows[scores >= kth], scores[scores >= kth]
            order = np.lexsort((self.ids[rows], -scores))[:k]
            for s, i in zip(scores[order].tolist(), self.ids[rows[order]].tolist()):
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _matrix(vectors) -> np.ndarray:
    out = np.zeros((len(vectors), max(map(len, vectors))), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _tree(rows: pd.DataFrame, page: int) -> pd.DataFrame:
    tree = MTree(rows["vec_id"].to_numpy(np.int64), _matrix(rows["vector"].tolist()), page)
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "tree": [pickle.dumps(tree)]})


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"block": [rows["block"].iloc[0]],
                         "queries": [pickle.dumps((rows["vec_id"].to_numpy(np.int64), _matrix(rows["vector"].tolist())))]})


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tree, queries in zip(batch.column(0), batch.column(1)):
            tree = pickle.loads(tree.as_py())
            rows = [(own, i, s) for own, q in zip(*pickle.loads(queries.as_py())) for s, i in tree.search(q, own, k)]
            columns = list(zip(*rows)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 1024) -> DataFrame:
    """``vec_id``, ``vector`` of the rows that take part: floor(scale * x) of each component."""
    whole = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e")).where(
        F.col("vec_id").isNotNull() & (F.size("e") > 0)
        & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return whole.select("vec_id", F.transform("e", lambda x: F.floor(x * scale)).alias("vector"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, page: int = PAGE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for all rows for which ``is_query`` holds."""
    size = vectors.agg(F.expr(f"cast(count(1) div {SHARD} as int) + 1").alias("_shards"))
    spread = F.xxhash64("vec_id", "vector")
    dealt = with_scalars(vectors, size).withColumn("shard", F.pmod(spread, F.col("_shards")).cast("int"))
    trees = dealt.select("shard", "vec_id", "vector").groupBy("shard").applyInPandas(partial(_tree, page=page), "shard int, tree binary")
    asked = vectors.where(is_query)
    blocks = asked.agg(F.expr(f"cast(count(1) div {BLOCK} as int) + 1").alias("_blocks"))
    blocks = with_scalars(asked, blocks).withColumn("block", F.pmod(spread, F.col("_blocks")).cast("int")).select("block", "vec_id", "vector")
    blocks = blocks.groupBy("block").applyInPandas(_block, "block int, queries binary")
    meet = with_scalars(blocks, size).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("_shards") - 1)))
    found = trees.join(meet, "shard").select("tree", "queries").mapInArrow(partial(_search, k=k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
