"""BK-trees over 64-bit fingerprints, as arrays: a forest holds the trees of many shards.

A node's children are keyed by their integer Hamming distance to it. Trees are built level by
level and searched level by level for many probes at once; a probe at distance d from a
node follows only the edges d - radius ... d + radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class Forest:
    """``shard``: sorted shard numbers of the nodes; ``prints``: their fingerprints (uint64)."""

    def __init__(self, shard: np.ndarray, prints: np.ndarray):
        n = len(prints)
        self.prints = prints
        new = np.ones(n, bool)
        new[1:] = shard[1:] != shard[:-1]
        self.roots = np.flatnonzero(new)
        self.root_of = self.roots[np.cumsum(new) - 1] if n else np.zeros(0, np.int64)
        parent, edge = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        active = np.flatnonzero(~new)
        at = self.root_of[active]
        while len(active):
            d = np.bitwise_count(prints[active] ^ prints[at]).astype(np.int64)
            _, first, place = np.unique(at * 128 + d, return_index=True, return_inverse=True)
            child = active[first]  # the first to come along an edge becomes its node
            parent[child], edge[child] = at[first], d[first]
            rest = np.ones(len(active), bool)
            rest[first] = False
            active, at = active[rest], child[place[rest]]
        order = np.lexsort((edge, parent))
        self.children = order[np.searchsorted(parent[order], 0):]
        self.edges = edge[self.children]
        self.first = np.searchsorted(parent[self.children], np.arange(n))
        self.count = np.bincount(parent[self.children], minlength=n)

    def search(self, prints: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (probe, node) within the radius, level by level."""
        probe, node = np.arange(len(prints)), roots
        while len(probe):
            d = np.bitwise_count(prints[probe] ^ self.prints[node]).astype(np.int64)
            hit = d <= radius
            yield probe[hit], node[hit]
            n = self.count[node]
            ends = np.cumsum(n)
            child = np.repeat(self.first[node] - (ends - n), n) + np.arange(ends[-1])
            probe, d = np.repeat(probe, n), np.repeat(d, n)
            near = np.abs(self.edges[child] - d) <= radius
            probe, node = probe[near], self.children[child[near]]


class Labels:
    """Components of what is linked so far; ``of`` gives each item's smallest member."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.of[a], self.of[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.of, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.of[self.of]
                if (up == self.of).all():
                    break
                self.of = up


#: Pairs looked at together while a forest is searched.
PAIRS = 1 << 20


def linked(shard: np.ndarray, prints: np.ndarray, is_member: np.ndarray, radius: int,
           accept=None, asked: int = 50_000, pairs: int = PAIRS) -> Labels:
    """Components within each shard.

    Rows are sorted by shard, members first. Members are the nodes of the shard's tree; the
    other rows only probe it. ``accept(i, j)`` may refuse pairs, ``asked`` at a time; it isn't asked about pairs that are connected.
    About ``pairs`` pairs of a probe and a node of its tree are looked at together.
    """
    labels = Labels(len(prints))
    nodes = np.flatnonzero(is_member)
    if not len(nodes):
        return labels
    forest = Forest(shard[nodes], prints[nodes])
    size = np.zeros(len(prints), np.int64)
    where = np.searchsorted(shard[nodes], shard)
    there = (where < len(nodes)) & (shard[nodes[np.minimum(where, len(nodes) - 1)]] == shard)
    size[there] = np.searchsorted(shard[nodes], shard[there], side="right") - where[there]
    probes = np.flatnonzero(there & ((size > 1) | ~is_member))
    cost = np.cumsum(size[probes])
    start = 0
    while start < len(probes):
        stop = max(start + 1, int(np.searchsorted(cost, (cost[start - 1] if start else 0) + pairs)))
        own = probes[start:stop]
        for p, node in forest.search(prints[own], where[own], radius):
            i, j = own[p], nodes[node]
            earlier = (j < i) & (labels.of[i] != labels.of[j])
            i, j = i[earlier], j[earlier]
            while accept is not None and len(i):
                # asked in parts, so that links found on the way spare later questions
                a, b = i[:asked], j[:asked]
                ok = accept(a, b)
                labels.link(a[ok], b[ok])
                i, j = i[asked:], j[asked:]
                apart = labels.of[i] != labels.of[j]
                i, j = i[apart], j[apart]
            labels.link(i, j)
        start = stop
    return labels
