"""A hierarchical navigable small-world graph over the vectors of one shard, in flat arrays.

Nodes are numbered from the highest level down, so the nodes of a level are the first so many and its
links are one array with a row for each of them; a missing link is -1. Vectors get one more component
that makes their lengths equal: then the nearest, by distance, are those of the largest inner product.

Searches of many queries go in step: each step opens a few nodes of every query and looks at all their
links at once.
"""

from __future__ import annotations

import numpy as np

LINKS = 16  # of a node on a level above the lowest, and those a new node asks for; the lowest level has twice as many
WIDE = 96  # nodes held while a new node looks for links
OPENED = 4  # nodes opened for each query in a step
TOGETHER = 256  # new nodes, or queries, that go in step
FAR = np.float32(np.inf)


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Float32 vectors of equal length (1, for the longest), whose order of distances is that of inner products."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(initial=1e-300)
    squares = np.einsum("ij,ij->i", wide, wide)
    most = squares.max(initial=1e-300)
    return np.column_stack((wide, np.sqrt(np.maximum(most - squares, 0)))).astype(np.float32) / np.float32(np.sqrt(most))


def asking(vectors: np.ndarray) -> np.ndarray:
    """Queries as unit vectors with the additional component, which is 0."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, initial=1e-300, keepdims=True)
    wide /= np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]
    return np.column_stack((wide, np.zeros(len(wide)))).astype(np.float32)


def spread(near: np.ndarray, gain: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Of candidates (rows of `near`, best first, -1 for none; `gain`: product with the node) those to link to, at most `most`.

    A candidate that is nearer to one already taken than to the node comes only after all others.
    """
    rows, width = near.shape
    found = vectors[near]
    between = found @ found.transpose(0, 2, 1)
    taken, real = np.zeros((rows, width), bool), near >= 0
    count = np.zeros(rows, np.int64)
    for j in range(width):
        hidden = (taken & (between[:, j, :] >= gain[:, j, None])).any(axis=1)
        taken[:, j] = real[:, j] & ~hidden & (count < most)
        count += taken[:, j]
    order = np.argsort(np.where(taken, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(near, order, axis=1)


class SmallWorld:
    def __init__(self, vectors: np.ndarray, sizes: list[int], links: list[np.ndarray]):
        self.vectors, self.sizes, self.links = vectors, sizes, links

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 7) -> tuple[SmallWorld, np.ndarray]:
        """The graph over lifted vectors, and their order in it."""
        n = len(vectors)
        heights = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(np.int64)
        order = np.argsort(-heights, kind="stable")
        heights = heights[order]
        sizes = [int((heights >= k).sum()) for k in range(int(heights.max(initial=0)) + 1)]
        links = [np.full((size, LINKS if k else 2 * LINKS), -1, np.int32) for k, size in enumerate(sizes)]
        graph = cls(np.ascontiguousarray(vectors[order]), sizes, links)
        start = 1
        while start < n:
            stop = start + min(TOGETHER, start, int((heights == heights[start]).sum() + (heights > heights[start]).sum()) - start)
            graph._insert(start, stop, int(heights[start]))
            start = stop
        return graph, order

    def _insert(self, start: int, stop: int, height: int) -> None:
        new, here = np.arange(start, stop), self.vectors[start:stop]
        near = self._descend(here, height, start)
        among = here @ here.T
        np.fill_diagonal(among, -FAR)
        for level in range(height, -1, -1):
            near, gain = self._search(here, near, WIDE, level, start)
            # New nodes do not find each other in the graph, so they are compared.
            both = np.concatenate((near, np.broadcast_to(new, (len(new), len(new)))), axis=1)
            gains = np.concatenate((gain, among), axis=1)
            best = np.argsort(-gains, axis=1, kind="stable")[:, :WIDE]
            gains = np.take_along_axis(gains, best, axis=1)
            chosen = spread(np.where(gains > -FAR, np.take_along_axis(both, best, axis=1), -1), gains, self.vectors, LINKS)
            self.links[level][start:stop, :chosen.shape[1]] = chosen
            self._link_back(np.repeat(new, chosen.shape[1]), chosen.ravel(), level)

    def _link_back(self, sources: np.ndarray, targets: np.ndarray, level: int) -> None:
        keep = targets >= 0
        order = np.argsort(targets[keep], kind="stable")
        sources, targets = sources[keep][order], targets[keep][order]
        nodes, first, counts = np.unique(targets, return_index=True, return_counts=True)
        links = self.links[level]
        width = links.shape[1]
        for at in range(0, len(nodes), TOGETHER):
            node, begin, count = (x[at:at + TOGETHER] for x in (nodes, first, counts))
            more = np.full((len(node), int(count.max())), -1, np.int64)
            k = np.arange(more.shape[1])
            more[k < count[:, None]] = sources[begin[0]:begin[-1] + count[-1]]
            old = links[node]
            more[(more[:, :, None] == old[:, None, :]).any(axis=2)] = -1  # linked already
            both = np.concatenate((old, more), axis=1)
            both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
            full = (both >= 0).sum(axis=1) > width
            links[node[~full]] = both[~full, :width]
            if full.any():
                node, both = node[full], both[full]
                gain = np.where(both >= 0, np.einsum("ijk,ik->ij", self.vectors[both], self.vectors[node]), -FAR)
                best = np.argsort(-gain, axis=1, kind="stable")
                links[node] = spread(np.take_along_axis(both, best, axis=1), np.take_along_axis(gain, best, axis=1), self.vectors, width)

    def _descend(self, queries: np.ndarray, level: int, count: int) -> np.ndarray:
        """Where to start on `level`: the nearest node found on the levels above."""
        near = np.zeros((len(queries), 1), np.int64)
        for k in range(len(self.sizes) - 1, level, -1):
            near, _ = self._search(queries, near, 1, k, count)
        return near

    def _search(self, queries: np.ndarray, start: np.ndarray, wide: int, level: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The `wide` nodes nearest to each query that a walk from `start` finds on a level of the first `count` nodes: ids, products."""
        links, rows = self.links[level], np.arange(len(queries))[:, None]
        seen = np.zeros((len(queries), min(self.sizes[level], count) + 1), bool)  # the last is that of -1
        seen[:, -1] = True
        ids = np.full((len(queries), max(wide, start.shape[1])), -1, np.int64)
        ids[:, :start.shape[1]] = start
        gain = np.full(ids.shape, -FAR, np.float32)
        gain[:, :start.shape[1]] = np.where(start >= 0, np.einsum("ijk,ik->ij", self.vectors[start], queries), -FAR)
        closed = ids < 0
        seen[rows, start] = True
        order = np.argsort(-gain, axis=1, kind="stable")[:, :wide]
        ids, gain, closed = (np.take_along_axis(x, order, axis=1) for x in (ids, gain, closed))
        some = np.arange(len(queries))
        while True:
            some = some[~closed[some].all(axis=1)]
            if not len(some):
                return ids, gain
            opening = np.argsort(closed[some], axis=1, kind="stable")[:, :OPENED]  # rows are sorted, so these are the best
            at = np.where(np.take_along_axis(closed[some], opening, axis=1), -1, np.take_along_axis(ids[some], opening, axis=1))
            closed[some[:, None], opening] = True
            new = np.where(at[:, :, None] >= 0, links[at], -1).reshape(len(some), -1).astype(np.int64)
            new[seen[some[:, None], new]] = -1
            new.sort(axis=1)  # two opened nodes may have a link in common
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            seen[some[:, None], new] = True
            mine = np.where(new >= 0, np.einsum("ijk,ik->ij", self.vectors[new], queries[some]), -FAR)
            ids_both, gain_both = np.concatenate((ids[some], new), axis=1), np.concatenate((gain[some], mine), axis=1)
            closed_both = np.concatenate((closed[some], new < 0), axis=1)
            order = np.argsort(-gain_both, axis=1, kind="stable")[:, :wide]
            ids[some], gain[some], closed[some] = (np.take_along_axis(x, order, axis=1) for x in (ids_both, gain_both, closed_both))

    def nearest(self, queries: np.ndarray, wide: int) -> np.ndarray:
        """Ids of up to `wide` nodes of large products with each query, -1 for none."""
        found = []
        for at in range(0, len(queries), TOGETHER):
            some = queries[at:at + TOGETHER]
            found.append(self._search(some, self._descend(some, 0, len(self.vectors)), wide, 0, len(self.vectors))[0])
        return np.concatenate(found) if found else np.zeros((0, wide), np.int64)
