"""A hierarchical navigable small-world graph in flat arrays.

Nodes are numbered by falling level, so the nodes of layer l are the first
``sizes[l]`` ones and the layer is one array (nodes, links) of node numbers,
-1 where there is no link.  Nodes enter in batches that share a level: a
batch searches the graph so far and compares its members with each other;
links are chosen so that a neighbour is nearer to the node than to any
neighbour already chosen, and free places go to the nearest of the rest.
Searches of a batch run in step, one array operation for all of them.
"""
from __future__ import annotations

import numpy as np

LINKS = 16          # links of a node above the base layer; twice as many in it
SLACK = 16          # links that may come in before a node's list is chosen anew
BEAM_BUILD, BEAM_SEARCH = 64, 128
_BATCH, _EXPAND, _CHOICE = 512, 4, 64


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


class Graph:
    def __init__(self, vectors: np.ndarray, sizes: list[int], layers: list[np.ndarray]):
        """``vectors`` in node order; scaled to 32 bits, which only steers the search."""
        top = float(np.abs(vectors).max()) if vectors.size else 1.0
        self.scale = 1.0 / top if 0 < top < float("inf") else 1.0
        self.x = (vectors * self.scale).astype(np.float32)
        self.norm = _dots(self.x, self.x)
        self.sizes, self.layers = sizes, layers

    # -- search --------------------------------------------------------------
    def _beam(self, layer: int, n: int, q: np.ndarray, start: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, squared distances), the ``ef`` nearest found among the first
        ``n`` nodes of the layer for each row of ``q``, nearest first (-1, inf
        where fewer); ``start`` holds distinct nodes for each row."""
        links, rows = self.layers[layer], len(q)
        qn = _dots(q, q)
        seen = np.zeros((rows, n + 1), bool)  # the last column stands for "no node"
        seen[:, n] = True
        every = np.arange(rows)

        def distance(r: np.ndarray, nodes: np.ndarray) -> np.ndarray:
            return np.maximum(qn[r] + self.norm[nodes] - 2 * _dots(q[r], self.x[nodes]), 0)

        width = start.shape[1]
        nodes = np.full((rows, ef), -1, np.int32)
        dist = np.full((rows, ef), np.inf, np.float32)
        flat = start.ravel()
        r = np.repeat(every, width)
        ok = flat >= 0
        seen[r[ok], flat[ok]] = True
        first = np.full(rows * width, np.inf, np.float32)
        first[ok] = distance(r[ok], flat[ok])
        order = np.argsort(first.reshape(rows, width), axis=1, kind="stable")[:, :ef]
        nodes[:, :order.shape[1]] = np.take_along_axis(start, order, 1)
        dist[:, :order.shape[1]] = np.take_along_axis(first.reshape(rows, width), order, 1)
        done = ~np.isfinite(dist)
        step = min(_EXPAND, ef)
        live = every
        while live.size:
            # The nearest nodes of each beam that are not yet expanded.
            pick = np.argsort(done[live], axis=1, kind="stable")[:, :step]
            fresh = ~np.take_along_axis(done[live], pick, 1)
            some = fresh[:, 0]
            live, pick, fresh = live[some], pick[some], fresh[some]
            if not live.size:
                break
            done[live[:, None], pick] = True
            around = links[np.where(fresh, nodes[live[:, None], pick], 0)].reshape(len(live), step, -1)
            around = np.where(fresh[:, :, None], around, -1).reshape(len(live), -1)
            around = np.where((around < 0) | (around >= n), n, around)
            at, col = np.nonzero(~seen[live[:, None], around])
            new = around[at, col]
            # Two expanded nodes may share a neighbour: once is enough.
            key = np.sort(at.astype(np.int64) * (n + 1) + new)
            key = key[np.diff(key, prepend=-1) > 0]
            at, new = key // (n + 1), key % (n + 1)
            seen[live[at], new] = True
            d = distance(live[at], new)
            close = d < dist[live[at], ef - 1]
            at, new, d = at[close], new[close], d[close]
            if not at.size:
                continue
            count = np.bincount(at, minlength=len(live))
            place = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            wide = count.max()
            more_nodes = np.full((len(live), wide), -1, np.int32)
            more_dist = np.full((len(live), wide), np.inf, np.float32)
            more_nodes[at, place], more_dist[at, place] = new, d
            all_nodes = np.concatenate([nodes[live], more_nodes], 1)
            all_dist = np.concatenate([dist[live], more_dist], 1)
            all_done = np.concatenate([done[live], ~np.isfinite(more_dist)], 1)
            order = np.argsort(all_dist, axis=1, kind="stable")[:, :ef]
            nodes[live] = np.take_along_axis(all_nodes, order, 1)
            dist[live] = np.take_along_axis(all_dist, order, 1)
            done[live] = np.take_along_axis(all_done, order, 1)
        return nodes, dist

    def _descend(self, q: np.ndarray, top: int, floor: int, sizes: list[int]) -> np.ndarray:
        """A near node of layer ``floor`` + 1 for each row, from the top down."""
        at = np.zeros((len(q), 1), np.int32)
        for layer in range(top, floor, -1):
            at = self._beam(layer, sizes[layer], q, at, 1)[0]
        return at

    def search(self, q: np.ndarray, ef: int = BEAM_SEARCH) -> np.ndarray:
        """Nodes nearest to each row of ``q`` (-1 where fewer than ``ef``)."""
        q = (q * self.scale).astype(np.float32)
        at = self._descend(q, len(self.sizes) - 1, 0, self.sizes)
        return self._beam(0, self.sizes[0], q, at, ef)[0]

    # -- building ------------------------------------------------------------
    def _choose(self, nodes: np.ndarray, dist: np.ndarray, m: int) -> np.ndarray:
        """Up to ``m`` of each row's candidates (nearest first, -1 at the end)."""
        rows, width = nodes.shape
        v = self.x[np.maximum(nodes, 0)]
        norm = self.norm[np.maximum(nodes, 0)]
        apart = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
        real = nodes >= 0
        kept = np.zeros((rows, width), bool)
        for r in range(width):
            kept[:, r] = real[:, r] & ~(kept[:, :r] & (apart[:, r, :r] < dist[:, r:r + 1])).any(axis=1)
        # Chosen ones first, then the nearest of the rest.
        order = np.argsort(np.where(kept, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :m]
        return np.take_along_axis(np.where(real, nodes, -1), order, 1)

    def _link(self, layer: int, s: int, chosen: np.ndarray, most: int) -> None:
        """Links of the nodes from ``s`` on, and back from their neighbours."""
        links, used = self.layers[layer], self.used[layer]
        e, cap = s + len(chosen), links.shape[1]
        links[s:e, :chosen.shape[1]] = chosen
        used[s:e] = (chosen >= 0).sum(axis=1)
        new, col = np.nonzero(chosen >= 0)
        to = chosen[new, col]
        mutual = np.zeros(len(to), bool)
        inside = to >= s
        mutual[inside] = (chosen[to[inside] - s] == (new[inside] + s)[:, None]).any(axis=1)
        to, new = to[~mutual], new[~mutual] + s
        if not len(to):
            return
        d = self.norm[to] + self.norm[new] - 2 * _dots(self.x[to], self.x[new])
        order = np.lexsort((new, d, to))
        to, new = to[order], new[order]
        head = np.flatnonzero(np.diff(to, prepend=-1))
        size = np.diff(head, append=len(to))
        rank = np.arange(len(to)) - np.repeat(head, size)
        keep = rank < SLACK
        to, new, rank = to[keep], new[keep], rank[keep]
        size = np.minimum(size, SLACK)
        target = to[np.flatnonzero(np.diff(to, prepend=-1))]
        full = used[target] + size > cap
        spill = np.repeat(full, size)
        links[to[~spill], used[to[~spill]] + rank[~spill]] = new[~spill]
        used[target[~full]] += size[~full].astype(used.dtype)
        crowded = target[full]
        wide = np.full((len(crowded), cap + SLACK), -1, np.int32)
        wide[:, :cap] = links[crowded]
        row = np.repeat(np.arange(len(crowded)), size[full])
        wide[row, cap + rank[spill]] = new[spill]
        for k in range(0, len(crowded), _BATCH):
            nodes, mine = wide[k:k + _BATCH], crowded[k:k + _BATCH]
            d = (self.norm[mine][:, None] + self.norm[np.maximum(nodes, 0)]
                 - 2 * np.matmul(self.x[np.maximum(nodes, 0)], self.x[mine][:, :, None])[:, :, 0])
            d = np.where(nodes >= 0, d, np.inf)
            order = np.argsort(d, axis=1, kind="stable")
            picked = self._choose(np.take_along_axis(nodes, order, 1), np.take_along_axis(d, order, 1), most)
            links[mine] = -1
            links[mine, :picked.shape[1]] = picked
            used[mine] = (picked >= 0).sum(axis=1)

    def _insert(self, s: int, e: int, level: int, top: int) -> None:
        q = self.x[s:e]
        sizes = [min(s, n) for n in self.sizes]
        at = self._descend(q, top, level, sizes)
        among = self.norm[s:e, None] + self.norm[None, s:e] - 2 * q @ q.T
        np.fill_diagonal(among, np.inf)
        near = np.argsort(among, axis=1, kind="stable")[:, :LINKS]
        near_d = np.take_along_axis(among, near, 1)
        near = np.where(np.isfinite(near_d), near + s, -1).astype(np.int32)
        for layer in range(min(level, top), -1, -1):
            nodes, dist = self._beam(layer, sizes[layer], q, at, BEAM_BUILD)
            at = nodes
            both = np.concatenate([nodes, near], 1)
            both_d = np.concatenate([dist, near_d.astype(np.float32)], 1)
            order = np.argsort(both_d, axis=1, kind="stable")[:, :_CHOICE]
            most = LINKS if layer else 2 * LINKS
            self._link(layer, s, self._choose(np.take_along_axis(both, order, 1), np.take_along_axis(both_d, order, 1), LINKS),
                       most)


def build(vectors: np.ndarray, seed: int = 0) -> tuple[np.ndarray, Graph]:
    """(order, graph): node i of the graph is row order[i] of ``vectors``
    (n, d), which are distinct.  The same rows give the same graph."""
    n = len(vectors)
    level = (-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(np.int64)
    order = np.argsort(-level, kind="stable")
    level = level[order]
    sizes = [int((level >= k).sum()) for k in range(int(level[0]) + 1)] if n else [0]
    layers = [np.full((size, (LINKS if k else 2 * LINKS) + SLACK), -1, np.int32) for k, size in enumerate(sizes)]
    g = Graph(vectors[order], sizes, layers)
    g.used = [np.zeros(size, np.int32) for size in sizes]
    s = 1
    while s < n:
        e = min(n, s + min(_BATCH, max(1, s // 2)))
        e = s + int(np.searchsorted(-level[s:e], -level[s], side="right"))  # one level to a batch
        g._insert(s, e, int(level[s]), int(level[0]))
        s = e
    return order, g
