"""A hierarchical navigable small-world graph over unit vectors, kept as flat neighbour arrays.

Nodes are ordered by level, highest first, so each layer is a prefix of the nodes and a layer is one
(nodes, degree) array of neighbours. Nodes are inserted in batches that search the graph in step: one numpy
operation advances the beams of all of them. Nodes of a batch are compared with each other directly.
"""

from __future__ import annotations

import numpy as np


class Graph:
    def __init__(self, x: np.ndarray, m: int = 10, ef: int = 24, expand: int = 4, batch: int = 768, seed: int = 1):
        self.m, self.m0, self.ef, self.expand, self.batch = m, 2 * m, ef, expand, batch
        n = len(x)
        level = np.floor(-np.log(np.random.default_rng(seed).random(n) + 1e-12) / np.log(m)).astype(int)
        self.order = np.argsort(-level, kind="stable")
        self.x = np.ascontiguousarray(x[self.order], "f4")
        sizes = [int((level >= lev).sum()) for lev in range(1, int(level.max(initial=0)) + 1)]
        # upper layers are small: their neighbours are exact
        self.upper = [self._exact(self.x[:s], m) for s in sizes if s > 1]
        self.nb = np.full((n, self.m0), -1, np.int32)
        self.sim = np.full((n, self.m0), -2.0, "f4")
        self.stamp = np.empty(0, np.int32)

    def _exact(self, x: np.ndarray, m: int) -> np.ndarray:
        """Nearest m of each row, by blocks of rows."""
        m = min(m, len(x) - 1)
        out = np.empty((len(x), m), np.int32)
        for i in range(0, len(x), 2048):
            s = x[i : i + 2048] @ x.T
            s[np.arange(len(s)), np.arange(i, i + len(s))] = -2
            out[i : i + 2048] = np.argpartition(-s, m - 1, axis=1)[:, :m]
        return out

    def search(self, q: np.ndarray, n: int, ef: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines), best first and padded with (-1, -2), of up to ef of the first n nodes."""
        ef = min(ef or self.ef, max(n, 1))
        size, x, nb = len(q), self.x, self.nb
        ids = np.full((size, ef), -1, np.int32)
        sims = np.full((size, ef), -2.0, "f4")
        if not n or not size:
            return ids, sims
        cur = np.zeros(size, np.int64)
        best = q @ x[0]
        for layer in reversed(self.upper):
            if len(layer) > n:
                continue
            live = np.arange(size)
            while len(live):
                near = layer[cur[live]]
                s = np.einsum("ijk,ik->ij", x[near], q[live])
                at = s.argmax(1)
                top = s[np.arange(len(live)), at]
                up = top > best[live]
                live, near, at, top = live[up], near[up], at[up], top[up]
                cur[live], best[live] = near[np.arange(len(live)), at], top
        if len(self.stamp) < size * n:
            self.stamp = np.empty(size * n, np.int32)
        seen = np.zeros(size * n, bool)
        rows = np.arange(size)
        ids[:, 0], sims[:, 0] = cur, best
        seen[rows * n + cur] = True
        done = np.ones((size, ef), bool)
        done[:, 0] = False
        live = rows
        e = min(self.expand, ef)
        while len(live):
            d = done[live]
            pick = np.argsort(d, axis=1, kind="stable")[:, :e]  # the best that are not expanded
            r = np.arange(len(live))[:, None]
            fresh = ~d[r, pick]
            done[live[:, None], pick] = True
            node = ids[live[:, None], pick]
            flat_nb = nb[node]  # (live, e, m0)
            ok = (flat_nb >= 0) & (flat_nb < n) & fresh[:, :, None]
            flat_nb = flat_nb.reshape(len(live), -1)
            cell = live[:, None] * n + flat_nb
            a, b = np.nonzero(ok.reshape(len(live), -1))
            c = cell[a, b]
            new = ~seen[c]
            a, b, c = a[new], b[new], c[new]
            mark = np.arange(len(c), dtype=np.int32)
            self.stamp[c] = mark  # of a node met twice in this step, the last one stays
            once = self.stamp[c] == mark
            a, b, c = a[once], b[once], c[once]
            seen[c] = True
            v = flat_nb[a, b]
            s = np.einsum("ij,ij->i", x[v], q[live[a]])
            # only those that enter the beam are merged
            worst = sims[live, -1]
            good = s > worst[a]
            a, v, s = a[good], v[good], s[good]
            if len(a):
                count = np.bincount(a, minlength=len(live))
                wide = int(count.max())
                col = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
                new_s = np.full((len(live), wide), -2.0, "f4")
                new_i = np.full((len(live), wide), -1, np.int32)
                new_s[a, col], new_i[a, col] = s, v
                touched = np.nonzero(count)[0]
                t = live[touched]
                all_s = np.concatenate([sims[t], new_s[touched]], axis=1)
                o = np.argsort(-all_s, axis=1, kind="stable")[:, :ef]
                k = np.arange(len(t))[:, None]
                sims[t] = all_s[k, o]
                ids[t] = np.concatenate([ids[t], new_i[touched]], axis=1)[k, o]
                done[t] = np.concatenate([done[t], np.zeros((len(t), wide), bool)], axis=1)[k, o]
                done[t] |= ids[t] < 0
            live = live[~done[live].all(1)]
        return ids, sims

    def _link(self, src: np.ndarray, dst: np.ndarray, s: np.ndarray) -> None:
        """Add links src -> dst and back; each node keeps its closest m0."""
        a = np.concatenate([src, dst])
        b = np.concatenate([dst, src])
        w = np.concatenate([s, s])
        nodes = np.unique(a)
        old_b, old_w = self.nb[nodes], self.sim[nodes]
        keep = old_b >= 0
        a = np.concatenate([a, np.repeat(nodes, keep.sum(1))])
        b = np.concatenate([b, old_b[keep]])
        w = np.concatenate([w, old_w[keep]])
        key = a.astype(np.int64) * len(self.x) + b
        _, first = np.unique(key, return_index=True)
        a, b, w = a[first], b[first], w[first]
        o = np.lexsort((-w, a))
        a, b, w = a[o], b[o], w[o]
        start = np.searchsorted(a, nodes)
        rank = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a))))
        ok = rank < self.m0
        self.nb[nodes], self.sim[nodes] = -1, -2.0
        self.nb[a[ok], rank[ok]], self.sim[a[ok], rank[ok]] = b[ok], w[ok]

    def build(self, k: int, floor: float):
        """Insert all nodes; yields pairs (a, b, cosine) met on the way: of each node its k best and all from floor on."""
        n = len(self.x)
        at = 0
        while at < n:
            size = min(self.batch, max(64, at), n - at)
            q = self.x[at : at + size]
            ids, sims = self.search(q, at) if at else (np.empty((size, 0), np.int32), np.empty((size, 0), "f4"))
            own = q @ q.T
            np.fill_diagonal(own, -2)
            c = min(self.m, size - 1)
            if c > 0:
                near = np.argpartition(-own, c - 1, axis=1)[:, :c]
                ids = np.concatenate([ids, near + at], axis=1).astype(np.int32)
                sims = np.concatenate([sims, np.take_along_axis(own, near, 1)], axis=1)
            if ids.shape[1]:
                o = np.argsort(-sims, axis=1, kind="stable")
                ids, sims = np.take_along_axis(ids, o, 1), np.take_along_axis(sims, o, 1)
                new = np.arange(at, at + size)
                top = slice(0, self.m)
                ok = ids[:, top] >= 0
                src = np.repeat(new, ok.sum(1))
                self._link(src, ids[:, top][ok], sims[:, top][ok])
                out = (ids >= 0) & ((np.arange(ids.shape[1]) < k)[None, :] | (sims >= floor))
                yield self.order[np.repeat(new, out.sum(1))], self.order[ids[out]], sims[out]
                if floor <= 1:
                    # more near ones in the batch than were taken, or a beam full of near ones: all of them, exactly
                    a, b = np.nonzero(np.triu(own >= floor, 1))
                    yield self.order[a + at], self.order[b + at], own[a, b]
                    if at:
                        yield from self._saturated(q, new, at, ids, sims, floor)
            at += size

    def _saturated(self, q, names, n, ids, sims, floor):
        ef = self.ef
        rows = np.nonzero(sims[:, : min(ef, sims.shape[1])].min(1) >= floor)[0]
        while len(rows) and ef < n:
            ef = min(n, ef * 4)
            i, s = self.search(q[rows], n, ef)
            ok = (i >= 0) & (s >= floor)
            yield self.order[np.repeat(names[rows], ok.sum(1))], self.order[i[ok]], s[ok]
            rows = rows[s.min(1) >= floor]

    def query(self, q: np.ndarray, k: int, floor: float, width: int | None = None):
        """Pairs (query row, node, cosine): the k best of each query and all from floor on; width of the beam."""
        n = len(self.x)
        for at in range(0, len(q), self.batch):
            part = q[at : at + self.batch]
            ef, rows = width or self.ef, np.arange(len(part))
            while True:
                ids, sims = self.search(part[rows], n, ef)
                ok = (ids >= 0) & ((np.arange(ids.shape[1]) < k)[None, :] | (sims >= floor))
                yield at + np.repeat(rows, ok.sum(1)), self.order[ids[ok]], sims[ok]
                full = (sims.min(1) >= floor) if ids.shape[1] else np.zeros(0, bool)
                if ef >= n or not full.any():
                    break
                rows, ef = rows[full], ef * 4


def centroids(x: np.ndarray, cells: int, rounds: int = 6, seed: int = 2) -> np.ndarray:
    """Spherical k-means on a sample."""
    r = np.random.default_rng(seed)
    c = x[r.choice(len(x), min(cells, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 0, total / np.maximum(norm, 1e-12), c)
    return c.astype("f4")
