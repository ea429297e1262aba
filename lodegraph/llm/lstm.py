"""A small bidirectional LSTM over sequences of sparse feature vectors, in numpy, for training and inference."""

from __future__ import annotations

import numpy as np

#: Numbers in a word vector.
WORD_DIM = 8


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


class BiLSTM:
    """features (sparse, embedded by W) -> two LSTMs -> class scores for every position."""

    def __init__(self, n_features: int, hidden: int, classes: int, seed: int = 7):
        r = np.random.default_rng(seed)
        self.h, self.k = hidden, classes
        s = 1.0 / np.sqrt(hidden)
        self.p = {"W": r.normal(0, 0.15, (n_features, 8 * hidden)).astype("f4"), "P": r.normal(0, 0.1, (WORD_DIM, 8 * hidden)).astype("f4"), "b": np.zeros(8 * hidden, "f4"), "V": r.normal(0, 0.3, (2 * hidden, classes)).astype("f4"), "c": np.zeros(classes, "f4")}
        for d in "fb":
            self.p["U" + d] = r.uniform(-s, s, (hidden, 4 * hidden)).astype("f4")
        self.p["b"][hidden : 2 * hidden] = 1.0  # forget gates start open
        self.p["b"][5 * hidden : 6 * hidden] = 1.0

    def embed(self, ids: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Input rows from sparse features (at least one a row) and word vectors."""
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return np.add.reduceat(self.p["W"][ids], starts, axis=0) + words @ self.p["P"] + self.p["b"]

    def _steps(self, x: np.ndarray, live: np.ndarray, u: np.ndarray, keep: list | None):
        """x (T, B, 4H); live[t] of the first sequences go on at t (sorted by length, longest first)."""
        t_max, b, h = x.shape[0], x.shape[1], self.h
        hs = np.zeros((t_max, b, h), "f4")
        hp, cp = np.zeros((b, h), "f4"), np.zeros((b, h), "f4")
        for t in range(t_max):
            n = live[t]
            g = x[t, :n] + hp[:n] @ u
            i, f, o = _sigmoid(g[:, :h]), _sigmoid(g[:, h : 2 * h]), _sigmoid(g[:, 2 * h : 3 * h])
            z = np.tanh(g[:, 3 * h :])
            if keep is not None:
                keep.append((n, i, f, o, z, cp[:n].copy(), hp[:n].copy()))
            c = f * cp[:n] + i * z
            cp[:n], hp[:n] = c, o * np.tanh(c)
            hs[t, :n] = hp[:n]
        return hs

    def scores(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Class log-odds for every row; rows are the embedded positions of all sequences, one after another."""
        out = np.empty((len(rows), self.k), "f4")
        order = np.argsort(-lengths, kind="stable")
        first = np.cumsum(lengths) - lengths
        # blocks of sequences of similar length bound the padding
        at = 0
        while at < len(order):
            top = max(1, int(lengths[order[at]]))
            pick = order[at : at + max(1, 40_000 // top)]
            at += len(pick)
            n = lengths[pick]
            pick, n = pick[n > 0], n[n > 0]
            if not len(pick):
                continue
            out_rows, hs = self._both(rows, first[pick], n)
            out[out_rows] = hs @ self.p["V"] + self.p["c"]
        return out

    def _index(self, first: np.ndarray, n: np.ndarray):
        t = int(n[0])
        steps = np.arange(t)[:, None]
        mask = steps < n[None, :]
        fwd = np.where(mask, first[None, :] + steps, first[None, :])
        bwd = np.where(mask, first[None, :] + n[None, :] - 1 - steps, first[None, :])
        return mask, fwd, bwd, mask.sum(1)

    def _both(self, rows, first, n):
        mask, fwd, bwd, live = self._index(first, n)
        h = self.h
        hf = self._steps(rows[fwd][:, :, : 4 * h], live, self.p["Uf"], None)
        hb = self._steps(rows[bwd][:, :, 4 * h :], live, self.p["Ub"], None)
        where = fwd[mask]
        both = np.empty((len(where), 2 * h), "f4")
        both[:, :h] = hf[mask]
        back = np.empty((len(rows), h), "f4")
        back[bwd[mask]] = hb[mask]
        both[:, h:] = back[where]
        return where, both

    def fit(self, docs: list[tuple[list[list[int]], np.ndarray, np.ndarray]], epochs: int, batch: int = 48, rate: float = 0.02, seed: int = 3) -> "BiLSTM":
        """docs: (feature ids by position, word vectors by position, labels). Adam, plain BPTT."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            for at in range(0, len(docs), batch):
                if at == 0:
                    order = r.permutation(len(docs))
                part = sorted((docs[i] for i in order[at : at + batch]), key=lambda d: -len(d[2]))
                grad = self._gradient(part)
                step += 1
                lr = rate * (0.5 ** (2.0 * epoch / max(1, epochs)))
                for k, g in grad.items():
                    np.clip(g, -1.0, 1.0, out=g)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.99 * v2[k] + 0.01 * g * g
                    self.p[k] -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-6)).astype("f4")
        return self

    def _gradient(self, part):
        h, p = self.h, self.p
        n = np.array([len(d[2]) for d in part])
        first = np.cumsum(n) - n
        ids = np.array([i for d in part for x in d[0] for i in x])
        words = np.concatenate([d[1] for d in part])
        sizes = np.array([len(x) for d in part for x in d[0]])
        y = np.concatenate([d[2] for d in part])
        rows = self.embed(ids, sizes, words)
        mask, fwd, bwd, live = self._index(first, n)
        kept = {"f": [], "b": []}
        hf = self._steps(rows[fwd][:, :, : 4 * h], live, p["Uf"], kept["f"])
        hb = self._steps(rows[bwd][:, :, 4 * h :], live, p["Ub"], kept["b"])
        both = np.zeros((len(rows), 2 * h), "f4")
        both[fwd[mask], :h] = hf[mask]
        both[bwd[mask], h:] = hb[mask]
        s = both @ p["V"] + p["c"]
        s = np.exp(s - s.max(1, keepdims=True))
        s /= s.sum(1, keepdims=True)
        s[np.arange(len(y)), y] -= 1.0
        s /= len(part)
        g = {"V": both.T @ s, "c": s.sum(0)}
        d_both = s @ p["V"].T
        d_rows = np.zeros_like(rows)
        for side, where, cols in (("f", fwd, slice(0, 4 * h)), ("b", bwd, slice(4 * h, 8 * h))):
            u = p["U" + side]
            d_out = d_both[:, :h] if side == "f" else d_both[:, h:]
            gu = np.zeros_like(u)
            dh, dc = np.zeros((len(part), h), "f4"), np.zeros((len(part), h), "f4")
            for t in range(len(kept[side]) - 1, -1, -1):
                k, i, f, o, z, cp, hp = kept[side][t]
                a = where[t, :k]
                hd = dh[:k] + d_out[a]
                tc = np.tanh(f * cp + i * z)
                cd = dc[:k] + hd * o * (1 - tc * tc)
                gates = np.concatenate([cd * z * i * (1 - i), cd * cp * f * (1 - f), hd * tc * o * (1 - o), cd * i * (1 - z * z)], axis=1)
                gu += hp.T @ gates
                dh[:k], dc[:k] = gates @ u.T, cd * f
                d_rows[a, cols] = gates
            g["U" + side] = gu
        g["b"], g["P"] = d_rows.sum(0), words.T @ d_rows
        gw = np.zeros_like(p["W"])
        order = np.argsort(ids, kind="stable")
        which, start = np.unique(ids[order], return_index=True)
        gw[which] = np.add.reduceat(np.repeat(d_rows, sizes, axis=0)[order], start, axis=0)
        g["W"] = gw
        return g
