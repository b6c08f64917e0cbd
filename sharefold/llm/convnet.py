"""A byte convolutional network in numpy: embedding, filters of several widths, max pooling, softmax.

It is trained on the driver on a bounded sample, or shard by shard in tasks, and applied inside tasks. For use, embedding and filters are folded
into look-up tables over bytes and byte pairs, so a filter costs one or two table rows a position.
"""

from __future__ import annotations

import numpy as np


class ByteConvNet:
    """Classifies fixed-length byte windows; byte 0 is padding. Training is repeatable: seed and order are fixed."""

    def __init__(self, labels: list[str], widths=(2, 3, 4), filters: int = 8, embed: int = 6, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.labels, self.widths, self.filters = list(labels), tuple(widths), filters
        self.p = {"emb": rng.normal(0, 0.5, (256, embed)).astype(np.float32)}
        for w in self.widths:
            self.p[f"w{w}"] = rng.normal(0, 1 / np.sqrt(w * embed), (w * embed, filters)).astype(np.float32)
            self.p[f"b{w}"] = np.zeros(filters, np.float32)
        wide = filters * len(self.widths)
        self.p["out"] = rng.normal(0, 1 / np.sqrt(wide), (wide, len(labels))).astype(np.float32)
        self.p["bias"] = np.zeros(len(labels), np.float32)
        self._tables = None

    def _pooled(self, x: np.ndarray):
        """Pooled features of windows (n, length) with where each maximum stood."""
        emb = self.p["emb"][x]
        out, at = [], []
        for w in self.widths:
            cols = np.concatenate([emb[:, j : x.shape[1] - w + 1 + j] for j in range(w)], axis=2)
            conv = cols @ self.p[f"w{w}"]
            best = conv.argmax(axis=1)
            out.append(np.take_along_axis(conv, best[:, None], 1)[:, 0] + self.p[f"b{w}"])
            at.append(best)
        return np.maximum(np.concatenate(out, axis=1), 0), at

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        pooled, at = self._pooled(x)
        slope = softmax(pooled @ self.p["out"] + self.p["bias"])
        slope[np.arange(len(y)), y] -= 1
        slope /= len(y)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"], g["bias"] = pooled.T @ slope, slope.sum(0)
        back = (slope @ self.p["out"].T) * (pooled > 0)
        d = self.p["emb"].shape[1]
        for n, w in enumerate(self.widths):
            part, best = back[:, n * self.filters : (n + 1) * self.filters], at[n]
            g[f"b{w}"] = part.sum(0)
            for j in range(w):
                seen = np.take_along_axis(x, best + j, axis=1)
                rows = slice(j * d, (j + 1) * d)
                g[f"w{w}"][rows] = np.einsum("nfd,nf->df", self.p["emb"][seen], part)
                np.add.at(g["emb"], seen.ravel(), (part[:, :, None] * self.p[f"w{w}"][rows].T[None]).reshape(-1, d))
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 2, least_steps: int = 1000):
        """Adam on cross-entropy over windows ``x`` (n, length) of bytes and class numbers ``y``; few windows are seen
        more often, so that the steps do not become too few."""
        epochs = max(epochs, least_steps * batch // max(1, len(y)) if len(y) < 125 * batch else 0)
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(q) for k, q in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for start in range(0, len(y), batch):
                pick = order[start : start + batch]
                step += 1
                for k, g in self._gradient(x[pick], y[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self._tables = None
        return self

    def tables(self):
        """Per width: a table over byte pairs for each two filter places, and over bytes for an odd last one."""
        if self._tables is None:
            d, made = self.p["emb"].shape[1], {}
            for w in self.widths:
                one = [self.p["emb"] @ self.p[f"w{w}"][j * d : (j + 1) * d] for j in range(w)]
                parts = [(j, (one[j][:, None] + one[j + 1][None]).reshape(65536, -1)) for j in range(0, w - 1, 2)]
                made[w] = parts + ([(w - 1, one[-1])] if w % 2 else [])
            self._tables = made
        return self._tables

    def probabilities(self, windows: np.ndarray, chunk: int = 256) -> np.ndarray:
        """Class probabilities of byte windows (n, length), in chunks of bounded memory."""
        out = np.empty((len(windows), len(self.labels)), np.float32)
        for start in range(0, len(windows), chunk):
            x = np.ascontiguousarray(windows[start : start + chunk].T).astype(np.intp)
            pairs = x[:-1] * 256 + x[1:]
            pooled = []
            for w in self.widths:
                long = len(x) - w + 1
                conv = None
                for j, table in self.tables()[w]:
                    index = (pairs if len(table) > 256 else x)[j : j + long]
                    rows = table.take(index.ravel(), axis=0)
                    conv = rows if conv is None else np.add(conv, rows, out=conv)
                pooled.append(conv.reshape(long, -1).max(axis=0).reshape(x.shape[1], -1) + self.p[f"b{w}"])
            hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
            out[start : start + chunk] = softmax(hidden @ self.p["out"] + self.p["bias"])
        return out

    def __getstate__(self):
        return {**self.__dict__, "_tables": None}


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text cut into windows of ``length`` bytes, the last padded with 0; and each text's number of windows."""
    counts = np.array([max(1, -(-len(t) // length)) for t in texts], dtype=np.int64)
    flat = np.zeros(int(counts.sum()) * length, np.uint8)
    at = 0
    for t, n in zip(texts, counts, strict=True):
        flat[at : at + len(t)] = np.frombuffer(t, np.uint8)
        at += int(n) * length
    return flat.reshape(-1, length), counts
