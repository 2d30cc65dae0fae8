"""A bidirectional LSTM over characters with a CRF over its tags, in numpy: loss and
gradients, training by Adam, Viterbi decoding and span posteriors."""

from __future__ import annotations

import numpy as np

VOCABULARY = 131  # 0: nothing, 1-127: ASCII, 128: other letters, 129: other digits, 130: the rest

_CODES: np.ndarray | None = None


def codes(text: str) -> np.ndarray:
    """A small code for each character."""
    global _CODES
    if _CODES is None:
        table = np.full(0x110000, 130, np.uint8)
        table[1:128] = np.arange(1, 128)
        for c in range(128, 0x3000):
            s = chr(c)
            table[c] = 128 if s.isalpha() else 129 if s.isdigit() else 130
        table[0x3000:0xE000] = 128  # ideographs and syllables
        _CODES = table
    return _CODES[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis=axis)) + m.squeeze(axis)


class Tagger:
    """params: for each direction d, x_d (code to gates), h_d (state to gates), b_d;
    out, bias (states to tags); step, first (CRF transitions, start)."""

    def __init__(self, tags: int, hidden: int = 16, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.tags, self.hidden = tags, hidden
        self.p = {"out": rng.normal(0, 0.2, (2 * hidden, tags)), "bias": np.zeros(tags), "step": np.zeros((tags, tags)), "first": np.zeros(tags)}
        for d in "fb":
            b = np.zeros(4 * hidden)
            b[hidden : 2 * hidden] = 1  # remember at first
            self.p |= {f"x_{d}": rng.normal(0, 0.3, (VOCABULARY, 4 * hidden)), f"h_{d}": rng.normal(0, 0.2, (hidden, 4 * hidden)), f"b_{d}": b}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _lstm(self, x: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        n, length = x.shape
        k = self.hidden
        h = np.zeros((n, k), np.float32)
        c = np.zeros((n, k), np.float32)
        states = np.zeros((n, length, k), np.float32)
        held = []
        table = self.p[f"x_{d}"] + self.p[f"b_{d}"]
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            gates = table[x[:, t]] + h @ self.p[f"h_{d}"]
            s = _sigmoid(gates[:, : 3 * k])
            g = np.tanh(gates[:, 3 * k :])
            before = (h, c)
            c = s[:, k : 2 * k] * c + s[:, :k] * g
            tc = np.tanh(c)
            h = s[:, 2 * k :] * tc
            states[:, t] = h
            if keep:
                held.append((t, s, g, tc, *before))
        return states, held

    def _lstm_back(self, x: np.ndarray, d: str, held: list, dstates: np.ndarray, grads: dict) -> None:
        n, k = len(x), self.hidden
        dh, dc = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        dx, dw = np.zeros_like(self.p[f"x_{d}"]), np.zeros_like(self.p[f"h_{d}"])
        for t, s, g, tc, h0, c0 in reversed(held):
            dh = dh + dstates[:, t]
            i, f, o = s[:, :k], s[:, k : 2 * k], s[:, 2 * k :]
            dc = dc + dh * o * (1 - tc * tc)
            gates = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            np.add.at(dx, x[:, t], gates)
            dw += h0.T @ gates
            dh = gates @ self.p[f"h_{d}"].T
            dc = dc * f
        grads[f"x_{d}"], grads[f"h_{d}"], grads[f"b_{d}"] = dx, dw, dx.sum(axis=0)

    def emissions(self, x: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._lstm(x, "f", False)[0], self._lstm(x, "b", False)[0]], axis=2)
        return states @ self.p["out"] + self.p["bias"]

    def _sums(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward log sums, and the log of all paths' total."""
        n, length, _ = e.shape
        a, b = np.zeros_like(e), np.zeros_like(e)
        step = self.p["step"]
        a[:, 0] = e[:, 0] + self.p["first"]
        for t in range(1, length):
            a[:, t] = e[:, t] + _logsumexp(a[:, t - 1, :, None] + step, 1)
        for t in range(length - 2, -1, -1):
            b[:, t] = _logsumexp(step + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2)
        return a, b, _logsumexp(a[:, -1], 1)

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of tags y and its gradients."""
        n, length = x.shape
        hf, kf = self._lstm(x, "f", True)
        hb, kb = self._lstm(x, "b", True)
        states = np.concatenate([hf, hb], axis=2)
        e = states @ self.p["out"] + self.p["bias"]
        a, b, z = self._sums(e)
        rows = np.arange(n)[:, None]
        gold = e[rows, np.arange(length), y].sum(axis=1) + self.p["first"][y[:, 0]] + self.p["step"][y[:, :-1], y[:, 1:]].sum(axis=1)
        de = np.exp(a + b - z[:, None, None])
        grads: dict = {"first": de[:, 0].sum(axis=0)}
        np.add.at(grads["first"], y[:, 0], -1)
        pairs = np.exp(a[:, :-1, :, None] + self.p["step"] + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]).sum(axis=(0, 1))
        np.add.at(pairs, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        grads["step"] = pairs
        de[rows, np.arange(length), y] -= 1
        grads["out"] = np.einsum("ntk,ntg->kg", states, de)
        grads["bias"] = de.sum(axis=(0, 1))
        ds = de @ self.p["out"].T
        k = self.hidden
        self._lstm_back(x, "f", kf, ds[:, :, :k], grads)
        self._lstm_back(x, "b", kb, ds[:, :, k:], grads)
        return float((z - gold).mean()), {g: v / n for g, v in grads.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 300, batch: int = 64, rate: float = 0.04, seed: int = 0) -> list[float]:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        losses = []
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(x), batch)
            loss, grads = self.loss(x[pick], y[pick])
            losses.append(loss)
            pace = rate * (1 - t / (steps + 1))
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.98 * v[k] + 0.02 * g * g
                self.p[k] = (self.p[k] - pace * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.98**t)) + 1e-6)).astype(np.float32)
        return losses

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags, and the posterior of each."""
        e = self.emissions(x)
        n, length, k = e.shape
        score = e[:, 0] + self.p["first"]
        back = np.zeros((n, length, k), np.int8)
        for t in range(1, length):
            total = score[:, :, None] + self.p["step"]
            back[:, t] = total.argmax(axis=1)
            score = total.max(axis=1) + e[:, t]
        tags = np.zeros((n, length), np.int8)
        tags[:, -1] = score.argmax(axis=1)
        rows = np.arange(n)
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = back[rows, t, tags[:, t]]
        a, b, z = self._sums(e)
        sure = np.exp(a + b - z[:, None, None])
        return tags, sure[rows[:, None], np.arange(length), tags]
