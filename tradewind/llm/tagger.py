"""A character-level bidirectional LSTM with CRF transitions in numpy: training and decoding.

Windows of one size, all lanes of a batch side by side. Characters outside ASCII share one symbol; 0 pads the end.
"""

from __future__ import annotations

import numpy as np

SYMBOLS, HIDDEN = 129, 16


def symbols(windows: list[str], size: int) -> np.ndarray:
    out = np.zeros((len(windows), size), np.int64)
    for row, text in zip(out, windows, strict=True):
        codes = np.frombuffer(text[:size].encode("utf-32-le", "surrogatepass"), np.uint32)
        row[:len(codes)] = np.minimum(codes, SYMBOLS - 1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    def __init__(self, tags: int, seed: int = 3, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.tags, self.hidden = tags, hidden
        self.p = {"out": rng.normal(0, 0.1, (2 * hidden, tags)), "bias": np.zeros(tags), "move": np.zeros((tags, tags))}
        for d in "fb":
            self.p["in" + d] = rng.normal(0, 0.3, (SYMBOLS, 4 * hidden))
            self.p["own" + d] = rng.normal(0, 0.2, (hidden, 4 * hidden))
            self.p["gate" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states in the order of the text, and what the backward pass needs."""
        n, size, h = len(x), x.shape[1], self.hidden
        own, gate, inner = self.p["own" + d], self.p["gate" + d], self.p["in" + d]
        state, cell = np.zeros((n, h), own.dtype), np.zeros((n, h), own.dtype)
        out, kept = np.empty((n, size, h), own.dtype), []
        for t in range(size) if d == "f" else range(size - 1, -1, -1):
            z = inner[x[:, t]] + state @ own + gate
            s, g = _sigmoid(z[:, :3 * h]), np.tanh(z[:, 3 * h:])
            before, last = cell, state
            cell = s[:, h:2 * h] * cell + s[:, :h] * g
            bent = np.tanh(cell)
            state = s[:, 2 * h:] * bent
            out[:, t] = state
            if keep:
                kept.append((t, s, g, before, bent, last))
        return out, kept

    def emissions(self, x: np.ndarray, keep: bool = False):
        f, kf = self._run(x, "f", keep)
        b, kb = self._run(x, "b", keep)
        both = np.concatenate([f, b], 2)
        return both @ self.p["out"] + self.p["bias"], both, kf, kb

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best path of tags for each window."""
        e = self.emissions(x)[0]
        n, size, _ = e.shape
        back = np.empty((n, size, self.tags), np.int8)
        score = e[:, 0]
        for t in range(1, size):
            ways = score[:, :, None] + self.p["move"][None]
            back[:, t] = ways.argmax(1)
            score = ways.max(1) + e[:, t]
        path = np.empty((n, size), np.int64)
        path[:, -1] = score.argmax(1)
        for t in range(size - 1, 0, -1):
            path[:, t - 1] = back[np.arange(n), t, path[:, t]]
        return path

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        e, both, kf, kb = self.emissions(x, True)
        n, size, k = e.shape
        move = self.p["move"]

        def total(a, axis):
            top = a.max(axis, keepdims=True)
            return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)

        ahead, behind = np.empty_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0]
        for t in range(1, size):
            ahead[:, t] = total(ahead[:, t - 1][:, :, None] + move[None], 1) + e[:, t]
        for t in range(size - 2, -1, -1):
            behind[:, t] = total(move[None] + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        z = total(ahead[:, -1], 1)
        rows, steps = np.arange(n)[:, None], np.arange(size)[None, :]
        right = e[rows, steps, y].sum(1) + move[y[:, :-1], y[:, 1:]].sum(1)
        de = np.exp(ahead + behind - z[:, None, None])
        de[rows, steps, y] -= 1
        pairs = np.zeros((k, k))
        for t in range(1, size):
            pairs += np.exp(ahead[:, t - 1][:, :, None] + move[None] + (e[:, t] + behind[:, t])[:, None, :] - z[:, None, None]).sum(0)
        np.add.at(pairs, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        g = {"move": pairs, "out": np.einsum("nth,ntk->hk", both, de), "bias": de.sum((0, 1))}
        db = de @ self.p["out"].T
        h = self.hidden
        for d, kept, part in (("f", kf, db[:, :, :h]), ("b", kb, db[:, :, h:])):
            own = self.p["own" + d]
            go, seen, steps_dz = np.zeros_like(own), [], []
            dh, dc = np.zeros((n, h)), np.zeros((n, h))
            for t, s, c, before, bent, last in reversed(kept):
                dh = dh + part[:, t]
                dc = dc + dh * s[:, 2 * h:] * (1 - bent**2)
                ds = np.concatenate([dc * c, dc * before, dh * bent], 1) * s * (1 - s)
                dz = np.concatenate([ds, dc * s[:, :h] * (1 - c**2)], 1)
                seen.append(x[:, t])
                steps_dz.append(dz)
                go += last.T @ dz
                dh, dc = dz @ own.T, dc * s[:, h:2 * h]
            every = np.concatenate(steps_dz)
            hot = np.zeros((SYMBOLS, len(every)))
            hot[np.concatenate(seen), np.arange(len(every))] = 1
            g["in" + d], g["own" + d], g["gate" + d] = hot @ every, go, every.sum(0)
        return float((z - right).mean()), {name: v / n for name, v in g.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 200, batch: int = 48, rate: float = 0.02, seed: int = 5) -> list[float]:
        """Adam over shuffled batches, about ``steps`` of them in whole rounds; the mean loss of each round."""
        rounds = max(2, -(-steps * batch // max(1, len(x))))
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        losses, step = [], 0
        for r in range(rounds):
            lost = []
            for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
                loss, g = self.gradients(x[at], y[at])
                size = np.sqrt(sum(float((a**2).sum()) for a in g.values()))
                step += 1
                for k, a in g.items():
                    a = a * min(1.0, 5 / (size + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * a
                    v[k] = 0.99 * v[k] + 0.01 * a**2
                    self.p[k] -= rate / (1 + 3 * r / rounds) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
                lost.append(loss)
            losses.append(float(np.mean(lost)) if lost else 0.0)
        return losses

    def light(self) -> Tagger:
        """The same in single precision, for decoding."""
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        return self
