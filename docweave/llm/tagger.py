"""A character tagger in numpy: bidirectional LSTM with CRF transitions."""

from __future__ import annotations

import numpy as np

SIGNS = 97  # printable ASCII, other letters, anything else
_OTHER_LETTER, _OTHER = 95, 96


def sign_ids(text: str) -> np.ndarray:
    """One small number for each code point."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    plain = (points >= 32) & (points < 127)
    return np.where(plain, points - 32, np.where(points >= 0xC0, _OTHER_LETTER, _OTHER))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Tagger:
    """Tags 0 (outside), 2k + 1 (begin of kind k) and 2k + 2 (inside of kind k)."""

    def __init__(self, kinds: int, hidden: int = 24, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.tags, self.hidden = 2 * kinds + 1, hidden
        shapes = {"out": (2 * hidden, self.tags), "bias": (self.tags,), "step": (self.tags, self.tags), "first": (self.tags,)}
        for side in "fb":
            shapes |= {f"in_{side}": (SIGNS, 4 * hidden), f"own_{side}": (hidden, 4 * hidden)}
        self.p = {k: (rng.normal(0, 0.15, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}
        for side in "fb":
            self.p[f"in_{side}"][:, hidden : 2 * hidden] += 1.0  # remember at first
        legal = np.array([[b % 2 == 1 or b == 0 or a in (b, b - 1) for b in range(self.tags)] for a in range(self.tags)])
        self.illegal = np.where(legal, 0, -1e4).astype(np.float32)
        self.no_start = np.where(np.arange(self.tags) % 2 == 1, 0, -1e4).astype(np.float32)
        self.no_start[0] = 0

    # ---- LSTM: both directions in one loop, the second over the reversed text ----
    def _both(self, name: str) -> np.ndarray:
        return np.stack([self.p[f"{name}_f"], self.p[f"{name}_b"]])

    def _walk(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (T, N, 2H) over ids (T, N)."""
        own, size = self._both("own"), self.hidden
        given = np.stack([self.p["in_f"][x], self.p["in_b"][x[::-1]]], axis=1)
        h = c = np.zeros((2, x.shape[1], size), np.float32)
        out = np.empty((len(x), 2, x.shape[1], size), np.float32)
        for t in range(len(x)):
            z = given[t] + h @ own
            gates = _sigmoid(z[..., : 3 * size])
            i, f, o, g = gates[..., :size], gates[..., size : 2 * size], gates[..., 2 * size :], np.tanh(z[..., 3 * size :])
            before_h, before_c = h, c
            c = f * c + i * g
            th = np.tanh(c)
            h = o * th
            out[t] = h
            if keep is not None:
                keep.append((i, f, o, g, th, before_h, before_c))
        return np.concatenate([out[:, 0], out[::-1, 1]], axis=2)

    def _walk_back(self, x: np.ndarray, kept: list, slope: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients from the slopes (T, N, 2H) of the states."""
        own, size = self._both("own"), self.hidden
        turned = own.transpose(0, 2, 1)
        pull = np.stack([slope[:, :, :size], slope[::-1, :, size:]], axis=1)
        d_own, all_dz = np.zeros_like(own), np.empty((len(x), 2, x.shape[1], 4 * size), np.float32)
        dh = dc = np.zeros((2, x.shape[1], size), np.float32)
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, th, before_h, before_c = kept[t]
            dh = dh + pull[t]
            dc = dc + dh * o * (1 - th * th)
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)], axis=2
            )
            all_dz[t] = dz
            d_own += before_h.transpose(0, 2, 1) @ dz
            dh, dc = dz @ turned, dc * f
        grads = {"own_f": d_own[0], "own_b": d_own[1]}
        for name, ids, dz in (("in_f", x, all_dz[:, 0]), ("in_b", x[::-1], all_dz[:, 1])):
            hot = np.zeros((x.size, SIGNS), np.float32)
            hot[np.arange(x.size), ids.reshape(-1)] = 1
            grads[name] = hot.T @ dz.reshape(x.size, -1)
        return grads

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (T, N, tags) of ids (T, N)."""
        return self._walk(x) @ self.p["out"] + self.p["bias"]

    # ---- CRF ----
    def _loss(self, e: np.ndarray, gold: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Mean negative log likelihood and its slopes by emissions, transitions and first tags."""
        steps, first = self.p["step"] + self.illegal, self.p["first"] + self.no_start
        length, n, tags = e.shape
        ahead, back = np.empty_like(e), np.zeros_like(e)
        ahead[0] = first + e[0]
        for t in range(1, length):
            ahead[t] = _logsum(ahead[t - 1][:, :, None] + steps[None], 1) + e[t]
        for t in range(length - 2, -1, -1):
            back[t] = _logsum(steps[None] + (e[t + 1] + back[t + 1])[:, None, :], 2)
        total = _logsum(ahead[-1], 1)
        share = np.exp(ahead + back - total[None, :, None])
        pairs = np.zeros_like(steps)
        for t in range(1, length):
            pairs += np.exp(ahead[t - 1][:, :, None] + steps[None] + (e[t] + back[t])[:, None, :] - total[:, None, None]).sum(0)
        rows = np.arange(n)
        score = first[gold[0]] + e[0, rows, gold[0]]
        right = np.zeros_like(e)
        right[0, rows, gold[0]] = 1
        gold_pairs = np.zeros_like(steps)
        for t in range(1, length):
            score = score + steps[gold[t - 1], gold[t]] + e[t, rows, gold[t]]
            right[t, rows, gold[t]] = 1
            np.add.at(gold_pairs, (gold[t - 1], gold[t]), 1)
        slope = (share - right) / n
        return float((total - score).mean()), slope, (pairs - gold_pairs) / n, slope[0].sum(0)

    def train(self, x: np.ndarray, gold: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.03, seed: int = 5) -> list[float]:
        """Fit to windows ``x`` (N, T) with tags ``gold`` (N, T); returns the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses, count, total = [], 0, epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order, lost = rng.permutation(len(x)), []
            for a in range(0, len(order), batch):
                rows = order[a : a + batch]
                ids, tags = x[rows].T, gold[rows].T
                kept: list = []
                states = self._walk(ids, kept)
                e = states @ self.p["out"] + self.p["bias"]
                loss, slope, steps, first = self._loss(e, tags)
                lost.append(loss)
                flat = slope.reshape(-1, self.tags)
                grads = {"out": states.reshape(len(flat), -1).T @ flat, "bias": flat.sum(0), "step": steps, "first": first}
                grads |= self._walk_back(ids, kept, slope @ self.p["out"].T)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                count += 1
                now = rate * (1 - 0.9 * count / total) * min(1.0, 5 / (norm + 1e-9))
                for k, g in grads.items():
                    m[k] += 0.1 * (g - m[k])
                    s[k] += 0.01 * (g * g - s[k])
                    self.p[k] -= (now * (m[k] / (1 - 0.9**count)) / (np.sqrt(s[k] / (1 - 0.99**count)) + 1e-6)).astype(np.float32)
            losses.append(float(np.mean(lost)))
        return losses

    def best_tags(self, e: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Viterbi tags of emissions (T, N, tags), each up to its own length; longest first."""
        steps, first = self.p["step"] + self.illegal, self.p["first"] + self.no_start
        length, n, tags = e.shape
        came = np.zeros((length, n, tags), np.int8)
        score = first + e[0]
        for t in range(1, length):
            alive = int(np.searchsorted(-lengths, -t, side="left"))
            ways = score[:alive, :, None] + steps[None]
            came[t, :alive] = ways.argmax(1)
            score[:alive] = ways.max(1) + e[t, :alive]
        tag = score.argmax(1)
        out = np.zeros((length, n), np.int64)
        for t in range(length - 1, -1, -1):
            inside = lengths > t
            out[t, inside] = tag[inside]
            if t:
                tag = np.where(inside, came[t][np.arange(n), tag], tag)
        return [out[: lengths[i], i] for i in range(n)]
