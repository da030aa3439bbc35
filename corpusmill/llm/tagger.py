"""Character tagger in numpy: two LSTMs, one per direction, and CRF transitions."""

from __future__ import annotations

import numpy as np

CLASSES = 98
SPACE = 1


def char_classes(text: str) -> np.ndarray:
    """ASCII characters by themselves, other letters and other characters as one class each."""
    code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    out = np.where((code >= 32) & (code < 127), code - 31, CLASSES - 1)
    for at in np.flatnonzero(code > 127):
        out[at] = CLASSES - 2 if text[at].isalpha() else CLASSES - 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    def __init__(self, tags: int, embed: int = 12, hidden: int = 20, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.hidden, self.tags = hidden, tags
        self.p = {"embed": rng.normal(0, 0.3, (CLASSES, embed)), "out": draw(2 * hidden, tags), "bias": np.zeros(tags),
                  "move": np.zeros((tags, tags)), "start": np.zeros(tags)}
        for d in "fb":
            self.p |= {d + "x": draw(embed, 4 * hidden), d + "h": draw(hidden, 4 * hidden), d + "b": np.zeros(4 * hidden)}
            self.p[d + "b"][hidden : 2 * hidden] = 1.0  # forget gates begin open

    def _run(self, d: str, x: np.ndarray, kept: list | None) -> np.ndarray:
        """Outputs of one direction for x (time, batch, embed)."""
        n, steps = self.hidden, x @ self.p[d + "x"] + self.p[d + "b"]
        h = c = np.zeros((x.shape[1], n))
        out = np.empty((x.shape[0], x.shape[1], n))
        for t in range(len(x)):
            gate = steps[t] + h @ self.p[d + "h"]
            act = _sigmoid(gate[:, : 3 * n])
            i, f, o, g = act[:, :n], act[:, n : 2 * n], act[:, 2 * n :], np.tanh(gate[:, 3 * n :])
            before, h_before = c, h
            c = f * c + i * g
            th = np.tanh(c)
            h = o * th
            out[t] = h
            if kept is not None:
                kept.append((i, f, o, g, before, th, h_before))
        return out

    def _back(self, d: str, x: np.ndarray, kept: list, slope: np.ndarray, grad: dict) -> np.ndarray:
        n, wh = self.hidden, self.p[d + "h"]
        dh = dc = np.zeros((x.shape[1], n))
        gates = np.empty((x.shape[0], x.shape[1], 4 * n))
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, before, th, h_before = kept[t]
            dh = dh + slope[t]
            dc = dc + dh * o * (1 - th**2)
            gates[t] = np.concatenate(
                [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g**2)], axis=1
            )
            grad[d + "h"] += h_before.T @ gates[t]
            dh, dc = gates[t] @ wh.T, dc * f
        flat = gates.reshape(-1, 4 * n)
        grad[d + "x"] += x.reshape(-1, x.shape[2]).T @ flat
        grad[d + "b"] += flat.sum(axis=0)
        return gates @ self.p[d + "x"].T

    def emissions(self, chars: np.ndarray) -> np.ndarray:
        """Tag scores (batch, time, tags) of windows of character classes (batch, time)."""
        x = self.p["embed"][chars.T]
        both = np.concatenate([self._run("f", x, None), self._run("b", x[::-1], None)[::-1]], axis=2)
        return (both @ self.p["out"] + self.p["bias"]).transpose(1, 0, 2)

    def loss_and_slopes(self, chars: np.ndarray, gold: np.ndarray) -> tuple[float, dict]:
        """Negative log likelihood per window and its gradient."""
        p, size = self.p, len(chars)
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        x, kept = p["embed"][chars.T], {"f": [], "b": []}
        forward, backward = self._run("f", x, kept["f"]), self._run("b", x[::-1], kept["b"])[::-1]
        both = np.concatenate([forward, backward], axis=2)
        score = both @ p["out"] + p["bias"]
        time = len(score)
        alpha = [score[0] + p["start"]]
        for t in range(1, time):
            alpha.append(score[t] + _log_sum(alpha[-1][:, :, None] + p["move"], 1))
        whole = _log_sum(alpha[-1], 1)
        beta = np.zeros((size, self.tags))
        slope = np.empty_like(score)
        for t in range(time - 1, -1, -1):
            slope[t] = np.exp(alpha[t] + beta - whole[:, None])
            if t:
                ahead = score[t] + beta
                pair = alpha[t - 1][:, :, None] + p["move"] + ahead[:, None, :] - whole[:, None, None]
                grad["move"] += np.exp(pair).sum(axis=0)
                beta = _log_sum(p["move"][None] + ahead[:, None, :], 2)
        grad["start"] += slope[0].sum(axis=0)
        rows, tags = np.arange(size), gold.T
        path = p["start"][tags[0]] + sum(score[t, rows, tags[t]] for t in range(time))
        np.add.at(grad["start"], tags[0], -1)
        for t in range(time):
            slope[t, rows, tags[t]] -= 1
            if t:
                path = path + p["move"][tags[t - 1], tags[t]]
                np.add.at(grad["move"], (tags[t - 1], tags[t]), -1)
        grad["bias"] += slope.sum(axis=(0, 1))
        grad["out"] += both.reshape(-1, both.shape[2]).T @ slope.reshape(-1, self.tags)
        down, n = slope @ p["out"].T, self.hidden
        dx = self._back("f", x, kept["f"], down[:, :, :n], grad)
        dx = dx + self._back("b", x[::-1], kept["b"], down[::-1, :, n:], grad)[::-1]
        np.add.at(grad["embed"], chars.T, dx)
        return float((whole - path).mean()), {k: v / size for k, v in grad.items()}

    def fit(self, chars: np.ndarray, gold: np.ndarray, rounds: int = 4, batch: int = 64, rate: float = 0.01) -> None:
        """Adam over shuffled batches, with gradients clipped by their norm."""
        rng = np.random.default_rng(11)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(chars))
            for at in range(0, len(order), batch):
                own, step = order[at : at + batch], step + 1
                _, grad = self.loss_and_slopes(chars[own], gold[own])
                norm = np.sqrt(sum((g**2).sum() for g in grad.values()))
                for k, g in grad.items():
                    g = g * min(1.0, 5 / (norm + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g**2
                    move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.p[k] = self.p[k] - rate * move

    def best_path(self, score: np.ndarray) -> np.ndarray:
        """Most likely tags for scores (batch, time, tags)."""
        best, back = score[:, 0] + self.p["start"], []
        for t in range(1, score.shape[1]):
            ways = best[:, :, None] + self.p["move"]
            back.append(ways.argmax(axis=1))
            best = ways.max(axis=1) + score[:, t]
        path = [best.argmax(axis=1)]
        for way in reversed(back):
            path.append(way[np.arange(len(way)), path[-1]])
        return np.array(path[::-1]).T
