"""A character tagger in numpy: bidirectional LSTM, CRF transitions, trained by Adam."""

from __future__ import annotations

import numpy as np

#: Character classes: ASCII as it is, but one class for all digits; other characters share one.
_CLASS = np.arange(129)
_CLASS[48:58] = 48
OTHER, PAD = 128, 0
HIDDEN, EMBEDDED = 16, 10
NEVER = -1e4


def _classes(codes: np.ndarray) -> np.ndarray:
    return _CLASS[np.minimum(codes, OTHER)]


def _padded(rows: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    out, sizes = np.full((len(rows), width), PAD), np.array([len(r) for r in rows])
    for k, row in enumerate(rows):
        out[k, : len(row)] = _classes(row)
    return out, sizes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


class Tagger:
    """Tags 0 (outside), 2k+1 (begin of kind k) and 2k+2 (inside kind k) for windows of characters."""

    def __init__(self, tags: int, seed: int):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) * (1.5 / sum(shape)) ** 0.5).astype(np.float32)
        self.p = {
            "emb": draw(OTHER + 1, EMBEDDED),
            "wx_f": draw(EMBEDDED, 4 * HIDDEN),
            "wh_f": draw(HIDDEN, 4 * HIDDEN),
            "b_f": np.zeros(4 * HIDDEN, np.float32),
            "wx_b": draw(EMBEDDED, 4 * HIDDEN),
            "wh_b": draw(HIDDEN, 4 * HIDDEN),
            "b_b": np.zeros(4 * HIDDEN, np.float32),
            "out": draw(2 * HIDDEN, tags),
            "b_o": np.zeros(tags, np.float32),
            "move": np.zeros((tags, tags), np.float32),
        }
        self.bar = np.zeros((tags, tags), np.float32)
        for to in range(2, tags, 2):
            self.bar[:, to] = NEVER
            self.bar[[to - 1, to], to] = 0
        self.start = np.zeros(tags, np.float32)

    def _lstm(self, x: np.ndarray, side: str, keep: bool) -> tuple[np.ndarray, list]:
        p, n, width = self.p, len(x), x.shape[1]
        inputs = x @ p["wx_" + side] + p["b_" + side]
        h = c = np.zeros((n, HIDDEN), np.float32)
        out, steps = np.empty((n, width, HIDDEN), np.float32), []
        for t in range(width):
            z = inputs[:, t] + h @ p["wh_" + side]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, last = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[:, t] = h
            if keep:
                steps.append((i, f, o, g, before, tc, last))
        return out, steps

    def _lstm_back(self, d_out: np.ndarray, x: np.ndarray, side: str, steps: list, grad: dict) -> np.ndarray:
        p = self.p
        dz_all = np.empty((*d_out.shape[:2], 4 * HIDDEN), np.float32)
        dh = dc = 0.0
        for t in range(d_out.shape[1] - 1, -1, -1):
            i, f, o, g, before, tc, last = steps[t]
            dh = d_out[:, t] + dh
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1
            )
            dz_all[:, t] = dz
            grad["wh_" + side] += last.T @ dz
            dc, dh = dc * f, dz @ p["wh_" + side].T
        flat = dz_all.reshape(-1, 4 * HIDDEN)
        grad["wx_" + side] += x.reshape(-1, EMBEDDED).T @ flat
        grad["b_" + side] += flat.sum(0)
        return dz_all @ p["wx_" + side].T

    def emissions(self, classes: np.ndarray, keep: bool = False):
        x = self.p["emb"][classes]
        ahead, steps_f = self._lstm(x, "f", keep)
        back, steps_b = self._lstm(x[:, ::-1], "b", keep)
        h = np.concatenate([ahead, back[:, ::-1]], 2)
        return h @ self.p["out"] + self.p["b_o"], (x, h, steps_f, steps_b)

    def gradient(self, classes: np.ndarray, sizes: np.ndarray, gold: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the gold tags, padding left out, and its gradient."""
        n, width = classes.shape
        scores, (x, h, steps_f, steps_b) = self.emissions(classes, True)
        scores = scores.astype(np.float64)
        inside = np.arange(width) < sizes[:, None]
        move = (self.p["move"] + self.bar).astype(np.float64)
        start = np.zeros(move.shape[0])
        start[2::2] = NEVER
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[:, 0] = scores[:, 0] + start
        for t in range(1, width):
            new = _log_sum(alpha[:, t - 1, :, None] + move, 1) + scores[:, t]
            alpha[:, t] = np.where(inside[:, t, None], new, alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            new = _log_sum(move + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(inside[:, t + 1, None], new, beta[:, t + 1])
        total = _log_sum(alpha[:, -1], 1)
        d = np.exp(alpha + beta - total[:, None, None])
        rows, cols = np.arange(n)[:, None], np.arange(width)
        loss = total - np.where(inside, scores[rows, cols, gold], 0).sum(1)
        d[rows, cols, gold] -= 1
        d[~inside] = 0
        d_move = np.zeros_like(move)
        for t in range(1, width):
            some = inside[:, t]
            if some.any():
                pair = alpha[some, t - 1, :, None] + move + (scores[some, t] + beta[some, t])[:, None, :]
                d_move += np.exp(pair - total[some, None, None]).sum(0)
                np.add.at(d_move, (gold[some, t - 1], gold[some, t]), -1)
                loss[some] -= move[gold[some, t - 1], gold[some, t]]
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        d = (d / n).astype(np.float32)
        grad["move"] = (d_move / n).astype(np.float32)
        grad["out"] = h.reshape(-1, 2 * HIDDEN).T @ d.reshape(-1, d.shape[2])
        grad["b_o"] = d.sum((0, 1))
        dh = d @ self.p["out"].T
        dx = self._lstm_back(dh[:, :, :HIDDEN], x, "f", steps_f, grad)
        dx = dx + self._lstm_back(dh[:, ::-1, HIDDEN:], x[:, ::-1], "b", steps_b, grad)[:, ::-1]
        np.add.at(grad["emb"], classes, dx)
        return float(loss.mean()), grad

    def decode(self, rows: list[np.ndarray], width: int) -> np.ndarray:
        """The best tags of each row of code points, by Viterbi; what lies past a row's end is 0."""
        classes, sizes = _padded(rows, width)
        scores, _ = self.emissions(classes)
        move = self.p["move"] + self.bar
        best = scores[:, 0].copy()
        best[:, 2::2] += NEVER
        back = np.empty((len(rows), width, move.shape[0]), np.int8)
        back[:, 0] = 0
        same = np.arange(move.shape[0], dtype=np.int8)
        for t in range(1, width):
            paths = best[:, :, None] + move
            inside = (t < sizes)[:, None]
            back[:, t] = np.where(inside, paths.argmax(1), same)
            best = np.where(inside, paths.max(1) + scores[:, t], best)
        tags = np.zeros((len(rows), width), np.int8)
        at, k = best.argmax(1), np.arange(len(rows))
        for t in range(width - 1, -1, -1):
            tags[:, t] = np.where(t < sizes, at, 0)
            at = back[k, t, at]
        return tags


def train_tagger(windows: list[tuple[np.ndarray, np.ndarray]], tags: int, width: int, steps: int, seed: int) -> Tagger:
    """Train on ``(code points, tags)`` windows; batches are drawn by a seeded generator, so results repeat."""
    tagger, rng = Tagger(tags, seed), np.random.default_rng(seed)
    classes, sizes = _padded([c for c, _ in windows], width)
    gold = np.zeros((len(windows), width), np.int64)
    for k, (_, own) in enumerate(windows):
        gold[k, : len(own)] = own
        if len(own) and own[0] and own[0] % 2 == 0:  # a window that begins inside a span
            gold[k, 0] = own[0] - 1
    first, second = ({k: np.zeros_like(v) for k, v in tagger.p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(windows), 32)
        _, grad = tagger.gradient(classes[pick], sizes[pick], gold[pick])
        size = sum(float((g * g).sum()) for g in grad.values()) ** 0.5
        rate = 0.02 * min(1.0, 4 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            g = g * min(1.0, 5 / (size + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            tagger.p[k] = tagger.p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    return tagger
