"""A small character convolutional network in numpy: one convolution, two poolings, one output.

Input is a window of characters around a candidate and a mark on the candidate's own
characters. Training is deterministic for given rows and a seed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LEFT, VALUE, RIGHT = 24, 48, 24
WIDTH = LEFT + VALUE + RIGHT
SYMBOLS, PAD, OTHER = 130, 129, 128


def window(text: str, start: int, end: int) -> tuple[str, str, str]:
    """(context before, first characters of the candidate, what follows these); the lengths are bounded whatever the text."""
    end = min(end, start + VALUE)
    return text[max(0, start - LEFT) : start], text[start:end], text[end : end + RIGHT]


def window_starts(start: int, end: int) -> list[int]:
    """Where windows begin that cover a candidate, each overlapping the one before by half at least."""
    return [*range(start, max(start, end - VALUE), VALUE // 2), max(start, end - VALUE)]


def encode(windows: list[tuple[str, str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, marks): one row of ``WIDTH`` characters per window."""
    codes = np.full((len(windows), WIDTH), PAD, np.int64)
    marks = np.zeros((len(windows), WIDTH), np.float32)
    for row, (before, value, after) in enumerate(windows):
        at = LEFT
        for part, begin in ((before, at - len(before)), (value, at), (after, at + len(value))):
            codes[row, begin : begin + len(part)] = [min(ord(c), OTHER) for c in part]
        marks[row, at : at + len(value)] = 1
    return codes, marks


def newton(curvature: np.ndarray, slope: np.ndarray) -> np.ndarray:
    """A damped Newton step of the calibration."""
    move = np.linalg.solve(curvature + 1e-6 * np.eye(2), slope)
    return move / max(1.0, np.abs(move).max())


@dataclass
class CharCnn:
    channels: int = 8
    span: int = 5
    filters: int = 24
    seed: int = 7
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    #: calibration: probability = sigmoid(slope * logit + shift)
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0
    #: at the threshold, on the held-out rows
    recall: float = 0.0
    precision: float = 0.0
    precise: bool = False

    def _forward(self, codes: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, tuple]:
        w = self.weights
        x = np.concatenate((w["embed"][codes], marks[:, :, None]), axis=2)
        cols = np.lib.stride_tricks.sliding_window_view(x, self.span, axis=1).reshape(len(codes), WIDTH - self.span + 1, -1)
        act = np.maximum(cols @ w["conv"] + w["conv_b"], 0)
        inside = marks[:, self.span // 2 : WIDTH - self.span // 2, None]
        top = act.argmax(axis=1)
        peak = np.take_along_axis(act, top[:, None, :], axis=1)[:, 0]
        share = inside / np.maximum(inside.sum(axis=1, keepdims=True), 1)
        pooled = np.concatenate((peak, (act * share).sum(axis=1)), axis=1)
        return pooled @ w["out"] + w["out_b"][0], (cols, act, top, share, pooled)

    def start(self) -> CharCnn:
        """Random weights, the same for a seed."""
        rng, shape = np.random.default_rng(self.seed), self._shape()
        self.weights = {k: (rng.normal(0, 0.3, s) if k[-2:] != "_b" else np.zeros(s)).astype(np.float32) for k, s in shape.items()}
        return self

    def _shape(self) -> dict[str, tuple[int, ...]]:
        c, f = self.channels, self.filters
        return {"embed": (SYMBOLS, c), "conv": (self.span * (c + 1), f), "conv_b": (f,), "out": (2 * f,), "out_b": (1,)}

    def fit(self, codes: np.ndarray, marks: np.ndarray, labels: np.ndarray, steps: int = 1500, batch: int = 64, rate: float = 3e-3,
            share: float | None = None, turn: tuple[int, ...] = (1,)) -> CharCnn:
        """Goes on from the weights there are (from ``start`` if there are none). ``share`` is the mean label where these rows are
        a part of the training rows; ``turn`` seeds the order of the rows."""
        if not self.weights:
            self.start()
        rng = np.random.default_rng((self.seed, *turn))
        c, f = self.channels, self.filters
        shape = self._shape()
        mean = float(labels.mean()) if share is None else share
        moments = {k: (np.zeros(s, np.float32), np.zeros(s, np.float32)) for k, s in shape.items()}
        # labels between 0 and 1 count for both classes
        weight = (labels * (0.5 / max(mean, 1e-6)) + (1 - labels) * (0.5 / max(1 - mean, 1e-6))).astype(np.float32)
        step = 0
        while step < steps:
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch):
                pick = order[at : at + batch]
                part = codes[pick]
                hide = rng.random(len(pick)) < 0.5  # half of the windows lose their context: the value alone must do
                part = np.where(hide[:, None] & (marks[pick] == 0), PAD, part)
                logit, (cols, act, top, share, pooled) = self._forward(part, marks[pick])
                miss = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[pick]) * weight[pick] / len(pick)).astype(np.float32)
                grads = {"out": pooled.T @ miss, "out_b": miss.sum(keepdims=True)}
                back = miss[:, None] * self.weights["out"]
                d_act = back[:, None, f:] * share
                rows, cells = np.arange(len(pick))[:, None], np.arange(f)[None]
                d_act[rows, top, cells] += back[:, :f]
                d_act *= act > 0
                grads["conv"] = np.einsum("npk,npf->kf", cols, d_act, optimize=True)
                grads["conv_b"] = d_act.sum(axis=(0, 1))
                d_cols = (d_act @ self.weights["conv"].T).reshape(len(pick), -1, c + 1, self.span)
                d_x = np.zeros((len(pick), WIDTH, c), np.float32)
                for k in range(self.span):
                    d_x[:, k : k + d_cols.shape[1]] += d_cols[:, :, :c, k]
                grads["embed"] = np.zeros((SYMBOLS, c), np.float32)
                np.add.at(grads["embed"], part, d_x)
                step += 1
                for k, g in grads.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    self.weights[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        return self

    def logits(self, codes: np.ndarray, marks: np.ndarray, batch: int = 512) -> np.ndarray:
        return np.concatenate([self._forward(codes[i : i + batch], marks[i : i + batch])[0] for i in range(0, len(codes), batch)] or [np.zeros(0)])

    def calibrate(self, codes: np.ndarray, marks: np.ndarray, labels: np.ndarray, min_recall: float, min_precision: float = 0.0) -> CharCnn:
        """Fits slope and shift on held-out rows, then takes the highest threshold that keeps the recall.

        The precision there is measured (``precise``: it reaches ``min_precision``) and changes nothing.
        """
        x = np.stack((self.logits(codes, marks).astype(np.float64), np.ones(len(labels))), axis=1)
        soft = np.where(labels == 1, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
        line = np.zeros(2)
        for _ in range(100):  # logistic regression on the logit with smoothed targets, damped Newton steps
            p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
            line += newton((x * (p * (1 - p))[:, None]).T @ x, x.T @ (soft - p))
        self.slope, self.shift = map(float, line)
        found = np.sort(self.probability(codes, marks)[labels == 1])
        self.threshold = float(found[int(np.floor((1 - min_recall) * len(found)))])
        hit = self.probability(codes, marks) >= self.threshold
        self.recall, self.precision = float(hit[labels == 1].mean()), float(labels[hit].mean())
        self.precise = self.precision >= min_precision
        return self

    def probability(self, codes: np.ndarray, marks: np.ndarray) -> np.ndarray:
        return self.sigmoid(self.slope * self.logits(codes, marks))

    def sigmoid(self, height: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(height + self.shift, -30, 30)))
