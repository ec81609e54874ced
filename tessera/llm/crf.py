"""A linear-chain conditional random field in numpy: binary features, batched forward-backward, batched Viterbi.

A position has a list of feature numbers below `size`; number 0 is the padding and weighs nothing."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np


def feature(name: str, size: int) -> int:
    return 1 + zlib.crc32(name.encode("utf-8", "surrogatepass")) % (size - 1)


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray  # feature by label
    moves: np.ndarray  # label by label
    starts: np.ndarray

    @property
    def size(self) -> int:
        return len(self.weights)

    def unary(self, feats: list[list[int]]) -> np.ndarray:
        """Scores of positions by label."""
        if not feats:
            return np.zeros((0, len(self.labels)))
        count = np.array([len(f) for f in feats])
        flat = np.fromiter((x for f in feats for x in f), np.int64, count.sum())
        row = np.repeat(np.arange(len(feats)), count)
        picked = self.weights[flat]
        return np.stack([np.bincount(row, picked[:, k], minlength=len(feats)) for k in range(len(self.labels))], axis=1)

    def scores(self, feats: np.ndarray) -> np.ndarray:
        """Scores of positions by label from a matrix of feature numbers, one template a column."""
        weights = self.weights.astype(np.float32)
        out = np.zeros((len(feats), len(self.labels)), np.float32)
        for column in feats.T:
            out += weights[column]
        return out

    def settled(self, u: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the best labels of a sequence are surely all the first one. Leaving it for a stretch gains no more than
        the sum of its positions' best gains, the dearest moves into, inside and out of it included; if no stretch of the
        sequence gains anything by that bound, Viterbi could find none either."""
        a = self.moves - self.moves[0, 0]
        enter = max(a[0, 1:].max(), (self.starts[1:] - self.starts[0]).max())
        leave, inside = max(0.0, a[1:, 0].max()), a[1:, 1:].max()
        gain = (u[:, 1:].max(axis=1) - u[:, 0]).astype(np.float64) + inside
        row = np.repeat(np.arange(len(length)), length)
        total = np.cumsum(gain)
        apart = (np.abs(gain).max(initial=0) * (length.max(initial=0) + 1) + 1.0) * 2 * row  # keeps minima within their row
        before = np.minimum.accumulate(np.concatenate([[0.0], total[:-1]]) - apart)
        best = np.full(len(length), -np.inf)
        np.maximum.at(best, row, total - apart - before)
        return best + enter + leave - inside < -1e-3

    def decode(self, feats: list[list[int]], length: np.ndarray) -> np.ndarray:
        """Best label numbers; sequences of these lengths lie one after another."""
        return self.viterbi(self.unary(feats), length)

    def viterbi(self, u: np.ndarray, length: np.ndarray) -> np.ndarray:
        out = np.zeros(len(u), np.int64)
        order = np.argsort(-length, kind="stable")
        first = (np.cumsum(length) - length)[order]
        size = length[order]
        most = int(size[0]) if len(size) else 0
        live = np.searchsorted(-size, -np.arange(1, most + 1), side="right")
        back = np.zeros(u.shape, np.int64)
        v = np.zeros((len(size), len(self.labels)))
        for t in range(most):
            k = live[t]
            at = first[:k] + t
            if t:
                s = v[:k, :, None] + self.moves[None]
                back[at] = s.argmax(axis=1)
                v[:k] = s.max(axis=1) + u[at]
            else:
                v[:k] = self.starts + u[at]
        state = v.argmax(axis=1)
        for t in range(most - 1, -1, -1):
            k = live[t]
            at = first[:k] + t
            out[at] = state[:k]
            if t:
                state[:k] = back[at, state[:k]]
        return out


def fit(sequences: list[tuple[list[list[int]], list[int]]], labels: list[str], size: int, rounds: int = 60, rate: float = 0.15, decay: float = 2e-3) -> Crf:
    """Maximum likelihood with weight decay, all sequences in each round, Adam steps; no chance involved."""
    sequences = sorted((s for s in sequences if s[0]), key=lambda s: -len(s[0]))
    L = len(labels)
    S = len(sequences)
    length = np.array([len(f) for f, _ in sequences])
    T, total = int(length[0]), int(length.sum())
    live = np.searchsorted(-length, -np.arange(1, T + 1), side="right")
    begin = np.concatenate([[0], np.cumsum(live)])  # positions lie by time step: those of step t from begin[t] on
    wide = max(len(p) for f, _ in sequences for p in f)
    feats = np.zeros((total, wide), np.int64)
    gold = np.zeros(total, np.int64)
    for s, (f, y) in enumerate(sequences):
        for t, p in enumerate(f):
            feats[begin[t] + s, : len(p)] = p
            gold[begin[t] + s] = y[t]
    used, index = np.unique(feats, return_inverse=True)  # only features seen get weights while fitting
    index = index.reshape(feats.shape)
    w = [np.zeros((len(used), L)), np.zeros((L, L)), np.zeros(L)]
    m, q = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    onehot = np.eye(L)[gold]
    pairs = sum((onehot[begin[t - 1] : begin[t - 1] + live[t]].T @ onehot[begin[t] : begin[t + 1]] for t in range(1, T)), np.zeros((L, L)))
    begins = onehot[:S].sum(axis=0)
    spread = index.ravel()
    for step in range(1, rounds + 1):
        u = w[0][index].sum(axis=1)
        e = np.exp(w[1])
        # scaled forward and backward passes
        a, b, scale = np.zeros((total, L)), np.ones((total, L)), np.zeros(total)
        x = np.exp(u - u.max(axis=1, keepdims=True))
        for t in range(T):
            at = slice(begin[t], begin[t + 1])
            v = np.exp(w[2]) * x[at] if t == 0 else (a[begin[t - 1] : begin[t - 1] + live[t]] @ e) * x[at]
            scale[at] = v.sum(axis=1)
            a[at] = v / scale[at][:, None]
        expect = np.zeros((L, L))
        for t in range(T - 2, -1, -1):
            now, nxt = slice(begin[t], begin[t] + live[t + 1]), slice(begin[t + 1], begin[t + 2])
            r = x[nxt] * b[nxt] / scale[nxt][:, None]
            b[now] = r @ e.T
            expect += e * (a[now].T @ r)
        post = a * b
        delta = onehot - post / post.sum(axis=1, keepdims=True)
        g0 = np.stack([np.bincount(spread, np.repeat(delta[:, k], wide), minlength=len(used)) for k in range(L)], axis=1)
        grads = [g0, pairs - expect, begins - post[:S].sum(axis=0)]
        for i, g in enumerate(grads):
            g = g / S - decay * w[i] / 10
            m[i] = 0.9 * m[i] + 0.1 * g
            q[i] = 0.999 * q[i] + 0.001 * g * g
            w[i] += rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(q[i] / (1 - 0.999**step)) + 1e-8)
        if used[0] == 0:
            w[0][0] = 0
    full = np.zeros((size, L))
    full[used] = w[0]
    full[0] = 0
    return Crf(labels, full, w[1], w[2])
