"""Gated recurrent units in numpy: many sequences side by side, one step at a time."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def step(h: np.ndarray, gates: np.ndarray, u: np.ndarray):
    """The next state, and what its gradient needs. ``gates``: inputs to update, reset and candidate."""
    width = u.shape[0]
    a = h @ u
    zr = sigmoid(gates[:, :2 * width] + a[:, :2 * width])
    z, r, q = zr[:, :width], zr[:, width:], a[:, 2 * width:]
    c = np.tanh(gates[:, 2 * width:] + r * q)
    return c + z * (h - c), (h, z, r, q, c)


def step_back(dh: np.ndarray, kept, u: np.ndarray):
    """Gradients of the previous state, the gate inputs and ``u``."""
    h, z, r, q, c = kept
    dc = dh * (1 - z) * (1 - c * c)
    daz = dh * (h - c) * z * (1 - z)
    dar = dc * q * r * (1 - r)
    da = np.concatenate((daz, dar, dc * r), axis=1)
    return dh * z + da @ u.T, np.concatenate((daz, dar, dc), axis=1), h.T @ da


class Adam:
    """Adam over a dictionary of arrays, updated in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.t = weights, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, gradient: dict[str, np.ndarray]) -> None:
        self.t += 1
        size = np.sqrt(sum(float((g * g).sum()) for g in gradient.values()))
        clip = min(1.0, 5.0 / (size + 1e-12))
        rate = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in gradient.items():
            g = g * clip
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.weights[k] -= (rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(self.weights[k].dtype)
