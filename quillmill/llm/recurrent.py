"""Recurrent layers in numpy, forward and backward, and Adam.

Time is the first axis. Inputs come already projected (``x W + b``), so that a word or character that
occurs often is projected once. ``mask`` is 1 where a step holds input; elsewhere the state is kept.
"""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def gru(u: np.ndarray, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """States [T, B, H] for projected inputs [T, B, 3H] (update, reset, new), and what backward needs."""
    steps, batch, width = x.shape
    size = width // 3
    h = np.zeros((batch, size), dtype=x.dtype)
    out = np.empty((steps, batch, size), dtype=x.dtype)
    held = []
    for t in range(steps):
        hu = h @ u
        gates = sigmoid(x[t, :, : 2 * size] + hu[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        n = np.tanh(x[t, :, 2 * size :] + r * hu[:, 2 * size :])
        m = mask[t][:, None]
        new = n + z * (h - n)
        if keep:
            held.append((h, z, r, n, hu[:, 2 * size :]))
        h = h + m * (new - h)
        out[t] = h
    return out, held


def gru_back(u: np.ndarray, x: np.ndarray, mask: np.ndarray, held: list, d_out: np.ndarray):
    """Gradients by the projected inputs and by ``u``."""
    steps, batch, width = x.shape
    size = width // 3
    dx, du = np.zeros_like(x), np.zeros_like(u)
    dh = np.zeros((batch, size), dtype=x.dtype)
    for t in range(steps - 1, -1, -1):
        h, z, r, n, hn = held[t]
        total = dh + d_out[t]
        m = mask[t][:, None]
        dnew = total * m
        dn = dnew * (1 - z) * (1 - n * n)
        dz = dnew * (h - n) * z * (1 - z)
        dr = dn * hn * r * (1 - r)
        dx[t] = np.concatenate([dz, dr, dn], axis=1)
        dhu = np.concatenate([dz, dr, dn * r], axis=1)
        du += h.T @ dhu
        dh = total * (1 - m) + dnew * z + dhu @ u.T
    return dx, du


def lstm(u: np.ndarray, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """States [T, B, H] for projected inputs [T, B, 4H] (in, forget, out, cell), and what backward needs."""
    steps, batch, width = x.shape
    size = width // 4
    h = np.zeros((batch, size), dtype=x.dtype)
    c = np.zeros_like(h)
    out = np.empty((steps, batch, size), dtype=x.dtype)
    held = []
    for t in range(steps):
        a = x[t] + h @ u
        gates = sigmoid(a[:, : 3 * size])
        i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        g = np.tanh(a[:, 3 * size :])
        m = mask[t][:, None]
        fresh = f * c + i * g
        th = np.tanh(fresh)
        if keep:
            held.append((h, c, i, f, o, g, th))
        c = c + m * (fresh - c)
        h = h + m * (o * th - h)
        out[t] = h
    return out, held


def lstm_back(u: np.ndarray, x: np.ndarray, mask: np.ndarray, held: list, d_out: np.ndarray):
    steps, batch, width = x.shape
    size = width // 4
    dx, du = np.zeros_like(x), np.zeros_like(u)
    dh = np.zeros((batch, size), dtype=x.dtype)
    dc = np.zeros_like(dh)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, th = held[t]
        total = dh + d_out[t]
        m = mask[t][:, None]
        dnew = total * m
        dfresh = dc * m + dnew * o * (1 - th * th)
        da = np.concatenate(
            [dfresh * g * i * (1 - i), dfresh * c * f * (1 - f), dnew * th * o * (1 - o), dfresh * i * (1 - g * g)], axis=1
        )
        dx[t] = da
        du += h.T @ da
        dh = total * (1 - m) + da @ u.T
        dc = dc * (1 - m) + dfresh * f
    return dx, du


class Adam:
    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.rate, self.step_no = rate, 0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, weights: dict[str, np.ndarray], gradients: dict[str, np.ndarray], clip: float = 5.0) -> None:
        self.step_no += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in gradients.values())))
        scale = min(1.0, clip / (norm + 1e-12))
        rate = self.rate * np.sqrt(1 - 0.999**self.step_no) / (1 - 0.9**self.step_no)
        for k, g in gradients.items():
            g = g * scale
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (g * g - self.second[k])
            weights[k] -= (rate * self.first[k] / (np.sqrt(self.second[k]) + 1e-8)).astype(weights[k].dtype)
