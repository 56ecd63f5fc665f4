"""Small recurrent networks in numpy: forward passes and backpropagation through time."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def gru(w: np.ndarray, u: np.ndarray, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (T, B, H) of a gated recurrent unit over symbols x (T, B)."""
    n, h = u.shape[0], np.zeros((x.shape[1], u.shape[0]), u.dtype)
    out = np.empty((len(x), x.shape[1], n), u.dtype)
    for t in range(len(x)):
        a, s = w[x[t]], h @ u
        zr = sigmoid(a[:, : 2 * n] + s[:, : 2 * n])
        z, r = zr[:, :n], zr[:, n:]
        c = np.tanh(a[:, 2 * n :] + r * s[:, 2 * n :])
        m = mask[t][:, None]
        if keep is not None:
            keep.append((h, z, r, c, s[:, 2 * n :], m))
        h = h + m * (1 - z) * (c - h)
        out[t] = h
    return out


def gru_states(w: np.ndarray, u: np.ndarray, x: np.ndarray, mask: np.ndarray, begin: int) -> np.ndarray:
    """The states of ``gru`` from step ``begin`` on, as (T, H, B): in place and with states in columns, which is faster where no gradient is asked."""
    n, wide = u.shape[0], x.shape[1]
    half = np.ones(3 * n, u.dtype)
    half[: 2 * n] = 0.5  # sigmoid(x) is tanh(x / 2) / 2 + 1 / 2
    table, turn = np.ascontiguousarray((w * half).T), np.ascontiguousarray((u * half).T)
    h, out = np.zeros((n, wide), u.dtype), np.empty((len(x) - begin, n, wide), u.dtype)
    a, s, whole = np.empty((3 * n, wide), u.dtype), np.empty((3 * n, wide), u.dtype), mask.all(1)
    for t in range(len(x)):
        np.take(table, x[t], axis=1, out=a)
        np.matmul(turn, h, out=s)
        zr, c, r = a[: 2 * n], a[2 * n :], a[n : 2 * n]
        zr += s[: 2 * n]
        np.tanh(zr, out=zr)
        r += 1
        s[2 * n :] *= r
        s[2 * n :] *= 0.5
        c += s[2 * n :]
        np.tanh(c, out=c)
        c -= h
        z = a[:n]
        np.subtract(1, z, out=z)
        z *= 0.5
        c *= z
        if not whole[t]:
            c *= mask[t]
        h += c
        if t >= begin:
            out[t - begin] = h
    return out


def gru_back(w: np.ndarray, u: np.ndarray, x: np.ndarray, keep: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of w and u."""
    dw, du, n = np.zeros_like(w), np.zeros_like(u), u.shape[0]
    dh = np.zeros_like(d_out[0])
    for t in range(len(x) - 1, -1, -1):
        h, z, r, c, s, m = keep[t]
        dh = dh + d_out[t]
        g = m * dh
        dc = g * (1 - z) * (1 - c * c)
        dz = -g * (c - h) * z * (1 - z)
        dr = dc * s * r * (1 - r)
        ds = np.concatenate([dz, dr, dc * r], 1)
        np.add.at(dw, x[t], np.concatenate([dz, dr, dc], 1))
        du += h.T @ ds
        dh = dh - g * (1 - z) + ds @ u.T
    return dw, du


def lstm(w: np.ndarray, u: np.ndarray, x: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (T, B, H) of a long short-term memory over symbols x (T, B)."""
    n = u.shape[0]
    h = c = np.zeros((x.shape[1], n), u.dtype)
    out = np.empty((len(x), x.shape[1], n), u.dtype)
    for t in range(len(x)):
        a = w[x[t]] + h @ u
        g = sigmoid(a[:, : 3 * n])
        i, f, o, q = g[:, :n], g[:, n : 2 * n], g[:, 2 * n :], np.tanh(a[:, 3 * n :])
        before, c = c, f * c + i * q
        e = np.tanh(c)
        if keep is not None:
            keep.append((h, before, i, f, o, q, e))
        h = o * e
        out[t] = h
    return out


def lstm_back(w: np.ndarray, u: np.ndarray, x: np.ndarray, keep: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    dw, du = np.zeros_like(w), np.zeros_like(u)
    dh = dc = np.zeros_like(d_out[0])
    for t in range(len(x) - 1, -1, -1):
        h, before, i, f, o, q, e = keep[t]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - e * e)
        da = np.concatenate([dc * q * i * (1 - i), dc * before * f * (1 - f), dh * e * o * (1 - o), dc * i * (1 - q * q)], 1)
        np.add.at(dw, x[t], da)
        du += h.T @ da
        dh, dc = da @ u.T, dc * f
    return dw, du


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m, self.v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        scale = min(1.0, 5.0 / (norm + 1e-9))
        fix = np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for p, g, m, v in zip(self.params, grads, self.m, self.v, strict=True):
            g = g * scale
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (self.rate * fix * m / (np.sqrt(v) + 1e-8)).astype(p.dtype)
