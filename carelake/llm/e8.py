"""Decoding to the E8 lattice, in doubled coordinates so that all are integers."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest points of integer coordinates with an even sum."""
    r = np.rint(x)
    odd = (r.sum(axis=1).astype(np.int64) & 1).astype(bool)
    if odd.any():
        rows = np.flatnonzero(odd)
        gap = x[rows] - r[rows]
        worst = np.abs(gap).argmax(axis=1)
        step = np.where(gap[np.arange(len(rows)), worst] >= 0, 1.0, -1.0)
        r[rows, worst] += step
    return r


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points of `x` (rows of 8), doubled: the better of D8 and D8 + 1/2."""
    whole = _nearest_d8(x)
    half = _nearest_d8(x - 0.5) + 0.5
    better = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.rint(2 * np.where(better[:, None], half, whole)).astype(np.int64)


def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled."""
    pairs = []
    for i, j in combinations(range(8), 2):
        for a, b in product((2, -2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            pairs.append(v)
    halves = [v for v in product((1, -1), repeat=8) if v.count(-1) % 2 == 0]
    return np.array(pairs + halves, dtype=np.int64)


def nearest_cells(x: np.ndarray, probes: int) -> np.ndarray:
    """rows x (1 + probes) x 8: each row's cell, then the neighbouring cells nearest to it."""
    home = decode(x)
    if not probes:
        return home[:, None, :]
    steps = neighbours()
    gap = 2 * x - home
    # |gap - s|^2 = |gap|^2 - 2 gap.s + |s|^2, and all steps are equally long
    closest = np.argsort(-(gap @ steps.T), axis=1, kind="stable")[:, :probes]
    return np.concatenate([home[:, None, :], home[:, None, :] + steps[closest]], axis=1)
