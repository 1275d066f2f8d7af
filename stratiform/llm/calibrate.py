"""Isotonic calibration from binned counts: bounded work on the driver, whatever the number of rows."""

from __future__ import annotations

import numpy as np


def isotonic(centers: np.ndarray, positives: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators over bins in order; points (x, probability) for linear interpolation."""
    blocks: list[list[float]] = []  # weighted x, positives, total
    for x, p, n in zip(centers, positives, totals):
        if n <= 0:
            continue
        blocks.append([x * n, p, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    if not blocks:
        return np.array([0.0]), np.array([0.5])
    b = np.array(blocks)
    # half a row of doubt keeps the ends off 0 and 1, so order within them survives
    return b[:, 0] / b[:, 2], (b[:, 1] + 0.25) / (b[:, 2] + 0.5)


def calibrated(x: np.ndarray, points: tuple[np.ndarray, np.ndarray], slope: float = 1e-4) -> np.ndarray:
    """Interpolated probability, strictly increasing in x also beyond the ends, within (0, 1)."""
    xs, ps = points
    p = np.interp(x, xs, ps)
    beyond = np.where(x < xs[0], x - xs[0], np.where(x > xs[-1], x - xs[-1], 0.0))
    p = p + np.where(beyond < 0, p, 1 - p) * np.tanh(beyond * 0.5)
    return np.clip(p * (1 - slope) + slope / (1 + np.exp(-np.clip(x, -30, 30))), 0.0, 1.0)
