"""Logistic regression on few features."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 40, least: float | None = None,
                 intercept: bool = True) -> np.ndarray:
    """Intercept (0 if there is none) and weights, by Newton steps; weights below ``least`` are set to it and held there."""
    rows = np.hstack([np.ones((len(x), 1)) * intercept, x])
    weights = np.zeros(rows.shape[1])
    held = np.zeros(rows.shape[1], bool)
    if not intercept:
        held[0] = True

    def sums(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        return rows.T @ (chance - y), (rows * (chance * (1 - chance))[:, None]).T @ rows

    return newton(sums, weights, held, np.full(rows.shape[1], penalty), rounds, least)


def newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], weights: np.ndarray, held: np.ndarray, ridge: np.ndarray,
           rounds: int, least: float | None = None) -> np.ndarray:
    """Newton steps on the slope and curve of a loss over all rows, which ``sums`` gives for any weights."""
    for _ in range(rounds):
        slope, curve = sums(weights)
        slope = slope + ridge * weights
        curve = curve + np.diag(ridge + 1e-9)
        free = ~held
        step = np.zeros_like(weights)
        step[free] = np.linalg.solve(curve[np.ix_(free, free)], slope[free])
        weights = weights - np.clip(step, -2, 2)
        if least is not None:
            low = weights < least
            low[0] = False
            weights[low] = least
            held |= low
        if np.abs(step).max() < 1e-6:
            break
    return weights


def probability(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
