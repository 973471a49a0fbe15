"""Sums over all pairs of two sets of numbers, from sums over each set alone.

A smooth function of a difference is a polynomial, to about 1e-12, while either number stays
in a cell of width ``WIDTH``. So a number counts as weights on the ``NODES`` Chebyshev nodes
of its cell, weights of many numbers add up, and pairs of nodes stand for all pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

WIDTH = 4.0
NODES = 24
#: Nodes paired at a time.
BLOCK = 1024

ORDERS = np.arange(NODES)
ANGLES = np.pi * (ORDERS + 0.5) / NODES
TO_NODES = np.cos(ORDERS[:, None] * ANGLES) * np.where(ORDERS == 0, 1, 2)[:, None] / NODES


def cells(values: np.ndarray) -> np.ndarray:
    return np.floor(values / WIDTH).astype(np.int64)


def nodes(cell: np.ndarray) -> np.ndarray:
    """The nodes of each cell, one row per cell."""
    return (np.asarray(cell)[:, None] + 0.5 + np.cos(ANGLES) / 2) * WIDTH


def spread(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each value and its weights on the nodes there."""
    cell = cells(values)
    place = np.clip(2 * (values / WIDTH - cell) - 1, -1, 1)
    return cell, np.cos(np.arccos(place)[:, None] * ORDERS) @ TO_NODES


def paired(
    function: Callable[[np.ndarray], np.ndarray], places: np.ndarray, weights: np.ndarray
) -> np.ndarray:
    """At each place, the sum of ``function(other - place)`` over all places, weighted."""
    out = np.zeros((len(places), *weights.shape[1:]))
    for first in range(0, len(places), BLOCK):
        own = slice(first, first + BLOCK)
        out[own] = function(places[None, :] - places[own, None]) @ weights
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(x / 2)


def sigmoid_slope(x: np.ndarray) -> np.ndarray:
    return 0.25 / np.cosh(np.clip(x / 2, -350, 350)) ** 2


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)
