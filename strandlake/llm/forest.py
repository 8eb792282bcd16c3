"""Spanning forests of the links that one task finds, so that it hands on no more edges than nodes."""

from __future__ import annotations

import numpy as np


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node of the pairs to the smallest node of its component."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b, label = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[far], nodes[label[far]]
