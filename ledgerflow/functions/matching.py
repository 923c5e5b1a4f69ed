"""Similarity by matching blocks: twice the characters in common blocks over all characters.

The longest common block of two texts is found first (of equal ones the leftmost in the first text, then in
the second), then those on its left and on its right, and so on. Pairs of a batch advance together: a step
of the dynamic program over all open pieces at once, with arrays of characters.
"""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Second texts of this length have their commonest characters left out by the definition; such pairs are told one by one.
LONG = 200
#: Cells of a step of the dynamic program, at most.
CELLS = 1 << 20


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(flat characters, offsets) of texts."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return flat, np.append(0, np.cumsum([len(t) for t in texts]))


def _window(flat: np.ndarray, start: np.ndarray, end: np.ndarray, fill: int) -> np.ndarray:
    """The characters start[i] .. end[i] of all pieces as rows of one array, filled up behind their ends."""
    width = int((end - start).max())
    at = start[:, None] + np.arange(width)
    return np.where(at < end[:, None], flat[np.minimum(at, len(flat) - 1)], fill)


def _longest_blocks(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length of the longest common block of each row, and where it begins in a and in b."""
    rows = np.arange(len(a))
    size, end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    run = np.zeros((len(a), b.shape[1] + 1), np.int64)
    for i in range(a.shape[1]):
        run[:, 1:] = np.where(a[:, i : i + 1] == b, run[:, :-1] + 1, 0)
        at = run.argmax(1)
        better = run[rows, at] > size
        size[better], end_a[better], end_b[better] = run[rows, at][better], i + 1, at[better]
    return size, end_a - size, end_b - size


def ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """The similarity of each pair, 0 to 1; two empty texts are alike."""
    n_a, n_b = np.array([len(t) for t in a], np.int64), np.array([len(t) for t in b], np.int64)
    common = np.zeros(len(a), np.int64)
    flat_a, off_a = _codes(a)
    flat_b, off_b = _codes(b)
    short = np.flatnonzero((n_b < LONG) & (n_a > 0) & (n_b > 0))
    # pieces still to be looked at: their pair, and where they begin and end in either text
    pair, a0, a1, b0, b1 = short, off_a[short], off_a[short + 1], off_b[short], off_b[short + 1]
    while len(pair):
        cost = np.argsort((a1 - a0) * 1000 + (b1 - b0), kind="stable")  # pieces of like size side by side
        pair, a0, a1, b0, b1 = pair[cost], a0[cost], a1[cost], b0[cost], b1[cost]
        size, in_a, in_b = (np.zeros(len(pair), np.int64) for _ in range(3))
        step = max(1, CELLS // (int((b1 - b0).max()) + 1))
        for k in range(0, len(pair), step):
            s = slice(k, k + step)
            size[s], in_a[s], in_b[s] = _longest_blocks(_window(flat_a, a0[s], a1[s], -1), _window(flat_b, b0[s], b1[s], -2))
        np.add.at(common, pair, size)
        x, y = a0 + in_a, b0 + in_b
        pair, a0, a1, b0, b1 = (np.concatenate(z) for z in ((pair, pair), (a0, x + size), (x, a1), (b0, y + size), (y, b1)))
        left = (np.tile(size, 2) > 0) & (a1 > a0) & (b1 > b0)
        pair, a0, a1, b0, b1 = pair[left], a0[left], a1[left], b0[left], b1[left]
    out = np.where(n_a + n_b > 0, 2 * common / np.maximum(n_a + n_b, 1), 1.0)
    for i in np.flatnonzero(n_b >= LONG).tolist():
        out[i] = SequenceMatcher(None, a[i], b[i]).ratio()
    return out


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.full(len(a), np.nan)
    known = (a.notna() & b.notna()).to_numpy()
    out[known] = ratios(a[known].tolist(), b[known].tolist())
    return pd.Series(out).where(known)


def matching_ratio(a: Column, b: Column) -> Column:
    """Similarity of two texts by matching blocks; null if either is null. For pairs that have been blocked, not for all."""
    return _ratio(a, b)
