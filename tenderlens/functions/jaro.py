"""Jaro distance over Arrow batches.

Distance = 1 - (m/|a| + m/|b| + (m - t)/m) / 3 with m matching characters inside the usual
window and t half the number of matched characters out of order, rounded down. No prefix bonus.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ship this module's functions inside the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _codes(texts: np.ndarray, lengths: np.ndarray, pad: int) -> np.ndarray:
    """Code points, one row per text, padded to a common width."""
    width = max(int(lengths.max(initial=0)), 1)
    joined = "".join(texts)
    flat = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    out = np.full((len(texts), width), pad, dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


_CELLS = 1 << 21


def jaro_distances(left: pd.Series, right: pd.Series) -> pd.Series:
    """Distances in slices of texts of like length, so that one long text does not widen all others."""
    width = np.maximum(left.str.len().fillna(0).to_numpy(), right.str.len().fillna(0).to_numpy()).astype(np.int64) + 1
    order = np.argsort(width, kind="stable")
    out, at = np.empty(len(order)), 0
    while at < len(order):
        # as many rows as keep rows * widest text within bounds, at least one
        room = np.arange(1, len(order) - at + 1) * width[order[at:]] <= _CELLS
        end = at + max(1, int(room.sum()))
        part = order[at:end]
        out[part] = _distances(left.iloc[part], right.iloc[part])
        at = end
    return pd.Series(out)


def _distances(left: pd.Series, right: pd.Series) -> pd.Series:
    missing = (left.isna() | right.isna()).to_numpy()
    a_text = left.fillna("").to_numpy(dtype=object)
    b_text = right.fillna("").to_numpy(dtype=object)
    if not len(a_text):
        return pd.Series([], dtype="float64")
    la = np.fromiter((len(s) for s in a_text), dtype=np.int64, count=len(a_text))
    lb = np.fromiter((len(s) for s in b_text), dtype=np.int64, count=len(b_text))
    a, b = _codes(a_text, la, -1), _codes(b_text, lb, -2)
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)[:, None]
    columns = np.arange(b.shape[1])[None, :]
    rows = np.arange(len(a))
    a_hit = np.zeros(a.shape, dtype=bool)
    b_hit = np.zeros(b.shape, dtype=bool)
    for i in range(a.shape[1]):
        same = (b == a[:, i : i + 1]) & ~b_hit & (np.abs(columns - i) <= window)
        first = same.argmax(axis=1)
        found = same[rows, first]
        a_hit[found, i] = True
        b_hit[rows[found], first[found]] = True
    m = a_hit.sum(axis=1)
    width = int(m.max(initial=0))
    if width:
        a_seq = np.take_along_axis(a, np.argsort(~a_hit, axis=1, kind="stable")[:, :width], axis=1)
        b_seq = np.take_along_axis(b, np.argsort(~b_hit, axis=1, kind="stable")[:, :width], axis=1)
        used = np.arange(width)[None, :] < m[:, None]
        t = ((a_seq != b_seq) & used).sum(axis=1) // 2
    else:
        t = np.zeros(len(a))
    with np.errstate(divide="ignore", invalid="ignore"):
        similarity = (m / la + m / lb + (m - t) / m) / 3.0
    similarity = np.where(m > 0, similarity, 0.0)
    similarity = np.where((la == 0) & (lb == 0), 1.0, similarity)
    return pd.Series(np.where(missing, np.nan, 1.0 - similarity))


@F.pandas_udf(T.DoubleType())
def _jaro_udf(left: pd.Series, right: pd.Series) -> pd.Series:
    return jaro_distances(left, right)


def jaro_distance(left, right):
    """Jaro distance column, NULL when either text is NULL."""
    return _jaro_udf(left, right)


def _bound(left: pd.Series, right: pd.Series) -> np.ndarray:
    """Largest similarity that the texts' character counts allow: counts in 64 classes of code points never fall short of
    the characters that can match."""
    counts = []
    for texts in (left, right):
        lengths = texts.str.len().to_numpy(dtype=np.int64)
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32) & 63
        row = np.repeat(np.arange(len(texts)), lengths)
        counts.append((lengths, np.bincount(row * 64 + codes, minlength=64 * len(texts)).reshape(-1, 64)))
    (n, a), (k, b) = counts
    m = np.minimum(a, b).sum(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.where(m > 0, (m / n + m / k + 1) / 3, 0.0)
    return np.where((n == 0) & (k == 0), 1.0, out)


def jaro_within(left, right, max_dist: float):
    """Jaro distance column; NULL when it is surely above ``max_dist`` or a text is NULL."""

    @F.pandas_udf(T.DoubleType())
    def within(a: pd.Series, b: pd.Series) -> pd.Series:
        out = pd.Series(np.full(len(a), np.nan))
        whole = np.flatnonzero((a.notna() & b.notna()).to_numpy())
        if len(whole):
            a, b = a.iloc[whole], b.iloc[whole]
            near = _bound(a, b) >= 1 - max_dist - 1e-9
            if near.any():
                out.iloc[whole[near]] = jaro_distances(a[near].reset_index(drop=True), b[near].reset_index(drop=True)).to_numpy()
        return out.where(out.notna(), None)

    return within(left, right)
