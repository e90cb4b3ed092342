"""Exact integer inner products of vectors, whatever the size of their components.

Components are floor(scale * x), x as a double. Products whose sums stay below 2**53 are taken in
doubles, below 2**63 in 64-bit integers, others in Python integers; a score beyond a long's range
counts as the nearest long, so every finite vector has a place in every order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F

LOW, HIGH = -(2**63) + 1, 2**63 - 1


def complete(vector: str) -> Column:
    """Whether a vector and all its components are there and finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~odd


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles; what no double can hold afterwards becomes Python integers."""
    with np.errstate(over="ignore"):
        out = np.floor(values * scale)
    if np.isfinite(out).all():
        return out
    return np.array([int(y) if np.isfinite(y) else int(x) * scale for x, y in zip(values.flat, out.flat, strict=True)],
                    object).reshape(values.shape)


def by_size(ids: pa.Array, lists: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, ids and the scaled component matrix of the rows of each vector length."""
    names = np.asarray(ids)
    sizes = np.asarray(pa.compute.list_value_length(lists)).astype(np.int64)
    flat = np.asarray(lists.flatten(), np.float64)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, names[rows], scaled(flat[starts[rows][:, None] + np.arange(size)], scale)


def _largest(rows: np.ndarray) -> np.ndarray:
    """Magnitude of each row's largest component, as doubles."""
    return np.abs(rows).max(axis=1, initial=0).astype(np.float64)


def _integers(rows: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in rows.flat], object).reshape(rows.shape)


def _exact(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    if not rows.size or not queries.size:
        return np.zeros((len(rows), len(queries)), np.int64)
    bound = float(_largest(rows).max()) * float(_largest(queries).max()) * rows.shape[1]
    if bound < 2**53:
        return (rows @ queries.T).astype(np.int64)
    if bound < 2**62:
        return rows.astype(np.int64) @ queries.T.astype(np.int64)
    return np.clip(_integers(rows) @ _integers(queries).T, LOW, HIGH).astype(np.int64)


def products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """``[row, query]`` inner products; rows and queries of large components are taken apart from the others."""
    size = rows.shape[1]
    high, asked = _largest(rows), _largest(queries)
    if high.max(initial=0) * asked.max(initial=0) * size < 2**53:
        return _exact(rows, queries)
    limit = np.sqrt(2**53 / max(size, 1))
    out = np.empty((len(rows), len(queries)), np.int64)
    for plain in (True, False):
        at = np.flatnonzero((high < limit) == plain)
        for usual in (True, False):
            to = np.flatnonzero((asked < limit) == usual)
            out[np.ix_(at, to)] = _exact(rows[at], queries[to])
    return out
