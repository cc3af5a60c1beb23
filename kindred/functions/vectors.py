"""Vector expressions, inside the JVM where the name does not say otherwise."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that :func:`numpy_cosine` multiplies at a time.
ROWS_AT_ONCE = 1024


def _doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(_doubles(a), F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalise(a: Column) -> Column:
    """Unit vector; a zero vector stays zero.

    The length is bound once per row as a lambda variable; written inside the
    inner lambda it would be computed again for every element.
    """
    length = F.array(F.when(norm(a) == 0, 1.0).otherwise(norm(a)))
    return F.get(F.transform(length, lambda n: F.transform(_doubles(a), lambda x: x / n)), F.lit(0))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector is zero."""
    scale = norm(a) * norm(b)
    return F.when(scale == 0, 0.0).otherwise(dot(a, b) / scale)


def _sums(rows: np.ndarray) -> np.ndarray:
    """Row sums, added up one after the other as :func:`dot` does."""
    return rows.cumsum(axis=1)[:, -1] if rows.shape[1] else np.zeros(len(rows))


def _cosines(a: pa.Array, b: pa.Array) -> pa.Array:
    sizes = [np.asarray(pc.fill_null(pc.list_value_length(v), -1)) for v in (a, b)]
    flat = [pc.list_flatten(v) for v in (a, b)]
    if flat[0].null_count or flat[1].null_count or any(len(np.unique(s)) > 1 or -1 in s for s in sizes) or (sizes[0] != sizes[1]).any():
        return pa.array([_cosine(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())
    x, y = (v.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(a), -1) for v in flat)
    scale = np.sqrt(_sums(x * x)) * np.sqrt(_sums(y * y))
    return pa.array(np.divide(_sums(x * y), scale, out=np.zeros(len(a)), where=scale != 0), pa.float64())


def _cosine(a: list | None, b: list | None) -> float | None:
    """One row of :func:`cosine`: unknown entries leave the result unknown, lengths that differ too unless one is zero."""
    if a is None or b is None or None in a or None in b:
        return None
    if len(a) != len(b):
        norms = [np.sqrt(_sums(np.array([v], dtype=float) ** 2))[0] for v in (a, b)]
        return 0.0 if norms[0] * norms[1] == 0 else None
    return _cosines(pa.array([a], pa.list_(pa.float64())), pa.array([b], pa.list_(pa.float64())))[0].as_py()


@F.arrow_udf(T.DoubleType())
def numpy_cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    """:func:`cosine` of many rows at once, in numpy; the JVM takes a boxed step per entry."""
    parts = [_cosines(a.slice(i, ROWS_AT_ONCE), b.slice(i, ROWS_AT_ONCE)) for i in range(0, len(a), ROWS_AT_ONCE)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.float64())


def blend(stat: Column, text: Column, alpha: float) -> Column:
    """``[alpha * unit(stat), (1 - alpha) * unit(text)]`` as one array."""
    if not 0.0 <= alpha <= 1.0:
        raise ValueError(f"alpha must be in [0, 1], got {alpha}")
    return F.concat(
        F.transform(l2_normalise(stat), lambda x: x * F.lit(alpha)),
        F.transform(l2_normalise(text), lambda x: x * F.lit(1.0 - alpha)),
    )
