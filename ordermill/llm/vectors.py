"""Integer vectors out of a table of float vectors, shared by the vector operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONGS = 1 << 63
ROWS = 8192                      # rows that a task holds as matrices at a time


def is_sound(vec_col: str) -> Column:
    """True for a vector whose components are all there and finite."""
    x = F.col(vec_col)
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double"))
                    & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    return x.isNotNull() & F.coalesce(fine, F.lit(False))


def integer_vectors(vectors: DataFrame, scale: int, id_col: str, vec_col: str,
                    extra: dict | None = None) -> tuple[DataFrame, int, int]:
    """(rows, dimension, bound): vec_id, x = floor(scale * component) as longs,
    and ``extra`` columns (new name: column), of the sound rows only.

    The dimension is that of the longest vector; shorter ones count as padded
    with zeros.  No component is larger than the bound, which must fit a long:
    one that does not is an error, never a wrong number."""
    rows = vectors.where(is_sound(vec_col)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("c"),
        *[F.col(c).alias(new) for new, c in (extra or {}).items()])
    size, most = rows.agg(
        F.max(F.size("c")), F.max(F.array_max(F.transform("c", lambda e: F.abs(e.cast("double")))))).first()
    bound = int((most or 0.0) * scale) + 1
    if bound >= LONGS:
        raise ValueError(f"a vector component times {scale} does not fit a long")
    x = F.transform("c", lambda e: F.floor(e.cast("double") * scale).cast("long"))
    return rows.select("vec_id", x.alias("x"), *(extra or {})), size or 0, bound


def matrix(lists, dims: int) -> np.ndarray:
    """Rows of an Arrow list column as an integer matrix, shorter ones padded with zeros."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    if (size == dims).all():
        return flat.reshape(len(size), dims)
    out = np.zeros((len(size), dims), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def slices(batches):
    """Record batches of at most ROWS rows."""
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            yield b.slice(lo, ROWS)
