"""Vector rows and joins back to them, shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from prefweave.llm.tables import need

HOT_KEYS = 1000


def floored(embeddings: DataFrame, scale: int, *keep: str) -> DataFrame:
    """``keep`` and ``x``, the components as long ``floor(scale * c)``, of the
    rows whose vector holds only finite components. What lies beyond the long
    range becomes its nearest end."""
    rows = need(embeddings, *keep, "embedding").withColumn("embedding", F.col("embedding").cast("array<double>"))
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("embedding").isNotNull() & finite).select(
        *keep, F.transform("embedding", lambda c: F.floor(c * scale).cast("bigint")).alias("x"))


def by_width(column: pa.Array | pa.ChunkedArray):
    """(width, rows, matrix) of every vector length in an Arrow list column."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = whole.offsets.to_numpy()
    values, sizes = whole.values.to_numpy(zero_copy_only=False), np.diff(offsets)
    for width in np.unique(sizes):
        rows = np.flatnonzero(sizes == width)
        yield int(width), rows, values[offsets[rows][:, None] + np.arange(width)]


def ints(*arrays: np.ndarray, bound) -> tuple[np.ndarray, ...]:
    """The integer arrays, as Python integers if ``bound(largest magnitude)``
    does not fit in 62 bits: sums and products stay exact either way."""
    most = max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)
    return tuple(a.astype(object) for a in arrays) if bound(most) >= 1 << 62 else arrays


def joined_back(rows: DataFrame, per_key: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with the columns of ``per_key``, which has one row for every key
    of theirs and in ``count`` how many rows have it. The keys that more than
    one in ``HOT_KEYS`` rows have are fewer than ``HOT_KEYS``, whatever the
    input: those few are broadcast, so that no task gets a hot key's rows; the
    others meet by a shuffle."""
    total = per_key.agg(F.sum(count)).first()[0] or 0
    often: Column = F.col(count) * HOT_KEYS > total
    hot = per_key.where(often).drop(count)
    return rows.join(F.broadcast(hot), key).unionByName(
        rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(per_key.where(~often).drop(count), key))
