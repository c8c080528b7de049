"""Vectors as rows: which take part, samples to fit an index on, and blocks of arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Whether a vector is there, not zero, and holds neither NULL nor infinite nor undefined components."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def sample(vectors: DataFrame, rows: int, column: str = "embedding") -> np.ndarray:
    """At most ``rows`` vectors, chosen by hash, on the driver; those of the most frequent dimension. An action."""
    picked = vectors.select(column, F.xxhash64(column).alias("h")).distinct().orderBy("h").limit(rows)
    found = [r[0] for r in picked.select(F.col(column).cast("array<double>")).collect()]
    if not found:
        return np.zeros((0, 1))
    dims = np.bincount([len(v) for v in found])
    return np.array([v for v in found if len(v) == dims.argmax()])


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column whose vectors all have one length, as an array of doubles."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), -1)
