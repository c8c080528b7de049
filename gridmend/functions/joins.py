"""Small driver-side tables and broadcasting behind a size check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000


def local_table(spark: SparkSession, columns: Mapping[str, Sequence], schema: str) -> DataFrame:
    """A table of driver-side values (axes, attributes, unit names) as a local relation of known size."""
    kinds = {"int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    types = dict(field.strip().split() for field in schema.split(","))
    return spark.createDataFrame(pa.table({name: pa.array(columns[name], kinds[types[name]]) for name in types}))


def row_counts(*tables: DataFrame, max_rows: int = BROADCAST_ROWS) -> list[int]:
    """Rows of each table, counted no further than ``max_rows + 1``. An action, one job, so give it axis or
    weight tables, not cubes."""
    rows = [t.limit(max_rows + 1).select(F.lit(i).alias("i")) for i, t in enumerate(tables)]
    found = {r["i"]: r["count"] for r in reduce(DataFrame.unionAll, rows).groupBy("i").count().collect()}
    return [found.get(i, 0) for i in range(len(tables))]


def is_small(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``max_rows`` rows (see ``row_counts``)."""
    return row_counts(table, max_rows=max_rows)[0] <= max_rows


def broadcast_if(small: bool, df: DataFrame) -> DataFrame:
    """Mark ``df`` for broadcast where its size has been checked; otherwise the join shuffles it."""
    return F.broadcast(df) if small else df
