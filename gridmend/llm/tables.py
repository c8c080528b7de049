"""Intermediate tables, global numbering and connected components, shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridmend.session import scratch_path
from gridmend.shipping import ship

#: Edges of a contracted graph that one task may finish, and rows of a table of rounds that are worth a task.
LAST_EDGES, TASK_ROWS = 20_000, 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder the cluster shares and read back: computed once, its lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`saved`, with the path, so that the table can be removed once its successor is written."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more, through Spark's own file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Intermediate tables by name. Saving under a name again removes the table that had it, once the new one is written."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        table, path = saved_at(df, name)
        old, self.paths[name] = self.paths.get(name), path
        if old:
            remove(self.spark, old)
        return table

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more, and let Spark's cleaner find the shuffles behind them."""
        for name in names:
            if path := self.paths.pop(name, None):
                remove(self.spark, path)
        self.spark._jvm.System.gc()  # the cleaner drops the shuffle files of plans that were collected


@contextmanager
def small_batches(spark: SparkSession, most: str = "8m") -> Iterator[None]:
    """Arrow batches of at most so many bytes for the jobs run meanwhile, on either side of the Python workers' pipes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``position``, gapless from 0 in the order of ``by``. An action.

    A range shuffle sorts, every partition counts its own rows, and only one count per partition is summed
    up, so no task sees more than its range. Rows equal in all of ``by`` are numbered in any order: give
    enough columns to tell rows apart that must not be exchanged (and to spread a frequent first key).
    """
    spark = df.sparkSession
    ordered = df.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
    local = ordered.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    local = saved(local, name)
    counts = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition of the shuffle
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = local.join(F.broadcast(starts), "_part")
    return placed.withColumn("position", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def hex_bits(column: Column, digits: int = 15) -> Column:
    """The first ``digits`` hexadecimal digits of a column's MD5 as a non-negative long; DuckDB computes the same."""
    return F.conv(F.substring(F.md5(column), 1, digits), 16, 10).cast("long")


def for_rows(df: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """``df``, of at most about ``rows`` rows, in no more partitions than these fill: a round of a few rows is not hundreds of tasks and files."""
    return df.coalesce(max(1, -(-rows // each)))


def connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number connected with each of ``n`` by the edges (a, b)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, before[b])
        np.minimum.at(label, b, before[a])
        label = label[label]
        if (label == before).all():
            return label


def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of a graph of at most ``LAST_EDGES`` edges (node, other)."""
    table = pa.Table.from_batches([*batches], pa.schema([("node", pa.int64()), ("other", pa.int64())]))
    nodes, at = np.unique(np.concatenate([table["node"].to_numpy(), table["other"].to_numpy()]), return_inverse=True)
    label = connected(len(nodes), at[: len(table)], at[len(table) :])
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["node", "component"])


def components(edges: DataFrame, name: str, scratch: Scratch | None = None) -> DataFrame:
    """(node, component) of every node of ``edges`` (a long, b long), component being its smallest node. Actions.

    In each round every node goes to the smallest of itself and its neighbours, and the edges go along: what they join then
    is a graph of the nodes gone to, fewer each round, connected where the one before was. When at most ``LAST_EDGES`` edges
    are left, one task finishes them; then the rounds are followed from the last to the first. Their tables are removed; the
    result stays in ``scratch`` as ``name``-labels.
    """
    scratch = Scratch(edges.sparkSession) if scratch is None else scratch
    ship(edges.sparkSession)
    ways = [F.struct(F.col(a).cast("long").alias("node"), F.col(b).cast("long").alias("other")) for a, b in ("ab", "ba")]
    both = edges.where("a != b").select(F.inline(F.array(*ways))).distinct()  # edges are read once for both ways
    both, rounds = scratch.saved(both, f"{name}-edges"), []
    first = left = both.count()
    while left > LAST_EDGES:
        least = both.groupBy("node").agg(F.least("node", F.min("other")).alias("component"))
        rounds.append(scratch.saved(for_rows(least, left), f"{name}-round{len(rounds)}"))
        gone = rounds[-1].select(F.col("node").alias("other"), F.col("component").alias("far"))
        moved = both.join(rounds[-1], "node").join(gone, "other").where("component != far")
        moved = moved.select(F.col("component").alias("node"), F.col("far").alias("other")).distinct()
        both = scratch.saved(for_rows(moved, left), f"{name}-edges")
        left = both.count()
    labels = both.coalesce(1).mapInArrow(finished, "node long, component long")
    names = [f"{name}-round{i}" for i in range(len(rounds))]
    while rounds:
        later = labels.withColumnRenamed("node", "next").withColumnRenamed("component", "last")
        labels = rounds.pop().withColumnRenamed("component", "next").join(later, "next", "left").select("node", F.coalesce("last", "next").alias("component"))
    labels = scratch.saved(for_rows(labels, first), f"{name}-labels")
    del both
    scratch.drop(f"{name}-edges", *names)
    return labels
