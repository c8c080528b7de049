"""Exact quantiles of groups of any size, without a buffer that grows with a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmend.functions.joins import broadcast_if, is_small
from gridmend.session import scratch_path


def exact_quantiles(
    cube: DataFrame,
    value_col: str,
    nodes: Sequence[float],
    by: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """The linearly interpolated quantiles of each group: ``by``, ``node`` (0-based), ``q``. Two actions.

    Values are counted, so copies of a value meet before they are shuffled. The counts are sorted by group and value
    over range partitions, in which a large group spreads over many, and written to the shared folder; one row per
    group and partition then says which ranks of the group lie there, and only the rows that hold a wanted rank go
    on. Missing values are left out, NaN counts as the largest value, and a group without values gives no rows.
    """
    spark, by = cube.sparkSession, list(by)
    if not nodes or not all(0 <= p <= 1 for p in nodes):
        raise ValueError("quantiles need positions between 0 and 1")
    groups = [F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)]
    keys = [f"_by_{i}" for i in range(len(by))]
    counts = cube.select(*groups, F.col(value_col).cast("double").alias("_v")).where("_v IS NOT NULL").groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "value-counts")
    ordered = counts.repartitionByRange(n, *keys, "_v").sortWithinPartitions(*keys, "_v").withColumn("_part", F.spark_partition_id())
    ordered.write.parquet(path)
    rows = spark.read.schema(ordered.schema).parquet(path)

    parts = rows.groupBy(*keys, "_part").agg(F.sum("_n").alias("_held"))
    of_group = Window.partitionBy(*keys)  # as many rows as a group has partitions
    before = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"_start": F.coalesce(F.sum("_held").over(before), F.lit(0)), "_size": F.sum("_held").over(of_group)})
    here = F.filter(_ranks(nodes, F.col("_size") - 1), lambda r: (r["rank"] >= F.col("_start")) & (r["rank"] < F.col("_start") + F.col("_held")))
    parts = parts.select(*[F.col(k).alias(f"_of{k}") for k in (*keys, "_part")], "_start", here.alias("_wanted")).where(F.size("_wanted") > 0)
    same = [F.col(k).eqNullSafe(F.col(f"_of{k}")) for k in (*keys, "_part")]
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    held = rows.withColumn("_upto", upto).join(broadcast_if(is_small(parts), parts), same)
    end = F.col("_start") + F.col("_upto")
    covered = F.filter("_wanted", lambda r: (r["rank"] < end) & (r["rank"] >= end - F.col("_n")))
    picked = held.select(*keys, "_v", F.explode(covered).alias("r"))
    ends = picked.groupBy(*keys, "r.node").agg(
        F.max(F.when(F.col("r.upper"), F.col("_v"))).alias("_high"), F.max(F.when(~F.col("r.upper"), F.col("_v"))).alias("_low"), F.max("r.share").alias("_share")
    )
    q = F.when(F.col("_share") == 0, F.col("_low")).otherwise(F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share"))
    return ends.select(*[F.col(k).alias(c) for k, c in zip(keys, by)], "node", q.alias("q"))


def _ranks(nodes: Sequence[float], last: Column) -> Column:
    """The two 0-based ranks around each node of a group whose highest rank is ``last``, and where between them it lies."""

    def pair(i: int, p: float) -> list[Column]:
        at = last * F.lit(float(p))
        low, share = F.floor(at), at - F.floor(at)

        def entry(rank: Column, upper: bool) -> Column:
            return F.struct(F.lit(i).alias("node"), rank.alias("rank"), share.alias("share"), F.lit(upper).alias("upper"))

        return [entry(low, False), entry(F.least(low + 1, last), True)]

    return F.array(*[e for i, p in enumerate(nodes) for e in pair(i, p)])
