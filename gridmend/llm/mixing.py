"""Mixing sources to target weights by hash thresholds, in SQL functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridmend.functions.joins import broadcast_if, is_small
from gridmend.llm.tables import hex_bits, saved

#: White space that separates words: space and the five controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, LEVEL_BITS = 60, 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: Sequence[float], most: float = 3.0) -> DataFrame:
    """(source, source_size, weight, target) of (source, size).

    Weights repeat over the sources in code-point order, NULL last. The targets share the total size by
    weight; none is above ``most`` times its source's size, and what is cut there is shared again. That
    ends where every uncapped source gets the same amount per weight, so the capped ones are those first
    in the order of cap / weight, and one window over the sources finds how many.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    capped = by_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    shared = capped.withColumns({
        "per_weight": (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward),
    })
    # The first source that its share does not lift above its cap ends the capped ones.
    level = F.min(F.when(F.col("cap") >= F.col("per_weight") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "per_weight")))
    level = level.over(every).getField("per_weight")
    return shared.select("source", "source_size", "weight", F.least("cap", F.coalesce(level, F.lit(0.0)) * F.col("weight")).alias("target"))


def thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold): rows of a source with ``hash < threshold`` hold about ``budget`` of its size.

    Nested histograms: sizes are summed by source and leading hash bits, the bucket in which the running
    sum crosses the budget is found, and only its rows are split by the next bits. After the last level
    that bucket is one hash value; its rows are taken if that brings the sum nearer to the budget.
    """
    small = is_small(budgets)
    edge = budgets.select("source", F.lit(0).cast("long").alias("prefix"), F.col("budget").alias("rest"))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = sizes.join(
            broadcast_if(small, edge.withColumnRenamed("source", "_source")),
            F.col("source").eqNullSafe(F.col("_source")) & (F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix")),
        )
        buckets = inside.groupBy("source", "rest", F.shiftright("hash", shift).alias("prefix")).agg(F.sum("size").alias("bucket_size"))
        running = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
        crossed = buckets.withColumn("upto", F.sum("bucket_size").over(running)).where("upto > rest")
        first = crossed.groupBy("source").agg(F.min_by(F.struct("prefix", "rest", "upto", "bucket_size"), "prefix").alias("b"))
        rest = F.col("b.rest") - (F.col("b.upto") - F.col("b.bucket_size"))
        edge = first.select("source", F.col("b.prefix").alias("prefix"), rest.alias("rest"), F.col("b.bucket_size").alias("bucket_size"))
    nearer = F.col("bucket_size") - F.col("rest") < F.col("rest")
    return edge.select("source", (F.col("prefix") + nearer.cast("long")).alias("threshold"))


def mix(documents: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``document`` (a struct of the columns ``keep``), size, source_size, target and taken of every document. Actions.

    ``taken`` are the words the mix takes, repeats counted. A source's target is met by whole repeats of all
    its documents and, for the rest, by those whose hash (of doc_id and size) is below the source's threshold; so a
    document is taken at most ``most`` times, and a rerun takes the same. NULL or empty texts have size 0, NULL sources
    are one source, equal rows are taken together, and an empty table gives an empty mix. Other columns are ignored.
    """
    size, id_text = word_count(F.col("text")), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    sized = documents.select(F.struct(*keep).alias("document"), "source", size.alias("size"), id_text.alias("_id"))
    sized = saved(sized.withColumn("hash", hex_bits(F.concat_ws(":", "_id", "size"))).drop("_id"), "mix-sizes")
    wanted = saved(targets(sized, weights, most), "mix-targets")
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budgets = wanted.withColumn("repeats", repeats).withColumn("budget", F.col("target") - F.col("repeats") * F.col("source_size"))
    edges = saved(thresholds(sized.select("source", "size", "hash"), budgets).withColumnRenamed("source", "_edge"), "mix-edges")
    per_source = budgets.join(edges, F.col("source").eqNullSafe(F.col("_edge")), "left").drop("_edge")
    per_source = per_source.select(F.col("source").alias("_source"), "source_size", "target", "repeats", "threshold")
    placed = sized.join(broadcast_if(is_small(wanted), per_source), F.col("source").eqNullSafe(F.col("_source")))
    extra = F.coalesce(F.col("hash") < F.col("threshold"), F.lit(False)).cast("long")
    return placed.select("document", "size", "source_size", "target", (F.col("size") * (F.col("repeats") + extra)).alias("taken"))


#: The same mix in DuckDB, by sorting: a hash value is taken if the sum up to it is within the budget or
#: its rows bring the sum nearer.
MIX_SQL = r"""
WITH sized AS (
  SELECT *, ('0x' || md5(COALESCE(CAST(doc_id AS VARCHAR), 'null') || ':' || size)[1:15])::BIGINT AS hash
  FROM (SELECT *, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {documents})),
src AS (
  SELECT source, SUM(size)::BIGINT AS source_size, SUM(size)::DOUBLE * 3.0 AS cap,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
shared AS (
  SELECT *, (SUM(source_size) OVER () - COALESCE(SUM(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / SUM(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS per_weight
  FROM src WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
lev AS (SELECT arg_min(per_weight, cap / weight) AS level FROM shared WHERE cap >= per_weight * weight),
wanted AS (
  SELECT source, source_size, LEAST(cap, COALESCE((SELECT level FROM lev), 0.0) * weight) AS target FROM shared),
budgets AS (
  SELECT *, target - repeats * source_size AS budget
  FROM (SELECT *, (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END)::BIGINT AS repeats FROM wanted)),
by_hash AS (
  SELECT source, hash, SUM(size)::BIGINT AS here, SUM(SUM(size)) OVER (PARTITION BY source ORDER BY hash)::BIGINT AS upto
  FROM sized GROUP BY source, hash),
edge AS (
  SELECT b.source, MIN(h.hash) + MIN(CASE WHEN h.here - (b.budget - (h.upto - h.here)) < b.budget - (h.upto - h.here) THEN 1 ELSE 0 END) AS threshold
  FROM budgets b JOIN by_hash h ON h.source IS NOT DISTINCT FROM b.source
  WHERE h.upto > b.budget
    AND h.hash = (SELECT MIN(x.hash) FROM by_hash x WHERE x.source IS NOT DISTINCT FROM b.source AND x.upto > b.budget)
  GROUP BY b.source),
mixed AS (
  SELECT s.*, b.source_size, b.target, b.repeats + CASE WHEN s.hash < e.threshold THEN 1 ELSE 0 END AS copies
  FROM sized s JOIN budgets b ON b.source IS NOT DISTINCT FROM s.source
  LEFT JOIN edge e ON e.source IS NOT DISTINCT FROM s.source)
"""
