"""Exact quantiles and nearest nodes against numpy and plain search."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmend.functions import nodes
from gridmend.operators.quantiles import exact_quantiles


def plainly(values, positions):
    return [float(np.quantile(values, p)) for p in positions]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_groups_of_every_size(spark, partitions):
    """A group with most of the rows, one value repeated, single values, a NULL group, missing values."""
    rnd = random.Random(1)
    rows = [("hot", round(rnd.gauss(0, 1), 3)) for _ in range(4000)] + [("same", 2.5)] * 50 + [("one", -1.0), (None, 3.0), (None, 4.0), ("none", None), ("two", 1.0), ("two", None), ("two", 2.0)]
    rnd.shuffle(rows)
    positions = [0.0, 0.013, 0.25, 0.5, 1 / 3, 0.999, 1.0]
    table = spark.createDataFrame(rows, "node string, v double").repartition(5)
    found = {}
    for r in exact_quantiles(table.withColumnRenamed("node", "q"), "v", positions, ["q"], partitions).toDF("g", "node", "value").collect():
        found.setdefault(r["g"], {})[r["node"]] = r["value"]
    groups = {g: [v for h, v in rows if h == g and v is not None] for g in {g for g, _ in rows}}
    assert found.keys() == {g for g, values in groups.items() if values}
    for g, by_node in found.items():
        assert [by_node[i] for i in range(len(positions))] == pytest.approx(plainly(groups[g], positions), abs=1e-12)


def test_without_groups_and_without_rows(spark):
    table = spark.range(1001).select(F.col("id").cast("float").alias("v"))
    assert [r["q"] for r in exact_quantiles(table, "v", [0.1, 0.9]).orderBy("node").collect()] == [100.0, 900.0]
    assert exact_quantiles(table.limit(0), "v", [0.5]).count() == 0
    with pytest.raises(ValueError):
        exact_quantiles(table, "v", [1.5])


def test_no_buffer_grows_with_a_group(spark):
    out = exact_quantiles(spark.range(100).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("v")), "v", [0.5], ["g"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "percentile" not in plan and "collect" not in plan


def test_nearest_of_uneven_nodes(spark):
    rnd = random.Random(2)
    for n in (1, 2, 3, 5, 8, 100):
        positions = sorted(rnd.random() ** 3 for _ in range(n))
        middle = [(a + b) / 2 for a, b in zip(positions, positions[1:])]
        qs = [-1.0, 0.0, 1.0, 2.0, *positions, *middle, *(rnd.random() for _ in range(50))]
        table = spark.createDataFrame([(i, q) for i, q in enumerate(qs)] + [(-1, None)], "i int, q double")
        column = F.array(*[F.lit(p) for p in positions])
        found = {r["i"]: r["node"] for r in table.select("i", nodes.nearest_node_uneven(F.col("q"), column).alias("node")).collect()}
        assert found.pop(-1) is None
        for i, q in enumerate(qs):
            assert math.isclose(abs(positions[found[i]] - q), min(abs(p - q) for p in positions))
            assert found[i] == min(range(n), key=lambda j: (abs(positions[j] - q), j))
    empty = spark.createDataFrame([(0.5, [])], "q double, nodes array<double>")
    assert empty.select(nodes.nearest_node_uneven(F.col("q"), F.col("nodes")).alias("node")).first()["node"] is None
