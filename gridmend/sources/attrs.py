"""Attributes of a dataset and its variables, as a table.

One row per attribute: ``variable`` (NULL for the dataset itself), ``pos`` (order), ``key``, ``value``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmend.functions.joins import local_table

ATTRS_SCHEMA = "variable string, pos int, key string, value string"


def attrs_table(spark: SparkSession, attrs: Mapping[str, str], variable: str | None = None) -> DataFrame:
    n = len(attrs)
    columns = {"variable": [variable] * n, "pos": range(n), "key": list(attrs), "value": [str(v) for v in attrs.values()]}
    return local_table(spark, columns, ATTRS_SCHEMA)


def settled(attrs: DataFrame) -> DataFrame:
    """The same attributes, computed now. They are the metadata of one dataset; computing them before its
    values brings up a bad one, such as an unknown unit, before the long job."""
    rows = attrs.select("variable", "pos", "key", "value").collect()
    columns = {name: [r[name] for r in rows] for name in ("variable", "pos", "key", "value")}
    return local_table(attrs.sparkSession, columns, ATTRS_SCHEMA)


def read_attrs(spark: SparkSession, path: str) -> DataFrame:
    """Root attributes from a file holding one JSON object, in the file's order."""
    text = spark.read.text(path, wholetext=True)
    pairs = text.select(F.posexplode(F.from_json("value", "map<string,string>")).alias("pos", "key", "value"))
    return pairs.select(F.lit(None).cast("string").alias("variable"), "pos", "key", "value")


def get_attrs(attrs: DataFrame, variable: str | None = None) -> str:
    """JSON text of the attributes of ``variable``, or of the dataset. An action on the attributes table."""
    mine = F.col("variable").isNull() if variable is None else F.col("variable") == variable
    rows = attrs.filter(mine).orderBy("pos").select("key", "value").collect()
    return json.dumps({r["key"]: r["value"] for r in rows})


def attrs_json(attrs: DataFrame) -> DataFrame:
    """The JSON text of every variable's attributes: ``variable``, ``attrs``."""

    def quoted(text: Column) -> Column:
        in_list = F.to_json(F.array(text))
        return F.substring(in_list, F.lit(2), F.length(in_list) - 2)

    pair = F.concat(quoted(F.col("key")), F.lit(": "), quoted(F.col("value")))
    ordered = F.sort_array(F.collect_list(F.struct("pos", pair.alias("pair"))))
    body = F.array_join(F.transform(ordered, lambda p: p["pair"]), ", ")
    return attrs.groupBy("variable").agg(F.concat(F.lit("{"), body, F.lit("}")).alias("attrs"))


def merge_attrs(base: DataFrame, *overrides: DataFrame) -> DataFrame:
    """``base`` with the attributes of each override set in turn: a known key keeps its place, a new one
    goes to the end."""
    merged = base.select("variable", "pos", "key", "value", F.lit(0).alias("_rank"))
    for rank, override in enumerate(overrides, start=1):
        merged = merged.unionByName(override.select("variable", "pos", "key", "value", F.lit(rank).alias("_rank")))
    latest = F.max_by("value", F.struct("_rank", "pos")).alias("value")
    order = F.min(F.struct("_rank", "pos")).alias("_order")
    by_place = Window.partitionBy("variable").orderBy("_order")
    return (
        merged.groupBy("variable", "key")
        .agg(latest, order)
        .select("variable", (F.row_number().over(by_place) - 1).alias("pos"), "key", "value")
    )


def carry_attrs(simulation: DataFrame, variables: Sequence[str], blank: Sequence[str] = ("sim_q",)) -> DataFrame:
    """Attributes an adjusted dataset takes from its simulation: those of the dataset and of the
    variables it shares, without the ``blank`` ones."""
    kept = [v for v in variables if v not in blank]
    return simulation.filter(F.col("variable").isNull() | F.col("variable").isin(kept))
