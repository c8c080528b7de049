"""Cubes on storage: partitioned Parquet, with attributes, axes and time-only variables beside it.

Below a cube's path, ``_attrs`` holds its attributes, ``_axes`` the labels and positions of its dimensions and
its calendar, ``_roles`` what its columns are where their names do not say, and ``_fixed`` the variables that do
not vary along the region dimensions. A primed store has no rows but ``_schema``, its columns in Parquet files without rows, and ``_regions``, the sizes its regions are cut
by; ``read_cube`` makes up the rows of regions that no job has written. Spark skips all of these when it reads
the cube itself.
"""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from gridmend.functions import axes as ax
from gridmend.functions.axes import CALENDAR, TIME, Axes, Axis
from gridmend.functions.joins import local_table
from gridmend.operators.slicing import ROLES, sel_slice
from gridmend.sources.attrs import ATTRS_SCHEMA, attrs_table, merge_attrs

AXES_SCHEMA = "dim string, idx int, label string"
ROLES_SCHEMA = "name string, role string"
FILL = "fill"  # metadata of a primed column: the value its empty rows have
ZERO = "zero"


def read_cube(spark: SparkSession, path: str, value_cols: Sequence[str] | None = None) -> DataFrame:
    """Open a cube. NaN becomes NULL in ``value_cols`` (by default every floating column), so that missing
    values compare, rank and aggregate as missing. A primed store has all its columns, whatever its files hold,
    and empty rows in the regions not written yet."""
    schema = primed_schema(spark, path)
    cube = spark.read.parquet(path) if schema is None else _primed_rows(spark, path, schema)
    floating = [f.name for f in cube.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return nan_to_null(cube, floating if value_cols is None else value_cols)


def _sidecar(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A table beside a cube; None if it is not there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_axes(table: DataFrame, path: str) -> None:
    """Store an axes table beside a cube."""
    table.select("dim", "idx", "label").coalesce(1).write.mode("overwrite").parquet(f"{path}/_axes")


def read_axes(spark: SparkSession, path: str, schema: StructType) -> Axes | None:
    """The axes stored beside a cube with this schema; None for a path without."""
    table = _sidecar(spark, f"{path}/_axes", AXES_SCHEMA)
    return None if table is None else ax.collected(table, schema)


def axes_rows(spark: SparkSession, axes: Axes) -> DataFrame:
    """The table of axes known on the driver."""
    lines = [(dim, i, None if label is i else str(label)) for dim, axis in axes.by_dim.items() for i, label in zip(*axis)]
    lines += [(CALENDAR, 0, axes.calendar)] if axes.calendar else []
    dims, positions, labels = zip(*lines) if lines else ((), (), ())
    return local_table(spark, {"dim": dims, "idx": positions, "label": labels}, AXES_SCHEMA)


def nan_to_null(cube: DataFrame, value_cols: Sequence[str]) -> DataFrame:
    return cube.withColumns({v: F.when(~F.isnan(v), F.col(v)) for v in value_cols})


def write_cube(
    cube: DataFrame,
    path: str,
    attrs: DataFrame | None = None,
    partition_by: Sequence[str] = (),
    axes: Axes | None = None,
    roles: Mapping[str, str] | None = None,
) -> None:
    """Write a whole cube, replacing what the path held, and its axes: those given, else found in what was written.

    ``roles`` tells of columns whose names do not whether they are a dimension, a coordinate or a variable.
    """
    cube.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    if attrs is not None:
        write_attrs(attrs, path)
    spark = cube.sparkSession
    if roles:
        write_roles(spark, roles, path)
    if axes is not None:
        write_axes(axes_rows(spark, axes), path)
    elif ax.dimensions(cube.columns):
        index_axes(spark, path, cube.schema)


def index_axes(spark: SparkSession, path: str, schema: StructType | None = None) -> None:
    """Find and store the axes of a cube that was written by other means: one scan of its key columns."""
    written = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    write_axes(ax.axes_table(written), path)


def write_roles(spark: SparkSession, roles: Mapping[str, str], path: str) -> None:
    """Store the roles of columns beside a cube."""
    if wrong := set(roles.values()) - set(ROLES):
        raise ValueError(f"a role is one of {ROLES}, not {sorted(wrong)}")
    table = local_table(spark, {"name": list(roles), "role": list(roles.values())}, ROLES_SCHEMA)
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/_roles")


def read_roles(spark: SparkSession, path: str) -> dict[str, str]:
    """The roles of columns stored beside a cube; a row per column it names."""
    table = _sidecar(spark, f"{path}/_roles", ROLES_SCHEMA)
    return {} if table is None else {r["name"]: r["role"] for r in table.collect()}


def write_attrs(attrs: DataFrame, path: str) -> None:
    attrs.write.mode("overwrite").parquet(f"{path}/_attrs")


def read_cube_attrs(spark: SparkSession, path: str) -> DataFrame:
    """The attributes written with a cube; empty if it has none."""
    found = _sidecar(spark, f"{path}/_attrs", ATTRS_SCHEMA)
    return attrs_table(spark, {}) if found is None else found


def primed_schema(spark: SparkSession, path: str) -> StructType | None:
    """The columns of a primed store without ``region_id``, its keys marked in their metadata; None for other paths."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(f"{path}/_schema").schema
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _add_to_schema(rows: DataFrame, path: str, key_cols: Sequence[str] = (), zero: Sequence[str] = ()) -> None:
    """Add columns to a primed store's schema, with what its readers must know of them. ``rows`` gives names and types."""

    def marked(name: str) -> Column:
        known = {"key": True} if name in key_cols else {FILL: ZERO} if name in zero else None
        return F.col(name).alias(name, metadata=known) if known else F.col(name)

    empty = rows.sparkSession.createDataFrame([], rows.schema)
    empty.select(*[marked(c) for c in rows.columns]).write.mode("append").parquet(f"{path}/_schema")


def region_sizes_of(spark: SparkSession, path: str) -> dict[str, int]:
    """The sizes a primed store's regions are cut by."""
    table = _sidecar(spark, f"{path}/_regions", "dim string, size int")
    return {} if table is None else {r["dim"]: r["size"] for r in table.orderBy("dim").collect()}


def _written_regions(cube: DataFrame) -> set[str]:
    """Regions that hold files, from the paths Spark lists anyway."""
    found = (re.search(r"/region_id=([^/]+)/", name) for name in cube.inputFiles())
    return {m.group(1) for m in found if m}


def _primed_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What jobs have written, and empty rows for the keys of all other regions.

    The keys are the product of the stored axes, as in an array, or the stored cells at every day where cells
    are no such product. A store written in full is its files alone.
    """
    whole = StructType([*schema.fields, StructField("region_id", StringType())])
    written = spark.read.schema(whole).parquet(path)
    sizes, axes = region_sizes_of(spark, path), read_axes(spark, path, schema)
    if not sizes or axes is None:
        return written
    done = _written_regions(written)
    per_dim = [{p // size for p in axes.by_dim[dim].positions} for dim, size in sizes.items()]
    if math.prod(len(steps) for steps in per_dim) <= len(done):
        return written
    empty = _empty_rows(spark, path, schema, sizes, axes)
    return written.unionByName(empty.where(~F.col("region_id").isin(sorted(done))) if done else empty)


def _axis_frame(spark: SparkSession, dim: str, axis: Axis, schema: StructType) -> DataFrame:
    """An axis as the columns it has in the cube."""
    table = local_table(spark, {"idx": axis.positions, "label": [str(x) for x in axis.labels]}, "idx int, label string")
    named = [F.col("idx").cast(schema[f"{dim}_idx"].dataType if f"{dim}_idx" in schema.names else "int").alias(f"{dim}_idx")]
    if dim in schema.names:
        named.append(F.col("label").cast(schema[dim].dataType).alias(dim))
    return table.select(*named)


def _empty_rows(spark: SparkSession, path: str, schema: StructType, sizes: Mapping[str, int], axes: Axes) -> DataFrame:
    keys = [f.name for f in schema.fields if f.metadata.get("key")]
    cell_keys = [k for k in keys if k not in (TIME, f"{TIME}_idx")]
    cell_types = StructType([schema[k] for k in cell_keys])
    rows = _sidecar(spark, f"{path}/_cells", cell_types)
    dims = [TIME] * (TIME in keys) if rows is not None else sorted(ax.dimensions(keys), key=lambda d: d == TIME)
    for dim in dims:
        lines = _axis_frame(spark, dim, axes.by_dim[dim], schema)
        rows = lines if rows is None else rows.crossJoin(F.broadcast(lines))  # axes, as many lines as the grid has
    rows = rows.withColumn("region_id", region_of(sizes))

    def column(field: StructField) -> Column:
        if field.name in keys:
            return F.col(field.name)
        return F.lit(0 if field.metadata.get(FILL) == ZERO else None).cast(field.dataType).alias(field.name)

    return rows.select(*[column(f) for f in schema.fields], "region_id")


def region_of(region_sizes: Mapping[str, int]) -> Column:
    """Label of the region a row belongs to: its position along each region dimension, in steps of size."""
    steps = [F.floor(F.col(f"{dim}_idx") / size).cast("string") for dim, size in region_sizes.items()]
    return F.concat_ws("_", *[F.concat(F.lit(f"{dim}"), s) for dim, s in zip(region_sizes, steps)])


def with_time_position(cube: DataFrame, axis: Axis, calendar: str) -> DataFrame:
    """Add ``date_idx``, the position on a stored time axis: by calendar arithmetic where it has no gaps, else by a
    lookup in the axis. Days beyond the axis get a position beyond it, or NULL."""
    if axis.is_gapless(calendar):
        return cube.withColumn("date_idx", ax.time_position(axis, calendar))
    lines = local_table(cube.sparkSession, {"idx": axis.positions, "label": [str(d) for d in axis.labels]}, "idx int, label string")
    lines = lines.select(F.col("idx").alias("date_idx"), F.to_date("label").alias(TIME))
    return cube.join(F.broadcast(lines), TIME, "left").select(*cube.columns, "date_idx")


def write_region(
    cube: DataFrame, path: str, region_sizes: Mapping[str, int], variable_dims: Mapping[str, Sequence[str]] | None = None
) -> None:
    """Replace the regions ``cube`` covers in a store laid out with the same ``region_sizes``.

    Variables that lack a region dimension (``variable_dims``) are dropped; other regions stay as they
    are. Regions are replaced whole, so ``cube`` must hold all rows of each one it touches; a retried or
    repeated write gives the same store. In a primed store, columns that ``cube`` lacks keep the values they
    have at its keys, columns that the store lacks are added to it, and rows must lie on its axes: they stay as
    they were primed. A region dimension ``date`` (or ``time``) counts the positions of that time axis. A store that was
    not primed has its axes found anew.
    """
    spark = cube.sparkSession
    region_sizes = {TIME if dim == ax.TIME_ALIAS else dim: size for dim, size in region_sizes.items()}
    rows = cube.drop(*fixed_variables(variable_dims, region_sizes))
    schema = primed_schema(spark, path)
    axes = read_axes(spark, path, schema) if schema is not None else None
    if TIME in region_sizes and "date_idx" not in rows.columns:
        if axes is None or axes.time is None:
            raise ValueError("regions along time need the time axis of a primed store")
        rows = with_time_position(rows, axes.time, ax.common_calendar(axes.calendar))
    rows = rows.withColumn("region_id", region_of(region_sizes))
    if schema is not None:
        rows = _with_all_columns(_on_axes(rows, axes), path, schema)
    rows = rows.hint("rebalance", "region_id")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("region_id").parquet(path)
    if schema is None:
        index_axes(spark, path)


def _on_axes(rows: DataFrame, axes: Axes | None) -> DataFrame:
    """The rows; reading one that lies off the store's axes fails."""
    inside = F.lit(True)
    for dim, axis in (axes.by_dim if axes else {}).items():
        name = TIME if dim == TIME else f"{dim}_idx"
        if name in rows.columns and axis.positions:
            low, high = (axis.labels[0], axis.labels[-1]) if dim == TIME else (axis.positions[0], axis.positions[-1])
            inside = inside & F.col(name).between(F.lit(low), F.lit(high))
    message = F.lit("a row lies off the axes of the store it is written to")
    region = F.when(F.coalesce(inside, F.lit(False)), F.col("region_id")).otherwise(F.raise_error(message).cast("string"))
    return rows.withColumn("region_id", region)


def _with_all_columns(rows: DataFrame, path: str, schema: StructType) -> DataFrame:
    """``rows`` with the store's columns and types, those they lack from the rows the store holds for their keys."""
    types = {f.name: f.dataType for f in schema.fields}
    keys = [f.name for f in schema.fields if f.metadata.get("key")]
    keys = [k for k in keys if f"{k}_idx" not in keys]  # the others only label positions
    if missing := [k for k in keys if k not in rows.columns]:
        raise ValueError(f"the rows of a region lack the store's keys {missing}")
    new = [c for c in rows.columns if c not in types and c not in ("region_id", "date_idx")]
    if new:
        _add_to_schema(rows.select(*new), path)
    rows = rows.withColumns({c: F.col(c).cast(types[c]) for c in rows.columns if c in types})
    lacking = [c for c in types if c not in rows.columns]
    if lacking:
        held = _primed_rows(rows.sparkSession, path, schema).select("region_id", *keys, *lacking)
        held = held.withColumnsRenamed({k: f"_held_{k}" for k in ("region_id", *keys)})
        same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in ("region_id", *keys)]
        rows = rows.join(held, same, "left").drop(*(f"_held_{k}" for k in ("region_id", *keys)))
    return rows.select(*types, *new, "region_id")


def fixed_variables(variable_dims: Mapping[str, Sequence[str]] | None, region_sizes: Mapping[str, int]) -> list[str]:
    """Variables that lack any of the region dimensions."""
    return [v for v, dims in (variable_dims or {}).items() if not set(region_sizes) <= set(dims)]


def prime_qdm_output(
    simulation: DataFrame,
    variable: str,
    years: Sequence[int],
    path: str,
    region_sizes: Mapping[str, int],
    key_cols: Sequence[str],
    attrs: DataFrame | None = None,
    root_attrs: DataFrame | None = None,
    new_attrs: DataFrame | None = None,
    variable_dims: Mapping[str, Sequence[str]] | None = None,
    axes: Axes | None = None,
) -> None:
    """Lay out a store for adjusted output that jobs then fill region by region.

    It has the simulation's days of ``min(years)..max(years)``, all its variables, empty as yet, and a
    zero ``sim_q`` of the variable's type. Variables that lack a region dimension are written in full. No other
    row is written: the store knows its columns, axes and regions. ``axes`` are the simulation's, where known;
    otherwise its key columns are scanned for them.
    """
    first, last = dt.date(min(years), 1, 1), dt.date(max(years), 12, 31)
    cut = sel_slice(simulation, {"date": (first, last)})
    primed = cut.withColumn("sim_q", F.lit(0).cast(simulation.schema[variable].dataType))
    known = axes.with_time(first, last) if axes is not None else None
    _prime(primed, path, region_sizes, key_cols, {"sim_q"}, variable_dims, known)
    _write_primed_attrs(path, attrs, root_attrs, new_attrs, None)


def prime_qplad_output(
    simulation: DataFrame,
    variable: str,
    path: str,
    region_sizes: Mapping[str, int],
    key_cols: Sequence[str],
    attrs: DataFrame | None = None,
    root_attrs: DataFrame | None = None,
    new_attrs: DataFrame | None = None,
    axes: Axes | None = None,
) -> None:
    """Lay out a store for downscaled output: the simulation's days and cells with ``variable`` alone, and no row (see ``prime_qdm_output``)."""
    _prime(simulation.select(*key_cols, variable), path, region_sizes, key_cols, set(), None, axes)
    _write_primed_attrs(path, attrs, root_attrs, new_attrs, variable)


def _prime(cube, path, region_sizes, key_cols, zero, variable_dims, axes: Axes | None) -> None:
    spark = cube.sparkSession
    region_sizes = {TIME if dim == ax.TIME_ALIAS else dim: size for dim, size in region_sizes.items()}
    fixed = fixed_variables(variable_dims, region_sizes)
    columns = cube.drop(*fixed)
    nothing = spark.createDataFrame([], StructType([*columns.schema.fields, StructField("region_id", StringType())]))
    nothing.write.mode("overwrite").partitionBy("region_id").parquet(path)
    _add_to_schema(columns, path, key_cols, zero)
    if axes is None:
        write_axes(ax.axes_table(cube.select(*key_cols)), path)
    else:
        write_axes(axes_rows(spark, axes), path)
    local_table(spark, {"dim": list(region_sizes), "size": list(region_sizes.values())}, "dim string, size int").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/_regions")
    labelled = {f"{d}_idx" for d in ax.dimensions(key_cols)} | set(ax.dimensions(key_cols))
    if not set(key_cols) <= labelled:  # cells that are no product of axes
        cube.select(*[k for k in key_cols if k != TIME]).distinct().write.mode("overwrite").parquet(f"{path}/_cells")
    for name in fixed:
        dims = [d if d == "date" else f"{d}_idx" for d in variable_dims[name]]
        cube.select(*dims, name).distinct().write.mode("overwrite").parquet(f"{path}/_fixed/{name}")


def _write_primed_attrs(path, attrs, root_attrs, new_attrs, variable) -> None:
    """Root attributes are ``root_attrs`` if given, else the simulation's; ``new_attrs`` come on top."""
    sets = [a for a in (attrs, root_attrs, new_attrs) if a is not None]
    if not sets:
        return
    own = attrs if attrs is not None else sets[0].limit(0)
    of_variables = own.filter(F.col("variable").isNotNull() & (F.col("variable") != "sim_q"))
    if variable is not None:
        of_variables = of_variables.filter(F.col("variable") == variable)
    root = (root_attrs if root_attrs is not None else own).filter(F.col("variable").isNull())
    root = merge_attrs(root, new_attrs) if new_attrs is not None else root
    write_attrs(of_variables.unionByName(root.select(*of_variables.columns)), path)


def rechunk(cube: DataFrame, target_chunks: Mapping[str, int], path: str) -> None:
    """Rewrite a cube chunk by chunk; values stay as they are.

    The rebalancing shuffle gathers each chunk and splits one that outgrows a task. ``target_chunks`` maps
    dimensions to sizes along their ``_idx`` columns; dimensions it does not name are not cut.
    """
    chunks = {f"chunk_{dim}": F.floor(F.col(f"{dim}_idx") / size).cast("int") for dim, size in target_chunks.items()}
    laid_out = cube.withColumns(chunks).hint("rebalance", *chunks)
    laid_out.write.mode("overwrite").partitionBy(*chunks).parquet(path)
