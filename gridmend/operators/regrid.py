"""Regridding between rectilinear lat/lon grids: a sparse product, done as joins and sums.

Both methods separate into a latitude and a longitude step, so the weights are two axis tables instead of
one entry per pair of cells. There is one shuffle. To a finer or similar grid, rows are shuffled on (time,
band of target latitudes) before weights multiply them: that moves each source row about once however many
target cells it reaches, both sums stay within their task, and a key holds no more rows than one band of
one time step. To a coarser grid, rows are weighted first and summed map-side, so that at best only target
values move.

The output has every target cell at every time step. Each step and band has one marker row besides its source rows,
placed on a line of its own (``FRAME``) that reaches all targets without a weight, so a target without any source
comes out missing within the group that its band has anyway.

An axis table has ``idx``, ``center`` and, for conservative regridding, the cell edges ``lo`` and ``hi``; its cells
do not overlap. Axes are matched by sorting their lines together, however many they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmend.functions.joins import BROADCAST_ROWS, broadcast_if, is_small, local_table, row_counts

FULL_CIRCLE = 360.0
BAND = 64  # target latitudes that share a shuffle key
FRAME = -1  # position of the marker rows
BILINEAR, CONSERVATIVE, CONSERVATIVE_NORMED = "bilinear", "conservative", "conservative_normed"


def axis_table(spark: SparkSession, centers: Sequence[float], edges: Sequence[float] | None = None) -> DataFrame:
    """Axis table of the given cell centres; edges default to the midpoints between them."""
    centers = [float(c) for c in centers]
    if edges is None:
        if len(centers) < 2:
            raise ValueError("an axis with a single cell needs its edges")
        middle = [(a + b) / 2 for a, b in zip(centers, centers[1:])]
        edges = [2 * centers[0] - middle[0], *middle, 2 * centers[-1] - middle[-1]]
    bounds = {
        "idx": range(len(centers)),
        "center": centers,
        "lo": [float(min(a, b)) for a, b in zip(edges, edges[1:])],
        "hi": [float(max(a, b)) for a, b in zip(edges, edges[1:])],
    }
    return local_table(spark, bounds, "idx int, center double, lo double, hi double")


def global_axis(spark: SparkSession, low: float, high: float, step: float) -> DataFrame:
    """Axis of equal cells of size ``step`` filling ``low..high``."""
    n = round((high - low) / step)
    return axis_table(
        spark, [low + step * (i + 0.5) for i in range(n)], [low + step * i for i in range(n + 1)]
    )


def add_cyclic(cube: DataFrame, dim: str, size: int | None = None) -> DataFrame:
    """Repeat the first slice of ``dim`` at its end, under the label it has. ``size`` is the axis length."""
    idx = f"{dim}_idx"
    if idx not in cube.columns:
        raise ValueError(f"the cube has no dimension {dim!r}")
    end = F.lit(size) if size is not None else cube.agg(F.max(idx) + 1).scalar()
    positions = F.when(F.col(idx) == 0, F.array(F.col(idx), end.cast(cube.schema[idx].dataType)))
    return cube.withColumn(idx, F.explode(F.coalesce(positions, F.array(F.col(idx)))))


def _turns(period: float) -> Column:
    """The shifts that put a copy of a periodic axis on either side of it."""
    return F.explode(F.array(F.lit(-period), F.lit(0.0), F.lit(period))).alias("by")


def bilinear_axis_weights(source: DataFrame, target: DataFrame, period: float | None = None) -> DataFrame:
    """``src``, ``dst``, ``label``, ``w``, ``parts``: the source points around every target centre.

    A target centre outside the source's hull gets one part without a weight, so its values come out
    missing; with a ``period`` there is no outside.
    """
    points = source.select("idx", "center")
    if period is not None:
        points = points.select("idx", "center", _turns(period)).select("idx", (F.col("center") + F.col("by")).alias("center"))
    lines = points.select(F.col("center").alias("at"), F.struct("center", "idx").alias("point"), F.lit(None).cast("int").alias("dst"))
    targets = target.select(F.col("center").alias("at"), F.lit(None).alias("point"), F.col("idx").alias("dst"))
    merged = lines.unionAll(targets.withColumn("point", F.col("point").cast(lines.schema["point"].dataType)))
    order = "OVER (ORDER BY at, dst NULLS FIRST)"  # axes, not data: one row per grid line
    around = merged.select(
        "at", "dst", F.expr(f"lag(point) IGNORE NULLS {order}").alias("p0"), F.expr(f"lead(point) IGNORE NULLS {order}").alias("p1")
    ).where("dst IS NOT NULL")
    fraction = (F.col("at") - F.col("p0.center")) / (F.col("p1.center") - F.col("p0.center"))

    def part(idx: str, weight: Column) -> Column:
        return F.struct(F.col(idx).cast("int").alias("src"), weight.cast("double").alias("w"))

    outside = F.lit(None)
    parts = (
        F.when(F.col("p0").isNull(), F.array(part("p1.idx", outside)))
        .when(F.col("p1").isNull(), F.array(part("p0.idx", F.when(F.col("at") == F.col("p0.center"), 1.0))))
        .when(fraction > 0, F.array(part("p0.idx", 1 - fraction), part("p1.idx", fraction)))
        .otherwise(F.array(part("p0.idx", F.lit(1.0))))
    )
    return around.select("dst", F.col("at").alias("label"), F.size(parts).alias("parts"), F.explode(parts).alias("p")).select(
        "p.src", "dst", "label", "p.w", "parts"
    )


def conservative_axis_weights(
    source: DataFrame,
    target: DataFrame,
    period: float | None = None,
    on_sphere: bool = False,
    renormalise: bool = False,
    small: bool = False,
) -> DataFrame:
    """``src``, ``dst``, ``label``, ``w``, ``parts``: the share of each target cell a source cell covers.

    ``on_sphere`` measures latitudes by their sine. Shares refer to the whole target cell, or with
    ``renormalise`` to its covered part. A target cell no source cell touches comes out missing.
    """

    def measure(x: Column) -> Column:
        return F.sin(F.radians(x)) if on_sphere else x

    cells = source.select("idx", "lo", "hi")
    if period is not None:
        cells = cells.select("idx", "lo", "hi", _turns(period)).select(
            "idx", (F.col("lo") + F.col("by")).alias("lo"), (F.col("hi") + F.col("by")).alias("hi")
        )
    place = F.row_number().over(Window.orderBy("lo")).alias("place")  # axes, not data: one row per grid line
    cells = cells.select(F.col("idx").alias("src"), F.col("lo").alias("s_lo"), F.col("hi").alias("s_hi"), place)
    wanted = target.select(F.col("idx").alias("dst"), F.col("center").alias("label"), "lo", "hi")
    lines = cells.select(F.col("s_lo").alias("at"), F.lit(1).alias("kind"), "place", F.lit(None).cast("int").alias("dst"))

    def edges(name: str, kind: int) -> DataFrame:
        return wanted.select(F.col(name).alias("at"), F.lit(kind).alias("kind"), F.lit(None).cast("int").alias("place"), "dst")

    # The last source cell that begins at or before the lower edge, and the last that begins before the upper one.
    merged = lines.unionAll(edges("lo", 2)).unionAll(edges("hi", 0))
    found = merged.select("dst", "kind", F.expr("last_value(place) IGNORE NULLS OVER (ORDER BY at, kind ROWS UNBOUNDED PRECEDING)").alias("place"))
    found = found.where("dst IS NOT NULL").groupBy("dst").agg(
        F.max(F.when(F.col("kind") == 2, F.col("place"))).alias("first"), F.max(F.when(F.col("kind") == 0, F.col("place"))).alias("last")
    )
    between = F.sequence(F.coalesce("first", F.lit(1)), F.coalesce("last", F.lit(1)))
    reached = F.when(F.coalesce("first", F.lit(1)) <= F.col("last"), between)
    wanted = wanted.join(broadcast_if(small, found), "dst").withColumn("place", F.explode_outer(reached))
    shared = measure(F.least("hi", "s_hi")) - measure(F.greatest("lo", "s_lo"))
    overlap = F.when(F.col("src").isNotNull(), shared)
    overlaps = (F.col("s_lo") < F.col("hi")) & (F.col("s_hi") > F.col("lo"))
    cells = cells.withColumnRenamed("place", "_place")
    shares = (
        wanted.join(broadcast_if(small, cells), (F.col("place") == F.col("_place")) & overlaps, "left")
        .groupBy("dst", "label", F.coalesce("src", F.lit(0)).alias("src"))
        .agg(F.sum(overlap / (measure(F.col("hi")) - measure(F.col("lo")))).alias("w"))
    )
    # A source beside a gap of the axis was reached without an overlap: no part of a target that has others.
    shares = shares.withColumn("_any", F.max("w").over(Window.partitionBy("dst"))).where("w IS NOT NULL OR _any IS NULL").drop("_any")
    per_target = Window.partitionBy("dst")
    if renormalise:
        shares = shares.withColumn("w", F.col("w") / F.sum("w").over(per_target))
    return shares.select(
        F.col("src").cast("int"), "dst", "label", "w", F.count("*").over(per_target).cast("int").alias("parts")
    )


def regrid(
    cube: DataFrame,
    source_axes: tuple[DataFrame, DataFrame],
    target_axes: tuple[DataFrame, DataFrame],
    value_cols: Sequence[str],
    method: str = BILINEAR,
    time_cols: Sequence[str] = ("date",),
    periodic_lon: bool = False,
    astype: str | None = None,
    time_steps: DataFrame | None = None,
) -> DataFrame:
    """Regrid to the (lat, lon) ``target_axes``: time columns, ``lat_idx``, ``lon_idx``, ``lat``, ``lon``, values.

    There is a row for every target cell at every step of ``time_steps``, the distinct ``time_cols`` (by default those of the
    cube, for which it is read once more). ``conservative`` shares refer to whole target cells, ``conservative_normed`` to their covered part. A
    target value is missing if any source value it needs is. Counts the axis tables (a small action): an
    axis has no more weights than three times its source and target points together, so axes small
    enough make their weights small enough to broadcast.
    """
    period = FULL_CIRCLE if periodic_lon else None
    (lat_from, lon_from), (lat_to, lon_to) = source_axes, target_axes
    sizes = row_counts(*source_axes, *target_axes)
    small = sum(sizes) <= BROADCAST_ROWS
    coarser = 2 * sizes[2] * sizes[3] <= sizes[0] * sizes[1]
    if method == BILINEAR:
        lat_w = bilinear_axis_weights(lat_from, lat_to)
        lon_w = bilinear_axis_weights(lon_from, lon_to, period)
    elif method in (CONSERVATIVE, CONSERVATIVE_NORMED):
        renormalise = method == CONSERVATIVE_NORMED
        lat_w = conservative_axis_weights(lat_from, lat_to, None, True, renormalise, small)
        lon_w = conservative_axis_weights(lon_from, lon_to, period, False, renormalise, small)
    else:
        raise ValueError(f"method must be {BILINEAR!r}, {CONSERVATIVE!r} or {CONSERVATIVE_NORMED!r}, got {method!r}")

    def named(weights: DataFrame, dim: str) -> DataFrame:
        target = F.col("dst").alias(f"_{dim}"), F.col("label").alias(dim)
        return weights.select(
            F.col("src").alias(f"{dim}_idx"), *target, F.col("w").alias(f"_w_{dim}"), F.col("parts").alias(f"_n_{dim}")
        )

    lat_w, lon_w = named(_with_frame(lat_w, lat_to), "lat"), named(_with_frame(lon_w, lon_to), "lon")
    rows = cube.select(*time_cols, "lat_idx", "lon_idx", *[F.col(v).cast("double").alias(v) for v in value_cols])
    steps = cube.select(*time_cols).distinct() if time_steps is None else time_steps.select(*time_cols)
    nothing = [F.lit(None).cast("double").alias(v) for v in value_cols]
    rows = rows.unionByName(steps.select(*time_cols, F.lit(FRAME).alias("lat_idx"), F.lit(FRAME).alias("lon_idx"), *nothing))
    if coarser:
        weighted = rows.join(broadcast_if(small, lat_w), "lat_idx").join(broadcast_if(small, lon_w), "lon_idx")
        weight, parts = F.col("_w_lat") * F.col("_w_lon"), F.col("_n_lat") * F.col("_n_lon")
        both = weighted.groupBy(*time_cols, "_lat", "lat", "_lon", "lon").agg(
            *[_weighted_sum(v, weight, parts) for v in value_cols]
        )
    else:
        lat_w = lat_w.withColumn("_band", F.floor(F.col("_lat") / BAND).cast("int"))
        reached = broadcast_if(small, lat_w.select("lat_idx", "_band").distinct())
        keys = [*time_cols, "_band"]
        by_lat = (
            rows.join(reached, "lat_idx")
            .repartition(*[F.col(k) for k in keys])
            .join(broadcast_if(small, lat_w), ["lat_idx", "_band"])
            .groupBy(*keys, "_lat", "lat", "lon_idx")
            .agg(*[_weighted_sum(v, F.col("_w_lat"), F.col("_n_lat")) for v in value_cols])
        )
        both = (
            by_lat.join(broadcast_if(small, lon_w), "lon_idx")
            .groupBy(*keys, "_lat", "lat", "_lon", "lon")
            .agg(*[_weighted_sum(v, F.col("_w_lon"), F.col("_n_lon")) for v in value_cols])
        )
    kinds = {v: astype or cube.schema[v].dataType for v in value_cols}
    return both.select(
        *time_cols, F.col("_lat").alias("lat_idx"), F.col("_lon").alias("lon_idx"), "lat", "lon",
        *[F.col(v).cast(kinds[v]).alias(v) for v in value_cols],
    )


def _with_frame(weights: DataFrame, target: DataFrame) -> DataFrame:
    """Axis weights, and the marker line's reach: every target, without a weight."""
    nothing = F.lit(None).cast("double").alias("w"), F.lit(None).cast("int").alias("parts")
    return weights.unionByName(target.select(F.lit(FRAME).alias("src"), F.col("idx").alias("dst"), F.col("center").alias("label"), *nothing))


def apply_weights(
    cube: DataFrame,
    weights: DataFrame,
    value_cols: Sequence[str],
    time_cols: Sequence[str] = ("date",),
    astype: str | None = None,
) -> DataFrame:
    """Sparse product with given weights (``src_cell``, ``dst_cell``, ``w``): time columns, ``dst_cell``, values.

    A target value is missing if any of its source values is. Counts the weights table (a small action).
    """
    return _product(cube, weights.select("src_cell", "dst_cell", "w"), value_cols, time_cols, astype, is_small(weights))


def apply_grid_weights(
    cube: DataFrame,
    weights: DataFrame,
    source_lons: int,
    target_axes: tuple[DataFrame, DataFrame],
    value_cols: Sequence[str],
    time_cols: Sequence[str] = ("date",),
    astype: str | None = None,
    first_cell: int = 0,
    time_steps: DataFrame | None = None,
) -> DataFrame:
    """Given weights on a cube with ``lat_idx`` and ``lon_idx``: the output has the positions and labels of ``target_axes``.

    Weights number the cells of either grid row by row from ``first_cell``, longitudes fastest; the source has
    ``source_lons`` of them in a row. Every target cell has a row at every step (see ``regrid``); one that the
    weights do not reach is missing, and a weight to a cell beyond the target grid raises.
    """
    lats, lons = row_counts(*target_axes)
    end = lats * lons + first_cell
    beyond = F.raise_error(F.lit("a weight leads to a cell beyond the target grid")).cast("bigint")
    inside = (F.col("dst_cell") >= first_cell) & (F.col("dst_cell") < end)
    given = weights.select(F.col("src_cell").cast("bigint"), F.when(inside, F.col("dst_cell").cast("bigint")).otherwise(beyond).alias("dst_cell"), "w")
    flat = (F.col("lat_idx") * source_lons + F.col("lon_idx") + first_cell).cast("bigint").alias("src_cell")
    steps = cube.select(*time_cols).distinct() if time_steps is None else time_steps.select(*time_cols)
    every = F.explode(F.sequence(F.lit(first_cell).cast("bigint"), F.lit(end - 1).cast("bigint"))).alias("dst_cell")
    frame = steps.repartition(*time_cols).select(*time_cols, every) if end > first_cell else None
    sums = _product(cube.select(*time_cols, flat, *value_cols), given, value_cols, time_cols, astype, is_small(weights), frame)
    at = F.col("dst_cell") - first_cell
    placed = sums.withColumns({"lat_idx": F.floor(at / lons).cast("int"), "lon_idx": (at % lons).cast("int")})
    for dim, axis, size in zip(("lat", "lon"), target_axes, (lats, lons)):
        labels = axis.select(F.col("idx").cast("int").alias(f"{dim}_idx"), F.col("center").alias(dim))
        placed = placed.join(broadcast_if(size <= BROADCAST_ROWS, labels), f"{dim}_idx")
    return placed.select(*time_cols, "lat_idx", "lon_idx", "lat", "lon", *value_cols)


def _product(cube, weights, value_cols, time_cols, astype, small: bool, frame: DataFrame | None = None) -> DataFrame:
    """The weighted sums, and a row without values for each row of ``frame`` that has none."""
    parts = F.count("*").over(Window.partitionBy("dst_cell")).alias("_parts")
    weighted = broadcast_if(small, weights.select("src_cell", "dst_cell", F.col("w").alias("_w"), parts))
    rows = cube.select(*time_cols, "src_cell", *[F.col(v).cast("double").alias(v) for v in value_cols]).join(weighted, "src_cell")
    rows = rows.select(*time_cols, "dst_cell", "_w", "_parts", *value_cols)
    if frame is not None:
        rows = rows.unionByName(frame, allowMissingColumns=True)
    sums = rows.groupBy(*time_cols, "dst_cell").agg(*[_weighted_sum(v, F.col("_w"), F.col("_parts")) for v in value_cols])
    return sums.select(*time_cols, "dst_cell", *[F.col(v).cast(astype or cube.schema[v].dataType).alias(v) for v in value_cols])


def _weighted_sum(value: str, weight: Column, parts: Column) -> Column:
    part = F.col(value) * weight
    return F.when(F.count(part) == F.max(parts), F.sum(part)).alias(value)
