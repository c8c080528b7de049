"""End-to-end jobs from stored cubes to stored cubes, one per user command.

Paths are whatever Spark's file systems read. A stored cube carries its attributes, axes and the roles of its
columns beside it (see ``sources.store``), so slices, time ranges, grids and the calendar come from there and a
cube is scanned once. The calendar is the attribute ``calendar`` of ``time``, else the one its days are on; data
that meet must be on the same. Keys of a cube are ``date`` and any of the columns in ``CELL_KEYS``, and what has the role of a
dimension or coordinate; every other numeric column is a variable. Slices are label slices with both ends
included, ``isel`` slices positional and half open; both take ``date`` (or ``time``) too.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from gridmend.functions import axes as ax
from gridmend.functions import nodes, timeaxis
from gridmend.functions.axes import TIME, TIME_ALIAS, Axes, Axis
from gridmend.functions.joins import local_table
from gridmend.operators import calendars, checks, clamps, qdm, qplad, slicing, units
from gridmend.operators import regrid as grids
from gridmend.sources import attrs as attributes
from gridmend.sources import store

CELL_KEYS = ("cell", "lat_idx", "lon_idx", "lat", "lon")
TIME_KEYS = ("date", "year", "day360", "time")
RANK_COLUMNS = ("sim_rank2", "sim_n")  # the exact rank behind sim_q, not a variable
LAYOUT = ("region_id", "chunk_lat", "chunk_lon", "chunk_date")

Slices = Mapping[str, tuple] | None


class Dataset(NamedTuple):
    cube: DataFrame
    attrs: DataFrame
    axes: Axes | None
    known_calendar: str | None  # None where its days are the same on both
    roles: Mapping[str, str]

    @property
    def calendar(self) -> str:
        return ax.common_calendar(self.known_calendar)

    @property
    def cells(self) -> list[str]:
        return [c for c in CELL_KEYS if c in self.cube.columns]

    @property
    def keys(self) -> list[str]:
        return [c for c in (*TIME_KEYS, *CELL_KEYS) if c in self.cube.columns]

    @property
    def variables(self) -> list[str]:
        keys = {*self.keys, *RANK_COLUMNS, *(n for n, role in self.roles.items() if role != slicing.VARIABLE)}
        return [f.name for f in self.cube.schema.fields if f.name not in keys and isinstance(f.dataType, NumericType)]

    @property
    def time_range(self) -> tuple | None:
        """First and last day, where the axes are stored."""
        return self.axes.time_range if self.axes else None

    def axis(self, dim: str) -> Axis:
        """An axis: as stored, else looked up in the cube (an action)."""
        if self.axes is not None and dim in self.axes.by_dim:
            return self.axes.by_dim[dim]
        return ax.collected(ax.axes_table(self.cube.select(*[c for c in (f"{dim}_idx", dim) if c in self.cube.columns])), self.cube.schema).by_dim[dim]

    def time_steps(self) -> DataFrame | None:
        """The steps of a stored time axis as a table."""
        if self.axes is None or self.axes.time is None or [k for k in self.keys if k in TIME_KEYS] != [TIME]:
            return None
        days = local_table(self.cube.sparkSession, {"day": [str(d) for d in self.axes.time.labels]}, "day string")
        return days.select(F.to_date("day").alias(TIME))


def open_dataset(spark: SparkSession, path: str, sel: Slices = None, isel: Slices = None) -> Dataset:
    cube = store.read_cube(spark, path).drop(*LAYOUT)
    attrs = store.read_cube_attrs(spark, path)
    axes = store.read_axes(spark, path, cube.schema)
    stated = attrs.filter((F.col("variable") == "time") & (F.col("key") == "calendar")).select("value").first()
    known = slicing.stored_axes(axes)
    if sel:
        lacking = {d: slicing.axis_of(cube, d) for d in sel if f"{d}_idx" in cube.columns and d not in known}
        cube = slicing.sel_slice(cube, sel, {**known, **lacking})
        axes = _sliced(axes, sel, positional=False)
    if isel:  # positions count in what the label slices left
        cube = slicing.isel_slice(cube, isel, slicing.stored_axes(axes))
        axes = _sliced(axes, isel, positional=True)
    calendar = ax.resolved_calendar(cube, axes, stated["value"] if stated else None)
    return Dataset(cube, attrs, axes, calendar, store.read_roles(spark, path))


def _sliced(axes: Axes | None, slices: Mapping[str, tuple], positional: bool) -> Axes | None:
    """The axes of what slices leave; lines of space keep their positions, time is counted anew."""
    if axes is None:
        return None
    by_dim = dict(axes.by_dim)
    for dim, (first, last) in slices.items():
        dim = TIME if dim == TIME_ALIAS else dim
        if (axis := by_dim.get(dim)) is None:
            continue
        if positional:
            kept = axis.pick(first, last)
        elif dim == TIME:
            first, last = timeaxis.label_bounds(first, last)
            kept = axis.cut(first or axis.labels[0], last or axis.labels[-1]) if axis.labels else axis
        else:
            low, high = axis.between(dim, first, last)
            lines = [(p, x) for p, x in zip(*axis) if low <= p <= high]
            kept = Axis(tuple(p for p, _ in lines), tuple(x for _, x in lines))
        by_dim[dim] = Axis(tuple(range(len(kept.labels))), kept.labels) if dim == TIME else kept
    return axes._replace(by_dim=by_dim)


def _save(
    cube: DataFrame, path: str, attrs: DataFrame, region_sizes: Mapping[str, int] | None = None, axes: Axes | None = None,
    roles: Mapping[str, str] | None = None,
) -> None:
    """Write a result. ``axes`` are given where it has those of its input, which saves finding them."""
    attrs = attributes.settled(attrs)
    if region_sizes:
        store.write_region(cube, path, region_sizes)
    else:
        store.write_cube(cube, path, attrs, axes=axes, roles=roles)


def _save_like(data: Dataset, cube: DataFrame, path: str, attrs: DataFrame | None = None) -> None:
    """Write a result that has the rows of its input."""
    _save(cube, path, data.attrs if attrs is None else attrs, axes=data.axes, roles=data.roles)


def _with_calendar(spark: SparkSession, attrs: DataFrame, calendar: str) -> DataFrame:
    return attributes.merge_attrs(attrs, attributes.attrs_table(spark, {"calendar": calendar}, "time"))


def _output_attrs(spark, dataset: Dataset, variables, root_attrs_file, new_attrs) -> DataFrame:
    """The simulation's attributes, root ones replaced by those in the file, ``new_attrs`` on top."""
    out = attributes.carry_attrs(dataset.attrs, ["time", *variables])
    if root_attrs_file:
        root = attributes.read_attrs(spark, root_attrs_file)
        out = out.filter(F.col("variable").isNotNull()).unionByName(root)
    return attributes.merge_attrs(out, attributes.attrs_table(spark, new_attrs)) if new_attrs else out


def prime_qdm_output_store(
    spark: SparkSession,
    simulation: str,
    variable: str,
    years: Iterable[int],
    out: str,
    region_sizes: Mapping[str, int],
    root_attrs_file: str | None = None,
    new_attrs: Mapping[str, str] | None = None,
    variable_dims: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Lay out the store that regional ``apply_qdm`` runs fill."""
    data = open_dataset(spark, simulation)
    store.prime_qdm_output(
        data.cube, variable, list(years), out, region_sizes, data.keys, data.attrs,
        attributes.read_attrs(spark, root_attrs_file) if root_attrs_file else None,
        attributes.attrs_table(spark, new_attrs) if new_attrs else None, variable_dims, data.axes,
    )


def prime_qplad_output_store(
    spark: SparkSession,
    simulation: str,
    variable: str,
    out: str,
    region_sizes: Mapping[str, int],
    root_attrs_file: str | None = None,
    new_attrs: Mapping[str, str] | None = None,
) -> None:
    """Lay out the store that regional ``apply_qplad`` runs fill."""
    data = open_dataset(spark, simulation)
    store.prime_qplad_output(
        data.cube, variable, out, region_sizes, data.keys, data.attrs,
        attributes.read_attrs(spark, root_attrs_file) if root_attrs_file else None,
        attributes.attrs_table(spark, new_attrs) if new_attrs else None, data.axes,
    )


def train_qdm(
    spark: SparkSession,
    historical: str,
    reference: str,
    out: str,
    variable: str,
    kind: str,
    sel_slice: Slices = None,
    isel_slice: Slices = None,
    quantiles_n: int = 100,
    window: int = 31,
) -> None:
    """Train quantile delta mapping (``kind`` additive or multiplicative) and store the model."""
    symbol = nodes.kind_symbol(kind)
    hist, ref = (open_dataset(spark, path, sel_slice, isel_slice) for path in (historical, reference))
    calendar = ax.common_calendar(hist.known_calendar, ref.known_calendar)
    model = qdm.train_qdm(
        ref.cube, hist.cube, variable, symbol, hist.cells, quantiles_n, window, calendar, ref.time_range, hist.time_range
    )
    _save(model, out, _model_attrs(spark, hist, variable, symbol, window, calendar))


def apply_qdm(
    spark: SparkSession,
    simulation: str,
    model: str,
    years: Iterable[int],
    variable: str,
    out: str,
    sel_slice: Slices = None,
    isel_slice: Slices = None,
    out_region_sizes: Mapping[str, int] | None = None,
    root_attrs_file: str | None = None,
    new_attrs: Mapping[str, str] | None = None,
    half_years: int = 10,
) -> None:
    """Adjust the ``years`` of a simulation; the output has ``variable`` and its quantiles ``sim_q``.

    ``out_region_sizes`` names the layout of a primed store to write into.
    """
    data, fitted = open_dataset(spark, simulation, sel_slice, isel_slice), open_dataset(spark, model)
    options = _model_options(fitted)
    adjusted = qdm.apply_qdm(
        data.cube, fitted.cube, variable, list(years), options["kind"], data.cells, half_years,
        int(options["window"]), _model_calendar(data, options), time_range=data.time_range,
    )
    attrs = _output_attrs(spark, data, [variable], root_attrs_file, new_attrs)
    attrs = units.units_to_cf(units.normalise_units(attrs, variable), variable)
    if out_region_sizes:
        adjusted = adjusted.drop(*RANK_COLUMNS).withColumn("sim_q", F.col("sim_q").cast(data.cube.schema[variable].dataType))
    _save(adjusted, out, attrs, out_region_sizes)


def train_qplad(
    spark: SparkSession,
    coarse_reference: str,
    fine_reference: str,
    out: str,
    variable: str,
    kind: str,
    sel_slice: Slices = None,
    isel_slice: Slices = None,
    quantiles_n: int = 620,
    window: int = 31,
) -> None:
    """Train analog downscaling from a coarse reference tiled onto the fine cells; store the model."""
    symbol = nodes.kind_symbol(kind)
    coarse, fine = (open_dataset(spark, path, sel_slice, isel_slice) for path in (coarse_reference, fine_reference))
    calendar = ax.common_calendar(coarse.known_calendar, fine.known_calendar)
    if coarse.time_range and fine.time_range:
        qplad.check_axes(coarse.axes.time.labels, fine.axes.time.labels, quantiles_n, window)
    else:
        qplad.check_qplad_inputs(coarse.cube, fine.cube, quantiles_n, window)
    model = qplad.train_qplad(
        coarse.cube, fine.cube, variable, symbol, fine.cells, quantiles_n, window, calendar, fine.time_range
    )
    _save(model, out, _model_attrs(spark, fine, variable, symbol, window, calendar))


def apply_qplad(
    spark: SparkSession,
    simulation: str,
    model: str,
    variable: str,
    out: str,
    sel_slice: Slices = None,
    isel_slice: Slices = None,
    out_region_sizes: Mapping[str, int] | None = None,
    root_attrs_file: str | None = None,
    new_attrs: Mapping[str, str] | None = None,
    wet_day_post_correction: bool = False,
) -> None:
    """Downscale adjusted data that carry ``sim_q``; the output has ``variable`` alone."""
    data, fitted = open_dataset(spark, simulation, sel_slice, isel_slice), open_dataset(spark, model)
    options = _model_options(fitted)
    calendar = _model_calendar(data, options)
    scaled = qplad.apply_qplad(data.cube, fitted.cube, variable, options["kind"], data.cells, calendar, wet_day_post_correction)
    attrs = _output_attrs(spark, data, [variable], root_attrs_file, new_attrs)
    _save(scaled.select(*data.keys, variable), out, attrs, out_region_sizes)


def get_attrs(spark: SparkSession, path: str, variable: str | None = None) -> str:
    """JSON text of a stored cube's attributes, or of one variable's."""
    return attributes.get_attrs(store.read_cube_attrs(spark, path), variable)


def rechunk(spark: SparkSession, path: str, target_chunks: Mapping[str, int], out: str) -> None:
    data = open_dataset(spark, path)
    store.rechunk(data.cube, target_chunks, out)
    store.write_attrs(data.attrs, out)
    if data.axes is not None:
        store.write_axes(store.axes_rows(spark, data.axes), out)


def regrid(
    spark: SparkSession,
    path: str,
    out: str,
    method: str,
    domain_axes: tuple[DataFrame, DataFrame],
    source_axes: tuple[DataFrame, DataFrame] | None = None,
    weights: DataFrame | None = None,
    astype: str | None = None,
    add_cyclic: str | None = None,
    keep_attrs: bool = True,
    first_cell: int = 0,
) -> None:
    """Regrid every variable to the domain's (lat, lon) axes, or by given weights.

    ``source_axes`` default to the cube's own cell centres (enough for bilinear). ``add_cyclic="lon"``
    closes the longitude circle. Weights number the cells of a lat/lon cube row by row from ``first_cell``, those
    of another cube as its column ``cell`` does. All time keys of the cube are kept; without ``keep_attrs`` the output has no
    attributes but its calendar.
    """
    data = open_dataset(spark, path)
    times = [k for k in data.keys if k in TIME_KEYS]
    steps = data.time_steps()
    if weights is not None and {"lat_idx", "lon_idx"} <= set(data.cube.columns):
        lons = data.axis("lon").positions[-1] + 1
        done = grids.apply_grid_weights(data.cube, weights, lons, domain_axes, data.variables, times, astype, first_cell, steps)
    elif weights is not None:
        cube = data.cube.withColumnRenamed("cell", "src_cell")
        done = grids.apply_weights(cube, weights, data.variables, times, astype).withColumnRenamed("dst_cell", "cell")
    else:
        if add_cyclic not in (None, "lon"):
            raise ValueError(f"only the longitude can be closed, not {add_cyclic!r}")
        own = source_axes or tuple(_axis_table(spark, data.axis(d)) for d in ("lat", "lon"))
        done = grids.regrid(
            data.cube, own, domain_axes, data.variables, method, times, periodic_lon=add_cyclic == "lon", astype=astype, time_steps=steps
        )
    attrs = data.attrs if keep_attrs else _with_calendar(spark, data.attrs.limit(0), data.calendar)
    _save(done, out, attrs)


def _axis_table(spark: SparkSession, axis: Axis) -> DataFrame:
    """A stored axis as regridding takes it."""
    return local_table(spark, {"idx": axis.positions, "center": [float(x) for x in axis.labels]}, "idx int, center double")


def clean_cmip6(spark: SparkSession, path: str, out: str, leapday_removal: bool = True, seed: int = 0) -> None:
    """Clean a raw model run: leftover dimensions and coordinates, precipitation units, calendar.

    A column ``height``, ``member_id`` or ``time_bnds`` stays if its stored role is that of a variable.
    """
    data = open_dataset(spark, path)
    variables = [v for v in data.variables if data.roles.get(v) == slicing.VARIABLE or v not in ("height", "member_id", "time_bnds")]
    in_units = {
        r["variable"]: r["value"] for r in data.attrs.filter(F.col("key") == "units").select("variable", "value").collect()
    }
    clean = calendars.standardize_gcm(
        data.cube, variables, data.calendar, data.cells, in_units, leapday_removal, seed, data.roles
    )
    attrs = data.attrs
    if "pr" in variables:
        attrs = attrs.filter(~F.col("variable").eqNullSafe("pr")).unionByName(
            attributes.attrs_table(spark, {"units": "mm day-1"}, "pr")
        )
    from_360 = data.calendar == timeaxis.DAY360
    calendar = timeaxis.NOLEAP if leapday_removal else timeaxis.STANDARD if from_360 else data.calendar
    if "time" in data.cube.columns and (from_360 or leapday_removal):  # now dates
        attrs = attrs.filter(~(F.col("variable").eqNullSafe("time") & F.col("key").isin("units")))
    _save(clean, out, _with_calendar(spark, attrs, calendar), roles={n: r for n, r in data.roles.items() if n in clean.columns})


def remove_leapdays(spark: SparkSession, path: str, out: str) -> None:
    data = open_dataset(spark, path)
    _save(calendars.remove_leap_days(data.cube), out, _with_calendar(spark, data.attrs, timeaxis.NOLEAP), roles=data.roles)


def correct_wet_day_frequency(
    spark: SparkSession, path: str, out: str, process: str, variable: str = "pr", seed: int = 0
) -> None:
    data = open_dataset(spark, path)
    _save_like(data, clamps.wet_day_frequency(data.cube, process, data.keys, variable, seed), out)


def apply_dtr_floor(spark: SparkSession, path: str, out: str, floor: float = 1.0) -> None:
    data = open_dataset(spark, path)
    _save_like(data, clamps.dtr_floor(data.cube, data.variables, floor), out)


def apply_non_polar_dtr_ceiling(spark: SparkSession, path: str, out: str, ceiling: float = 70.0) -> None:
    data = open_dataset(spark, path)
    _save_like(data, clamps.non_polar_dtr_ceiling(data.cube, data.variables, ceiling), out)


def adjust_maximum_precipitation(spark: SparkSession, path: str, out: str, threshold: float = 3000.0) -> None:
    data = open_dataset(spark, path)
    _save_like(data, clamps.precip_ceiling(data.cube, data.variables, threshold), out)


def validate(spark: SparkSession, path: str, variable: str, data_type: str, time_period: str) -> None:
    """Raise AssertionError unless the stored cube passes every check for ``variable``."""
    data = open_dataset(spark, path)
    steps = len(data.axes.time.labels) if data.axes and data.axes.time else None
    checks.validate(data.cube, variable, data_type, time_period, steps)


def _model_attrs(spark: SparkSession, data: Dataset, variable: str, symbol: str, window: int, calendar: str) -> DataFrame:
    """Attributes of a trained model: how it was fitted, and the units of its factors."""
    own = units.normalise_units(data.attrs.filter(F.col("variable") == variable), variable)
    fitted = {"kind": symbol, "window": str(window), "variable": variable, "calendar": calendar}
    return own.unionByName(attributes.attrs_table(spark, fitted))


def _model_calendar(data: Dataset, options: Mapping[str, str]) -> str:
    """The calendar of data a model is applied to, which must be the model's."""
    return ax.common_calendar(data.known_calendar, options.get("calendar"))


def _model_options(model: Dataset) -> dict[str, str]:
    rows = model.attrs.filter(F.col("variable").isNull()).select("key", "value").collect()
    return {r["key"]: r["value"] for r in rows}
