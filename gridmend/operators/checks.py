"""Validation: every check is an aggregate by year; violations are rows, and a raising wrapper sits on top."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Fixed values: (time period, is raw model output) -> fewest days allowed, most days without a warning.
TIMESTEP_LIMITS = {
    ("future", True): (35040, 35405),
    ("future", False): (31025, 31390),
    ("historical", True): (27740, 27740),
    ("historical", False): (23725, 23725),
}
RAW_MODEL = "cmip6"
CHECKS_OF = {
    "tasmin": ("temp_range",),
    "tasmax": ("temp_range",),
    "dtr": ("dtr_range", "negative"),
    "pr": ("negative", "max_precip"),
}


def check_variable_name(cube: DataFrame, name: str) -> None:
    """Raise AssertionError unless ``name`` is a numeric column."""
    if name not in cube.columns or not isinstance(cube.schema[name].dataType, NumericType):
        raise AssertionError(f"{name} is not a numeric variable of the dataset")


def timestep_counts(cube: DataFrame, data_type: str, time_period: str) -> DataFrame:
    """One row: ``n_steps``, the limits, and ``status`` ok, excess or missing. Unknown periods are ok."""
    few, many = TIMESTEP_LIMITS.get((time_period, data_type == RAW_MODEL), (None, None))
    n = F.col("n_steps")
    status = F.when(n < F.lit(few), "missing").when(n > F.lit(many), "excess").otherwise("ok")
    return (
        cube.select("date")
        .distinct()
        .agg(F.count("*").alias("n_steps"))
        .select(
            "n_steps",
            F.lit(few).cast("int").alias("min_steps"),
            F.lit(many).cast("int").alias("warn_above"),
            status.alias("status"),
        )
    )


def check_timesteps(cube: DataFrame, data_type: str, time_period: str, n_steps: int | None = None) -> None:
    """Raise AssertionError on too few days, warn on too many. An action over the ``date`` column unless ``n_steps`` is known from a stored axis."""
    few, many = TIMESTEP_LIMITS.get((time_period, data_type == RAW_MODEL), (None, None))
    if few is None:
        return
    n = cube.select("date").distinct().count() if n_steps is None else n_steps
    if n < few:
        raise AssertionError(f"{time_period} {data_type} data are missing time steps, have {n}")
    if n > many:
        warnings.warn(f"{time_period} {data_type} data have excess time steps: {n}", stacklevel=2)


def yearly_metrics(cube: DataFrame, variable: str, lat_col: str | None = "lat") -> DataFrame:
    """What the checks need, per year, in one aggregation with partial sums."""
    v = F.col(variable)
    metrics = [
        F.count_if(v.isNull()).alias("n_missing"),
        F.min(v).cast("double").alias("lowest"),
        F.max(v).cast("double").alias("highest"),
        F.count_if(v < -0.001).alias("n_negative"),
        F.count_if(v > 3000).alias("n_over_3000"),
    ]
    if lat_col is not None and lat_col in cube.columns:
        lat = F.col(lat_col)
        metrics += [
            F.max(F.when(lat < -60, v)).cast("double").alias("max_south"),
            F.max(F.when(lat > 60, v)).cast("double").alias("max_north"),
            F.max(F.when((lat > -60) & (lat < 60), v)).cast("double").alias("max_between"),
        ]
    return cube.groupBy(F.year("date").alias("year")).agg(*metrics)


def _rule(name: str, failed: Column, observed: Column, limit: str) -> Column:
    return F.when(
        failed, F.struct(F.lit(name).alias("rule"), observed.cast("double").alias("observed"), F.lit(limit).alias("bound"))
    )


def _rules(check: str, data_type: str, allow_empty_band: bool) -> list[Column]:
    """Each rule is a violation where it fails and missing where it holds. A comparison with a missing
    extreme fails the strict rules, as it does for data without a single value."""

    def unless(holds: Column) -> Column:
        return ~F.coalesce(holds, F.lit(False))

    low, high = F.col("lowest"), F.col("highest")
    if check == "no_missing":
        return [_rule("no_missing", F.col("n_missing") > 0, F.col("n_missing"), "no missing values")]
    if check == "temp_range":
        return [
            _rule("temp_range_min", unless(low > 130), low, "min > 130"),
            _rule("temp_range_max", unless(high < 377), high, "max < 377"),
        ]
    if check == "dtr_range":
        raw = data_type == RAW_MODEL
        floor = _rule("dtr_min", unless(low >= 0 if raw else low > 0), low, "min >= 0" if raw else "min > 0")
        between = F.col("max_between")
        broken = between > 70 if allow_empty_band else unless(between <= 70)
        return [
            floor,
            _rule("dtr_south", F.col("max_south") >= 100, F.col("max_south"), "max < 100 south of -60"),
            _rule("dtr_north", F.col("max_north") >= 100, F.col("max_north"), "max < 100 north of 60"),
            _rule("dtr_between", broken, between, "max <= 70 between -60 and 60"),
        ]
    if check == "negative":
        return [_rule("negative", F.col("n_negative") > 0, F.col("n_negative"), "no value < -0.001")]
    if check == "max_precip":
        return [_rule("max_precip", F.col("n_over_3000") > 0, high, "no value > 3000")]
    raise ValueError(f"unknown check {check!r}")


def violations(
    cube: DataFrame,
    variable: str,
    checks: list[str] | tuple[str, ...],
    data_type: str = "downscaled",
    allow_empty_band: bool = False,
    lat_col: str = "lat",
) -> DataFrame:
    """One row (``year``, ``rule``, ``observed``, ``bound``) per rule a year breaks."""
    if "dtr_range" in checks and lat_col not in cube.columns:
        raise ValueError(f"the diurnal temperature range is checked by latitude: no column {lat_col!r}")
    rules = [rule for check in checks for rule in _rules(check, data_type, allow_empty_band)]
    broken = F.explode(F.filter(F.array(*rules), lambda r: r.isNotNull())).alias("v")
    return yearly_metrics(cube, variable, lat_col).select("year", broken).select("year", "v.*")


def validation_report(
    cube: DataFrame, variable: str, data_type: str, allow_empty_band: bool = False, lat_col: str = "lat"
) -> DataFrame:
    """All violations of the yearly checks that apply to ``variable``."""
    if variable not in CHECKS_OF:
        raise ValueError(f"variable must be one of {sorted(CHECKS_OF)}, got {variable!r}")
    return violations(cube, variable, ("no_missing", *CHECKS_OF[variable]), data_type, allow_empty_band, lat_col)


def validate(
    cube: DataFrame, variable: str, data_type: str, time_period: str, n_steps: int | None = None,
    allow_empty_band: bool = False, lat_col: str = "lat",
) -> None:
    """Raise AssertionError naming the broken rules. Actions: the day count, unless ``n_steps`` is known, then one pass over the cube.

    The report holds at most eight rows per year.
    """
    check_variable_name(cube, variable)
    check_timesteps(cube, data_type, time_period, n_steps)
    broken = validation_report(cube, variable, data_type, allow_empty_band, lat_col).orderBy("year", "rule").collect()
    if broken:
        lines = [f"{r['year']} {r['rule']}: {r['observed']} (must be: {r['bound']})" for r in broken]
        raise AssertionError(f"{variable} is not valid:\n" + "\n".join(lines))
