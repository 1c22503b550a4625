"""Derivations: a new series from other series and from attributes of the site.

A method takes Settings and the description of the result, and returns keys, time and the result's value column.
Inputs are joined on time under their input names, so it does not matter what their columns are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import physics
from tidemark.functions.values import nan_to_null
from tidemark.operators.align import daily_onto_hourly, merge_series, time_grid
from tidemark.operators.chunks import CHUNK_SLOTS, running_max_since, with_slot
from tidemark.operators.intervals import join_intervals
from tidemark.plans.methods import Frame, Settings, method
from tidemark.spec import SeriesSpec, check_same_cadence


def gather(settings: Settings, target: SeriesSpec) -> DataFrame:
    """All inputs next to each other on key and time, each under its input name.

    Parameters may be numbers, or Frames of intervals (keys, start, end, value) for attributes that change in time.
    """
    if not settings.inputs:
        raise ValueError(f"Derivation {settings.method} was given no input series")
    # Inputs that are columns of one DataFrame are taken from it together, without a join.
    sources: dict[tuple, dict[str, Frame]] = {}
    for name, frame in settings.inputs.items():
        sources.setdefault((id(frame.df), frame.spec.time, frame.spec.keys), {})[name] = frame
    check_same_cadence(*(frame.spec.with_(time=target.time) for frame in settings.inputs.values()))
    frames = []
    for together in sources.values():
        first = next(iter(together.values()))
        ids = [F.col(old).alias(new) for old, new in zip(first.spec.id_columns, target.id_columns)]
        values = [nan_to_null(first.df, frame.spec.value).alias(name) for name, frame in together.items()]
        frames.append((first.df.select(*ids, *values), first.spec.with_(time=target.time, keys=target.keys)))
    joined = frames[0][0] if len(frames) == 1 else merge_series(frames)
    # Attributes that come from one table of intervals are joined on together.
    tables: dict[int, dict[str, Frame]] = {}
    for name, parameter in settings.params.items():
        if isinstance(parameter, Frame):
            tables.setdefault(id(parameter.df), {})[name] = parameter
    for attributes in tables.values():
        intervals = next(iter(attributes.values())).df
        named = [F.col(frame.spec.value).alias(name) for name, frame in attributes.items()]
        joined = join_intervals(joined, target, intervals.select(*target.keys, "start", "end", *named), *attributes)
    return joined


def result(joined: DataFrame, target: SeriesSpec, value: Column) -> DataFrame:
    return joined.select(*target.id_columns, value.alias(target.value))


def _attribute(settings: Settings, name: str) -> Column:
    """A parameter as a column: joined in if it changes in time, else the number."""
    parameter = settings.param(name)
    return F.col(name) if isinstance(parameter, Frame) else F.lit(float(parameter))


def _formula(*names: str, inputs: list[str], attributes: list[str] = (), formula: Callable[..., Column]) -> None:
    """Register a derivation that is one formula over its inputs and attributes, given in that order."""

    def run(settings: Settings, target: SeriesSpec) -> DataFrame:
        for name in inputs:
            settings.input(name)
        columns = [F.col(name) for name in inputs] + [_attribute(settings, name) for name in attributes]
        return result(gather(settings, target), target, formula(*columns))

    run.__doc__ = formula.__doc__
    method("derivation", *names)(run)


# The names of methods, inputs and parameters below are those the metadata uses.
_SOIL = ["ref_soc", "ref_bulkdensity", "ref_latticewater"]

_formula("calculate_rn", inputs=["swin", "swout", "lwin", "lwout"], formula=physics.net_radiation)
_formula("calc_mean_g", "calc_flux_mean_shf", inputs=["g1", "g2"], formula=physics.mean_of_two)
_formula("calculate_mslp", inputs=["pa", "ta"], attributes=["altitude"], formula=physics.sea_level_pressure)
_formula(
    "calculate_pe",
    inputs=["rn", "g", "ta", "rh", "ws", "pa"],
    attributes=["wind_height"],
    formula=physics.penman_monteith_30min,
)
_formula("latent_heat_to_et", inputs=["le", "ta"], formula=physics.latent_heat_to_water)
_formula(
    "calc_flux_et_l1", "calc_flux_et_l2", inputs=["latent_heat_flux", "ta"], formula=physics.latent_heat_to_water
)
_formula("calc_flux_le_l1", "calc_flux_le_l2", inputs=["rn", "g", "h"], formula=physics.latent_heat_flux)
_formula("calculate_q", inputs=["ta", "rh"], formula=physics.absolute_humidity)
_formula("calc_albedo", inputs=["swin", "swout", "solar_zenith"], formula=physics.albedo)
_formula(
    "calc_factor_inten",
    inputs=["crns_count"],
    attributes=["ref_c0", "gamma"],
    formula=physics.neutron_intensity_factor,
)
_formula("calc_factor_q", inputs=["q"], attributes=["ref_q0"], formula=physics.humidity_factor)
_formula("calc_factor_PA", inputs=["pa"], attributes=["l"], formula=physics.pressure_factor)
_formula(
    "is_snow_day",
    inputs=["albedo"],
    attributes=["albedo_min_threshold", "albedo_max_threshold"],
    formula=physics.snow_day,
)
_formula(
    "correct_counts",
    inputs=["cts_mod", "cosmosfactor_inten", "cosmosfactor_pa", "cosmosfactor_q"],
    formula=physics.corrected_counts,
)
_formula(
    "calculate_vwc",
    inputs=["cts_mod_corr"],
    attributes=[*_SOIL, "n0_mod", "n_min", "n_max"],
    formula=physics.water_content,
)
_formula(
    "calculate_vwc_with_snow",
    inputs=["cts_est", "cts_mod_corr"],
    attributes=[*_SOIL, "n0_mod", "n_min", "n_max"],
    formula=lambda estimated, measured, *site: physics.water_content(F.coalesce(estimated, measured), *site),
)
_formula("get_precip_tipping", inputs=["precip_tipping_a", "precip_tipping_b"], formula=F.greatest)
_formula("calculate_crns_swe", inputs=["cts_smo", "cts_est"], attributes=["n0_mod"], formula=physics.snow_water)
_formula(
    "calculate_crns_sigma_swe",
    inputs=["cts_smo", "cts_est"],
    attributes=["n0_mod"],
    formula=physics.snow_water_sigma,
)
_formula("calculate_snowfox_swe", inputs=["cts_smo", "cts_est"], formula=physics.snow_water_buried)
_formula("calculate_snowfox_sigma_swe", inputs=["cts_smo", "cts_est"], formula=physics.snow_water_buried_sigma)
_formula(
    "calculate_smi",
    inputs=["cosmos_vwc"],
    attributes=["vwc_wilting_point", "vwc_field_capacity", "vwc_saturation"],
    formula=physics.soil_moisture_index,
)
_formula("calculate_eff_depth", inputs=["cosmos_vwc"], attributes=_SOIL, formula=physics.effective_depth)
_formula(
    "calculate_d86",
    inputs=["cosmos_vwc", "pa"],
    attributes=[*_SOIL, "distance"],
    formula=physics.penetration_depth,
)
_formula(
    "distance_to_level",
    inputs=["dist_to_water"],
    attributes=["sensor_height"],
    formula=lambda distance, height: height - distance,
)


@method("derivation", "solar_zenith")
def solar_zenith(settings: Settings, target: SeriesSpec) -> DataFrame:
    """Angle of the sun for every time of the load window, both ends included, at each site's latitude.

    The parameter ``sites`` is a Frame of sites with their latitude in the value column. Other inputs are ignored.
    """
    sites = settings.param("sites")
    window = sites.df.select(
        *target.keys,
        F.lit(str(settings.param("load_start"))).cast("timestamp_ntz").alias("first_time"),
        F.lit(str(settings.param("load_end"))).cast("timestamp_ntz").alias("last_time"),
    )
    latitudes = sites.df.select(*target.keys, F.col(sites.spec.value).alias("_latitude"))
    grid = time_grid(window, target).join(latitudes, [*target.keys], "left")
    return result(grid, target, physics.solar_zenith(F.col(target.time), F.col("_latitude")))


@method("derivation", "get_snow_estimated_counts")
def snow_estimated_counts(settings: Settings, target: SeriesSpec, chunk_size: int = CHUNK_SLOTS) -> DataFrame:
    """Counts as if there were no snow: on snow days, the last count before the snow started, raised whenever a measured
    count is higher. Null on other days.

    Every measured count on a day without snow starts afresh, so the estimate is the largest count since the latest one.
    """
    counts, snow = settings.input("cts_smo"), settings.input("snow")
    hourly = counts.df.select(
        *(F.col(old).alias(new) for old, new in zip(counts.spec.id_columns, target.id_columns)),
        nan_to_null(counts.df, counts.spec.value).alias("_count"),
    )
    hourly_spec = counts.spec.with_(time=target.time, keys=target.keys)
    dated = daily_onto_hourly(hourly, hourly_spec, snow.df, snow.spec, "_snow")
    lying = F.coalesce(F.col("_snow"), F.lit(False))
    rows = with_slot(dated.withColumn("_lying", lying), hourly_spec)
    restart = ~F.col("_lying") & F.col("_count").isNotNull()
    scanned = running_max_since(rows, hourly_spec, restart, F.col("_count"), chunk_size)
    return result(scanned, target, F.when(F.col("_lying"), F.col("_running_max")))
