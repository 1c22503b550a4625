"""Run the steps of a plan: load, correct, check, infill, aggregate, derive, with the flags each of them keeps.

A step only builds on the DataFrame of the step before, so a whole plan is one lazy DataFrame for all sites.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Importing the operator modules registers their methods.
from tidemark.functions.flagbits import appeared_or_vanished, changed, set_bit
from tidemark.functions.values import round_even
from tidemark.operators import aggregate, corrections, derive, flagging, infill, quality  # noqa: F401
from tidemark.operators.flagging import FlagColumns
from tidemark.operators.intervals import join_site_parameters
from tidemark.operators.quality import FAILED
from tidemark.plans.methods import Frame, Settings, get_method
from tidemark.spec import SeriesSpec


@dataclass(frozen=True)
class Series:
    """A dataset while its plan runs: the data, its description and its flag columns."""

    df: DataFrame
    spec: SeriesSpec
    flags: FlagColumns = field(default_factory=FlagColumns)

    @property
    def frame(self) -> Frame:
        return Frame(self.df, self.spec)

    def with_df(self, df: DataFrame) -> Series:
        return replace(self, df=df)


def _with_flag_columns(series: Series) -> Series:
    return series.with_df(flagging.ensure_flag_columns(series.df, list(series.flags.columns.values())))


def _rounded(df: DataFrame, spec: SeriesSpec, settings: Settings) -> DataFrame:
    """Round after a method, if its settings say so. Flags compare the values before rounding."""
    decimals = settings.params.get("round")
    return df if decimals is None else df.withColumn(spec.value, round_even(spec.value, decimals))


def _run(kind: str, df: DataFrame, spec: SeriesSpec, settings: Settings) -> DataFrame:
    """Run a method that keeps the rows of ``df``, on the rows its settings are for."""
    function = get_method(kind, settings.method)
    if settings.by_site is None:
        return function(Frame(df, spec), settings)
    joined, names = join_site_parameters(df, spec, settings.by_site, "_site_", "_set")
    own = {name: F.col(f"_site_{name}") for name in names}
    settings = replace(settings, params=settings.params | own, by_site=None)
    ran = function(Frame(joined.withColumn("_unset", F.col(spec.value)), spec), settings)
    result = ran.withColumn(spec.value, F.when(F.col("_set"), F.col(spec.value)).otherwise(F.col("_unset")))
    if kind == "quality_control":
        result = result.withColumn(FAILED, F.when(F.col("_set"), F.col(FAILED)).otherwise(F.lit(False)))
    return result.drop("_set", "_unset", *(f"_site_{name}" for name in names))


def load(source: Frame, target: SeriesSpec, flags: FlagColumns = FlagColumns()) -> Series:
    """Take over a series under the target's column names and anchor (times stay), and set its first flags."""
    ids = [F.col(old).alias(new) for old, new in zip(source.spec.id_columns, target.id_columns)]
    data = source.df.select(*ids, F.col(source.spec.value).alias(target.value))
    series = _with_flag_columns(Series(data, target, flags))
    core = flags.column("core")
    return series if core is None else series.with_df(flagging.set_initial_core(series.df, target.value, core))


def correct(series: Series, methods: list[Settings], last: bool = True) -> Series:
    """Apply corrections; flag the rows each one changed, and the core after the last one."""
    return _change(series, methods, "correction", "correction", changed, last)


def fill(series: Series, methods: list[Settings], last: bool = True) -> Series:
    """Apply infill methods; flag the rows each one filled, and the core after the last one."""
    return _change(series, methods, "infill", "infill", appeared_or_vanished, last)


def _change(series: Series, methods: list[Settings], kind: str, role: str, difference, last: bool) -> Series:
    series = _with_flag_columns(series)
    spec, flags = series.spec, series.flags
    flag, core = flags.column(role), flags.column("core")
    df = series.df
    for settings in methods:
        before = df if flag is None else df.withColumn("_before", F.col(spec.value))
        df = _run(kind, before, spec, settings)
        if flag is not None:
            mask = difference(df, "_before", spec.value)
            df = df.withColumn(flag, set_bit(flag, flags.bit(role, settings.method), mask)).drop("_before")
        df = _rounded(df, spec, settings)
    if last and core is not None and flag is not None:
        if kind == "correction":
            df = flagging.set_core_after_correction(df, spec.value, core, flag)
        else:
            df = flagging.set_core_after_infill(df, core, flag)
    return series.with_df(df)


def check(series: Series, methods: list[Settings], remove: bool = True) -> Series:
    """Run quality checks, keep their flags, and take out what failed unless more checks follow."""
    series = _with_flag_columns(series)
    spec, flags = series.spec, series.flags
    flag, core = flags.column("quality_control"), flags.column("core")
    df = series.df
    for settings in methods:
        df = _run("quality_control", df, spec, settings)
        if flag is not None:
            df = df.withColumn(flag, set_bit(flag, flags.bit("quality_control", settings.method), F.col(FAILED)))
        df = _rounded(df.drop(FAILED), spec, settings)
    if core is not None and flag is not None:
        df = flagging.set_core_after_qc(df, core, flag)
    if remove and flag is not None:
        df = flagging.remove_flagged(df, spec.value, flag, core)
    return series.with_df(df)


def aggregate_to(source: Frame, target: SeriesSpec, settings: Settings, flags: FlagColumns = FlagColumns()) -> Series:
    """Aggregate a series to the target's period, flag incomplete buckets, and null those below the threshold."""
    ids = [F.col(old).alias(new) for old, new in zip(source.spec.id_columns, target.id_columns)]
    renamed = source.df.select(*ids, F.col(source.spec.value).alias(target.value))
    frame = Frame(renamed, source.spec.with_(keys=target.keys, time=target.time, value=target.value))
    # Without one in the settings, the bucket and its label follow the target.
    defaults = {"aggregation_period": target.period, "aggregation_time_anchor": target.anchor}
    settings = replace(settings, params=defaults | settings.params)
    df = _rounded(get_method("aggregation", settings.method)(frame, settings), target, settings)
    series = _with_flag_columns(Series(df, target, flags))
    core = flags.column("core")
    df = series.df if core is None else aggregate.set_core_after_aggregation(series.df, target, core)
    df = aggregate.null_below_threshold(df, target)
    return series.with_df(df.select(*target.id_columns, target.value, *flags.columns.values()))


def derive_to(settings: Settings, target: SeriesSpec, flags: FlagColumns = FlagColumns()) -> Series:
    """Derive the target from the inputs, and flag where that gave nothing."""
    df = _rounded(get_method("derivation", settings.method)(settings, target), target, settings)
    series = _with_flag_columns(Series(df, target, flags))
    core = flags.column("core")
    return series if core is None else series.with_df(
        flagging.set_core_after_derivation(series.df, target.value, core)
    )


@dataclass(frozen=True)
class Step:
    """One step of a plan. Inputs are names of datasets; ``source`` is what a load or an aggregation reads.

    ``last`` is false if methods of the same configuration follow as steps of their own.
    """

    kind: str
    methods: tuple[Settings, ...] = ()
    source: str | None = None
    inputs: dict[str, dict[str, str]] = field(default_factory=dict)  # method name -> input name -> dataset
    last: bool = True

    def needs(self) -> set[str]:
        named = {dataset for inputs in self.inputs.values() for dataset in inputs.values()}
        return named | ({self.source} if self.source else set())


@dataclass(frozen=True)
class DatasetPlan:
    """What a dataset is and the steps that make it, in order.

    ``sites`` (the series keys) limits the plan to some series. A plan with ``variants`` has no steps of its own: each of them
    makes its own series, and their rows are the dataset.
    """

    target: SeriesSpec
    steps: tuple[Step, ...]
    flags: FlagColumns = field(default_factory=FlagColumns)
    sites: DataFrame | None = None
    variants: tuple[DatasetPlan, ...] = ()

    def needs(self) -> set[str]:
        return set().union(*(part.needs() for part in (*self.steps, *self.variants)))


def _of_sites(datasets: dict[str, Frame], names: set[str], sites: DataFrame) -> dict[str, Frame]:
    """Some datasets with the rows of some series. Datasets that are columns of one DataFrame stay that."""
    cut: dict[int, DataFrame] = {}
    found = {}
    for name in names & set(datasets):
        frame = datasets[name]
        if id(frame.df) not in cut:
            cut[id(frame.df)] = frame.df.join(sites, list(frame.spec.keys), "left_semi")
        found[name] = Frame(cut[id(frame.df)], frame.spec)
    return found


def _stacked(parts: list[Series]) -> Series:
    """Series of one dataset made by variants of its plan, told apart by their keys. Flag columns are those of all."""
    first = parts[0]
    df = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), (part.df for part in parts))
    columns = reduce(lambda known, part: {**part.flags.columns, **known}, parts, {})
    schemes = reduce(lambda known, part: {**part.flags.schemes, **known}, parts, {})
    return Series(df, first.spec, FlagColumns(columns, schemes))


def run_plan(plan: DatasetPlan, datasets: dict[str, Frame]) -> Series:
    """Run the steps of one plan. ``datasets`` holds everything the steps name."""
    if plan.variants:
        return _stacked([run_plan(variant, datasets) for variant in plan.variants])
    if plan.sites is not None:
        datasets = datasets | _of_sites(datasets, plan.needs(), plan.sites)

    def resolved(step: Step, settings: Settings) -> Settings:
        named = {name: datasets[dataset] for name, dataset in step.inputs.get(settings.method, {}).items()}
        return replace(settings, inputs=settings.inputs | named)

    series = None
    for number, step in enumerate(plan.steps):
        methods = [resolved(step, settings) for settings in step.methods]
        if series is None and step.kind in ("correction", "quality_control", "infill"):
            raise ValueError(f"A plan cannot start with {step.kind}: there is no data yet")
        if step.kind == "load":
            series = load(datasets[step.source], plan.target, plan.flags)
        elif step.kind == "correction":
            series = correct(series, methods, step.last)
        elif step.kind == "quality_control":
            following = plan.steps[number + 1].kind if number + 1 < len(plan.steps) else None
            series = check(series, methods, remove=following != "quality_control")
        elif step.kind == "infill":
            series = fill(series, methods, step.last)
        elif step.kind == "aggregation":
            series = aggregate_to(datasets[step.source], plan.target, methods[0], plan.flags)
        elif step.kind == "derivation":
            series = derive_to(methods[0], plan.target, plan.flags)
        else:
            raise ValueError(f"Unknown kind of step: {step.kind}")
    if series is None:
        raise ValueError("The plan has no steps")
    return series


@dataclass(frozen=True)
class RunResult:
    done: dict[str, Series]
    failed: dict[str, str]
    #: Rows, values and missing values of what was saved.
    counts: dict[str, dict[str, int]] = field(default_factory=dict)

    def raise_if_failed(self) -> None:
        if self.failed:
            raise RuntimeError(f"{len(self.failed)} dataset(s) failed: {self.failed}")


def run_plans(
    plans: dict[str, DatasetPlan], sources: dict[str, Frame], failed: dict[str, str] | None = None
) -> RunResult:
    """Run many plans, each after what it needs. A plan that cannot be built fails with all that depend on it, as do those
    that need a dataset in ``failed``; the others still run. Nothing is computed yet: the results are lazy."""
    order = TopologicalSorter({name: plan.needs() - set(sources) for name, plan in plans.items()}).static_order()
    known, done, failed = dict(sources), {}, dict(failed or {})
    for name in order:
        if name not in plans:
            failed.setdefault(name, "no plan and no data")
            continue
        if broken := sorted(plans[name].needs() & set(failed)):
            failed[name] = f"depends on {broken[0]}, which failed"
            continue
        try:
            series = run_plan(plans[name], known)
        except Exception as error:  # noqa: BLE001 - one bad dataset must not stop the others
            failed[name] = str(error)
        else:
            done[name], known[name] = series, series.frame
    return RunResult(done, failed)
