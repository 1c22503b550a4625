"""Make plans from the metadata tables.

Metadata holds a plan for every dataset, which is one variable at one site. Datasets of the same variable, cadence and
level are one kind here. The *shape* of a plan is all that must be the same for datasets to share it: its steps and methods in
order, the parameters that shape a method, the kinds of its inputs, its flag columns. Datasets of one kind and
shape become one plan for their sites, and what else differs between sites, numbers and periods, becomes tables by site and
time. So a network of any size gives as many plans as it has shapes; their results are stacked by kind.

Datasets that break a rule of the metadata, and what depends on them, are left out and reported; the others are not
affected. Only the different shapes come to the driver, each once. Their values stay in DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass

from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.operators import graph
from tidemark.operators.flagging import FlagColumns, flag_role_problems
from tidemark.plans.methods import Frame, Settings, method_names
from tidemark.plans.run import Stored
from tidemark.plans.runner import DatasetPlan, Step
from tidemark.session import cut_lineage
from tidemark.sources.metadata import references
from tidemark.spec import SeriesSpec

# Configuration types of the metadata -> kinds of step.
STEP_KINDS = {
    "load": "load",
    "correction": "correction",
    "qc": "quality_control",
    "infill": "infill",
    "aggregate": "aggregation",
    "calculate": "derivation",
}
# Parameters that shape a method, and so are part of the shape of a plan. All others are numbers by site.
SHAPING = (
    "round",
    "threshold",
    "n",
    "start_time",
    "end_time",
    "time_ge",
    "time_le",
    "window",
    "window_size",
    "alignment",
    "max_gap_size",
    "min_threshold",
    "max_threshold",
    "value",
)
WHOLE_NUMBERS = ("round", "threshold", "n", "max_gap_size", "min_threshold", "max_threshold")


@dataclass(frozen=True)
class MetadataTables:
    """The tables that ``sources.metadata`` flattens the records to. Arguments are the resolved ones."""

    datasets: DataFrame
    steps: DataFrame
    settings: DataFrame
    arguments: DataFrame
    flag_columns: DataFrame
    flag_members: DataFrame


def kind_name(*columns: str):
    """A kind of dataset: variable, cadence and level."""
    return F.concat_ws("/", *columns)


def with_kind(datasets: DataFrame) -> DataFrame:
    return datasets.withColumn("kind_id", kind_name("variable", "periodicity", "processing_level"))


def _methods(tables: MetadataTables) -> DataFrame:
    """Every method of every plan: dataset, kind_id, site, index, kind, position, method, start, end, configuration."""
    kinds = with_kind(tables.datasets).select("dataset", "kind_id", F.col("site").alias("own_site"))
    return (
        tables.settings.join(tables.steps, ["dataset", "configuration"])
        .join(kinds, "dataset")
        .withColumn("site", F.coalesce("own_site", "site"))
        .drop("own_site", "arguments")
    )


def _named(tables: MetadataTables) -> DataFrame:
    """Every named input or dependency: dataset, configuration, position, parameter, role, needed, needed_kind (null if no
    dataset has that name)."""
    wanted = tables.arguments.where("role in ('input', 'dependency')").withColumnRenamed("value", "needed")
    kinds = with_kind(tables.datasets).select(F.col("dataset").alias("needed"), F.col("kind_id").alias("needed_kind"))
    return wanted.join(kinds, "needed", "left")


def _values(tables: MetadataTables, methods: DataFrame) -> DataFrame:
    literal = tables.arguments.where("role = 'value'").select(
        "dataset",
        "configuration",
        "position",
        "parameter",
        F.col("value").alias("text"),
        F.col("start").alias("since"),
        F.col("end").alias("until"),
    )
    return methods.join(literal, ["dataset", "configuration", "position"])


def _shaping(text: list[str], name: str):
    if name == "value":
        return sorted(float(one) for one in text)
    return int(float(text[0])) if name in WHOLE_NUMBERS else text[0]


def _by_site(values: DataFrame, methods: DataFrame, names: list[str]) -> DataFrame:
    """Parameters of one method as a table: site, start, end and a column for each."""
    ids = ["site", "start", "end"]
    listed = methods.select(*ids).distinct()
    if not names:
        return listed
    numbers = values.where(F.col("parameter").isin(*names)).groupBy(*ids)
    pivoted = numbers.pivot("parameter", names).agg(F.first(F.col("text").try_cast("double")))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in ids]
    renamed = pivoted.withColumnsRenamed({name: f"_{name}" for name in ids})
    condition = same[0] & same[1] & same[2]
    return listed.join(renamed, condition, "left").drop(*(f"_{name}" for name in ids))


def _attributes(values: DataFrame, names: list[str], target: SeriesSpec) -> dict[str, Frame]:
    """Parameters of a derivation as attributes of the sites: intervals, open where a value does not change in time."""
    wide = {}
    for name in names:
        own = values.where(F.col("parameter") == name)
        rows = own.select("site", F.col("since").alias("start"), F.col("until").alias("end"), F.col("text").try_cast("double").alias(name))
        wide[name] = Frame(rows.distinct(), target.with_(value=name))
    return wide


# --- Rules -------------------------------------------------------------------------------------------------------


def broken_rules(tables: MetadataTables) -> DataFrame:
    """(dataset, rule, detail): every rule of the metadata that a dataset breaks. One table, made by one job.

    An index of a plan is used once; a configuration is of a known type and its methods exist; a parameter that shapes a
    method has one value, a number where it must be one; an input names exactly one dataset, which exists; the role of
    a flag column is known and used once; a site has one dataset of a kind, and it agrees with most of its kind in time column,
    anchor and unit.
    """
    methods = _methods(tables)
    at = ["dataset", "configuration", "position", "parameter"]
    broken = [
        (graph.duplicate_plan_indices(tables.steps), "index used more than once", F.col("index")),
        (methods.where(~F.col("kind").isin(*STEP_KINDS)), "unknown configuration type", F.col("kind")),
    ]
    unknown = F.lit(False)
    for kind, step in STEP_KINDS.items():
        if step != "load":
            unknown = unknown | ((F.col("kind") == kind) & ~F.col("method").isin(*method_names(step)))
    broken.append((methods.where(unknown), "unknown method", F.col("method")))
    shaping = _values(tables, methods).where(F.col("parameter").isin(*SHAPING))
    once = shaping.where("parameter <> 'value'").groupBy(*at).agg(F.countDistinct("text").alias("n"))
    broken.append((once.where("n > 1"), "parameter has several values", F.col("parameter")))
    numbers = shaping.where(F.col("parameter").isin(*WHOLE_NUMBERS, "value"))
    broken.append((numbers.where(F.col("text").try_cast("double").isNull()), "parameter is not a number", F.col("parameter")))
    inputs = _named(tables).groupBy(*at).agg(F.count("*").alias("n"), F.count("needed_kind").alias("found"))
    broken.append((inputs.where("n <> 1 or found <> 1"), "input is not exactly one dataset", F.col("parameter")))
    roles = flag_role_problems(tables.flag_columns)
    broken.append((roles, "flag column", F.concat_ws(": ", "reason", "role")))

    kinds = with_kind(tables.datasets)
    twice = kinds.groupBy("kind_id", "site").agg(F.count("*").alias("n")).where("n > 1").select("kind_id", "site")
    broken.append((kinds.join(twice, ["kind_id", "site"], "left_semi"), "site has several datasets of a kind", F.col("kind_id")))
    drawn = kinds.withColumn("drawn", F.to_json(F.struct("anchor", "time_column", "unit")))
    counted = drawn.groupBy("kind_id", "drawn").agg(F.count("*").alias("n"))
    usual = counted.groupBy("kind_id").agg(F.max_by("drawn", F.struct("n", "drawn")).alias("usual"))
    other = drawn.join(usual, "kind_id").where("drawn <> usual")
    broken.append((other, "differs from its kind in anchor, time column or unit", F.col("drawn")))
    found = [df.select("dataset", F.lit(rule).alias("rule"), detail.cast("string").alias("detail")) for df, rule, detail in broken]
    return reduce(DataFrame.unionByName, found).distinct()


def broken_datasets(tables: MetadataTables) -> DataFrame:
    """(dataset, rule, detail) of all datasets that break a rule or depend on one that does; written to the shared folder."""
    own = cut_lineage(broken_rules(tables))
    if own.isEmpty():
        return own
    edges = graph.dependency_edges(references(tables.arguments))
    failed = graph.failed_with_descendants(edges, own.select("dataset").distinct())
    later = failed.join(own, "dataset", "left_anti").select("dataset", F.lit("depends on a broken dataset").alias("rule"))
    return cut_lineage(own.unionByName(later.withColumn("detail", F.lit(None).cast("string"))))


# --- Shapes ------------------------------------------------------------------------------------------------------


def _shapes(tables: MetadataTables, methods: DataFrame, values: DataFrame) -> DataFrame:
    """(dataset, kind_id, site, shape, entries) of every dataset with a plan. An entry is one line of its shape: a method, a shaping
    parameter, an input or a flag column, in order; equal entries have equal shapes."""
    place = ["index", "kind", "position", "method"]
    ids = ["dataset", "configuration", "position"]
    nothing = F.lit(None).cast("string")
    own = methods.select("dataset", F.lit("method").alias("what"), *place, nothing.alias("name"), nothing.alias("text"))
    shaping = values.where(F.col("parameter").isin(*SHAPING))
    shaping = shaping.select("dataset", F.lit("shaping").alias("what"), *place, F.col("parameter").alias("name"), "text")
    inputs = methods.join(_named(tables), ids)
    inputs = inputs.select(
        "dataset", F.lit("input").alias("what"), *place, F.col("parameter").alias("name"), F.col("needed_kind").alias("text")
    )
    flags = tables.flag_columns.select(
        "dataset", F.lit("flag").alias("what"), F.lit(None).cast("int").alias("index"), F.col("scheme").alias("kind"),
        F.lit(None).cast("int").alias("position"), nothing.alias("method"), F.col("role").alias("name"), F.col("column_name").alias("text"),
    )
    lines = reduce(DataFrame.unionByName, [own, shaping, inputs, flags])
    # A dataset has as many lines as its plan, never more.
    listed = lines.groupBy("dataset").agg(F.sort_array(F.collect_set(F.struct("what", *place, "name", "text"))).alias("entries"))
    planned = methods.select("dataset", "kind_id", "site").distinct()
    return planned.join(listed, "dataset").withColumn("shape", F.sha2(F.to_json("entries"), 256))


def _flags(entries: list[Row], members: dict[str, dict[str, int]]) -> FlagColumns:
    flags = [entry for entry in entries if entry["what"] == "flag"]
    return FlagColumns({flag["name"]: flag["text"] for flag in flags}, {flag["name"]: members.get(flag["kind"], {}) for flag in flags})


def _specs(tables: MetadataTables) -> dict[str, SeriesSpec]:
    """What most datasets of each kind are."""
    shape = ["variable", "periodicity", "anchor", "time_column", "unit"]
    counted = with_kind(tables.datasets).groupBy("kind_id", *shape).agg(F.count("*").alias("n"))
    drawn = F.struct("n", F.to_json(F.struct("anchor", "time_column", "unit")))
    usual = counted.groupBy("kind_id").agg(*(F.max_by(name, drawn).alias(name) for name in shape))
    return {
        row["kind_id"]: SeriesSpec.of(
            row["periodicity"], time=row["time_column"], value=row["variable"], anchor=row["anchor"], unit=row["unit"]
        )
        for row in usual.collect()
    }


def plans_by_kind(tables: MetadataTables, broken: DataFrame | None = None) -> dict[str, DatasetPlan]:
    """One plan for each kind of dataset that has steps, with a variant for each shape. Each method acts on the sites of its
    variant, in the periods that list it. ``broken`` are the datasets to leave out, ``broken_datasets(tables)`` if not given.

    A load or an aggregation reads the kind its ``dep_ts`` refers to.
    """
    specs = _specs(tables)
    broken = broken_datasets(tables) if broken is None else broken
    sound = _methods(tables).join(broken.select("dataset"), "dataset", "left_anti")
    # Every method's table of parameters is cut from these two, so they are made once.
    methods = cut_lineage(sound)
    values = cut_lineage(_values(tables, methods))
    shapes = cut_lineage(_shapes(tables, methods, values))
    methods = methods.join(shapes.select("dataset", "shape"), "dataset")
    values = values.join(shapes.select("dataset", "shape"), "dataset")

    # Each different shape once, whatever the number of sites.
    found = shapes.groupBy("kind_id", "shape").agg(F.first("entries").alias("entries")).collect()
    at = ["kind_id", "shape", "index", "kind", "position", "method"]
    numeric: dict[tuple, list[str]] = {}
    for row in values.where(~F.col("parameter").isin(*SHAPING)).select(*at, "parameter").distinct().collect():
        numeric.setdefault(tuple(row[name] for name in at), []).append(row["parameter"])
    schemes = {entry["kind"] for row in found for entry in row["entries"] if entry["what"] == "flag"}
    members: dict[str, dict[str, int]] = {}
    for row in tables.flag_members.where(F.col("scheme").isin(*schemes)).collect() if schemes else []:
        members.setdefault(row["scheme"], {})[row["flag"]] = row["bit"]

    variants: dict[str, list[DatasetPlan]] = {}
    for row in sorted(found, key=lambda row: (row["kind_id"], row["shape"])):
        kind_id, shape, entries = row["kind_id"], row["shape"], row["entries"]
        steps = _steps(kind_id, shape, entries, numeric, specs[kind_id], methods, values)
        own = shapes.where((F.col("kind_id") == kind_id) & (F.col("shape") == shape)).select("site")
        variants.setdefault(kind_id, []).append(DatasetPlan(specs[kind_id], steps, _flags(entries, members), sites=own))
    return {kind: DatasetPlan(specs[kind], (), variants=tuple(plans)) for kind, plans in variants.items()}


def _steps(
    kind_id: str, shape: str, entries: list[Row], numeric: dict, target: SeriesSpec, methods: DataFrame, values: DataFrame
) -> tuple[Step, ...]:
    """The steps of a shape: one for each method, in order of index and position."""
    order = ("index", "kind", "position", "method")
    places = sorted(tuple(entry[name] for name in order) for entry in entries if entry["what"] == "method")
    # The methods of one configuration are one unit: core flags follow the last of them.
    closing = {place[:2]: place for place in places}
    steps = []
    for place in places:
        index, kind, position, name = place
        here = [entry for entry in entries if tuple(entry[one] for one in order) == place]
        needed = {entry["name"]: entry["text"] for entry in here if entry["what"] == "input"}
        source = needed.pop("dep_ts", None)
        fixed: dict[str, list[str]] = {}
        for entry in here:
            if entry["what"] == "shaping":
                fixed.setdefault(entry["name"], []).append(entry["text"])
        params = {key: _shaping(text, key) for key, text in fixed.items()}
        by_site, step = None, STEP_KINDS[kind]
        numbers = sorted(numeric.get((kind_id, shape, *place), []))
        if step == "derivation":
            params |= _attributes(values.where(_at(kind_id, shape, place)), numbers, target)
        if step in ("correction", "quality_control", "infill"):
            own = _at(kind_id, shape, place)
            by_site = _by_site(values.where(own), methods.where(own), numbers)
        inputs = {name: needed} if needed else {}
        steps.append(Step(step, (Settings(name, params, by_site=by_site),), source, inputs, last=closing[place[:2]] == place))
    return tuple(steps)


def _at(kind_id: str, shape: str, place: tuple):
    index, kind, position, name = place
    return (
        (F.col("kind_id") == kind_id)
        & (F.col("shape") == shape)
        & (F.col("index") == index)
        & (F.col("kind") == kind)
        & (F.col("position") == position)
        & (F.col("method") == name)
    )


def stored_inputs(tables: MetadataTables, plans: dict[str, DatasetPlan], base: str) -> dict[str, Stored]:
    """The kinds that plans need and that have no plan themselves, as stored below one base folder."""
    specs = _specs(tables)
    wanted = set().union(*(plan.needs() for plan in plans.values())) - set(plans)
    return {kind: Stored(base, specs[kind]) for kind in sorted(wanted) if kind in specs}
