"""Metadata records as tables: datasets, plan steps, method arguments, flag columns, sites, deployments, annotations.

The records are JSON documents with an ``items`` list. Schemas are given, so nothing is inferred. Fields that come in
several shapes (a value or a list of them, one reference or many) are read as JSON text and parsed here.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.flagbits import FLAG_TYPES
from tidemark.functions.times import TimeLike, at
from tidemark.spec import ANCHOR_CODES

_ID = "struct<`@id`:string>"
_VALUE = "struct<value:string,valueReference:string>"
_ARGUMENT = f"struct<parameter:{_ID},hasValue:{_VALUE},hasStructuredValue:string>"
_INNER_ARGUMENTS = f"array<struct<argument:array<struct<parameter:{_ID},hasValue:{_VALUE}>>>>"
_PERIOD = "struct<startDate:string,endDate:string>"
_ANNOTATION = (
    f"struct<property:{_ID},hasValue:{_VALUE},"
    "hasValueSeries:struct<hasCurrentValue:array<struct<value:string,interval:" + _PERIOD + ">>>>"
)

SCHEMAS = {
    "dataset": f"""`@id` string, `@type` array<{_ID}>, sourceColumnName string, timeColumnName string,
        processingLevel {_ID}, originatingSite array<{_ID}>, originatingProgramme array<{_ID}>,
        measure array<struct<periodicity:string,resolution:string,hasUnit:{_ID},valueTimeAnchor:{_ID}>>,
        distribution array<struct<accessUrl:array<string>>>,
        methodology struct<uses:array<{_ID}>,hasPart:array<struct<index:int,configuration:{_ID}>>>,
        hasFlagColumn array<struct<columnName:string,valueScheme:{_ID}>>""",
    "configuration": f"""`@id` string, type {_ID}, appliesToDataset array<struct<`@id`:string,originatingSite:array<{_ID}>>>,
        hasAnnotation array<{_ANNOTATION}>,
        hasCurrentValue array<struct<`@id`:string,method:{_ID},argument:array<{_ARGUMENT}>,observationInterval:{_PERIOD}>>""",
    "site": f"""`@id` string, identifier array<string>, label array<string>, utilisedBy array<{_ID}>,
        easting double, northing double, lat double, `long` double, altitude double, operatingPeriod {_PERIOD},
        hasAnnotation array<{_ANNOTATION}>""",
    "deployment": "`@id` string, startedAtTime string, endedAtTime string, deployedHeight double, deployedOnPlatform string",
    "flag_scheme": f"`@id` string, flagType {_ID}, hasTopConcept array<struct<prefLabel:array<string>,value:int>>",
}


def read_items(spark: SparkSession, path: str, kind: str, multi_line: bool = True) -> DataFrame:
    """One row per record of all documents in a folder. With ``multi_line`` off, each line is a document."""
    schema = T.StructType([T.StructField("items", T.ArrayType(T.StructType.fromDDL(SCHEMAS[kind])))])
    return spark.read.schema(schema).json(path, multiLine=multi_line).select(F.inline("items"))


def last_segment(uri: Column | str) -> Column:
    """The last part of a URI."""
    uri = F.col(uri) if isinstance(uri, str) else uri
    return F.element_at(F.split(F.rtrim(uri, F.lit("/")), "/"), -1)


def parameter_name(uri: Column) -> Column:
    return F.regexp_replace(last_segment(uri), "-", "_")


def text_values(raw: Column) -> Column:
    """A JSON value or list of them as a list of texts."""
    as_list = F.from_json(raw, "array<string>")
    return F.when(raw.startswith("["), as_list).when(raw.isNotNull(), F.array(raw))


def referenced_ids(raw: Column) -> Column:
    """One reference or a list of them as a list of ids."""
    wrapped = F.when(raw.startswith("["), raw).otherwise(F.concat(F.lit("["), raw, F.lit("]")))
    return F.transform(F.from_json(wrapped, f"array<{_ID}>"), lambda reference: reference["@id"])


def _time(text: Column) -> Column:
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def datasets(items: DataFrame) -> DataFrame:
    """One row per dataset: what it is and where it is stored."""
    measure = F.get("measure", F.lit(0))
    anchor = last_segment(measure["valueTimeAnchor"]["@id"])
    codes = F.create_map(*(F.lit(text) for pair in ANCHOR_CODES.items() for text in pair))
    return items.select(
        F.col("@id").alias("dataset"),
        last_segment(F.get("originatingProgramme", F.lit(0))["@id"]).alias("network"),
        last_segment(F.get("originatingSite", F.lit(0))["@id"]).alias("site"),
        F.col("sourceColumnName").alias("variable"),
        F.col("timeColumnName").alias("time_column"),
        last_segment("processingLevel.@id").alias("processing_level"),
        last_segment(F.get("@type", F.lit(0))["@id"]).alias("dataset_type"),
        measure["resolution"].alias("resolution"),
        measure["periodicity"].alias("periodicity"),
        F.element_at(codes, anchor).alias("anchor"),
        measure["hasUnit"]["@id"].alias("unit"),
        F.rtrim(F.get(F.get("distribution", F.lit(0))["accessUrl"], F.lit(0)), F.lit("/")).alias("access_url"),
    )


def plan_steps(items: DataFrame) -> DataFrame:
    """The steps of each dataset's plan: (dataset, index, configuration). See ``operators.graph.plan_order``."""
    step = F.explode("methodology.hasPart").alias("step")
    return items.select(F.col("@id").alias("dataset"), step).select(
        "dataset", "step.index", F.col("step.configuration.@id").alias("configuration")
    )


def flag_columns(items: DataFrame, flag_schemes: DataFrame) -> DataFrame:
    """Flag columns with their scheme and role: (dataset, column_name, scheme, role). An unknown flag type is left as it
    is, which ``operators.flagging.check_flag_roles`` finds."""
    declared = items.select(F.col("@id").alias("dataset"), F.explode("hasFlagColumn").alias("flag")).select(
        "dataset", F.col("flag.columnName").alias("column_name"), last_segment("flag.valueScheme.@id").alias("scheme")
    )
    known = F.create_map(*(F.lit(text) for pair in FLAG_TYPES.items() for text in pair))
    flag_type = last_segment("flagType.@id")
    role = F.coalesce(F.element_at(known, flag_type), flag_type)
    roles = flag_schemes.select(last_segment("@id").alias("scheme"), role.alias("role"))
    return declared.join(roles, "scheme", "left").select("dataset", "column_name", "scheme", "role")


def flag_members(flag_schemes: DataFrame) -> DataFrame:
    """The flags of each scheme: (scheme, flag, bit)."""
    member = F.explode("hasTopConcept").alias("member")
    return flag_schemes.select(last_segment("@id").alias("scheme"), member).select(
        "scheme", F.get("member.prefLabel", F.lit(0)).alias("flag"), F.col("member.value").alias("bit")
    )


def method_settings(items: DataFrame) -> DataFrame:
    """One row per dataset, configuration and method: (dataset, site, configuration, kind, position, method, start, end,
    arguments). A configuration that applies to several datasets gives a row for each."""
    applied = items.select(
        F.col("@id").alias("configuration"),
        last_segment("type.@id").alias("kind"),
        F.explode("appliesToDataset").alias("applied"),
        "hasCurrentValue",
    )
    return applied.select("*", F.posexplode("hasCurrentValue").alias("position", "current")).select(
        F.col("applied.@id").alias("dataset"),
        last_segment(F.get("applied.originatingSite", F.lit(0))["@id"]).alias("site"),
        "configuration",
        "kind",
        "position",
        last_segment("current.method.@id").alias("method"),
        _time(F.col("current.observationInterval.startDate")).alias("start"),
        _time(F.col("current.observationInterval.endDate")).alias("end"),
        F.col("current.argument").alias("arguments"),
    )


def arguments(settings: DataFrame) -> DataFrame:
    """One row per argument value: (dataset, configuration, position, parameter, role, value).

    Role ``value`` is a literal, ``input`` a dataset under a named input, ``dependency`` one under dep_ts or load_dep_ts,
    and ``nested`` a literal inside a structured argument, whose parameter is written outer.inner.
    """
    ids = ["dataset", "configuration", "position"]
    each = settings.select(*ids, F.explode("arguments").alias("argument")).select(
        *ids,
        parameter_name(F.col("argument.parameter.@id")).alias("parameter"),
        F.col("argument.hasValue").alias("held"),
        F.col("argument.hasStructuredValue").alias("structured"),
    )
    raw = F.col("structured")
    listed = F.when(raw.startswith("["), raw).otherwise(F.concat(F.lit("["), raw, F.lit("]")))
    inner = F.flatten(F.transform(F.from_json(listed, _INNER_ARGUMENTS), lambda part: part["argument"]))

    def entry(parameter: Column, role: Column, value: Column) -> Column:
        return F.struct(parameter.alias("parameter"), role.alias("role"), value.alias("value"))

    outer = F.col("parameter")
    refers = F.when(outer.isin("dep_ts", "load_dep_ts"), "dependency").otherwise("input")
    found = (
        F.transform(text_values(F.col("held.value")), lambda value: entry(outer, F.lit("value"), value)),
        F.transform(referenced_ids(F.col("held.valueReference")), lambda value: entry(outer, refers, value)),
        F.flatten(
            F.transform(
                inner,
                lambda part: F.transform(
                    F.coalesce(text_values(part["hasValue"]["value"]), F.array().cast("array<string>")),
                    lambda value: entry(
                        F.concat_ws(".", outer, parameter_name(part["parameter"]["@id"])), F.lit("nested"), value
                    ),
                ),
            )
        ),
    )
    nothing = F.array().cast("array<struct<parameter:string,role:string,value:string>>")
    # All shapes of an argument come out of one pass over the records.
    return each.select(*ids, F.inline(F.concat(*(F.coalesce(entries, nothing) for entries in found))))


SITE_ATTRIBUTES = ["easting", "northing", "lat", "lon", "altitude"]


def resolved_arguments(
    arguments: DataFrame,
    settings: DataFrame,
    sites: DataFrame,
    annotations: DataFrame,
    deployments: DataFrame | None = None,
) -> DataFrame:
    """Arguments with what they point to at their site: adds ``start`` and ``end`` for values that change in time.

    An ``annotation`` argument names annotations of the site and a ``site_attribute`` a column of it; either becomes a
    parameter under that name. A structured argument whose source is ``deployment`` becomes the heights of the site's
    deployments on the platform it names.
    """
    ids = ["dataset", "configuration", "position"]
    never = F.lit(None).cast("timestamp_ntz")
    pointers = ("annotation", "site_attribute")
    plain = arguments.where((F.col("role") != "nested") & ~F.col("parameter").isin(*pointers))
    plain = plain.withColumn("start", never).withColumn("end", never)

    site_of = settings.select(*ids, "site").distinct()
    asked = arguments.where((F.col("role") == "value") & F.col("parameter").isin(*pointers))
    asked = asked.join(site_of, ids).withColumn("name", F.lower("value"))
    notes = annotations.select(
        last_segment("id").alias("site"), F.col("property").alias("name"), "start", "end", F.col("value").alias("held")
    )
    texts = sites.select("site", *(F.col(name).cast("string").alias(name) for name in SITE_ATTRIBUTES))
    attributes = texts.unpivot("site", SITE_ATTRIBUTES, "name", "held")
    attributes = attributes.withColumn("start", never).withColumn("end", never)

    def found(pointer: str, table: DataFrame) -> DataFrame:
        hits = asked.where(F.col("parameter") == pointer).join(table, ["site", "name"])
        return hits.select(*ids, F.col("name").alias("parameter"), "role", F.col("held").alias("value"), "start", "end")

    resolved = plain.unionByName(found("annotation", notes)).unionByName(found("site_attribute", attributes))
    if deployments is None:
        return resolved

    part = F.element_at(F.split("parameter", r"\."), -1)
    nested = arguments.where("role = 'nested'").withColumn("outer", F.split("parameter", r"\.")[0])
    described = nested.groupBy(*ids, "outer").agg(
        *(F.max(F.when(part == name, F.col("value"))).alias(f"_{name}") for name in ("source", "platform", "attribute"))
    )
    wanted = described.where("_source = 'deployment' and _attribute = 'deployedHeight'").join(site_of, ids)
    at_site = deployments.withColumnRenamed("platform", "site")
    heights = wanted.join(at_site, "site").where(F.col("deployment_id").contains(F.col("_platform")))
    return resolved.unionByName(
        heights.select(
            *ids,
            F.col("outer").alias("parameter"),
            F.lit("value").alias("role"),
            F.col("height").cast("string").alias("value"),
            "start",
            "end",
        )
    )


def input_problems(arguments: DataFrame) -> DataFrame:
    """Named inputs that do not name exactly one dataset."""
    ids = ["dataset", "configuration", "position", "parameter"]
    return arguments.where("role = 'input'").groupBy(*ids).agg(F.count("*").alias("n")).where("n > 1")


def references(arguments: DataFrame) -> DataFrame:
    """What datasets refer to, for ``operators.graph.dependency_edges``: (dataset, parameter, depends_on)."""
    return arguments.where("role in ('input', 'dependency')").select(
        "dataset", "parameter", F.col("value").alias("depends_on")
    )


def sites(items: DataFrame) -> DataFrame:
    """One row per site."""
    return items.select(
        last_segment("@id").alias("site"),
        F.get("identifier", F.lit(0)).alias("short_code"),
        F.get("label", F.lit(0)).alias("name"),
        last_segment(F.get("utilisedBy", F.lit(0))["@id"]).alias("network"),
        "easting",
        "northing",
        "lat",
        F.col("long").alias("lon"),
        "altitude",
        _time(F.col("operatingPeriod.startDate")).alias("start"),
        _time(F.col("operatingPeriod.endDate")).alias("end"),
    )


def annotations(items: DataFrame) -> DataFrame:
    """Annotations as rows (id, property, start, end, value); plain values have neither start nor end."""
    each = items.select(F.col("@id").alias("id"), F.explode("hasAnnotation").alias("note")).select(
        "id", parameter_name(F.col("note.property.@id")).alias("property"), "note"
    )
    held = F.coalesce(
        F.get(text_values(F.col("note.hasValue.value")), F.lit(0)),
        F.get(referenced_ids(F.col("note.hasValue.valueReference")), F.lit(0)),
    )
    nothing = F.lit(None).cast("timestamp_ntz")
    plain = each.select("id", "property", nothing.alias("start"), nothing.alias("end"), held.alias("value"))
    dated = each.select("id", "property", F.explode("note.hasValueSeries.hasCurrentValue").alias("part")).select(
        "id",
        "property",
        _time(F.col("part.interval.startDate")).alias("start"),
        _time(F.col("part.interval.endDate")).alias("end"),
        F.get(text_values(F.col("part.value")), F.lit(0)).alias("value"),
    )
    return plain.where("value is not null").unionByName(dated)


def deployments(items: DataFrame) -> DataFrame:
    """Deployments of instruments: (deployment_id, platform, start, end, height)."""
    return items.select(
        F.col("@id").alias("deployment_id"),
        last_segment("deployedOnPlatform").alias("platform"),
        _time(F.col("startedAtTime")).alias("start"),
        _time(F.col("endedAtTime")).alias("end"),
        F.col("deployedHeight").alias("height"),
    )


# --- Which sites, which datasets, which windows ------------------------------------------------------------------


def active_sites(sites: DataFrame, window_start: TimeLike, window_end: TimeLike) -> DataFrame:
    """Sites that operated in the window of days; a missing start or end is no limit."""
    day_after = F.date_trunc("day", at(window_end)).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    first_day = F.date_trunc("day", at(window_start)).cast("timestamp_ntz")
    started = F.col("start").isNull() | (F.col("start") < day_after)
    going = F.col("end").isNull() | (F.col("end") > first_day)
    return sites.where(started & going)


def network_sites(sites: DataFrame, network: str, named: DataFrame | None = None) -> DataFrame:
    """The sites of a network, or those ``named`` (site): of these, a site of another network is dropped, one of none is
    kept."""
    if named is None:
        return sites.where(F.col("network") == network)
    in_network = F.col("network").isNull() | (F.col("network") == network)
    return sites.where(in_network).join(named.select("site").distinct(), "site", "left_semi")


def select_datasets(
    datasets: DataFrame,
    sites: DataFrame | None = None,
    variables: list[str] | None = None,
    periodicities: list[str] | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Datasets by id (dataset), or processed ones by site (site), variable and periodicity. What is not given is not
    limited."""
    if ids is not None:
        return datasets.join(ids.select("dataset").distinct(), "dataset", "left_semi")
    chosen = datasets.where("processing_level = 'processed'")
    if sites is not None:
        chosen = chosen.join(sites.select("site").distinct(), "site", "left_semi")
    if variables:
        chosen = chosen.where(F.col("variable").isin(*variables))
    if periodicities:
        chosen = chosen.where(F.col("periodicity").isin(*periodicities))
    return chosen


def site_years(sites: DataFrame, today: dt.date | str) -> DataFrame:
    """One window per site and calendar year of its life, up to today: (site, start, end). Sites without a start have
    none; see ``sites_without_start``."""
    first = F.to_date("start")
    last = F.least(F.coalesce(F.to_date("end"), F.lit(str(today)).cast("date")), F.lit(str(today)).cast("date"))
    lived = sites.select("site", first.alias("first"), last.alias("last")).where("first <= last")
    years = lived.withColumn("year", F.explode(F.sequence(F.year("first"), F.year("last"))))
    return years.select(
        "site",
        F.greatest("first", F.make_date("year", F.lit(1), F.lit(1))).alias("start"),
        F.least("last", F.make_date("year", F.lit(12), F.lit(31))).alias("end"),
    )


def sites_without_start(sites: DataFrame) -> DataFrame:
    return sites.where("start is null")


def clamped_start(sites: DataFrame, requested: TimeLike, by: list[str] = ()) -> DataFrame:
    """The requested start, or the first opening of any of the sites if that is later, in column ``start``: one row, or
    one for each value of ``by``. Unchanged where any site has no start."""
    known = F.when(F.count_if(F.col("start").isNull()) == 0, F.min(F.date_trunc("day", "start").cast("timestamp_ntz")))
    return sites.groupBy(*by).agg(F.greatest(at(requested), known).alias("start"))
