"""Re-run a plan for the days new data falls in, as the batch look-back does.

Rows may be restated at any time, so there is no watermark. Each micro-batch takes the days it touches, reads those days
and a margin either side from the store, runs the plan on them, and upserts the days touched. Running a batch twice
gives the same days, so a failed batch can be run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.session import cut_lineage
from tidemark.sources.store import DATE, read_days, upsert_days
from tidemark.spec import SeriesSpec


def reprocess_touched_days(
    stream: DataFrame,
    spec: SeriesSpec,
    raw_base: str,
    processed_base: str,
    plan: Callable[[DataFrame], tuple[DataFrame, SeriesSpec]],
    margin_days: int = 1,
) -> DataStreamWriter:
    """A stream writer: new raw rows go to the raw store, and the plan's result for their days to the processed store."""

    def run_batch(batch: DataFrame, _: int) -> None:
        batch = cut_lineage(batch)  # read several times below
        if batch.isEmpty():
            return
        upsert_days(batch, raw_base, spec)
        keys = list(spec.keys)
        days = batch.select(*keys, F.to_date(spec.time).alias("_day")).distinct()
        margin = F.sequence(F.date_sub("_day", margin_days), F.date_add("_day", margin_days))
        needed = days.select(*keys, F.explode(margin).alias(DATE)).distinct()
        first, last = needed.agg(F.min(DATE), F.max(DATE)).first()
        raw = read_days(batch.sparkSession, raw_base, first, last)
        raw = raw.withColumns({key: F.col(key).cast(batch.schema[key].dataType) for key in keys})
        result, result_spec = plan(raw.join(needed, [*keys, DATE], "left_semi").drop(DATE))
        touched = result.withColumn("_day", F.to_date(result_spec.time)).join(days, [*keys, "_day"], "left_semi")
        upsert_days(touched.drop("_day"), processed_base, result_spec)

    return stream.writeStream.foreachBatch(run_batch)
