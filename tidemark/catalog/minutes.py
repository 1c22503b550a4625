"""Queries over a series of one value a minute, whose sites span three chunks of slots each."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import UNIT, q6, query, r6, table
from tidemark.functions.times import slot, slot_start
from tidemark.operators import aggregate
from tidemark.operators.align import pad
from tidemark.plans.methods import Frame, Settings, get_method
from tidemark.spec import Period, SeriesSpec

MINUTE = Period.parse("PT1M")
SPEC = SeriesSpec.of("PT1M")

PADDED = f"""minutely AS (SELECT event_type AS site, date_trunc('minute', ts) AS time, avg(value) * {UNIT} AS value FROM events GROUP BY 1, 2),
ends AS (SELECT site, min(time) AS lo, max(time) AS hi FROM minutely GROUP BY site),
grid AS (SELECT site, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS time FROM ends),
padded AS (SELECT g.site, g.time, m.value FROM grid g LEFT JOIN minutely m USING (site, time))"""


def padded(spark, folder) -> Frame:
    events = table(spark, folder, "events")
    events = events.select(F.col("event_type").alias("site"), slot_start(slot("ts", MINUTE), MINUTE).alias("time"), "value")
    return Frame(pad(events.groupBy("site", "time").agg((F.avg("value") * UNIT).alias("value")), SPEC), SPEC)


@query(
    "minutes_rolling",
    f"""WITH {PADDED}, rolled AS (SELECT site, time, avg(value) OVER w AS mean, count(value) OVER w AS n,
      row_number() OVER (PARTITION BY site ORDER BY time) AS up FROM padded
      WINDOW w AS (PARTITION BY site ORDER BY time ROWS BETWEEN 719 PRECEDING AND CURRENT ROW))
    SELECT site, time, {q6("CASE WHEN up > 719 AND n >= 3 THEN mean END")} AS value, n FROM rolled""",
)
def minutes_rolling(spark, folder):
    """Means of twelve hours."""
    params = {"window_size": "PT12H", "threshold": 3, "alignment": "trailing"}
    rolled = aggregate.rolling_mean(padded(spark, folder), Settings("rolling_mean_for_counts", params))
    return rolled.select("site", "time", r6("value").alias("value"), F.col("count_value").alias("n"))


@query(
    "minutes_filled",
    f"""WITH {PADDED}, nearest AS (SELECT *, epoch_us(time) / 60000000 AS m,
      last_value(value IGNORE NULLS) OVER back AS v0, last_value(CASE WHEN value IS NOT NULL THEN epoch_us(time) / 60000000 END IGNORE NULLS) OVER back AS m0,
      first_value(value IGNORE NULLS) OVER ahead AS v1, first_value(CASE WHEN value IS NOT NULL THEN epoch_us(time) / 60000000 END IGNORE NULLS) OVER ahead AS m1
      FROM padded WINDOW back AS (PARTITION BY site ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        ahead AS (PARTITION BY site ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT site, time, {q6("CASE WHEN value IS NULL AND m1 - m0 - 1 <= 600 THEN v0 + (v1 - v0) * ((m - m0) / (m1 - m0)) ELSE value END")} AS value
    FROM nearest""",
)
def minutes_filled(spark, folder):
    """Gaps of up to ten hours; some reach over the edge of a chunk."""
    frame = padded(spark, folder)
    filled = get_method("infill", "linear_interp")(frame, Settings("linear_interp", {"max_gap_size": 600}))
    return filled.select("site", "time", r6("value").alias("value"))


@query(
    "minutes_spikes",
    f"""WITH {PADDED}, known AS (SELECT site, time, coalesce(value, 0) AS value FROM padded),
    around AS (SELECT *, value - lag(value) OVER w AS rise, lead(value) OVER w - value AS fall FROM known WINDOW w AS (PARTITION BY site ORDER BY time))
    SELECT site, time, CASE WHEN rise IS NOT NULL AND fall IS NOT NULL THEN rise * fall < 0 AND least(abs(rise), abs(fall)) > 90 END AS failed FROM around""",
)
def minutes_spikes(spark, folder):
    """Minutes without an event count as zero."""
    frame = padded(spark, folder)
    known = Frame(frame.df.withColumn("value", F.coalesce("value", F.lit(0.0))), frame.spec)
    checked = get_method("quality_control", "spike")(known, Settings("spike", {"gt": 90}))
    return checked.select("site", "time", F.col("_failed").alias("failed"))
