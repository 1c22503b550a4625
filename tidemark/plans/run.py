"""Process a window of days: read the stored series, run the plans, save the results.

Datasets are stored by location. All datasets of one location lie next to each other in the same files, so they are read
together and written together.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections import Counter
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.align import merge_series, pad_together
from tidemark.operators.despike import LOOKBACK_DAYS, despike_with_lookback
from tidemark.plans.methods import Frame
from tidemark.plans.runner import DatasetPlan, RunResult, run_plans
from tidemark.session import cut_lineage
from tidemark.sources.store import DATE, counted, counts_of, read_days, upsert_days, widened, within_window
from tidemark.spec import SeriesSpec, check_same_cadence


@dataclass(frozen=True)
class Stored:
    """Where a dataset is stored: the location, and its key, time and value columns there."""

    base: str
    spec: SeriesSpec


@dataclass(frozen=True)
class Loaded:
    frames: dict[str, Frame]
    failed: dict[str, str] = field(default_factory=dict)


def load_stored(spark: SparkSession, datasets: dict[str, Stored], start: dt.date, end: dt.date) -> Loaded:
    """Read datasets for a window of days, each location once, and pad those that share keys, time and cadence on one grid.

    A dataset whose column no file has, or with values that padding would lose, fails alone; a location that cannot be
    read, or has nothing stored, fails with all its datasets.
    """
    frames, failed = {}, {}
    for base, names in _by_location({name: stored.base for name, stored in datasets.items()}).items():
        table = read_days(spark, base, start, end, schema=T.StructType([]))
        grids: dict[tuple, list[str]] = {}
        for name in names:
            spec = datasets[name].spec
            lacking = [column for column in (*spec.id_columns, spec.value) if column not in table.columns]
            if not table.columns:
                failed[name] = f"nothing stored at {base}"
            elif lacking:
                failed[name] = f"no column {lacking[0]} at {base}"
            else:
                grids.setdefault((tuple(spec.id_columns), spec.period), []).append(name)
        for (ids, _), group in grids.items():
            values = sorted({datasets[name].spec.value for name in group})
            padded, lost = pad_together(table.select(*ids, *values), datasets[group[0]].spec, values)
            for name in group:
                spec = datasets[name].spec
                if spec.value in lost:
                    failed[name] = f"rows off the grid at {base}"
                else:
                    frames[name] = Frame(padded.select(*ids, spec.value), spec)
    return Loaded(frames, failed)


def _by_location(bases: dict[str, str]) -> dict[str, list[str]]:
    grouped: dict[str, list[str]] = {}
    for name, base in bases.items():
        grouped.setdefault(base, []).append(name)
    return grouped


def merged_for_saving(result: RunResult, names: list[str]) -> tuple[DataFrame, SeriesSpec]:
    """The datasets of one location next to each other. They must agree on cadence."""
    series = [result.done[name] for name in names]
    check_same_cadence(*(one.spec for one in series))
    first = series[0].spec
    if len(series) == 1:
        return series[0].df, first
    return merge_series([(one.df, one.spec) for one in series]), first


@dataclass(frozen=True)
class Staged:
    """Datasets that go to one place together, written to the shared folder, and how many rows and values that job saw."""

    names: list[str]
    df: DataFrame
    spec: SeriesSpec
    seen: dict[str, int]

    def counts(self, result: RunResult) -> dict[str, dict[str, int]]:
        """Rows, values and missing values of each dataset."""
        values = {name: self.seen[result.done[name].spec.value] for name in self.names}
        return {name: {"rows": self.seen["rows"], "values": n, "missing": self.seen["rows"] - n} for name, n in values.items()}


def _staged(result: RunResult, names: list[str], start: dt.date, end: dt.date) -> Staged:
    df, spec = merged_for_saving(result, names)
    values = [result.done[name].spec.value for name in names]
    df, seen = counted(within_window(df, spec.time, start, end), f"saved {uuid.uuid4().hex}", values)
    return Staged(names, cut_lineage(df), spec, counts_of(seen, values))


def save_results(
    result: RunResult, outputs: dict[str, str], start: dt.date, end: dt.date
) -> tuple[dict[str, str], dict[str, dict[str, int]]]:
    """Save the datasets that have an output location, cut to the days asked for. Returns what failed, and the counts of what
    was saved, by dataset; the counts come from the job that computes the rows.

    Everything is computed and written to the shared folder before the first location is replaced, as locations may also
    be inputs. Where a group fails while running, its datasets are tried one by one, so that a bad one fails alone.
    """
    failed, counts = {}, {}
    staged: dict[str, list[Staged]] = {}
    saved = {name: base for name, base in outputs.items() if name in result.done}
    for base, names in _by_location(saved).items():
        try:
            staged[base] = [_staged(result, names, start, end)]
        except Exception as error:  # noqa: BLE001 - the others can still be saved
            good = []
            for name in names if len(names) > 1 else []:
                try:
                    good.append(_staged(result, [name], start, end))
                except Exception as own:  # noqa: BLE001
                    failed[name] = str(own)
            if len(good) == len(names) or len(names) == 1:
                # Each can be computed, so they do not go together.
                failed |= {name: str(error) for name in names}
            elif good:
                staged[base] = good
    for base, parts in staged.items():
        names = [name for part in parts for name in part.names]
        try:
            tables = [(part.df, part.spec) for part in parts]
            upsert_days(merge_series(tables) if len(tables) > 1 else tables[0][0], base, tables[0][1])
        except Exception as error:  # noqa: BLE001 - the other locations can still be saved
            failed |= {name: str(error) for name in names}
        else:
            for part in parts:
                counts |= part.counts(result)
    return failed, counts


def used_more_than_once(plans: dict[str, DatasetPlan], outputs: dict[str, str]) -> list[str]:
    """Datasets that several plans read, or one reads and one saves. They are kept while saving, not computed again. A
    lost executor only loses what it kept; that is computed anew."""
    uses = Counter(name for plan in plans.values() for name in plan.needs()) + Counter(outputs.keys())
    return sorted(name for name, times in uses.items() if times > 1)


def process_window(
    spark: SparkSession,
    plans: dict[str, DatasetPlan],
    inputs: dict[str, Stored],
    outputs: dict[str, str],
    start: dt.date,
    end: dt.date,
    margin_days: int = 1,
) -> RunResult:
    """Read, process and save a window of days, for all sites. The result has the counts of what was saved. Raises at the end
    if any dataset failed.

    A margin of days either side is read, so that buckets and moving windows at the edges are complete, and cut off again
    before saving.
    """
    loaded = load_stored(spark, inputs, *widened(start, end, margin_days))
    result = run_plans(plans, loaded.frames, loaded.failed)
    available = loaded.frames | {name: series.frame for name, series in result.done.items()}
    shared = [available[name].df for name in used_more_than_once(plans, outputs) if name in available]
    for df in shared:
        df.persist(StorageLevel.DISK_ONLY)
    try:
        unsaved, counts = save_results(result, outputs, start, end)
    finally:
        for df in shared:
            df.unpersist()
    failed = result.failed | unsaved
    final = RunResult({name: series for name, series in result.done.items() if name not in failed}, failed, counts)
    final.raise_if_failed()
    return final


def despike_days(
    spark: SparkSession, base: str, spec: SeriesSpec, start: dt.date, end: dt.date, columns: list[str], radiation: str, **settings
) -> DataFrame:
    """Stored flux series of some days without spikes. Only the folders of those days and of the look-back are opened."""
    lookback = settings.get("lookback_days", LOOKBACK_DAYS)
    stored = read_days(spark, base, start - dt.timedelta(days=lookback), end).drop(DATE)
    return despike_with_lookback(stored, spec, start, end, columns, radiation, **settings)
