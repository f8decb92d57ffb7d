"""Count reports as data, and one scan for all of them that read a table.

A :class:`Part` says what is counted per bucket of one logical table; a report
is a few parts and a function that makes the series of them. One part
alone is one grouped scan. :func:`shared_series` computes the parts of any
number of reports in one grouped scan per table: counts add up, so the rows are
reduced to one row a day (and one for midnight rows, which closed windows need
twice) with a conditional count for each metric of each part, and every
series -- of days or months, half-open or closed, whatever its range -- follows
from those few rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arith import count_when
from ..functions.time import bucket_of, is_bucket_start, next_bucket, time_range, time_type
from ..operators.buckets import BUCKET, _bucket_value, _shift, bucket_pivot
from ..operators.timebox import time_boxed
from ..session import scratch_dir

DAY, EDGE = "_day", "_edge"


@dataclass(frozen=True)
class Part:
    """Conditional counts per bucket of ``table``'s rows that satisfy ``where``.

    ``metrics``: name -> predicate; ``total``: name of the count of all those
    rows; ``start``, ``end``: first and last bucket (both or none).
    A bucket without such rows has no row.
    """
    table: str
    metrics: Mapping[str, Column] = field(default_factory=dict)
    where: Column | None = None
    total: str | None = None
    grain: str = "day"
    start: _dt.date | None = None
    end: _dt.date | None = None
    closed: str = "left"

    def columns(self) -> list[str]:
        return ([self.total] if self.total else []) + list(self.metrics)

    def days(self) -> tuple[_dt.date, _dt.date] | None:
        """The days whose rows count; the second is excluded but for its midnight if closed."""
        if self.start is None:
            return None
        return _bucket_value(self.start, self.grain), _shift(_bucket_value(self.end, self.grain), self.grain, 1)


@dataclass(frozen=True)
class CountPlan:
    parts: tuple[Part, ...]
    finish: Callable[[SparkSession, Sequence[DataFrame]], DataFrame]


def series_of(df: DataFrame, part: Part, ts: str = "ts") -> DataFrame:
    """The part's series by a scan of its own."""
    if part.closed == "both":
        if part.total:
            raise ValueError("a closed part has no total")
        return time_boxed(df, ts, part.start, part.end, part.grain, part.metrics, closed="both", where=part.where)
    return bucket_pivot(df, ts, part.grain, part.metrics, total=part.total, where=part.where, start=part.start, end=part.end)


def run_counts(tables: Mapping[str, DataFrame], plan: CountPlan) -> DataFrame:
    series = [series_of(tables[p.table], p) for p in plan.parts]
    return plan.finish(series[0].sparkSession, series)


def daily_counts(df: DataFrame, parts: Sequence[Part], ts: str = "ts") -> DataFrame:
    """One grouped scan: ``_day``, ``_edge`` (midnight rows) and for part ``i`` its rows
    ``n{i}`` and metrics ``m{i}_{j}``.

    The scan is bounded by the parts' days together, and by their conditions
    if all have one; both reach the source.
    """
    days = [p.days() for p in parts]
    if all(days):
        closed = any(p.closed == "both" for p in parts)
        df = df.where(time_range(df, ts, min(d[0] for d in days), max(d[1] for d in days), hi_inclusive=closed))
    conditions = [p.where for p in parts]
    if all(c is not None for c in conditions):
        df = df.where(reduce(or_, conditions))
    aggs = []
    for i, p in enumerate(parts):
        rows = F.lit(True) if p.where is None else p.where
        aggs.append(count_when(rows).alias(f"n{i}"))
        aggs += [count_when(rows & pred).alias(f"m{i}_{j}") for j, pred in enumerate(p.metrics.values())]
    edge = is_bucket_start(ts, "day", time_type(df, ts)) if any(p.closed == "both" for p in parts) else F.lit(False)
    return df.groupBy(bucket_of(ts, "day").alias(DAY), edge.alias(EDGE)).agg(*aggs)


def part_of(daily: DataFrame, i: int, part: Part) -> DataFrame:
    """Series of part ``i`` of the table that ``daily`` counts: the same rows as :func:`series_of`."""
    own = bucket_of(DAY, part.grain)
    rows = daily.where(F.col(f"n{i}") > 0)
    if part.closed == "both":
        # a midnight row that starts a bucket ends the one before it
        starts_one = F.col(EDGE) & (F.col(DAY) == own)
        both = F.when(starts_one, F.array(next_bucket(own, part.grain, -1), own)).otherwise(F.array(own))
        rows = rows.withColumn(BUCKET, F.explode(both))
    else:
        rows = rows.withColumn(BUCKET, own)
    if part.start is not None:
        rows = rows.where(F.col(BUCKET).between(F.lit(_bucket_value(part.start, part.grain)), F.lit(_bucket_value(part.end, part.grain))))
    counted = ([F.sum(f"n{i}").alias(part.total)] if part.total else []) + [
        F.sum(f"m{i}_{j}").alias(k) for j, k in enumerate(part.metrics)]
    return rows.groupBy(BUCKET).agg(*counted)


def shared_series(tables: Mapping[str, DataFrame], plans: Mapping[str, CountPlan]) -> dict[str, DataFrame]:
    """The series of every plan, each table scanned once.

    A table's daily counts (two rows a day at most) are computed here and
    written to the shared folder; the series are built of what is
    read back there.
    """
    by_table: dict[str, list[Part]] = {}
    place: dict[str, list[tuple[str, int]]] = {}
    for name, plan in plans.items():
        for part in plan.parts:
            parts = by_table.setdefault(part.table, [])
            place.setdefault(name, []).append((part.table, len(parts)))
            parts.append(part)
    counted = {}
    for name, parts in by_table.items():
        daily = daily_counts(tables[name], parts)
        path = scratch_dir(daily.sparkSession, f"daily-{name}")
        daily.write.parquet(path)
        counted[name] = daily.sparkSession.read.schema(daily.schema).parquet(path)
    return {name: plan.finish(counted[plan.parts[0].table].sparkSession,
                              [part_of(counted[t], i, by_table[t][i]) for t, i in place[name]])
            for name, plan in plans.items()}
