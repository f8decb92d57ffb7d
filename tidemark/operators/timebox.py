"""Time-boxed series and incremental, bucket-by-bucket refresh.

The reference runs one query per bucket. Here a whole range is one filtered
scan and one ``groupBy(bucket)``; a closed window (``[from, to]``) is kept
exact by giving a row that sits on a boundary to both buckets it touches.
Refresh is an anti-join + union on the bucket key, and only buckets that are
missing or still open are aggregated again.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.arith import count_when
from ..functions.time import (
    bucket_of,
    is_bucket_start,
    next_bucket,
    time_range,
    time_type,
)
from .buckets import BUCKET, _bucket_value, _shift, densify, spine_between
from .changes import days_of_buckets, in_days

EMPTY_POLICIES = ("zero", "null", "omit")


def assign_buckets(df: DataFrame, ts: str, starts, ends, grain: str = "day",
                   closed: str = "left") -> DataFrame:
    """Rows of ``df`` inside the range, with a ``bucket`` column.

    ``closed='left'``: bucket ``b`` holds ``[b, next(b))``.
    ``closed='both'``: bucket ``b`` holds ``[b, next(b)]``, so a row exactly on
    a boundary belongs to the bucket it ends and the one it starts; it is
    emitted twice (``explode`` of a 1- or 2-element array) and then clipped
    to the range. The range filter is on the raw column (pushed down).
    """
    if closed not in ("left", "both"):
        raise ValueError("closed must be 'left' or 'both'")
    dtype = time_type(df, ts)
    start, end = _bucket_value(starts, grain), _bucket_value(ends, grain)
    stop = _shift(end, grain, 1)
    if closed == "left":
        return df.where(time_range(df, ts, start, stop)).withColumn(BUCKET, bucket_of(ts, grain))
    rows = df.where(time_range(df, ts, start, stop, hi_inclusive=True))
    own = bucket_of(ts, grain)
    both = F.when(is_bucket_start(ts, grain, dtype), F.array(next_bucket(own, grain, -1), own))
    rows = rows.withColumn(BUCKET, F.explode(both.otherwise(F.array(own))))
    return rows.where((F.col(BUCKET) >= F.lit(start)) & (F.col(BUCKET) <= F.lit(end)))


def _closed_counts(df: DataFrame, ts: str, starts, ends, grain: str,
                   metrics: Mapping[str, Column]) -> DataFrame:
    """Counts of closed windows: rows are reduced to (own bucket, on the
    boundary) first, and only those few are emitted for both of their buckets."""
    start, end = _bucket_value(starts, grain), _bucket_value(ends, grain)
    rows = df.where(time_range(df, ts, start, _shift(end, grain, 1), hi_inclusive=True))
    counted = (rows.groupBy(bucket_of(ts, grain).alias("__own"), is_bucket_start(ts, grain, time_type(df, ts)).alias("__edge"))
               .agg(*[count_when(p).alias(k) for k, p in metrics.items()]))
    own = F.col("__own")
    both = F.when(F.col("__edge"), F.array(next_bucket(own, grain, -1), own)).otherwise(F.array(own))
    return (counted.withColumn(BUCKET, F.explode(both)).drop("__own", "__edge")
            .where((F.col(BUCKET) >= F.lit(start)) & (F.col(BUCKET) <= F.lit(end))))


def time_boxed(df: DataFrame, ts: str, starts, ends, grain: str = "day",
               metrics: Mapping[str, Column] | None = None,
               aggs: Mapping[str, Column] | None = None,
               closed: str = "left", empty: str = "omit",
               where: Column | None = None,
               only_buckets: DataFrame | None = None) -> DataFrame:
    """One row per bucket from ``starts`` to ``ends`` (inclusive).

    ``metrics``: output name -> predicate, counted as ``SUM(IF(p,1,0))``;
    ``aggs``: output name -> any aggregate expression. ``empty`` is the
    policy for a bucket with no input rows: ``'zero'`` (COALESCE),
    ``'null'`` (an ungrouped SUM) or ``'omit'`` (a plain GROUP BY).
    ``only_buckets`` (a DataFrame with a ``bucket`` column) restricts the
    work to those buckets. It is clipped to the range and made distinct, so
    it has at most as many rows as the range has buckets, and AQE picks the join.
    """
    if empty not in EMPTY_POLICIES:
        raise ValueError(f"empty must be one of {EMPTY_POLICIES}")
    if where is not None:
        df = df.where(where)
    reduced = closed == "both" and bool(metrics) and not aggs
    if reduced:
        rows = _closed_counts(df, ts, starts, ends, grain, metrics)
    else:
        rows = assign_buckets(df, ts, starts, ends, grain, closed)
    if only_buckets is not None:
        s, e = _bucket_value(starts, grain), _bucket_value(ends, grain)
        only_buckets = (only_buckets.select(BUCKET)
                        .where((F.col(BUCKET) >= F.lit(s)) & (F.col(BUCKET) <= F.lit(e))).distinct())
        rows = rows.join(only_buckets, BUCKET, "left_semi")
    exprs = [F.sum(k).cast("bigint").alias(k) if reduced else count_when(p).alias(k)
             for k, p in (metrics or {}).items()]
    exprs += [e.alias(k) for k, e in (aggs or {}).items()]
    if not exprs:
        raise ValueError("time_boxed needs at least one metric")
    out = rows.groupBy(BUCKET).agg(*exprs)
    if empty == "omit":
        return out
    spine = spine_between(df.sparkSession, starts, ends, grain)
    if only_buckets is not None:
        spine = spine.join(only_buckets, BUCKET, "left_semi")
    return densify(spine, out, fill=0 if empty == "zero" else None)


# ------------------------------------------------------------------ refresh ---

def _metric_cols(stored: DataFrame, key: str) -> list[str]:
    return [c for c in stored.columns if c != key]


def kept_buckets(stored: DataFrame, cutoff, starts=None, ends=None, grain: str = "day",
                 key: str = BUCKET) -> DataFrame:
    """Stored rows that stay as they are.

    A stored row whose metrics are all NULL counts as not stored. Inside the
    refresh range a bucket is kept only while its end is before ``cutoff``
    (the reference recomputes every bucket ending on or after the first of
    the current month); outside the range every valid stored row is kept.
    """
    metrics = _metric_cols(stored, key)
    valid = stored.dropna(how="all", subset=metrics) if metrics else stored
    cut = _bucket_value(cutoff, "day")
    closed_bucket = next_bucket(F.col(key), grain) < F.lit(cut)
    if starts is None and ends is None:
        return valid.where(closed_bucket)
    inside = F.lit(True)
    if starts is not None:
        inside = inside & (F.col(key) >= F.lit(_bucket_value(starts, grain)))
    if ends is not None:
        inside = inside & (F.col(key) <= F.lit(_bucket_value(ends, grain)))
    return valid.where(~inside | closed_bucket)


def incremental_refresh(stored: DataFrame, fresh: DataFrame, cutoff, starts=None, ends=None,
                        grain: str = "day", key: str = BUCKET) -> DataFrame:
    """Upsert by bucket: kept stored rows plus fresh rows for every other bucket.

    Equal to a full rebuild when stored and fresh agree. ``fresh`` must have
    the stored columns (checked by :func:`schema_drift` first).
    """
    kept = kept_buckets(stored, cutoff, starts, ends, grain, key)
    recomputed = fresh.join(kept.select(key), key, "left_anti")
    return kept.unionByName(recomputed.select(*stored.columns))


def buckets_to_refresh(stored: DataFrame, starts, ends, cutoff, grain: str = "day",
                       key: str = BUCKET) -> DataFrame:
    """Buckets of ``[starts, ends]`` that must be aggregated again."""
    spark = stored.sparkSession
    spine = spine_between(spark, starts, ends, grain, name=key)
    return spine.join(kept_buckets(stored, cutoff, starts, ends, grain, key).select(key),
                      key, "left_anti")


def first_open_bucket(stored: DataFrame, starts, ends, cutoff, grain: str = "day",
                      key: str = BUCKET) -> _dt.date:
    """The earliest bucket of the range that must be aggregated again; ``ends``'s
    bucket if none is. Reads the stored series only, and one row of the result."""
    first = buckets_to_refresh(stored, starts, ends, cutoff, grain, key).agg(F.min(key)).first()[0]
    return first or _bucket_value(ends, grain)


def refresh_series(stored: DataFrame, df: DataFrame, ts: str, starts, ends, cutoff,
                   grain: str = "day", metrics: Mapping[str, Column] | None = None,
                   aggs: Mapping[str, Column] | None = None, closed: str = "left",
                   empty: str = "omit", where: Column | None = None) -> DataFrame:
    """Incremental refresh that aggregates only missing or open buckets, and reads only
    their days: a list of day partitions, or ranges of the time column
    (literals of the scan). One value for each of these buckets comes to the driver."""
    todo = buckets_to_refresh(stored, starts, ends, cutoff, grain)
    buckets = sorted(r[0] for r in todo.collect())
    near = in_days(df, ts, days_of_buckets(buckets, grain, closed))
    first = buckets[0] if buckets else ends
    fresh = time_boxed(near, ts, first, ends, grain, metrics, aggs, closed, empty, where, only_buckets=todo)
    return incremental_refresh(stored, fresh, cutoff, starts, ends, grain)


# -------------------------------------------------------------------- drift ---

def schema_drift(stored: DataFrame | StructType, fresh: DataFrame | StructType,
                 key: str = BUCKET) -> list[tuple[str, str | None, str | None, str]]:
    """Column-by-column comparison of two series schemas.

    Returns ``(column, stored_type, fresh_type, status)`` with status
    ``same``, ``added`` (only in fresh), ``dropped`` (only in stored) or
    ``retyped``. This is schema metadata, so it is a plain list.
    """
    s = stored.schema if isinstance(stored, DataFrame) else stored
    f = fresh.schema if isinstance(fresh, DataFrame) else fresh
    st = {x.name: x.dataType.simpleString() for x in s.fields}
    ft = {x.name: x.dataType.simpleString() for x in f.fields}
    out = []
    for name in list(st) + [n for n in ft if n not in st]:
        a, b = st.get(name), ft.get(name)
        status = ("same" if a == b else "added" if a is None else
                  "dropped" if b is None else "retyped")
        out.append((name, a, b, status))
    return out


def has_drift(stored, fresh, key: str = BUCKET) -> bool:
    return any(r[3] != "same" for r in schema_drift(stored, fresh, key))


def refresh_with_drift(stored: DataFrame, fresh: DataFrame, cutoff, starts=None, ends=None,
                       grain: str = "day", force: bool = False, key: str = BUCKET) -> DataFrame:
    """Refresh, but rebuild from ``fresh`` when the series shape changed.

    Unlike the reference (which restarts from an already advanced date) the
    rebuild covers the full range. With ``force`` the stored rows are kept
    and aligned by name; columns missing on either side are NULL.
    """
    if not has_drift(stored, fresh, key):
        return incremental_refresh(stored, fresh, cutoff, starts, ends, grain, key)
    if not force:
        return fresh
    kept = kept_buckets(stored, cutoff, starts, ends, grain, key)
    recomputed = fresh.join(kept.select(key), key, "left_anti")
    return kept.unionByName(recomputed, allowMissingColumns=True)


# ---------------------------------------------------------------- schedule ---

FREQUENCY_SECONDS = {"daily": 86400, "hourly": 3600}


def due_reports(registry: DataFrame, history: DataFrame, now: _dt.datetime,
                force: bool = False) -> DataFrame:
    """Reports whose last run + their interval is before ``now``.

    ``registry(report, frequency)``, ``history(report, last_run TIMESTAMP)``.
    A report never run is due; an unknown frequency has interval 0. Output:
    ``report, frequency, last_run, due_at, due``.
    """
    freq = F.col("frequency")
    seconds = F.coalesce(*[F.when(freq == k, F.lit(v)) for k, v in FREQUENCY_SECONDS.items()],
                         F.lit(0))
    last = (history.groupBy("report").agg(F.max("last_run").alias("last_run")))
    epoch0 = F.lit("1970-01-01 00:00:00").cast("timestamp")
    out = registry.select("report", "frequency").join(last, "report", "left")
    due_at = F.coalesce(F.col("last_run"), epoch0) + F.make_dt_interval(secs=seconds)
    now_lit = F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    due = F.lit(True) if force else (due_at < now_lit)
    return out.select("report", "frequency", "last_run", due_at.alias("due_at"), due.alias("due"))


def record_runs(history: DataFrame, ran: DataFrame, now: _dt.datetime) -> DataFrame:
    """History after recording ``ran(report)`` at ``now``: latest run per report."""
    now_lit = F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    new = ran.select("report", now_lit.alias("last_run"))
    return (history.select("report", "last_run").unionByName(new)
            .groupBy("report").agg(F.max("last_run").alias("last_run")))
