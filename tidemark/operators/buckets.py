"""Time-bucketed counting: spines, conditional counts, distinct counts,
densification, latest buckets and funnels.

Plan shape for every counting operator: a range filter on the raw time column
(pushed to the Parquet scan), a projection to the few columns used, one
``groupBy(bucket)`` whose partial aggregate runs map-side, and -- for dense
series -- a left join of a spine that has at most ``n`` rows. Several
predicates over one table are one conditional aggregate, never one scan each.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arith import count_rows, count_when
from ..functions.time import (
    _check_grain,
    bucket_of,
    time_range,
    to_date_value,
)

BUCKET = "bucket"


# ---------------------------------------------------------------- spines ---

def _step(grain: str) -> Column:
    _check_grain(grain)
    return F.expr("INTERVAL 1 DAY") if grain == "day" else F.expr("INTERVAL 1 MONTH")


def _bucket_value(value, grain: str) -> _dt.date:
    day = to_date_value(value)
    return day if grain == "day" else day.replace(day=1)


def _shift(day: _dt.date, grain: str, steps: int) -> _dt.date:
    if grain == "day":
        return day + _dt.timedelta(days=steps)
    month = day.year * 12 + (day.month - 1) + steps
    return _dt.date(month // 12, month % 12 + 1, 1)


def spine_bounds(as_of, n: int, grain: str = "day") -> tuple[_dt.date, _dt.date]:
    """First and last bucket of an ``n``-bucket calendar ending at ``as_of``."""
    if n < 1:
        raise ValueError("a spine needs n >= 1")
    end = _bucket_value(as_of, grain)
    return _shift(end, grain, -(n - 1)), end


def date_spine(spark: SparkSession, as_of, n: int, grain: str = "day",
               order: str | None = None, name: str = BUCKET) -> DataFrame:
    """``n`` consecutive buckets ending with the bucket of ``as_of``.

    Generated from a range of numbers: no row source, no cross join, and
    its size is exactly ``n`` (safe to broadcast).
    """
    start, end = spine_bounds(as_of, n, grain)
    return spine_between(spark, start, end, grain, order=order, name=name)


def spine_between(spark: SparkSession, start, end, grain: str = "day",
                  order: str | None = None, name: str = BUCKET) -> DataFrame:
    """Every bucket from ``start`` to ``end`` inclusive (literal bounds)."""
    s, e = _bucket_value(start, grain), _bucket_value(end, grain)
    if s > e:  # an empty range is an empty calendar, not an error
        return spark.createDataFrame([], f"{name} date")
    steps = (e - s).days if grain == "day" else (e.year - s.year) * 12 + e.month - s.month
    step = F.col("id").cast("int")
    bucket = F.date_add(F.lit(s), step) if grain == "day" else F.add_months(F.lit(s), step)
    return _order(spark.range(0, steps + 1, 1, 1).select(bucket.alias(name)), order, name)


def data_spine(df: DataFrame, ts: str, grain: str = "day", order: str | None = None,
               name: str = BUCKET) -> DataFrame:
    """Every bucket from the first to the last bucket present in ``df``.

    The bounds are an aggregate computed on the cluster (min/max, partial
    per task); nothing is collected to the driver.
    """
    b = bucket_of(ts, grain)
    bounds = df.select(b.alias("_b")).agg(F.min("_b").alias("_s"), F.max("_b").alias("_e"))
    out = bounds.where(F.col("_s").isNotNull()).select(
        F.explode(F.sequence("_s", "_e", _step(grain))).alias(name))
    return _order(out, order, name)


def _order(df: DataFrame, order: str | None, name: str) -> DataFrame:
    if order is None:
        return df
    if order not in ("asc", "desc"):
        raise ValueError("order must be 'asc', 'desc' or None")
    return df.orderBy(F.col(name).asc() if order == "asc" else F.col(name).desc())


# ------------------------------------------------------------- filtering ---

def in_range(df: DataFrame, ts: str, start=None, end=None, grain: str = "day") -> DataFrame:
    """Keep rows whose bucket lies in ``[start, end]`` (bucket keys, inclusive).

    Expressed on the raw column as ``ts >= start AND ts < next(end)`` so the
    bounds are literals of the column type and reach the Parquet scan.
    """
    if start is None and end is None:
        return df
    lo = _bucket_value(start, grain) if start is not None else None
    hi = _shift(_bucket_value(end, grain), grain, 1) if end is not None else None
    return df.where(time_range(df, ts, lo, hi))


# ------------------------------------------------------------ aggregates ---

def _prepare(df: DataFrame, ts: str, grain: str, where: Column | None,
             start, end) -> DataFrame:
    if where is not None:
        df = df.where(where)
    return in_range(df, ts, start, end, grain)


def bucket_counts(df: DataFrame, ts: str, grain: str = "day", where: Column | None = None,
                  name: str = "n", start=None, end=None) -> DataFrame:
    """Rows per bucket (``COUNT(*) ... GROUP BY DATE(ts)``); empty buckets absent."""
    df = _prepare(df, ts, grain, where, start, end)
    return df.groupBy(bucket_of(ts, grain).alias(BUCKET)).agg(count_rows().alias(name))


def bucket_pivot(df: DataFrame, ts: str, grain: str, metrics: Mapping[str, Column],
                 total: str | None = "Total", where: Column | None = None,
                 start=None, end=None, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Conditional counts per bucket in one scan.

    ``metrics`` maps an output name to a predicate; each becomes
    ``SUM(IF(pred,1,0))``. ``total`` adds ``COUNT(*)``. ``extra`` maps names
    to ready-made aggregate expressions. Empty buckets are absent.
    """
    df = _prepare(df, ts, grain, where, start, end)
    aggs = []
    if total:
        aggs.append(count_rows().alias(total))
    aggs += [count_when(pred).alias(label) for label, pred in metrics.items()]
    aggs += [expr.alias(label) for label, expr in (extra or {}).items()]
    return df.groupBy(bucket_of(ts, grain).alias(BUCKET)).agg(*aggs)


def bucket_distinct(df: DataFrame, ts: str, grain: str, key: str,
                    metrics: Mapping[str, Column], approx: bool = False,
                    where: Column | None = None, start=None, end=None,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct ``key`` per bucket for each predicate (``COUNT(DISTINCT ...)``).

    NULL keys are ignored. All metrics share the key, so rows are reduced once
    to (bucket, key) with one flag per metric -- map-side first, a hot bucket
    spreads over its keys, no row is copied per metric -- and the flags are
    summed per bucket. ``approx=True`` switches to HyperLogLog++ sketches,
    which merge map-side and need no key shuffle at all.
    """
    df = _prepare(df, ts, grain, where, start, end)
    bucket = bucket_of(ts, grain).alias(BUCKET)
    if approx:
        return df.groupBy(bucket).agg(*[
            F.approx_count_distinct(F.when(pred, F.col(key)), rsd).cast("bigint").alias(label)
            for label, pred in metrics.items()])
    # A bucket whose keys are all NULL still has a row, so NULL stays a key here.
    known = F.col(key).isNotNull()
    flags = [F.max(F.when(pred & known, F.lit(1)).otherwise(F.lit(0))).alias(f"_m{i}")
             for i, pred in enumerate(metrics.values())]
    per_key = df.groupBy(bucket, F.col(key).alias("_key")).agg(*flags)
    return per_key.groupBy(BUCKET).agg(*[F.sum(f"_m{i}").cast("bigint").alias(label)
                                         for i, label in enumerate(metrics)])


# --------------------------------------------------------------- density ---

def densify(spine: DataFrame, *series: DataFrame, fill=0, key: str = BUCKET) -> DataFrame:
    """Left-join each series onto the spine; missing metrics become ``fill``.

    ``fill=None`` keeps NULL (the reference's ungrouped SUM over an empty
    bucket). Each series should already be limited to the spine's range, so
    every join side has at most ``n`` rows; AQE turns them into broadcast
    joins from measured sizes.
    """
    out = spine
    for s in series:
        out = out.join(s, on=key, how="left")
    if fill is None:
        return out
    metric_cols = [c for s in series for c in s.columns if c != key]
    return out.select(key, *[F.coalesce(F.col(c), F.lit(fill)).alias(c) for c in metric_cols])


def dense_pivot(df: DataFrame, ts: str, grain: str, as_of, n: int,
                metrics: Mapping[str, Column], total: str | None = None,
                where: Column | None = None, fill=0,
                extra: Mapping[str, Column] | None = None) -> DataFrame:
    """``bucket_pivot`` over the ``n`` buckets ending at ``as_of``, with every
    bucket present (the reference's calendar LEFT JOIN + COALESCE)."""
    start, end = spine_bounds(as_of, n, grain)
    spine = spine_between(df.sparkSession, start, end, grain)
    agg = bucket_pivot(df, ts, grain, metrics, total=total, where=where,
                       start=start, end=end, extra=extra)
    return densify(spine, agg, fill=fill)


def dense_distinct(df: DataFrame, ts: str, grain: str, as_of, n: int, key: str,
                   metrics: Mapping[str, Column], where: Column | None = None,
                   approx: bool = False, fill=0) -> DataFrame:
    """``bucket_distinct`` over ``n`` buckets ending at ``as_of``, densified."""
    start, end = spine_bounds(as_of, n, grain)
    spine = spine_between(df.sparkSession, start, end, grain)
    agg = bucket_distinct(df, ts, grain, key, metrics, approx=approx, where=where,
                          start=start, end=end)
    return densify(spine, agg, fill=fill)


def latest_buckets(series: DataFrame, n: int, key: str = BUCKET) -> DataFrame:
    """The ``n`` newest buckets of a series (``ORDER BY key DESC LIMIT n``).

    Planned as TakeOrderedAndProject: each task keeps its own top ``n`` and
    only those reach the final merge.
    """
    return series.orderBy(F.col(key).desc()).limit(n)


# ---------------------------------------------------------------- funnel ---

def funnel_counts(df: DataFrame, ts: str, step_col: str, steps: Sequence[str],
                  grain: str = "day", where: Column | None = None,
                  start=None, end=None, labels: Sequence[str] | None = None) -> DataFrame:
    """Counts of each funnel step per bucket (``COALESCE(SUM(IF(step=..)),0)``).

    A bucket whose rows are all outside the steps still appears, with zeros,
    as in the grouped SQL.
    """
    labels = list(labels or steps)
    metrics = {label: F.col(step_col) == step for label, step in zip(labels, steps)}
    out = bucket_pivot(df, ts, grain, metrics, total=None, where=where, start=start, end=end)
    return out.select(BUCKET, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in labels])
