"""Rolling windows and cohorts without range joins.

A trailing window ``[to - n days, to]`` evaluated for every bucket is a range
(theta) join in SQL, which Spark can only plan as a nested-loop join. Here a
row's contribution is a step function of the bucket instead: it starts at the
first bucket whose window holds the row and ends after the last, so it is two
differences however long the window is. Rows are first reduced to (key, day,
on-midnight) counts; running sums of the differences, per user and then over
all, give every bucket. No row is copied into the buckets of its window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arith import count_when, safe_ratio
from ..functions.time import bucket_of, time_range, time_type
from .buckets import BUCKET, _bucket_value, _shift, densify, spine_between

DAY = "_day"
MID = "_mid"
# Of a user: signups, edits, account rows, and of these mobile and desktop ones.
_MEASURES = ("_s", "_c", "_a", "_m", "_d")
_COUNTED = _MEASURES[2:]


def _day_counts(df: DataFrame, ts: str, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Rows reduced to (keys, day, is-midnight) with the given aggregates."""
    dtype = time_type(df, ts)
    day = F.to_date(ts)
    mid = F.col(ts) == day.cast(dtype)
    return (df.where(F.col(ts).isNotNull())
            .groupBy(*[F.col(k) for k in keys], day.alias(DAY), mid.alias(MID))
            .agg(*[e.alias(k) for k, e in aggs.items()]))


def _bucket_span(before: int, after: int, starts, ends) -> tuple[Column, Column]:
    """First and last bucket of the range whose window holds a day's rows: those
    (window end ``to = b + 1 day``) whose closed window ``[to - before days, to + after
    days]`` holds them.

    For a row on day ``d``: ``to`` runs from ``ceil(ts) - after`` to
    ``d + before``; ``ceil(ts)`` is ``d`` for a midnight row, else ``d + 1``.
    """
    d = F.col(DAY)
    ceil_day = F.when(F.col(MID), d).otherwise(F.date_add(d, 1))
    s, e = _bucket_value(starts, "day"), _bucket_value(ends, "day")
    return (F.greatest(F.date_sub(ceil_day, after + 1), F.lit(s)),
            F.least(F.date_add(d, before - 1), F.lit(e)))


def _window_filter(df: DataFrame, ts: str, starts, ends, before: int, after: int) -> DataFrame:
    """Rows that can fall in any window of the range (pushed to the scan)."""
    s, e = _bucket_value(starts, "day"), _bucket_value(ends, "day")
    first_to, last_to = _shift(s, "day", 1), _shift(e, "day", 1)
    lo, hi = _shift(first_to, "day", -before), _shift(last_to, "day", after)
    return df.where(time_range(df, ts, lo, hi, hi_inclusive=True))


# ---------------------------------------------------------------- ratio ---

def rolling_ratio(df: DataFrame, ts: str, measure: str, num_pred: Column, n: int,
                  starts, ends, where: Column | None = None, name: str = "ratio") -> DataFrame:
    """For each day ``D`` in ``[starts, ends]``: the share of ``measure`` from
    rows matching ``num_pred`` over the whole days ``D-n .. D-1``.

    ``SUM`` semantics: no matching rows -> NULL numerator -> NULL ratio; a
    zero or NULL denominator -> NULL. Every day of the range is present.
    """
    if where is not None:
        df = df.where(where)
    s, e = _bucket_value(starts, "day"), _bucket_value(ends, "day")
    df = df.where(time_range(df, ts, _shift(s, "day", -n), e))
    daily = df.groupBy(F.to_date(ts).alias(BUCKET)).agg(
        F.sum(F.when(num_pred, F.col(measure))).alias("_num"),
        F.sum(F.col(measure)).alias("_den"))
    # One row a day from here on: every day of the range and the n before it. Each
    # window is summed by itself, not as a difference of running sums, so
    # doubles stay as exact as they are.
    days = spine_between(df.sparkSession, _shift(s, "day", -n), e, "day").join(daily, BUCKET, "left")
    window = Window.orderBy(F.unix_date(BUCKET)).rangeBetween(-n, -1)
    sums = days.select(BUCKET, F.sum("_num").over(window).alias("_num"), F.sum("_den").over(window).alias("_den"))
    return sums.where(F.col(BUCKET) >= F.lit(s)).select(BUCKET, safe_ratio("_num", "_den").alias(name))


# --------------------------------------------------------------- cohort ---

def rolling_active_cohort(signups: DataFrame, edits: Sequence[DataFrame], accounts: DataFrame,
                          starts, ends, n: int = 30, min_edits: int = 5,
                          user: str = "user", ts: str = "ts", flag: str = "flag",
                          account_where: Column | None = None,
                          labels: tuple[str, str] = ("mobile", "desktop"),
                          account_before: int | None = None, account_after: int = 1) -> DataFrame:
    """Newly registered users who became active, by day bucket.

    For each day bucket ``b`` (window end ``to = b + 1 day``):
    1. users with a signup row in ``[to - n d, to]``;
    2. their rows over all ``edits`` tables in the same window, summed per
       user across tables, kept when ``>= min_edits``;
    3. their ``accounts`` rows with ``ts`` in ``[to - (n+1) d, to + 1 d]``
       (repeated rows fan out, as in an inner join);
    4. counts of rows with ``flag = 1`` and ``flag <> 1`` (NULL in neither).
    A bucket with no rows is NULL (an ungrouped SUM). ``signups``,
    ``edits`` and ``accounts`` carry columns ``user`` and ``ts``;
    ``accounts`` also ``flag``.

    Rows are reduced to (user, day) counts map-side. Signups, edits and accounts
    are then step functions of the bucket, each day's rows two differences; their
    running sums per user say in which buckets the user is active and how many account
    rows count there. What changes from one such step to the next is
    summed over the users, and a running sum over the days is the series.
    """
    before_acc = n + 1 if account_before is None else account_before
    mobile, desktop = labels
    acc = accounts if account_where is None else accounts.where(account_where)
    zero, one, is_mobile = F.lit(0), F.lit(1), F.col(flag)
    kinds = [(_window_filter(signups, ts, starts, ends, n, 0), (one, zero, zero, zero, zero))]
    kinds += [(_window_filter(t, ts, starts, ends, n, 0), (zero, one, zero, zero, zero)) for t in edits]
    kinds.append((_window_filter(acc, ts, starts, ends, before_acc, account_after),
                  (zero, zero, one, F.when(is_mobile == 1, 1).otherwise(0), F.when(is_mobile != 1, 1).otherwise(0))))
    rows = None
    for i, (t, values) in enumerate(kinds):
        part = t.select(F.col(user), F.col(ts), F.lit(i == len(kinds) - 1).alias("_acc"),
                        *[v.alias(c) for c, v in zip(_MEASURES, values)])
        rows = part if rows is None else rows.unionByName(part)
    per_day = _day_counts(rows.where(F.col(user).isNotNull()), ts, [user, "_acc"], {c: F.sum(c) for c in _MEASURES})
    spans = [F.when(F.col("_acc"), a).otherwise(w) for a, w in zip(
        _bucket_span(before_acc, account_after, starts, ends), _bucket_span(n, 0, starts, ends))]
    per_day = per_day.withColumns({"_lo": spans[0], "_hi": spans[1]}).where(F.col("_lo") <= F.col("_hi"))
    enter = per_day.select(user, F.col("_lo").alias(BUCKET), *_MEASURES)
    leave = per_day.select(user, F.date_add("_hi", 1).alias(BUCKET), *[(-F.col(c)).alias(c) for c in _MEASURES])
    steps = enter.unionAll(leave).repartition(user).groupBy(user, BUCKET).agg(*[F.sum(c).alias(c) for c in _MEASURES])
    upto = Window.partitionBy(user).orderBy(BUCKET)
    held = steps.select(user, BUCKET, *[F.sum(c).over(upto).alias(c) for c in _MEASURES])
    active = (F.col("_s") > 0) & (F.col("_c") >= min_edits)
    counted = held.select(user, BUCKET, *[F.when(active, F.col(c)).otherwise(0).alias(c) for c in _COUNTED])
    change = [(F.col(c) - F.lag(c, 1, 0).over(upto)).alias(c) for c in _COUNTED]
    moved = counted.select(BUCKET, *change).where(" or ".join(f"{c} != 0" for c in _COUNTED))
    daily = moved.groupBy(BUCKET).agg(*[F.sum(c).alias(c) for c in _COUNTED])
    # one row a day from here on; no account row of an active user: NULL
    so_far = Window.orderBy(BUCKET)
    dense = densify(spine_between(signups.sparkSession, starts, ends, "day"), daily, fill=0)
    series = dense.select(BUCKET, *[F.sum(c).over(so_far).cast("bigint").alias(c) for c in _COUNTED])
    return series.select(BUCKET, *[F.when(F.col("_a") > 0, F.col(c)).alias(label) for c, label in (("_m", mobile), ("_d", desktop))])


# ----------------------------------------------------------- thresholds ---

def threshold_groups(df: DataFrame, keys: Sequence[str], split: Mapping[str, Column],
                     min_exclusive: int | None = None, min_inclusive: int | None = None,
                     ts: str | None = None, grain: str = "day",
                     where: Column | None = None) -> DataFrame:
    """Count groups with enough rows, split by predicates on the group keys.

    Groups are ``keys`` (plus the bucket when ``ts`` is given); a group
    qualifies with ``count > min_exclusive`` or ``count >= min_inclusive``.
    ``split`` maps an output name to a predicate over the key columns; each
    output is ``SUM(IF(pred,1,0))`` over qualifying groups (NULL when none).
    """
    if where is not None:
        df = df.where(where)
    group = [F.col(k) for k in keys]
    if ts is not None:
        group.append(bucket_of(ts, grain).alias(BUCKET))
    counted = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    if min_exclusive is not None:
        counted = counted.where(F.col("_n") > min_exclusive)
    if min_inclusive is not None:
        counted = counted.where(F.col("_n") >= min_inclusive)
    aggs = [count_when(p).alias(label) for label, p in split.items()]
    if ts is None:
        return counted.agg(*aggs)
    return counted.groupBy(BUCKET).agg(*aggs)


# ---------------------------------------------------------- cohort count ---

def cohort_event_count(events: DataFrame, cohort: DataFrame, key: str, cohort_key: str,
                       ts: str, grain: str = "day", where: Column | None = None,
                       cohort_where: Column | None = None, name: str = "n") -> DataFrame:
    """Events of cohort members per bucket, as ``events INNER JOIN cohort``.

    A key repeated in ``cohort`` multiplies its events, like the inner join.
    Both sides are reduced first -- events to (key, bucket) counts, the
    cohort to (key, multiplicity) -- so a hot key is one row per bucket.
    """
    if where is not None:
        events = events.where(where)
    if cohort_where is not None:
        cohort = cohort.where(cohort_where)
    ev = (events.where(F.col(key).isNotNull())
          .groupBy(F.col(key).alias("_k"), bucket_of(ts, grain).alias(BUCKET))
          .agg(F.count(F.lit(1)).alias("_n")))
    members = (cohort.where(F.col(cohort_key).isNotNull())
               .groupBy(F.col(cohort_key).alias("_k")).agg(F.count(F.lit(1)).alias("_m")))
    joined = ev.join(members, "_k")
    return joined.groupBy(BUCKET).agg(F.sum(F.col("_n") * F.col("_m")).cast("bigint").alias(name))
