"""Column functions for time: parsing, bucketing, literals, bucket ends.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen and comparisons on the raw timestamp column reach the Parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

TS14 = "yyyyMMddHHmmss"
GRAINS = ("day", "month")
# Column metadata keys: the 14-digit text column a parsed time came from, and
# a day-partition column (DATE or 'yyyy-MM-dd' text) of the same rows.
TEXT_SOURCE = "tidemark.text_ts"
DAY_PARTITION = "tidemark.day_partition"


def _check_grain(grain: str) -> None:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")


def parse_ts(col: Column | str, ntz: bool = True) -> Column:
    """14-digit ``yyyyMMddHHmmss`` text to a timestamp; anything else -> NULL.

    Only text of exactly 14 digits parses, so for every parsed row the text
    order is the time order (see :func:`time_range`). The text is a
    wall-clock value, so the result is ``TIMESTAMP_NTZ`` (independent of the
    session time zone) unless ``ntz=False``.
    """
    text = _c(col)
    digits = text.rlike("^[0-9]{14}$")
    if not ntz:
        return F.when(digits, F.try_to_timestamp(text, F.lit(TS14)))

    def part(start: int, length: int) -> Column:
        return F.substring(text, start, length).cast("int")
    # Built from the digit groups: no time zone is involved, so a wall-clock
    # time that a zone skips (a daylight-saving gap) still parses exactly.
    # Invalid fields (month 13, 30 February, second 60) give NULL.
    wall = F.try_make_timestamp_ntz(years=part(1, 4), months=part(5, 2), days=part(7, 2),
                                    hours=part(9, 2), mins=part(11, 2), secs=part(13, 2))
    return F.when(digits & (part(13, 2) < 60), wall)


def with_parsed_ts(df, text_col: str, name: str = "ts", day_partition: str | None = None):
    """Add ``name`` parsed from the 14-digit text column ``text_col`` and
    remember the source, so time ranges also filter the text column --
    a plain string comparison that Parquet can prune row groups with.

    ``day_partition`` names a partition column holding each row's day
    (DATE or ``yyyy-MM-dd`` text); ranges then bound it too, so whole
    partitions are skipped (``PartitionFilters``)."""
    from pyspark.sql.types import StringType
    meta = {}
    if day_partition and day_partition in df.columns:
        meta[DAY_PARTITION] = day_partition
    if isinstance(df.schema[text_col].dataType, StringType):
        meta[TEXT_SOURCE] = text_col
        return df.withColumn(name, parse_ts(text_col).alias(name, metadata=meta))
    return df.withColumn(name, parse_ts(F.col(text_col).cast("string")).alias(name, metadata=meta))


def with_day_partition(df, ts: str, day_partition: str):
    """Mark an existing time column ``ts`` as partitioned by ``day_partition``."""
    meta = dict(df.schema[ts].metadata)
    meta[DAY_PARTITION] = day_partition
    return df.withColumn(ts, F.col(ts).alias(ts, metadata=meta))


def _text14(value) -> str:
    if isinstance(value, _dt.datetime):
        return value.strftime("%Y%m%d%H%M%S")
    return to_date_value(value).strftime("%Y%m%d") + "000000"


def time_range(df, ts: str, lo=None, hi=None, hi_inclusive: bool = False) -> Column:
    """``lo <= ts < hi`` (or ``<= hi``) as literals of the column type.

    When ``ts`` was parsed from 14-digit text (:func:`with_parsed_ts`) the
    same bounds are also applied to the text column: exact, because only
    14-digit text parses, and pushable to the Parquet scan.
    """
    dtype = time_type(df, ts)
    t = F.col(ts)
    conds = []
    if lo is not None:
        conds.append(t >= ts_literal(lo, dtype))
    if hi is not None:
        conds.append(t <= ts_literal(hi, dtype) if hi_inclusive else t < ts_literal(hi, dtype))
    part = df.schema[ts].metadata.get(DAY_PARTITION)
    if part and part in df.columns:
        # Whole days: a bound inside a day still needs that day's partition.
        p = F.col(part)
        is_text = not isinstance(df.schema[part].dataType, DateType)
        def day_lit(v):
            d = to_date_value(v)
            return F.lit(d.isoformat()) if is_text else F.lit(d)
        if lo is not None:
            conds.append(p >= day_lit(lo))
        if hi is not None:
            conds.append(p <= day_lit(hi))
    text = df.schema[ts].metadata.get(TEXT_SOURCE)
    if text and text in df.columns:
        x = F.col(text)
        if lo is not None:
            conds.append(x >= F.lit(_text14(lo)))
        if hi is not None:
            # Text has whole seconds: a fractional exclusive bound becomes
            # inclusive on the text (the exact bound is the one on ``ts``).
            frac = isinstance(hi, _dt.datetime) and hi.microsecond
            conds.append(x <= F.lit(_text14(hi)) if hi_inclusive or frac else x < F.lit(_text14(hi)))
    out = None
    for c in conds:
        out = c if out is None else out & c
    return F.lit(True) if out is None else out


def format_ts14(col: Column | str) -> Column:
    """Timestamp or date to 14-digit text (the sink/edge format)."""
    return F.date_format(_c(col), TS14)


def bucket_of(col: Column | str, grain: str) -> Column:
    """Bucket key (DATE) of a timestamp: its day, or the first of its month."""
    _check_grain(grain)
    day = F.to_date(_c(col))
    return day if grain == "day" else F.trunc(day, "MM")


def bucket_start_ts(bucket: Column | str, dtype: DataType) -> Column:
    """Midnight that starts a DATE bucket, in the type of the time column."""
    return _c(bucket).cast(dtype)


def next_bucket(bucket: Column | str, grain: str, steps: int = 1) -> Column:
    """The bucket ``steps`` grains after ``bucket`` (DATE arithmetic)."""
    _check_grain(grain)
    b = _c(bucket)
    return F.date_add(b, steps) if grain == "day" else F.add_months(b, steps)


def is_bucket_start(col: Column | str, grain: str, dtype: DataType) -> Column:
    """True when a timestamp sits exactly on a bucket boundary (midnight, or
    midnight of the first of the month)."""
    ts = _c(col)
    return ts == bucket_of(ts, grain).cast(dtype)


def to_date_value(value) -> _dt.date:
    """Accept a ``date``, ``datetime`` or ISO text and return a ``date``."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def ts_literal(value, dtype: DataType) -> Column:
    """A literal in the column's own type, so the predicate is a plain
    comparison that Catalyst folds and pushes to the Parquet reader."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, _dt.date):
        text = value.isoformat() + ("" if isinstance(dtype, DateType) else " 00:00:00")
    else:
        text = str(value)
    return F.lit(text).cast(dtype)


def time_type(df, ts: str) -> DataType:
    """The data type of a time column; text columns must be parsed first."""
    dtype = df.schema[ts].dataType
    if not isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        raise TypeError(f"column {ts!r} is {dtype.simpleString()}; parse it with parse_ts first")
    return dtype


def add_days(col: Column | str, days: int) -> Column:
    """Timestamp plus a whole number of days (a day-time interval)."""
    return _c(col) + F.make_dt_interval(F.lit(days))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
