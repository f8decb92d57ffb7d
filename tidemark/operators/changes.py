"""What changed in a source since a series was computed, by day partition.

A manifest has one row for each day partition of a table: a stamp of its files
(from their listing; no file is opened), its row count and an
order-free fingerprint of its rows. A later look lists the files again, reads only
the partitions whose files differ, and says which of these have other rows
than before: rewritten files with the same rows are no change.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Collection, Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..functions.time import DAY_PARTITION, TEXT_SOURCE, _text14, bucket_of, next_bucket, time_range
from .buckets import BUCKET, _shift

DAY = "day"
MANIFEST_SCHEMA = f"{DAY} date, stamp long, rows bigint, print_a long, print_b decimal(38,0)"


def file_stamps(spark: SparkSession, paths: Sequence[str], partition: str) -> DataFrame:
    """``day``, ``stamp``: of the files under ``paths`` in each ``partition=`` folder, an
    order-free hash of their paths, lengths and modification times. Only listed, not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(list(paths)).select("path", "length", "modificationTime"))
    day = F.to_date(F.regexp_extract("path", f"/{partition}=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})/", 1))
    return (files.where(F.col("path").rlike(f"/{partition}=[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}/"))
            .groupBy(day.alias(DAY)).agg(F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("stamp")))


def content_manifest(df: DataFrame, partition: str) -> DataFrame:
    """``day``, ``rows``, ``print_a``, ``print_b`` of each day partition of ``df``.

    The fingerprint is the exclusive-or of one row hash and the sum of
    another (with another seed): order-free, and repeated rows do not cancel out.
    Map-side partial; one row a day is shuffled from each task.
    """
    columns = [F.col(c) for c in sorted(df.columns)]
    # NULLs leave a hash as it was: which columns are NULL is hashed too
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in sorted(df.columns)])
    return df.groupBy(F.col(partition).cast("date").alias(DAY)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(F.xxhash64(nulls, *columns)).alias("print_a"),
        F.sum(F.xxhash64(*columns, nulls, F.lit(1)).cast("decimal(38,0)")).cast("decimal(38,0)").alias("print_b"))


def day_partition_of(df: DataFrame, ts: str = "ts") -> str:
    part = df.schema[ts].metadata.get(DAY_PARTITION)
    if not part or part not in df.columns:
        raise ValueError(f"{ts!r} has no day partition")
    return part


def look(df: DataFrame, paths: Sequence[str], old: DataFrame | None = None, ts: str = "ts") -> tuple[DataFrame, list[_dt.date]]:
    """The manifest of ``df`` (stored under ``paths``, partitioned by the day of ``ts``) and the
    days whose rows differ from ``old``, gone and new ones included (all, without ``old``).

    Files are listed; only days whose stamp differs are read, by a partition
    filter. What comes to the driver is one value for each day that differs.
    """
    part = day_partition_of(df, ts)
    stamps = file_stamps(df.sparkSession, paths, part)
    if old is None:
        return stamps.join(content_manifest(df, part), DAY, "left").select(*_columns()), days_of(stamps)
    both = stamps.withColumnRenamed("stamp", "now").join(old.select(DAY, "stamp"), DAY, "full_outer")
    suspects = days_of(both.where(~F.col("now").eqNullSafe(F.col("stamp"))))
    read = content_manifest(in_days(df, ts, suspects), part)
    fresh = stamps.where(F.col(DAY).isin(suspects)).join(read, DAY, "left").select(*_columns())
    kept = old.join(stamps, [DAY, "stamp"], "left_semi").select(*_columns())
    prints = ["rows", "print_a", "print_b"]
    differ = fresh.select(DAY, *[F.col(c).alias(f"_{c}") for c in prints]).join(
        old.where(F.col(DAY).isin(suspects)).select(DAY, *prints), DAY, "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in prints])
    return kept.unionByName(fresh), days_of(differ.where(~same))


def _columns() -> list[Column]:
    return [F.col(c.split()[0]) for c in MANIFEST_SCHEMA.replace("(38,0)", "").split(", ")]


def days_of(df: DataFrame) -> list[_dt.date]:
    """The days of a frame that has at most one row a day."""
    return sorted(r[0] for r in df.select(DAY).distinct().collect())


def runs_of(days: Iterable[_dt.date]) -> list[tuple[_dt.date, _dt.date]]:
    """Runs of consecutive days: first, and the day after the last."""
    out: list[tuple[_dt.date, _dt.date]] = []
    for d in sorted(set(days)):
        if out and out[-1][1] == d:
            out[-1] = out[-1][0], d + _dt.timedelta(days=1)
        else:
            out.append((d, d + _dt.timedelta(days=1)))
    return out


def in_days(df: DataFrame, ts: str, days: Collection[_dt.date]) -> DataFrame:
    """Rows of those days: a list of partitions if ``ts`` has a day partition, else the
    runs of days as ranges of the time column; both reach the scan."""
    days = sorted(set(days))
    if not days:
        return df.where(F.lit(False))
    part = df.schema[ts].metadata.get(DAY_PARTITION)
    if part and part in df.columns:
        values = days if isinstance(df.schema[part].dataType, DateType) else [d.isoformat() for d in days]
        return df.where(F.col(part).isin(values))
    return df.where(reduce(or_, [time_range(df, ts, a, b) for a, b in runs_of(days)]))


def near_days(df: DataFrame, ts: str, days: Collection[_dt.date]) -> tuple[DataFrame, bool]:
    """:func:`in_days` for rows that are reduced by day next, and whether all of them have been parsed.

    Of a ``ts`` parsed from text only the text is compared (not parsed: rows of the range whose
    text is no time are left for the caller, with NULL days). A bound on ``ts`` would be
    pushed below the parsing and repeat it, and all that the text is made of, at each of its uses.
    """
    text, part = (df.schema[ts].metadata.get(k) for k in (TEXT_SOURCE, DAY_PARTITION))
    if not days or not text or text not in df.columns or part and part in df.columns:
        return in_days(df, ts, days), True
    bounds = [(F.col(text) >= F.lit(_text14(a))) & (F.col(text) < F.lit(_text14(b))) for a, b in runs_of(days)]
    return df.where(reduce(or_, bounds)), False


def touched_buckets(spark: SparkSession, days: Collection[_dt.date], grain: str, closed: str = "left") -> DataFrame:
    """``bucket``s that rows of the given days count in."""
    days = spark.createDataFrame([(d,) for d in sorted(set(days))], f"{DAY} date")
    own = days.select(bucket_of(DAY, grain).alias(BUCKET), DAY)
    out = own.select(BUCKET)
    if closed == "both":  # midnight rows that start a bucket end the one before it
        out = out.unionAll(own.where(F.col(DAY) == F.col(BUCKET)).select(next_bucket(BUCKET, grain, -1).alias(BUCKET)))
    return out.distinct()


def days_of_buckets(buckets: Iterable[_dt.date], grain: str, closed: str = "left") -> list[_dt.date]:
    """All days whose rows the buckets count."""
    out = set()
    for b in buckets:
        end = _shift(b, grain, 1)
        out.update(b + _dt.timedelta(days=k) for k in range((end - b).days + (closed == "both")))
    return sorted(out)
