"""Distinct users as day bitmaps that merge: any month or trailing window without the events.

Users get dense numbers, kept in a dictionary that only grows. A day's users
are then bitmaps of 32,768 users each, one for every metric; a month is the OR of its days'
bitmaps and a trailing window the OR of two running ORs, so exact distinct
counts of any span come from the stored bitmaps. A refresh reads the events of the
days it is given and replaces those days.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.time import bucket_of
from ..session import scratch_dir
from .buckets import BUCKET, _bucket_value, _shift, densify, in_range, spine_between
from .changes import near_days

USER, NUMBER, PART = "user", "number", "part"
USERS_SCHEMA = f"{USER} string, {NUMBER} long"


def dense_numbers(rows: DataFrame, first: int, name: str = NUMBER) -> DataFrame:
    """``rows`` with numbers ``first``, ``first + 1``, ... in no particular order.

    Each task numbers its own rows; the offsets are one row a task. The rows are written
    down before, so that a lost task finds the same ones again.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, "numbered")
    (rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.spark_partition_id())
     .write.parquet(path))
    placed = spark.read.parquet(path)
    tasks = placed.groupBy("_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    tasks = tasks.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_rows")
    out = placed.join(F.broadcast(tasks), "_task")
    return out.withColumn(name, F.col("_at") - F.col("_first") + F.col("_before") + first).drop("_task", "_at", "_first", "_before")


def user_days(df: DataFrame, ts: str, key: str, metrics: Mapping[str, Column]) -> DataFrame:
    """``bucket`` (day, NULL where ``ts`` is), ``user`` and a flag for each metric (``_m0``, ...).

    Rows are reduced to (day, user) map-side; those without a user do not count.
    """
    flags = [F.max(F.when(pred, 1).otherwise(0)).alias(f"_m{i}") for i, pred in enumerate(metrics.values())]
    return df.where(F.col(key).isNotNull()).groupBy(
        bucket_of(ts, "day").alias(BUCKET), F.col(key).cast("string").alias(USER)).agg(*flags)


def day_bitmaps(per_user: DataFrame, metrics: Collection[str], numbers: DataFrame) -> DataFrame:
    """``bucket`` (day), ``part`` and a bitmap for each metric (NULL: no user of the part).

    ``per_user``: see :func:`user_days`.
    """
    known = per_user.where(F.col(BUCKET).isNotNull()).join(numbers, USER)
    bits = [F.bitmap_construct_agg(F.when(F.col(f"_m{i}") == 1, F.bitmap_bit_position(NUMBER))).alias(name)
            for i, name in enumerate(metrics)]
    made = known.groupBy(BUCKET, F.bitmap_bucket_number(NUMBER).alias(PART)).agg(*bits)
    return made.select(BUCKET, PART, *[F.when(F.bitmap_count(name) > 0, F.col(name)).alias(name) for name in metrics])


def merged_counts(bitmaps: DataFrame, metrics: Collection[str], grain: str = "day") -> DataFrame:
    """Distinct users per bucket of ``grain``: the days' bitmaps ORed part by part, then counted."""
    ored = bitmaps.groupBy(bucket_of(BUCKET, grain).alias("_b"), PART).agg(*[F.bitmap_or_agg(m).alias(m) for m in metrics])
    return ored.groupBy(F.col("_b").alias(BUCKET)).agg(*[_counted(m) for m in metrics])


def _counted(metric: str) -> Column:
    return F.coalesce(F.sum(F.bitmap_count(metric)), F.lit(0)).cast("bigint").alias(metric)


def trailing_counts(bitmaps: DataFrame, metrics: Collection[str], n: int, starts, ends) -> DataFrame:
    """Distinct users of the ``n`` days ending with each day from ``starts`` to ``ends``.

    Days are cut in blocks of ``n``. A window is the last days of one block and the first
    of the next, or one block: the OR of a running OR backwards from the one's end and one forwards from
    the other's start. Each bitmap is read for two running ORs, however long the
    window; their rows are those of one part and one block.
    """
    if n < 1:
        raise ValueError("a window needs n >= 1")
    s, e = _bucket_value(starts, "day"), _bucket_value(ends, "day")
    if s > e:
        return bitmaps.select(BUCKET, *[F.lit(0).cast("bigint").alias(m) for m in metrics]).where(F.lit(False))
    first = _shift(s, "day", 1 - n)
    days = (e - first).days + 1
    rows = bitmaps.where(F.col(BUCKET).between(F.lit(first), F.lit(e)))
    # every day of every part that occurs: a running OR has a value on days without users
    spine = rows.select(PART).distinct().withColumn(BUCKET, F.explode(F.sequence(F.lit(first), F.lit(e))))
    dense = spine.join(rows, [PART, BUCKET], "left").withColumn("_day", F.datediff(BUCKET, F.lit(first)))
    block = (F.col("_day") / n).cast("int")
    forward = Window.partitionBy(PART, block).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy(PART, block).orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, 0)
    ored = [(m, F.bitmap_or_agg(m)) for m in metrics]
    # the running OR up to day d belongs to the window ending there, the one from day d on to that starting there
    head = dense.select(PART, F.col("_day").alias("_end"), *[o.over(forward).alias(m) for m, o in ored])
    tail = dense.select(PART, (F.col("_day") + n - 1).alias("_end"), *[o.over(back).alias(m) for m, o in ored])
    both = head.unionAll(tail).where(F.col("_end").between(n - 1, days - 1))
    per_part = both.groupBy("_end", PART).agg(*[o.alias(m) for m, o in ored])
    counts = per_part.groupBy("_end").agg(*[_counted(m) for m in metrics])
    out = counts.select(F.date_add(F.lit(first), F.col("_end")).alias(BUCKET), *metrics)
    return densify(spine_between(bitmaps.sparkSession, s, e, "day"), out, fill=0)


@dataclass
class DistinctSeries:
    """Stored day bitmaps of the distinct ``key`` under ``root``, and the users' numbers.

    ``metrics``: name -> predicate; ``where`` holds for all. Several tables that
    share the users (and ``root``) are as many series with their own ``name``. One
    refresh at a time may write under a ``root``.
    """

    spark: SparkSession
    root: str
    key: str
    metrics: Mapping[str, Column]
    where: Column | None = None
    ts: str = "ts"
    name: str = "days"
    _schema: str = field(init=False)

    def __post_init__(self):
        self._schema = ", ".join([f"{PART} long", *[f"{m} binary" for m in self.metrics], f"{BUCKET} date"])

    def _complete(self, pattern: str) -> list[str]:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        fs = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(str(f.getPath().getParent()) for f in fs.globStatus(where) or [])

    def numbers(self) -> DataFrame:
        """``user``, ``number`` (from 1) of all users met so far."""
        runs = self._complete("users/run-*/_SUCCESS")
        return self.spark.read.schema(USERS_SCHEMA).parquet(*runs) if runs else self.spark.createDataFrame([], USERS_SCHEMA)

    def enter(self, users: DataFrame) -> DataFrame:
        """Give the users (column ``user``) that have no number the next ones; all numbers."""
        known = self.numbers()
        new = users.where(F.col(USER).isNotNull()).distinct().join(known, USER, "left_anti")
        first = (known.agg(F.max(NUMBER)).first()[0] or 0) + 1
        # a run of its own: one that is lost has no success mark and its numbers are given again
        dense_numbers(new, first).select(USER, NUMBER).write.parquet(f"{self.root}/users/run-{first:020d}-{uuid.uuid4().hex[:8]}")
        return self.numbers()

    def refresh(self, df: DataFrame, days: Collection[_dt.date]) -> None:
        """Replace the bitmaps of ``days`` by those of ``df``'s rows; only these days are read, and once.

        The rows are reduced to (day, user) and written down; the new numbers and the
        bitmaps are made from that.
        """
        days = sorted(set(days))
        if not days:
            return
        rows, parsed = near_days(df if self.where is None else df.where(self.where), self.ts, days)
        path = scratch_dir(self.spark, "user-days")
        user_days(rows, self.ts, self.key, self.metrics).write.parquet(path)
        per_user = self.spark.read.parquet(path)
        if not parsed:  # texts of these days that are no time
            per_user = per_user.where(F.col(BUCKET).isin(days))
        numbers = self.enter(per_user.select(USER))
        made = day_bitmaps(per_user, self.metrics, numbers)
        # part 0 marks a day as computed: one without users is replaced too
        marks = self.spark.createDataFrame([(d,) for d in days], f"{BUCKET} date").withColumn(PART, F.lit(0).cast("long"))
        (made.unionByName(marks, allowMissingColumns=True).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "zstd").partitionBy(BUCKET).parquet(f"{self.root}/{self.name}"))

    def bitmaps(self) -> DataFrame:
        return self.spark.read.schema(self._schema).parquet(f"{self.root}/{self.name}")

    def computed_days(self) -> list[_dt.date]:
        """The days that have been computed: one value a day."""
        return sorted(r[0] for r in self.bitmaps().where(F.col(PART) == 0).select(BUCKET).distinct().collect())

    def counts(self, grain: str = "day", start=None, end=None) -> DataFrame:
        """Distinct users per day or month; only the partitions of the range are read."""
        return merged_counts(in_range(self.bitmaps(), BUCKET, start, end, grain), list(self.metrics), grain)

    def trailing(self, n: int, starts, ends) -> DataFrame:
        return trailing_counts(self.bitmaps().where(F.col(PART) > 0), list(self.metrics), n, starts, ends)
