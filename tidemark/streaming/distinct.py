"""Streaming ``UNION`` of schema versions, and distinct users, before counting.

Overlapping versions of a log hold the same rows twice; a stream that counts
them must forget repeats it has seen, in whatever order the files come. The
rows seen (projected, as ``UNION`` has it) are keyed state. Without ``expiry``
it keeps every row, and any order gives the batch result; with one, a row is
forgotten when event time has moved on by it, and rows later than that
are left out, as with any watermark: give the largest delay between repeats.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.arith import count_when
from ..functions.time import bucket_of, with_parsed_ts
from ..sources.versions import unify_versions
from .buckets import BUCKET, bucket_count_stream, upsert_buckets

EVENT_TIME = "_et"


def wall_instant(ts: str) -> Column:
    """The wall-clock time as an instant (as if it were UTC): watermarks need a ``TIMESTAMP``,
    and nothing is to depend on the session's zone."""
    t = F.col(ts)
    return F.timestamp_seconds(F.unix_date(F.to_date(t)).cast("long") * 86400 + F.hour(t) * 3600
                               + F.minute(t) * 60 + F.second(t))


def distinct_stream(rows: DataFrame, keys: Sequence[str] | None = None, ts: str = "ts",
                    expiry: str | None = None) -> DataFrame:
    """The first of all rows that agree in ``keys`` (default: all columns; NULLs agree).

    With ``expiry`` the state of a key goes that long after its event time; a NULL time
    has none and is left out. Without, no row is.
    """
    keys = list(keys or rows.columns)
    if expiry is None:
        return rows.dropDuplicates(keys)
    timed = rows.withColumn(EVENT_TIME, wall_instant(ts)).where(F.col(EVENT_TIME).isNotNull())
    return timed.withWatermark(EVENT_TIME, expiry).dropDuplicatesWithinWatermark(keys).drop(EVENT_TIME)


def version_stream(spark: SparkSession, versions: Sequence[tuple[str, StructType | str]], columns: Sequence[str],
                   fill: Mapping[str, object] | None = None, text_ts: str = "timestamp", fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """``UNION ALL`` of the versions (folder and schema of each) as a stream: the projection
    ``columns`` with literal ``fill``s, the time parsed into ``ts``."""
    streams = []
    for path, schema in versions:
        reader = spark.readStream.schema(schema).format(fmt)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        streams.append(reader.load(path))
    return with_parsed_ts(unify_versions(streams, columns=columns, fill=fill, dedup=False), text_ts)


def distinct_user_stream(rows: DataFrame, ts: str, key: str, metrics: Mapping[str, Column],
                         where: Column | None = None, expiry: str | None = None) -> DataFrame:
    """Distinct ``key`` per day and metric, as a streaming aggregate.

    Each row becomes the metrics it counts in; the (day, key, metric) triples are the state that
    is kept once, so a user is counted when first met, and only once.
    """
    if where is not None:
        rows = rows.where(where)
    hits = F.filter(F.array(*[F.when(p, F.lit(name)) for name, p in metrics.items()]), lambda x: x.isNotNull())
    met = rows.where(F.col(key).isNotNull()).select(
        bucket_of(ts, "day").alias(BUCKET), F.col(key).alias("_key"), F.explode(hits).alias("_metric"))
    met = met.where(F.col(BUCKET).isNotNull()).withColumn("_day", F.col(BUCKET).cast("timestamp_ntz"))
    once = distinct_stream(met, [BUCKET, "_key", "_metric"], ts="_day", expiry=expiry)
    return once.groupBy(BUCKET).agg(*[count_when(F.col("_metric") == name).alias(name) for name in metrics])


def run_series(counts: DataFrame, sink: str, checkpoint: str):
    """Run a streaming aggregate by bucket over everything available now; its series is at ``sink``.

    Each batch replaces the buckets it touched, so a batch that is repeated after
    a failure writes the same; run again, it goes on from the checkpoint.
    """
    query = (counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .foreachBatch(upsert_buckets(sink)).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def streaming_version_counts(spark: SparkSession, versions: Sequence[tuple[str, StructType | str]], columns: Sequence[str],
                             metrics: Mapping[str, Column], sink: str, checkpoint: str, total: str | None = "total",
                             where: Column | None = None, expiry: str | None = None, **kw):
    """Counts per day over the ``UNION`` of the versions, repeated rows removed first;
    ``kw`` as in :func:`version_stream`."""
    rows = distinct_stream(version_stream(spark, versions, columns, **kw), columns, expiry=expiry)
    rows = rows if where is None else rows.where(where)
    return run_series(bucket_count_stream(rows.where(F.col("ts").isNotNull()), "ts", metrics, total), sink, checkpoint)


def streaming_distinct_users(spark: SparkSession, versions: Sequence[tuple[str, StructType | str]], columns: Sequence[str],
                             key: str, metrics: Mapping[str, Column], sink: str, checkpoint: str,
                             where: Column | None = None, expiry: str | None = None, **kw):
    """Distinct users per day over the versions. Repeated rows add no user, so the triples
    of :func:`distinct_user_stream` are the only rows kept as state."""
    rows = version_stream(spark, versions, columns, **kw)
    return run_series(distinct_user_stream(rows, "ts", key, metrics, where, expiry), sink, checkpoint)
