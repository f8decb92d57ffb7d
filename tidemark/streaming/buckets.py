"""Bucketed counts as a Structured Streaming job.

The reference refreshes its series by re-running queries; the streaming form
keeps per-bucket counts in state and upserts only the buckets a micro-batch
touched. The sink is a Parquet series partitioned by bucket and written with
dynamic partition overwrite, so each batch replaces exactly the buckets it
carries (idempotent when a batch is replayed after a failure).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.arith import count_when

BUCKET = "bucket"


def bucket_count_stream(events: DataFrame, ts: str, metrics: Mapping[str, Column],
                        total: str | None = "total", watermark: str | None = None,
                        width: str = "1 day") -> DataFrame:
    """Streaming aggregate: counts per ``width`` window of event time.

    Every row counts, however late: the state is one row per bucket, so nothing
    has to be evicted. Only a ``watermark`` given by the caller drops rows later
    than it. Windows need a ``TIMESTAMP``; the event instant is built from the
    wall-clock fields of the time column (as if it were UTC), so day windows
    are wall-clock days and the bucket is read back with ``unix_seconds`` --
    nothing depends on the session time zone.
    """
    t = F.col(ts)
    wall_secs = (F.unix_date(F.to_date(t)).cast("long") * 86400 + F.hour(t) * 3600
                 + F.minute(t) * 60 + F.second(t))
    rows = events.withColumn("_et", F.timestamp_seconds(wall_secs))
    if watermark:
        rows = rows.withWatermark("_et", watermark)
    aggs = []
    if total:
        aggs.append(F.count(F.lit(1)).alias(total))
    aggs += [count_when(p).alias(k) for k, p in metrics.items()]
    grouped = rows.groupBy(F.window("_et", width).alias("_w")).agg(*aggs)
    names = ([total] if total else []) + list(metrics)
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("_w.start")) / 86400).cast("int"))
    return grouped.select(day.alias(BUCKET), *names)


def upsert_buckets(path: str):
    """``foreachBatch`` writer replacing the partitions of the batch's buckets."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(path))
    return write


def streaming_bucket_counts(spark: SparkSession, source: str, schema: StructType | str, ts: str,
                            metrics: Mapping[str, Column], sink: str, checkpoint: str,
                            total: str | None = "total", fmt: str = "parquet",
                            watermark: str | None = None, max_files_per_trigger: int | None = None,
                            glob: str | None = None):
    """Run the stream over everything available now and stop.

    Returns the finished ``StreamingQuery``; the series is at ``sink``
    (read it with ``spark.read.parquet(sink)``). On a cluster ``sink`` and
    ``checkpoint`` must be in the shared folder; rerunning resumes from the
    checkpoint and processes only new files. ``source`` is a table's path: a
    folder of part files or one file; ``glob`` picks files in a folder
    (``pathGlobFilter``).
    """
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    if glob is None and where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isFile():
        source, glob = where.getParent().toString(), where.getName()  # a stream reads folders only
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    counts = bucket_count_stream(reader.load(source), ts, metrics, total, watermark)
    query = (counts.writeStream.outputMode("update")
             .option("checkpointLocation", checkpoint)
             .foreachBatch(upsert_buckets(sink))
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return query
