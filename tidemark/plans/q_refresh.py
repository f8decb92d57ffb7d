"""Queries through the stored-series, named-source and user-SQL paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.series import read_series
from ..session import scratch_dir
from ..sources.logical import VERSIONS, LogicalCatalog, logical_tables
from ..sources.tables import load_source
from .catalog import REGISTRY, register, table
from .q_buckets import EVENT_TYPES
from .q_reports import AS_OF, STARTS, derived_raw, derived_uploads
from .reports import run_report, run_sql_report
from .runner import refresh_changed, refresh_report

_STARTS_SQL = REGISTRY["report_app_edits_starts"].oracle


@register("refresh_report", covers="incremental_refresh J-04 J-06 S-13 S-14: written, refreshed, read back", oracle=_STARTS_SQL)
def refresh_report_query(spark, sf_dir):
    """A report's series stored up to the 20th, refreshed to the end of the
    month (closed buckets kept, the rest recomputed) and read back."""
    tables = derived_uploads(spark, sf_dir)
    root = scratch_dir(spark, "series")
    refresh_report(spark, tables, "app-edits-starts", root, "2024-01-20", starts=STARTS)
    path = refresh_report(spark, tables, "app-edits-starts", root, AS_OF, cutoff="2024-01-15", starts=STARTS)
    return read_series(spark, path, "bucket date, total bigint, android bigint, ios bigint")


@register("catalog_report", covers="load_source LogicalCatalog S-01 S-03: report over named sources",
          oracle=REGISTRY["report_successful_edits_main"].oracle)
def catalog_report_query(spark, sf_dir):
    """The main-namespace edit report over a catalogue of named sources: the
    raw edit-log versions derived from events, written as a source's folders."""
    root = scratch_dir(spark, "source")
    versions = {n: df for n, df in derived_raw(spark, sf_dir).items() if n in VERSIONS["edits_web"]}
    for name, raw in versions.items():
        raw.write.parquet(f"{root}/{name}")
    tables = LogicalCatalog(spark, {"sources": {"el": {"path": root}, "commons": {"path": root}}},
                            may_be_absent=set(VERSIONS["edits_web"]) - set(versions))
    return run_report(tables, "successful-edits-main", AS_OF)


@register("load_source", covers="load_source S-01 (path template of a named source)", oracle="""
SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type
""")
def load_source_query(spark, sf_dir):
    conf = {"sources": {"driver": {"format": "parquet", "path": sf_dir.rstrip("/") + "/{table}.parquet"}}}
    return load_source(spark, conf, "driver", "events").groupBy("event_type").count().withColumnRenamed("count", "n")


_BY_TYPE = ", ".join(f"CAST(SUM(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS {t}" for t in EVENT_TYPES)


@register("sql_report", covers="run_sql_report: a user's own SQL with named parameters", oracle=f"""
SELECT CAST(ts AS DATE) AS bucket, {_BY_TYPE}
FROM events WHERE value >= 10 AND CAST(ts AS DATE) <= DATE '{AS_OF}' GROUP BY 1
""")
def sql_report_query(spark, sf_dir):
    sql = f"SELECT CAST(ts AS DATE) AS bucket, {_BY_TYPE} FROM events " \
          "WHERE value >= :least AND CAST(ts AS DATE) <= CAST(:as_of AS DATE) GROUP BY 1"
    return run_sql_report(spark, {"events": table(spark, sf_dir, "events")}, sql, {"least": 10, "as_of": AS_OF})


@register("report_labelled", covers="run_report labelled: display headers", oracle=f"""
SELECT bucket AS "Day", total AS "Total", android AS "Android", ios AS "iOS" FROM ({_STARTS_SQL})
""")
def report_labelled_query(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "app-edits-starts", AS_OF, starts=STARTS, labelled=True)


@register("refresh_changed", covers="refresh by changed day J-04 J-05: late rows in early buckets, partition list", oracle=_STARTS_SQL)
def refresh_changed_query(spark, sf_dir):
    """The app-edit log partitioned by day, at first without every seventh event (by
    time) of four days; then the late rows arrive, and those days and the open buckets are read again."""
    raw = derived_uploads(spark, sf_dir)["edits_app"].drop("ts").withColumn(
        "day", F.to_date(F.substring("timestamp", 1, 8), "yyyyMMdd"))
    late = (F.col("day").between("2024-01-05", "2024-01-08")) & (F.crc32(F.col("timestamp").cast("binary")) % 7 == 0)
    path, root = scratch_dir(spark, "edits"), scratch_dir(spark, "series")

    def refreshed():
        tables = logical_tables({VERSIONS["edits_app"][0]: spark.read.parquet(path)}, day_partition="day")
        return refresh_changed(spark, tables, {"edits_app": [path]}, "app-edits-starts", root, AS_OF, cutoff=AS_OF, starts=STARTS)

    raw.where(~late).write.partitionBy("day").parquet(path)
    refreshed()
    raw.where(late).write.mode("append").partitionBy("day").parquet(path)
    return read_series(spark, refreshed(), "bucket date, total bigint, android bigint, ios bigint")
