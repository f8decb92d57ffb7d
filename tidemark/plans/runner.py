"""Refreshing stored report series: read, check shape, refresh, write, record.

Series live under ``<root>/<report>/v=<version>`` as CSV (the reference's
sink), with the report's display headers. A refresh never writes over its
input: it writes the next version, which must not exist yet, and readers take
the highest complete one (with ``_SUCCESS``). History is append-only
(:func:`~tidemark.operators.series.append_history`).
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import to_date_value
from ..operators.buckets import BUCKET
from ..operators.changes import MANIFEST_SCHEMA, days_of_buckets, in_days, look, touched_buckets
from ..operators.series import append_history, compact_history, read_history, read_series, write_series
from ..operators.timebox import buckets_to_refresh, due_reports, first_open_bucket, incremental_refresh
from .counts import shared_series
from .reports import REPORTS, Report, params_for, run_report

# Complete versions that stay beside the newest one.
KEPT_VERSIONS = 1


def _versions(spark: SparkSession, series_root: str, complete: bool = True) -> list[int]:
    """Version numbers under ``series_root``: one folder entry per version."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    where = hadoop(f"{series_root.rstrip('/')}/v=*" + ("/_SUCCESS" if complete else ""))
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(where) or []
    return sorted(int(m.group(1)) for f in found if (m := re.search(r"/v=(\d+)(?:/|$)", f.getPath().toString())))


def _remove_version(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def latest_series(spark: SparkSession, series_root: str, schema) -> tuple[DataFrame | None, int]:
    """The newest complete version (read with ``schema``) and its number."""
    versions = _versions(spark, series_root)
    if not versions:
        return None, 0
    v = versions[-1]
    return read_series(spark, f"{series_root}/v={v}", schema), v


def stored_columns(spark: SparkSession, path: str) -> list[str]:
    """Header names of a stored CSV series (no data is read)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def _stored(spark: SparkSession, tables, name: str, series_root: str, as_of, force: bool, starts, ends,
            registry: Mapping[str, Report]) -> DataFrame | None:
    """The newest complete version of a time-boxed report, if its header is the report's own (or ``force``)."""
    rep = registry[name]
    versions = _versions(spark, series_root)
    if not rep.timeboxed or not versions:
        return None
    path = f"{series_root}/v={versions[-1]}"
    # The schema of one bucket's plan; only a plan, nothing runs.
    last = params_for(rep, as_of, starts, ends).ends
    schema = run_report(tables, name, as_of, starts=last, ends=ends, registry=registry).schema
    if force or stored_columns(spark, path) == [rep.labels.get(c, c) for c in schema.names]:
        return read_series(spark, path, schema)
    return None


def _write_next(spark: SparkSession, out: DataFrame, rep: Report, series_root: str, version: int | None = None) -> str:
    """Write the next version and remove those that are done with, with their manifests: complete
    ones older than the last two, and ones that a lost run left incomplete before the newest complete one."""
    every, complete = _versions(spark, series_root, complete=False), _versions(spark, series_root)
    target = f"{series_root}/v={version or _next_version(spark, series_root)}"
    write_series(out, target, fmt="csv", labels=rep.labels, replace=False)
    lost = [v for v in every if complete and v < complete[-1] and v not in complete]
    for v in complete[:-KEPT_VERSIONS] + lost:
        _remove_version(spark, f"{series_root}/v={v}")
        _remove_version(spark, f"{series_root}/m={v}")
    return target


def _record(spark: SparkSession, names: list[str], history: str | None, now: _dt.datetime | None) -> None:
    if not history:
        return
    when = (now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).strftime("%Y-%m-%d %H:%M:%S")
    # The same literal as in the due test, so neither depends on the process's zone.
    runs = spark.createDataFrame([(name, when) for name in names], "report string, last_run string")
    append_history(runs.withColumn("last_run", F.col("last_run").cast("timestamp")).coalesce(1), history)
    compact_history(spark, history)


def refresh_report(spark: SparkSession, tables, name: str, root: str, as_of,
                   cutoff=None, force: bool = False, now: _dt.datetime | None = None,
                   history: str | None = None, starts=None, ends=None,
                   registry: Mapping[str, Report] = REPORTS) -> str:
    """Refresh one report's stored series and return the path written.

    A time-boxed report keeps its closed stored buckets and recomputes the
    rest, reading its tables from the first of these on; if the stored header
    is not the report's own the series is rebuilt (unless ``force``). Other
    reports are recomputed whole. The run is appended to ``history`` when
    given. A version that exists already, even an incomplete one, is never
    written again; older complete versions than the last two, and incomplete ones
    before the newest complete one, are removed.
    """
    series_root = f"{root.rstrip('/')}/{name}"
    stored = _stored(spark, tables, name, series_root, as_of, force, starts, ends, registry)
    out = run_report(tables, name, as_of, starts=starts, ends=ends, stored=stored, cutoff=cutoff, force=force, registry=registry)
    target = _write_next(spark, out, registry[name], series_root)
    _record(spark, [name], history, now)
    return target


def refresh_all(spark: SparkSession, tables, root: str, as_of, names: list[str] | None = None, cutoff=None,
                force: bool = False, now: _dt.datetime | None = None, history: str | None = None,
                starts=None, ends=None, registry: Mapping[str, Report] = REPORTS) -> dict[str, str]:
    """Refresh many reports (``names``; default: the registered ones that ``history`` says
    are due, all without one): ``{name: path written}``.

    The same series as one :func:`refresh_report` after another, but the count reports read each
    logical table once for all of them, from the earliest bucket that any of them
    has to recompute on. Each series is a version of its own: a run that is lost in between
    leaves the others complete, and the history names only what was written.
    """
    if names is None:
        if history:
            names = [r["report"] for r in due_now(spark, history, now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), force, registry)
                     .where("due").select("report").collect()]  # names of the catalogue, no data
        else:
            names = [r.name for r in registry.values() if r.registered]
    root = root.rstrip("/")
    held = {name: _stored(spark, tables, name, f"{root}/{name}", as_of, force, starts, ends, registry) for name in names}
    plans, params = {}, {}
    for name in names:
        rep = registry[name]
        if rep.counts:
            params[name] = p = params_for(rep, as_of, starts, ends)
            if held[name] is not None:
                p = replace(p, starts=first_open_bucket(held[name], p.starts, p.ends, _cutoff(p, cutoff), rep.grain))
            plans[name] = rep.counts(p)
    events = tables.for_source("el") if hasattr(tables, "for_source") else tables
    shared = shared_series(events, plans) if plans else {}
    written = {}
    for name in names:
        if name not in shared:
            out = run_report(tables, name, as_of, starts=starts, ends=ends, stored=held[name], cutoff=cutoff, force=force, registry=registry)
        elif held[name] is None:
            out = shared[name]
        else:
            p = params[name]
            out = incremental_refresh(held[name], shared[name], _cutoff(p, cutoff), p.starts, p.ends, registry[name].grain)
        written[name] = _write_next(spark, out, registry[name], f"{root}/{name}")
        _record(spark, [name], history, now)
    return written


def refresh_changed(spark: SparkSession, tables, sources: Mapping[str, Sequence[str]], name: str, root: str, as_of,
                    cutoff=None, force: bool = False, now: _dt.datetime | None = None, history: str | None = None,
                    starts=None, ends=None) -> str:
    """Refresh a time-boxed count report from the days that changed alone.

    ``sources``: logical table -> the folders of its versions, partitioned by day.
    Beside each version of the series lies the manifest (see
    :mod:`~tidemark.operators.changes`) of the tables it was computed from. Aggregated again
    are the buckets that are missing or open (as in :func:`refresh_report`) and those
    that a changed day counts in, however early; the tables are read by the
    list of these buckets' day partitions. Without a stored series, or one of another shape, all is read.
    The manifest is taken before the rows are: what changes meanwhile differs from it next time.
    """
    rep = REPORTS[name]
    if not (rep.counts and rep.timeboxed):
        raise ValueError(f"{name!r} is not a time-boxed count report")
    series_root = f"{root.rstrip('/')}/{name}"
    p = params_for(rep, as_of, starts, ends)
    used = sorted({part.table for part in rep.counts(p).parts})
    versions = _versions(spark, series_root)
    held = _stored(spark, tables, name, series_root, as_of, force, starts, ends, REPORTS)
    old = None
    if held is not None and _exists(spark, f"{series_root}/m={versions[-1]}/_SUCCESS"):
        old = spark.read.schema(f"source string, {MANIFEST_SCHEMA}").parquet(f"{series_root}/m={versions[-1]}")
    manifests, changed = [], set()
    for table in used:
        mine = None if old is None else old.where(F.col("source") == table).drop("source")
        found, days = look(tables[table], sources[table], mine)
        manifests.append(found.select(F.lit(table).alias("source"), "*"))
        changed.update(days)
    target = _next_version(spark, series_root)
    reduce(DataFrame.unionByName, manifests).coalesce(1).write.mode("overwrite").parquet(f"{series_root}/m={target}")
    if old is None:
        out = run_report(tables, name, as_of, starts=starts, ends=ends)
    else:
        todo = buckets_to_refresh(held, p.starts, p.ends, _cutoff(p, cutoff), rep.grain).select(BUCKET).unionAll(
            touched_buckets(spark, changed, rep.grain, rep.closed)).distinct()
        # as many values as the range has buckets, at most
        todo = sorted(r[0] for r in todo.where(F.col(BUCKET).between(F.lit(p.starts), F.lit(p.ends))).collect())
        days = days_of_buckets(todo, rep.grain, rep.closed)
        fresh = rep.build({t: in_days(tables[t], "ts", days) for t in used}, p).where(F.col(BUCKET).isin(todo))
        kept = held.where(~F.col(BUCKET).isin(todo)) if todo else held
        out = kept.unionByName(fresh.select(*held.columns))
    written = _write_next(spark, out, rep, series_root, target)
    _record(spark, [name], history, now)
    return written


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _next_version(spark: SparkSession, series_root: str) -> int:
    every = _versions(spark, series_root, complete=False)
    return (every[-1] if every else 0) + 1


def _cutoff(p, cutoff) -> _dt.date:
    return to_date_value(cutoff) if cutoff else p.as_of.replace(day=1)


def due_now(spark: SparkSession, history: str, now: _dt.datetime, force: bool = False,
            registry: Mapping[str, Report] = REPORTS) -> DataFrame:
    """Registered reports that are due at ``now`` (see :func:`due_reports`)."""
    known = spark.createDataFrame([(r.name, r.frequency) for r in registry.values() if r.registered],
                                  "report string, frequency string")
    return due_reports(known, read_history(spark, history), now, force)
