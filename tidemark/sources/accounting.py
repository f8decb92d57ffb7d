"""What a run did with the rows it read, counted in its own scan.

A row whose time does not parse, or lies outside a report's range, or
repeats one of another schema version, leaves no trace in a series. An :class:`Accounting`
puts ``observe`` metrics into the logical tables, so the job that computes a report
counts them on the way: nothing is read for it alone. A filter cannot pass the counting, though:
the rows outside the range are read (and only so can be counted), so it is asked for, not the rule.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.arith import count_rows
from ..functions.time import parse_ts, time_range, to_date_value

ACCOUNT_SCHEMA = ("report string, run timestamp, table string, version string, rows bigint, no_time bigint, unparsed bigint, "
                  "outside bigint, removed bigint")


class Accounting:
    """Counters of the logical tables of one run.

    ``starts`` and ``ends`` (days, inclusive) are the report's range. Each version of a table counts the rows
    read (``rows``), those without a time (``no_time``) and those whose text is no time (``unparsed``); the table
    counts what is left of them (``rows``), what of it is ``outside`` the range (a time that did not parse is no time
    and counts above), and what ``UNION`` ``removed``. A task that is run again after its executor was
    lost counts again, so figures of such a run may be too large; the series are not.
    """

    def __init__(self, starts=None, ends=None):
        self.lo = None if starts is None else to_date_value(starts)
        self.hi = None if ends is None else to_date_value(ends) + _dt.timedelta(days=1)
        self._observations: dict[str, tuple[str, str | None, Observation]] = {}

    def _add(self, table: str, version: str | None) -> Observation:
        name = f"tidemark_rows_{id(self)}_{len(self._observations)}"
        self._observations[name] = (table, version, Observation(name))
        return self._observations[name][2]

    def version(self, table: str, version: str, df: DataFrame, text_col: str | None) -> DataFrame:
        """``df``, a raw version of ``table``, counted."""
        if text_col is None or text_col not in df.columns:
            return df.observe(self._add(table, version), count_rows().alias("rows"))
        text = F.col(text_col).cast("string")
        return df.observe(self._add(table, version), count_rows().alias("rows"), F.count_if(text.isNull()).alias("no_time"),
                          F.count_if(text.isNotNull() & parse_ts(text).isNull()).alias("unparsed"))

    def table(self, table: str, df: DataFrame, ts: str | None) -> DataFrame:
        """``df``, the logical table, counted."""
        metrics = [count_rows().alias("rows")]
        if ts is not None and not (self.lo is None and self.hi is None):
            inside = time_range(df.select(ts), ts, self.lo, self.hi)
            metrics.append(F.count_if(F.col(ts).isNotNull() & ~inside).alias("outside"))
        return df.observe(self._add(table, None), *metrics)

    def figures(self, done: DataFrame) -> list[tuple]:
        """``(table, version, rows, no_time, unparsed, outside, removed)`` of the tables that ``done`` reads;
        it must have been run (written, collected). Version None is the table itself."""
        plan = done._jdf.queryExecution().analyzed().toString()
        met = set(re.findall(r"CollectMetrics (\w+)", plan))
        seen = [(table, version, o.get) for name, (table, version, o) in self._observations.items() if name in met]
        read: dict[str, int] = {}
        for table, version, m in seen:
            if version is not None:
                read[table] = read.get(table, 0) + m["rows"]
        return [(table, version, m["rows"], m.get("no_time"), m.get("unparsed"), m.get("outside"),
                 read[table] - m["rows"] if version is None else None) for table, version, m in seen]


def append_accounts(spark: SparkSession, account: Accounting, done: DataFrame, report: str, now: _dt.datetime, root: str) -> None:
    """Append the figures of a run, beside the run history: a few rows a run, never rewritten."""
    when = now.strftime("%Y-%m-%d %H:%M:%S")
    rows = spark.createDataFrame([(report, when, *f) for f in account.figures(done)],
                                 ACCOUNT_SCHEMA.replace("run timestamp", "run string"))
    rows.withColumn("run", F.col("run").cast("timestamp")).coalesce(1).write.mode("append").parquet(root)


def read_accounts(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(ACCOUNT_SCHEMA).parquet(root)


def counted_tables(raw: Mapping[str, DataFrame], account: Accounting, day_partition: str | None = None) -> dict[str, DataFrame]:
    """:func:`~tidemark.sources.logical.logical_tables` with the counters in them."""
    from .logical import VERSIONS, WIKI_TIMES, logical_tables
    of = {v: name for name, versions in VERSIONS.items() for v in versions} | {name: name for name in WIKI_TIMES}
    text = {name: "timestamp" for name in VERSIONS} | WIKI_TIMES
    counted = {v: account.version(of[v], v, df, text[of[v]]) if v in of else df for v, df in raw.items()}
    tables = logical_tables(counted, day_partition)
    return {name: account.table(name, df, "ts" if "ts" in df.columns else None) for name, df in tables.items()}
