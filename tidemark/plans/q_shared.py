"""All count reports of the catalogue at once, each table scanned once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from .catalog import REGISTRY, register
from .q_reports import (
    _CLICKS2,
    _UI_METRICS,
    AS_OF,
    STARTS,
    _closed_sql,
    derived_more,
    derived_tables,
    derived_tracking,
)
from .reports import REPORTS, run_all

#: Queries of single reports whose names differ from the report's.
_NAMED = {"edits-monthly-successful": "report_monthly_successful_edits"}
COUNT_REPORTS = [r.name for r in REPORTS.values() if r.counts]


def _oracle(name: str) -> str:
    if name == "ui-daily":  # over the click names that the other click reports have too
        return _closed_sql(_CLICKS2, [(k, f"x.event_name = '{n}'") for k, n in _UI_METRICS])
    return REGISTRY[_NAMED.get(name, "report_" + name.replace("-", "_"))].oracle


def _metrics(name: str) -> list[str]:
    return [c for c in REPORTS[name].labels if c != "bucket"]


def all_tables(spark, sf_dir) -> dict:
    return derived_tables(spark, sf_dir) | derived_more(spark, sf_dir) | derived_tracking(spark, sf_dir)


def long_form(df, name: str):
    """``report``, ``bucket``, ``metric``, ``value``: one row for each number of a series."""
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in df.columns if c != "bucket"]
    return df.select(F.lit(name).alias("report"), "bucket", F.inline(F.array(*cells)))


@register("run_all", covers="run_all J-12 R-01..R-35: every count report from one scan of each table", oracle=" UNION ALL ".join(
    f"SELECT '{name}' AS report, bucket, '{m}' AS metric, {m} AS value FROM ({_oracle(name)})"
    for name in COUNT_REPORTS for m in _metrics(name)))
def run_all_query(spark, sf_dir):
    series = run_all(all_tables(spark, sf_dir), AS_OF, names=COUNT_REPORTS, starts=STARTS)
    return reduce(lambda a, b: a.unionAll(b), [long_form(df, name) for name, df in series.items()])
