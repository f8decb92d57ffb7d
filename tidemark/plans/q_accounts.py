"""Rows accounted for by a report's own scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.accounting import Accounting, counted_tables
from .catalog import register
from .q_reports import _EDITS_CTE, NEW_FROM, OLD_BEFORE, derived_raw
from .reports import run_report

FIRST, LAST = "2024-01-12", "2024-01-30"


_BAD = "CAST(substr(event_username, 5) AS BIGINT) % 50 = 0"
_COLUMNS = "wiki, event_username, event_action, event_namespace, event_userEditCount"


@register("row_accounts", covers="row accounting S-13 F-07 X-17 U-01: read, unparsed, outside, removed by UNION", oracle=f"""
WITH {_EDITS_CTE},
v AS (
  SELECT 'MobileWebEditing_5644223' AS version, COUNT(*) AS rows, COUNT(*) FILTER ({_BAD}) AS unparsed
  FROM e WHERE ts < TIMESTAMP '{OLD_BEFORE} 00:00:00'
  UNION ALL
  SELECT 'MobileWebEditing_6077315', COUNT(*), 0 FROM e WHERE ts >= TIMESTAMP '{NEW_FROM} 00:00:00'),
t AS (
  SELECT timestamp || CASE WHEN {_BAD} THEN '?' ELSE '' END AS timestamp, {_COLUMNS} FROM e WHERE ts < TIMESTAMP '{OLD_BEFORE} 00:00:00'
  UNION
  SELECT timestamp, {_COLUMNS} FROM e WHERE ts >= TIMESTAMP '{NEW_FROM} 00:00:00')
SELECT version, CAST(rows AS BIGINT) AS rows, CAST(0 AS BIGINT) AS no_time, CAST(unparsed AS BIGINT) AS unparsed,
  NULL::BIGINT AS outside, NULL::BIGINT AS removed FROM v
UNION ALL
SELECT NULL, COUNT(*), NULL, NULL, COUNT(*) FILTER (timestamp NOT LIKE '%?' AND timestamp < '20240112000000'),
  (SELECT CAST(SUM(rows) AS BIGINT) FROM v) - COUNT(*) FROM t
""")
def row_accounts(spark, sf_dir):
    """The edit log in two overlapping versions, in the older one the times of every fiftieth user's
    rows are no times: what the run of a report over the days from the 12th on counted."""
    old, new = "MobileWebEditing_5644223", "MobileWebEditing_6077315"
    raw = derived_raw(spark, sf_dir)
    text = F.col("timestamp")
    raw = {old: raw[old].withColumn("timestamp", F.when(F.expr(_BAD), F.concat(text, F.lit("?"))).otherwise(text)), new: raw[new]}
    account = Accounting(FIRST, LAST)
    out = run_report(counted_tables(raw, account), "successful-edits-main", LAST)
    out.write.parquet(scratch_dir(spark, "series"))
    rows = [f[1:] for f in account.figures(out)]
    return spark.createDataFrame(rows, "version string, rows bigint, no_time bigint, unparsed bigint, outside bigint, removed bigint")
