"""Reports kept as files, run by name."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from .catalog import register, table
from .files import with_files
from .q_reports import AS_OF
from .reports import run_report

FOLDER = Path(__file__).resolve().parents[2] / "examples" / "reports"


@register("reports_from_files", covers="reports as files J-12 S-11: one in SQL, one in Python, run by name", oracle=f"""
SELECT 'value-by-type' AS report, CAST(ts AS DATE) AS bucket, event_type AS name, COUNT(*) AS n, CAST(floor(SUM(value)) AS BIGINT) AS value
FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND CAST(ts AS DATE) <= DATE '{AS_OF}' GROUP BY 2, 3
UNION ALL
SELECT 'busy-users', bucket, 'users', COUNT(*), NULL FROM (
  SELECT CAST(ts AS DATE) AS bucket, user_id, COUNT(*) AS c FROM events GROUP BY 1, 2) u
WHERE c >= 5 AND bucket <= DATE '{AS_OF}' GROUP BY bucket
""")
def reports_from_files(spark, sf_dir):
    tables, registry = {"events": table(spark, sf_dir, "events")}, with_files(FOLDER)
    by_type = run_report(tables, "value-by-type", AS_OF, registry=registry)
    busy = run_report(tables, "busy-users", AS_OF, registry=registry)
    return by_type.select(F.lit("value-by-type").alias("report"), "bucket", F.col("event_type").alias("name"),
                          F.col("events").alias("n"), "value").unionAll(
        busy.select(F.lit("busy-users"), "bucket", F.lit("users"), "users", F.lit(None).cast("bigint")))
