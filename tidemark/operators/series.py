"""Series at the edges: writing, reading back, describing, period deltas."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from ..functions.arith import safe_ratio
from .buckets import BUCKET

SERIES_FORMATS = ("csv", "parquet")


def _bare(path: str) -> str:
    """A path without scheme and authority, to compare with another."""
    return "/" + re.sub(r"^\w+:(//[^/]*)?", "", path).strip("/")


def _reads_from(df: DataFrame, path: str) -> bool:
    """Whether a file source of the plan lies at, in or above ``path``: from
    the root paths of its relations, without listing a file."""
    target = _bare(path) + "/"
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith("LogicalRelation") or leaf.nodeName().startswith("Relation"):
            relation = leaf.relation()
            if not hasattr(relation, "location") or "HadoopFsRelation" not in relation.getClass().getName():
                continue
            roots = relation.location().rootPaths()
            for k in range(roots.size()):
                root = _bare(roots.apply(k).toString()) + "/"
                if root.startswith(target) or target.startswith(root):
                    return True
    return False


def write_series(df: DataFrame, path: str, fmt: str = "csv", key: str = BUCKET,
                 labels: Mapping[str, str] | None = None, partitioned: bool = False,
                 replace: bool = True) -> None:
    """Write a series, fully replacing what is at ``path`` (``replace=False``:
    failing if something is there).

    ``csv`` is the reference's sink: a header line and rows sorted by the
    bucket key. The sort is a range partitioning, so part files are in key
    order and no single task has to take the whole series; AQE coalesces a
    small series (one row per bucket) into a single file by itself.
    ``labels`` renames columns for display. ``parquet`` with ``partitioned=True`` writes one
    partition per bucket with dynamic partition overwrite, so a refresh
    replaces only the buckets it carries. Writing to a path the plan reads
    from is refused: write to a new path and switch instead.
    """
    if fmt not in SERIES_FORMATS:
        raise ValueError(f"fmt must be one of {SERIES_FORMATS}")
    if _reads_from(df, path):
        raise ValueError(f"refusing to overwrite {path!r}: the series is computed from it")
    out = df
    key = key if key in df.columns else df.columns[0]  # a summary without buckets
    if labels:
        out = out.select(*[F.col(c).alias(labels.get(c, c)) for c in out.columns])
    if fmt == "csv":
        (out.orderBy(labels.get(key, key) if labels else key)
         .write.mode("overwrite" if replace else "error").option("header", True).option("dateFormat", "yyyy-MM-dd")
         .csv(path))
        return
    writer = out.write.mode("overwrite" if replace else "error")
    if partitioned:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(key)
    writer.parquet(path)


def read_series(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "csv") -> DataFrame:
    """Read a stored series with an explicit schema (no inference)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    return reader.parquet(path)


def describe_series(df: DataFrame | StructType, name: str,
                    labels: Mapping[str, str] | None = None) -> list[tuple]:
    """Descriptor rows ``(report, ordinal, column, type, label)``.

    Column 0 is the date key, the rest are integers or numbers, as the
    dashboard descriptor expects. Schema metadata only, so a plain list;
    ``spark.createDataFrame(rows, DESCRIPTOR_SCHEMA)`` makes it a table.
    """
    schema = df.schema if isinstance(df, DataFrame) else df
    rows = []
    for i, f in enumerate(schema.fields):
        if i == 0 or isinstance(f.dataType, DateType):
            kind = "date"
        elif f.dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
            kind = "int"
        elif f.dataType.simpleString() == "string":
            kind = "string"
        else:
            kind = "float"
        rows.append((name, i, f.name, kind, (labels or {}).get(f.name, f.name)))
    return rows


DESCRIPTOR_SCHEMA = "report string, ordinal int, column string, type string, label string"


def period_delta(series: DataFrame, metric: str, steps: Mapping[str, int],
                 key: str = BUCKET, grain: str = "month") -> DataFrame:
    """Each bucket's value next to its value ``k`` buckets earlier, and the
    relative change ``(now - then) / then`` (NULL without a base).

    ``steps`` maps a suffix to a number of buckets, e.g. ``{'1m': 1,
    '1y': 12}``. One pass: every row is sent to its own bucket and to the
    buckets ``k`` later (an ``explode`` of 1 + len(steps) entries), then one
    ``groupBy`` lines the values up -- no self-join, so the series is
    computed once, and no window over the whole series in a single task.
    """
    def shift(k):
        return F.date_add(F.col(key), k) if grain == "day" else F.add_months(F.col(key), k)
    targets = [F.struct(F.col(key).alias("_b"), F.lit("").alias("_kind"))]
    targets += [F.struct(shift(k).alias("_b"), F.lit(suffix).alias("_kind")) for suffix, k in steps.items()]
    sent = series.select(F.col(metric).alias("_v"), F.inline(F.array(*targets)))
    aggs = [F.max(F.when(F.col("_kind") == "", F.lit(True))).alias("_present"),
            F.sum(F.when(F.col("_kind") == "", F.col("_v"))).alias("value")]
    aggs += [F.sum(F.when(F.col("_kind") == sfx, F.col("_v"))).alias(f"value_{sfx}") for sfx in steps]
    lined = sent.groupBy(F.col("_b").alias(key)).agg(*aggs).where(F.col("_present"))
    cols = [key, F.col("value").cast(series.schema[metric].dataType).alias("value")]
    for sfx in steps:
        then = F.col(f"value_{sfx}").cast(series.schema[metric].dataType)
        cols += [then.alias(f"value_{sfx}"),
                 safe_ratio(F.col("value") - F.col(f"value_{sfx}"), F.col(f"value_{sfx}")).alias(f"change_{sfx}")]
    return lined.select(*cols)


# ---------------------------------------------------------------- history ---

HISTORY_SCHEMA = "report string, last_run timestamp"


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """Latest run per report from an append-only history folder.

    A missing folder is an empty history (every report due). An unreadable file
    in it is an error: dropping it would hide a loss of history.
    """
    from pyspark.errors import AnalysisException
    try:
        rows = spark.read.schema(HISTORY_SCHEMA).parquet(root)
        rows.schema  # resolve now: a missing folder raises here
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], HISTORY_SCHEMA)
    return rows.groupBy("report").agg(F.max("last_run").alias("last_run"))


def append_history(runs: DataFrame, root: str) -> None:
    """Append ``runs(report, last_run)``. Appends never rewrite what a
    concurrent reader is reading; readers take the latest row per report."""
    runs.select("report", F.col("last_run").cast("timestamp")).write.mode("append").parquet(root)


#: Files of a run history from which it is compacted.
HISTORY_FILES = 200


def compact_history(spark: SparkSession, root: str, files: int = HISTORY_FILES) -> bool:
    """Put the latest run per report in one file if the history has ``files`` or more.

    What is there is listed first; the new file is written beside it, and only the listed files
    go then. A run that is appended meanwhile stays, and one that is lost in between leaves
    rows twice, which readers do not mind.
    """
    from pyspark.errors import AnalysisException
    try:
        listed = spark.read.schema(HISTORY_SCHEMA).parquet(root).inputFiles()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    if len(listed) < files:
        return False
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    uri = spark.sparkContext._jvm.java.net.URI  # the names are encoded
    paths = [hadoop(uri(name)) for name in listed]
    rows = spark.read.schema(HISTORY_SCHEMA).parquet(*[p.toString() for p in paths])
    # one row a report
    append_history(rows.groupBy("report").agg(F.max("last_run").alias("last_run")).coalesce(1), root)
    for path in paths:
        path.getFileSystem(conf).delete(path, False)
    return True
