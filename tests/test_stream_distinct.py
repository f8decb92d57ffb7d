"""Streams over overlapping schema versions: any file order, restarts, equal to the batch result."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import raw_tables
from tidemark.operators.buckets import bucket_distinct, bucket_pivot
from tidemark.sources.logical import PROJECTIONS, VERSIONS, logical_tables
from tidemark.streaming.distinct import streaming_distinct_users, streaming_version_counts

COLUMNS = PROJECTIONS["edits_web"]
OK = "event_action = 'success'"


def metrics():
    return {"main": F.col("event_namespace") == 0, "newbie": F.col("event_userEditCount") == 0}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def versions(spark, tmp_path_factory):
    """Rows of each version in many small files, those of the first two in disorder."""
    raw = {n: df for n, df in raw_tables(spark).items() if n in VERSIONS["edits_web"]}
    first, second = list(raw)[:2]
    # the overlap: half of the first version's rows are in the second too
    common = raw[first].where(F.crc32(F.col("timestamp").cast("binary")) % 2 == 0)
    raw[second] = raw[second].unionByName(common, allowMissingColumns=True)
    rnd = random.Random(3)
    files = []
    for name, df in raw.items():
        parts = df.collect()
        rnd.shuffle(parts)
        step = max(1, len(parts) // 3)
        files += [(name, df.schema, parts[k:k + step]) for k in range(0, len(parts), step)]
    rnd.shuffle(files)
    return raw, files


def put(spark, root, files):
    for name, schema, part in files:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/{name}")


def named(raw, root):
    return [(f"{root}/{n}", df.schema) for n, df in raw.items()]


@pytest.mark.parametrize("expiry", [None, "3650 days"])
def test_counts_equal_the_batch_union(spark, tmp_path, versions, expiry):
    raw, files = versions
    src, sink, log = (str(tmp_path / x) for x in ("src", "sink", "log"))
    put(spark, src, [(n, df.schema, df.limit(0).collect()) for n, df in raw.items()])
    for part in (files[: len(files) // 2], files[len(files) // 2:]):  # a restart in between
        put(spark, src, part)
        streaming_version_counts(spark, named(raw, src), COLUMNS, metrics(), sink, log, where=F.expr(OK), expiry=expiry, max_files_per_trigger=1)
    batch = logical_tables(raw)["edits_web"].where("ts is not null")
    want = bucket_pivot(batch, "ts", "day", metrics(), total="total", where=F.expr(OK))
    got = spark.read.parquet(sink).select("bucket", "total", "main", "newbie")
    assert rows_of(got) == rows_of(want) and got.count() > 5
    # the overlap matters: without removing repeats there are more
    union = None
    for df in raw.values():
        part = df.select(*[c if c in df.columns else F.lit(None).alias(c) for c in COLUMNS])
        union = part if union is None else union.unionByName(part)
    assert union.where(OK).count() > want.agg(F.sum("total")).first()[0]


def test_distinct_users_equal_the_batch(spark, tmp_path, versions):
    raw, files = versions
    src, sink, log = (str(tmp_path / x) for x in ("src", "sink", "log"))
    put(spark, src, [(n, df.schema, df.limit(0).collect()) for n, df in raw.items()])
    for part in (files[1::2], files[::2]):
        put(spark, src, part)
        streaming_distinct_users(spark, named(raw, src), COLUMNS, "event_username", metrics(), sink, log, where=F.expr(OK), max_files_per_trigger=2)
    want = bucket_distinct(logical_tables(raw)["edits_web"].where("ts is not null"), "ts", "day", "event_username", metrics(), where=F.expr(OK))
    want = want.where("main > 0 or newbie > 0")
    assert rows_of(spark.read.parquet(sink).select("bucket", "main", "newbie")) == rows_of(want)
