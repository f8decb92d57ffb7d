"""Small helpers shared by the operators: table access, scratch tables that
survive lost executors, size-checked broadcasts, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: One word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows, and measured bytes, up to which a side is broadcast; larger sides are shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of the whole text as long; null text: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that ``df`` does not use, whatever columns it brings."""
    used = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name = f"__{base}"
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    For wide rows (column pruning, compression). The folder goes when the
    application ends.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if its counted rows are at most
    ``BROADCAST_ROWS``; else unmarked, so that the join shuffles both sides."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def width(df: DataFrame) -> Column:
    """About the bytes of a row: text and bytes as long as they are, lists and structs as their JSON."""
    sizes = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            sizes.append(F.octet_length(c) + 16)
        elif kind in ("array", "struct", "map"):
            sizes.append(F.octet_length(F.to_json(F.struct(c))) + 16)
    return sum((F.coalesce(s, F.lit(8)) for s in sizes), F.lit(8 * (len(df.columns) - len(sizes)) + 16)).cast("long")


def light(df: DataFrame) -> DataFrame:
    """``small`` for rows of any width: their bytes are measured too."""
    n, size = df.agg(F.count("*"), F.sum(width(df))).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else df


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph by alternating large and small stars.

    ``edges`` has long columns ``a`` and ``b``; rows with a null or with
    ``a = b`` say nothing and are left out. Returns ``node``, ``component``
    (the smallest node reachable) for every node that is not itself its
    component. Each round is a few joins and partial aggregates; no node's
    neighbours are gathered in one place.
    """
    a, b = F.col("a"), F.col("b")
    e = settle(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    mark = None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark or now[0] == 0:
            return e.select(a.alias("node"), b.alias("component"))
        mark = now
        both = e.select(a.alias("u"), b.alias("v")).unionAll(e.select(b.alias("u"), a.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        e = settle(moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct())
