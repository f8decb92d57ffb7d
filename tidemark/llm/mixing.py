"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, settle, small, word_count

SEEDS = 16


def uniform(key: Column, seed: Column) -> Column:
    """Number in [0, 1) from the key and a seed: eight hex digits of an MD5."""
    digest = F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), F.floor(seed / 4).cast("string")))
    part = F.substring(digest, (seed % 4).cast("int") * 8 + 1, F.lit(8))
    return F.conv(part, 16, 10).cast("long") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, source: str, size: str, weights=(1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """Per source its ``source_size``, ``target`` and ``rate``.

    Sources in code-point order, null last, take ``weights`` in turn and share
    the total size. A target stops at ``max_repeat`` times its source's size;
    the excess goes to the others by weight until none is above. That fixed
    point is a water level: sources sorted by ``max_repeat * size / weight``
    are full up to the first whose limit the level over the rest does not
    reach. The windows run over one row per source.
    """
    by_source = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    order = Window.orderBy(F.col(source).asc_nulls_last())
    every = Window.partitionBy()
    fill = Window.orderBy("limit", F.col(source).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = F.col("source_size")
    out = (by_source.withColumn("weight", weight)
           .withColumn("limit", max_repeat * s / F.col("weight"))
           .withColumn("full", F.coalesce(F.sum(s).over(fill), F.lit(0)))
           .withColumn("full_weight", F.coalesce(F.sum("weight").over(fill), F.lit(0.0)))
           .withColumn("level", (F.sum(s).over(every) - max_repeat * F.col("full"))
                       / (F.sum("weight").over(every) - F.col("full_weight"))))
    level = F.min(F.when(F.col("level") <= F.col("limit"), F.struct("limit", source, "level"))).over(every)
    out = out.withColumn("at", level["level"])
    target = F.least(max_repeat * s.cast("double"), F.col("at") * F.col("weight"))
    return (out.withColumn("target", target)
            .withColumn("rate", F.when(s > 0, F.col("target") / s).otherwise(0.0))
            .select(source, "source_size", "target", "rate"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=(1, 2, 3), max_repeat: int = 3, seeds: int = SEEDS) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``, ``rate``, ``seed``.

    A document is taken ``floor(rate)`` times plus one Bernoulli copy with
    probability equal to the fraction, drawn from ``uniform(id, seed)``. Of a
    fixed number of seeds each source takes the one whose total comes nearest
    to its target (the smallest such seed), so reruns agree.
    """
    sized = settle(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                               word_count(F.col(text_col)).alias("size")))
    targets = settle(source_targets(sized, "source", "size", weights, max_repeat))
    n = targets.count()
    rated = sized.alias("d").join(small(targets, n).alias("t"), F.expr("d.source <=> t.source"))
    rated = rated.select("t.source", "target", "source_size", "rate", "id", "size")
    whole, part = F.floor("rate"), F.col("rate") - F.floor("rate")
    drawn = [F.sum(F.col("size") * (whole + (uniform(F.col("id"), F.lit(k)) < part).cast("long"))).alias(f"s{k}")
             for k in range(seeds)]
    sums = rated.groupBy("source").agg(F.first("target").alias("target"), F.first("source_size").alias("source_size"),
                                       F.first("rate").alias("rate"), *drawn)
    best = F.least(*[F.struct(F.abs(F.col(f"s{k}") - F.col("target")), F.lit(k).alias("seed")) for k in range(seeds)])
    return settle(sums.select("source", "source_size", "target", "rate", best["seed"].alias("seed")))


def mix_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights=(1, 2, 3), max_repeat: int = 3, seeds: int = SEEDS) -> DataFrame:
    """All rows of ``docs`` with ``source_size``, ``target`` and ``copies`` (long).

    Defined cases: null text or no word: size 0 (the rate still applies);
    null source: a source of its own, last in order; sources of size 0: target
    0 and no copies; null id: drawn as an empty id; repeated rows are drawn
    alike; an empty table stays empty. Extra columns are kept; one called
    ``source_size``, ``target`` or ``copies`` is replaced.
    """
    plan = mix_plan(docs, id_col, text_col, source_col, weights, max_repeat, seeds)
    n = plan.count()
    src, rate, seed, total, aim = fresh(docs, "source", "rate", "seed", "total", "aim")
    plan = plan.select(F.col("source").alias(src), F.col("rate").alias(rate), F.col("seed").alias(seed),
                       F.col("source_size").alias(total), F.col("target").alias(aim))
    joined = docs.join(small(plan, n), docs[source_col].eqNullSafe(plan[src]))
    extra = uniform(F.col(id_col), F.col(seed)) < F.col(rate) - F.floor(rate)
    copies = F.floor(rate) + extra.cast("long")
    return joined.withColumns({"source_size": F.col(total), "target": F.col(aim), "copies": copies}).drop(
        src, rate, seed, total, aim)


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, each row as often as it is taken."""
    row, again = fresh(docs, "row", "again")
    read = [how.get(f"{k}_col", d) for k, d in (("id", "doc_id"), ("text", "text"), ("source", "source"))]
    taken = mix_copies(docs.select(F.struct(*docs.columns).alias(row), *read), **how).where("copies > 0")
    return taken.withColumn(again, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(f"{row}.*")
