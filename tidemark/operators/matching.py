"""Matching keys across sources, category membership, lookups with defaults,
retention and reconciliation summaries.

The reference fetches key lists into the client and sends them back as bind
lists. Here every cross-source step is a join on the cluster: membership is a
semi-join (a log row counts once however often its key repeats in the list),
and the log side is aggregated to (key, bucket) counts before it is shuffled,
so a key that holds a third of all rows becomes a handful of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arith import safe_ratio, two_decimal
from ..functions.time import bucket_of
from .buckets import BUCKET


def _matched(log: DataFrame, keys: DataFrame, on: str, ts: str | None, grain: str, key: str, tag: str,
             where: Column | None, weight: str | None, group: Sequence[str] | None):
    """(log reduced to (key, *out_keys) counts) joined with the distinct
    (tag, key) lists; returns the joined frame and the output key names."""
    if where is not None:
        log = log.where(where)
    group_cols = [F.col(on).alias("_k")]
    out_keys: list[str] = []
    if ts is not None:
        group_cols.append(bucket_of(ts, grain).alias(BUCKET))
        out_keys.append(BUCKET)
    for g in group or []:
        group_cols.append(F.col(g))
        out_keys.append(g)
    n = F.sum(weight) if weight else F.count(F.lit(1))
    pre = log.where(F.col(on).isNotNull()).groupBy(*group_cols).agg(n.alias("_n"))
    lists = (keys.where(F.col(key).isNotNull())
             .select(F.col(tag).alias(tag), F.col(key).alias("_k")).distinct())
    return pre.join(lists, "_k"), out_keys


def match_keys(log: DataFrame, keys: DataFrame, on: str, ts: str | None = None,
               grain: str = "day", key: str = "key", tag: str = "tag",
               where: Column | None = None, weight: str | None = None,
               group: Sequence[str] | None = None) -> DataFrame:
    """Log rows whose ``on`` value is in each tagged key list, counted.

    ``keys(tag, key)`` may repeat; it is made distinct per (tag, key) so each
    log row counts at most once per tag (``IN`` semantics). Output is long:
    ``(bucket, tag, n)`` when ``ts`` is given, ``(*group, tag, n)`` when
    ``group`` names existing columns, else ``(tag, n)``; only non-zero
    counts appear. NULL keys never match. ``weight`` names a column holding
    pre-aggregated row counts, summed instead of counting rows.
    """
    joined, out_keys = _matched(log, keys, on, ts, grain, key, tag, where, weight, group)
    return joined.groupBy(*out_keys, tag).agg(F.sum("_n").cast("bigint").alias("n"))


def match_keys_wide(log: DataFrame, keys: DataFrame, on: str, tags: Sequence[str],
                    names: Sequence[str] | None = None, ts: str | None = None,
                    grain: str = "day", key: str = "key", tag: str = "tag",
                    where: Column | None = None, weight: str | None = None,
                    group: Sequence[str] | None = None) -> DataFrame:
    """:func:`match_keys` with one count column per tag (0 when none match).

    The tag columns are conditional sums taken directly over the joined
    rows, so the wide form costs one aggregation, like the long one.
    """
    names = list(names or tags)
    joined, out_keys = _matched(log, keys.where(F.col(tag).isin(list(tags))), on, ts, grain, key, tag,
                                where, weight, group)
    aggs = [F.sum(F.when(F.col(tag) == t, F.col("_n")).otherwise(F.lit(0))).cast("bigint").alias(n)
            for t, n in zip(tags, names)]
    return joined.groupBy(*out_keys).agg(*aggs) if out_keys else joined.agg(*aggs)


def pivot_tags(long: DataFrame, tags: Sequence[str], names: Sequence[str] | None = None,
               key: str = BUCKET, tag: str = "tag", value: str = "n") -> DataFrame:
    """Long ``(key, tag, value)`` to one column per tag. The tag list is given,
    so Spark needs no extra job to find the distinct values."""
    names = list(names or tags)
    wide = long.groupBy(key).pivot(tag, list(tags)).agg(F.first(value))
    return wide.select(key, *[F.col(f"`{t}`").alias(n) for t, n in zip(tags, names)])


def category_members(pages: DataFrame, links: DataFrame, category: str,
                     page_id: str = "page_id", link_from: str = "cl_from",
                     link_to: str = "cl_to") -> DataFrame:
    """Pages linked to ``category``: ``pages JOIN links ON cl_from = page_id
    WHERE cl_to = category``. An inner join: a page linked twice appears
    twice, as in the reference's fetched list."""
    chosen = links.where(F.col(link_to) == F.lit(category)).select(F.col(link_from).alias("_from"))
    return pages.join(chosen, pages[page_id] == chosen["_from"]).drop("_from")


def category_counts(links: DataFrame, categories: Mapping[str, str], link_to: str = "cl_to",
                    source: str = "source") -> DataFrame:
    """``COUNT(*) FROM links WHERE cl_to = category`` for several sources at
    once: one filtered scan, one small aggregate. Output ``(source, n)``."""
    cat = F.col(link_to)
    label = None
    for src, c in categories.items():
        label = F.when(cat == c, F.lit(src)) if label is None else label.when(cat == c, F.lit(src))
    rows = links.where(cat.isin(list(categories.values()))).select(label.alias(source))
    return rows.groupBy(source).agg(F.count(F.lit(1)).alias("n"))


def enrich_counts(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, value: str,
                  name: str | None = None, default=0) -> DataFrame:
    """Left-join a looked-up value onto ``df`` by key; a missing key gets
    ``default``. The lookup is reduced to one row per key first (largest
    value wins), so duplicate keys there cannot multiply rows of ``df``."""
    name = name or value
    table = (lookup.where(F.col(lookup_key).isNotNull())
             .groupBy(F.col(lookup_key).alias("_lk")).agg(F.max(value).alias("_lv")))
    out = df.join(table, df[key] == table["_lk"], "left")
    return out.select(*[df[c] for c in df.columns],
                      F.coalesce(F.col("_lv"), F.lit(default)).alias(name))


def retention_summary(totals: DataFrame, retained: DataFrame | None = None,
                      corrections: DataFrame | None = None, source: str = "source",
                      as_text: bool = False) -> DataFrame:
    """Per source: ``total`` (minus a known correction), ``undeleted`` and the
    fraction lost ``(total - undeleted) / total`` (NULL when total is 0).

    ``totals(source, total)``, ``retained(source, undeleted)``,
    ``corrections(source, correction)``. With ``retained=None`` the
    ``undeleted`` column is already in ``totals`` (one pass computed both).
    ``as_text`` adds the reference's two-decimal text form.
    """
    out = totals if retained is None else totals.join(retained, source, "left")
    if corrections is not None:
        out = out.join(corrections, source, "left")
        total = F.col("total") - F.coalesce(F.col("correction"), F.lit(0))
    else:
        total = F.col("total")
    out = out.select(source, total.cast("bigint").alias("total"),
                     F.coalesce(F.col("undeleted"), F.lit(0)).cast("bigint").alias("undeleted"))
    frac = safe_ratio(F.col("total") - F.col("undeleted"), F.col("total"))
    out = out.withColumn("deleted_fraction", frac)
    if as_text:
        out = out.withColumn("deletion_percentage", two_decimal("deleted_fraction"))
    return out


def source_reconciliation(claimed: DataFrame, log: DataFrame, sources: Sequence[str],
                          on: str, source: str = "source", key: str = "key",
                          labels: Sequence[str] = ("claimed", "found", "difference"),
                          names: Sequence[str] | None = None) -> DataFrame:
    """Three rows per the reference's check: how many keys each source
    claims (duplicates kept; NULL keys -- empty titles -- are not keys and
    are left out), how many log rows match them (each log row once per
    source) and the difference. One column per source.
    """
    names = list(names or sources)
    # One pass per side: claims reduced to (source, key, claims), the log to
    # (key, rows); a left join lines them up (a NULL key never matches).
    claims = (claimed.where(F.col(key).isNotNull())
              .groupBy(source, F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")))
    rows_per_key = (log.where(F.col(on).isNotNull())
                    .groupBy(F.col(on).alias("_k")).agg(F.count(F.lit(1)).alias("_m")))
    per = (claims.join(rows_per_key, "_k", "left")
           .groupBy(source).agg(F.sum("_n").alias("_c"), F.coalesce(F.sum("_m"), F.lit(0)).alias("_f")))
    values = [F.col("_c"), F.col("_f"), F.col("_c") - F.col("_f")]
    triples = F.array(*[F.struct(F.lit(lab).alias("label"), v.alias("v")) for lab, v in zip(labels, values)])
    rows = per.select(source, F.inline(triples))
    return rows.groupBy("label").agg(*[
        F.coalesce(F.sum(F.when(F.col(source) == s, F.col("v"))), F.lit(0)).cast("bigint").alias(n)
        for s, n in zip(sources, names)])
