"""Queries for key normalisation, matching, membership and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import normalise_title, normalise_user
from ..operators.buckets import BUCKET, densify, in_range, spine_between, spine_bounds
from ..operators.matching import (
    category_counts,
    category_members,
    enrich_counts,
    match_keys,
    match_keys_wide,
    retention_summary,
    source_reconciliation,
)
from .catalog import register, table
from .q_buckets import STATUSES

PART_TAGS = ("ECONOMY", "PROMO", "STANDARD")
SHIP_AS_OF = "2001-11-04"
# Known miscounts per source, subtracted from the totals (the reference keeps
# such a table of constants for its sources). Fixed values:
CORRECTIONS = {"F": 5, "O": 3, "P": 0}


def _norm_sql(expr: str) -> str:
    return (f"CASE WHEN length({expr}) > 0 THEN replace(replace("
            f"upper(substr({expr}, 1, 1)) || substr({expr}, 2), 'File:', ''), ' ', '_') END")


def _raw_title():
    """A title as an upload log would hold it: some with a lower-case
    ``file:`` prefix, all with spaces."""
    return F.when(F.col("p_size") > 25, F.concat(F.lit("file:"), F.col("p_name"))).otherwise(F.col("p_name"))


_RAW_TITLE_SQL = "CASE WHEN p_size > 25 THEN 'file:' || p_name ELSE p_name END"


@register("normalise_title", covers="normalise_title X-12 X-13", oracle=f"""
SELECT p_partkey, {_norm_sql(_RAW_TITLE_SQL)} AS title FROM part
""")
def normalise_title_query(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", normalise_title(_raw_title()).alias("title"))


@register("normalise_title_binary", covers="normalise_title X-15 (UTF-8 bytes as stored by a wiki database)", oracle=f"""
SELECT p_partkey, {_norm_sql("'é ' || p_name")} AS title FROM part
""")
def normalise_title_binary_query(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    stored = F.encode(F.concat(F.lit("é "), F.col("p_name")), "UTF-8")
    return part.select("p_partkey", normalise_title(stored, binary=True).alias("title"))


@register("normalise_user", covers="normalise_user X-12 X-14", oracle="""
SELECT c_custkey,
  CASE WHEN length(trim('  ' || lower(c_name) || ' ')) > 0 THEN
    upper(substr(trim('  ' || lower(c_name) || ' '), 1, 1)) || substr(trim('  ' || lower(c_name) || ' '), 2)
  END AS user_key
FROM customer
""")
def normalise_user_query(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    padded = F.concat(F.lit("  "), F.lower("c_name"), F.lit(" "))
    return customer.select("c_custkey", normalise_user(padded).alias("user_key"))


def _title_log(spark, sf_dir, start=None, end=None):
    """Line items with the (canonical) title of their part. The line items
    are reduced to (part, month) counts before the join, so the join moves
    at most parts x months rows. ``start``/``end`` (months) filter the raw
    ship date, which reaches the Parquet scan."""
    lineitem = in_range(table(spark, sf_dir, "lineitem"), "l_shipdate", start, end, "month")
    part = table(spark, sf_dir, "part")
    per_part = (lineitem.groupBy("l_partkey", F.trunc(F.to_date("l_shipdate"), "MM").alias(BUCKET))
                .agg(F.count(F.lit(1)).alias("lines")))
    titled = per_part.join(part.select("p_partkey", normalise_title("p_name").alias("title")),
                           per_part["l_partkey"] == F.col("p_partkey"))
    return titled.select(BUCKET, "title", "lines")


def _tag_keys(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_type").alias("tag"), normalise_title(_raw_title()).alias("key"))


_MATCH_CTE = f"""
keys AS (
  SELECT DISTINCT p_type AS tag, {_norm_sql(_RAW_TITLE_SQL)} AS key
  FROM part),
log AS (
  SELECT CAST(date_trunc('month', l.l_shipdate) AS DATE) AS bucket, {_norm_sql('p.p_name')} AS title
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


@register("match_keys", covers="match_keys S-10 F-17 J-N9 (semi-join per tag)", oracle=f"""
WITH {_MATCH_CTE}
SELECT log.bucket, keys.tag, COUNT(*) AS n
FROM log JOIN keys ON log.title = keys.key
GROUP BY log.bucket, keys.tag
""")
def match_keys_query(spark, sf_dir):
    """Line items per ship month whose part title is in each part type's
    normalised title list (titles repeat across types and within one)."""
    log = _title_log(spark, sf_dir)
    return match_keys(log, _tag_keys(spark, sf_dir), "title", weight="lines", group=[BUCKET])


@register("match_keys_dense", covers="match_keys densify R-25 J-N3 D-01", oracle=f"""
WITH {_MATCH_CTE},
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '2000-12-01', DATE '2001-11-01', INTERVAL 1 MONTH) t(d)),
agg AS (
  SELECT log.bucket,
    SUM(CASE WHEN keys.tag = 'ECONOMY' THEN 1 ELSE 0 END) AS economy,
    SUM(CASE WHEN keys.tag = 'PROMO' THEN 1 ELSE 0 END) AS promo,
    SUM(CASE WHEN keys.tag = 'STANDARD' THEN 1 ELSE 0 END) AS standard
  FROM log JOIN keys ON log.title = keys.key GROUP BY log.bucket)
SELECT s.bucket,
  CAST(COALESCE(a.economy, 0) AS BIGINT) AS economy,
  CAST(COALESCE(a.promo, 0) AS BIGINT) AS promo,
  CAST(COALESCE(a.standard, 0) AS BIGINT) AS standard
FROM spine s LEFT JOIN agg a ON s.bucket = a.bucket
""")
def match_keys_dense(spark, sf_dir):
    """The deleted-uploads shape: 12-month calendar, one column per key list."""
    start, end = spine_bounds(SHIP_AS_OF, 12, "month")
    log = _title_log(spark, sf_dir, start, end)
    wide = match_keys_wide(log, _tag_keys(spark, sf_dir), "title", PART_TAGS,
                           [t.lower() for t in PART_TAGS], weight="lines", group=[BUCKET])
    return densify(spine_between(spark, start, end, "month"), wide, fill=0)


@register("category_members", covers="category_members J-N7 F-18", oracle="""
SELECT p.p_partkey AS page_id, p.p_name AS page_title
FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey
WHERE l.l_returnflag = 'R'
""")
def category_members_query(spark, sf_dir):
    pages = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"),
                                                F.col("p_name").alias("page_title"))
    links = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("cl_from"),
                                                    F.col("l_returnflag").alias("cl_to"))
    return category_members(pages, links, "R")


@register("enrich_counts", covers="enrich_counts J-N10 R-22", oracle="""
SELECT o.o_orderstatus AS source, o.o_custkey AS user_key, COUNT(*) AS uploads,
  COALESCE(MAX(c.c_acctbal), 0) AS edits
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY o.o_orderstatus, o.o_custkey
""")
def enrich_counts_query(spark, sf_dir):
    """Orders per (status, customer) with the customer's balance, 0 when
    the customer is unknown."""
    orders = table(spark, sf_dir, "orders")
    per_user = orders.groupBy(F.col("o_orderstatus").alias("source"),
                              F.col("o_custkey").alias("user_key")).agg(F.count(F.lit(1)).alias("uploads"))
    return enrich_counts(per_user, "user_key", table(spark, sf_dir, "customer"), "c_custkey",
                         "c_acctbal", name="edits", default=0.0)


@register("retention_summary", covers="retention_summary R-23 A-14 P-08 X-10", oracle=f"""
WITH totals AS (SELECT o_orderstatus AS source, COUNT(*) AS total FROM orders GROUP BY 1),
kept AS (
  SELECT o_orderstatus AS source, COUNT(*) AS undeleted FROM orders
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1),
corr AS (SELECT * FROM (VALUES {', '.join(f"('{k}', {v})" for k, v in CORRECTIONS.items())}) t(source, correction))
SELECT t.source,
  CAST(t.total - COALESCE(c.correction, 0) AS BIGINT) AS total,
  CAST(COALESCE(k.undeleted, 0) AS BIGINT) AS undeleted,
  ROUND(CAST(t.total - COALESCE(c.correction, 0) - COALESCE(k.undeleted, 0) AS DOUBLE)
        / NULLIF(t.total - COALESCE(c.correction, 0), 0), 6) AS deleted_fraction
FROM totals t LEFT JOIN kept k ON t.source = k.source LEFT JOIN corr c ON t.source = c.source
""")
def retention_summary_query(spark, sf_dir):
    """Orders per status (less a known correction), how many still have
    line items, and the fraction without."""
    orders = table(spark, sf_dir, "orders")
    # One pass over orders: a left join to the distinct line-item keys
    # (reduced map-side before the shuffle) marks the orders that are kept.
    kept_keys = (table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
                 .distinct().withColumn("_kept", F.lit(1)))
    per_status = (orders.select("o_orderkey", "o_orderstatus").join(kept_keys, "o_orderkey", "left")
                  .groupBy(F.col("o_orderstatus").alias("source"))
                  .agg(F.count(F.lit(1)).alias("total"), F.count("_kept").alias("undeleted")))
    corrections = spark.createDataFrame(list(CORRECTIONS.items()), "source string, correction bigint")
    out = retention_summary(per_status, None, F.broadcast(corrections))
    return out.withColumn("deleted_fraction", F.round("deleted_fraction", 6))


@register("source_reconciliation", covers="source_reconciliation R-35 J-N13 A-13 U-03", oracle="""
WITH claimed AS (SELECT o_orderstatus AS source, o_orderkey AS key FROM orders),
c AS (SELECT source, COUNT(*) AS v FROM claimed GROUP BY 1),
f AS (
  SELECT k.source, COUNT(*) AS v
  FROM lineitem l JOIN (SELECT DISTINCT source, key FROM claimed) k ON l.l_orderkey = k.key
  GROUP BY 1),
rows AS (
  SELECT 'claimed' AS label, source, v FROM c
  UNION ALL SELECT 'found', source, v FROM f
  UNION ALL SELECT 'difference', c.source, c.v - COALESCE(f.v, 0) FROM c LEFT JOIN f ON c.source = f.source)
SELECT label,
  CAST(COALESCE(SUM(CASE WHEN source = 'F' THEN v END), 0) AS BIGINT) AS f,
  CAST(COALESCE(SUM(CASE WHEN source = 'O' THEN v END), 0) AS BIGINT) AS o,
  CAST(COALESCE(SUM(CASE WHEN source = 'P' THEN v END), 0) AS BIGINT) AS p
FROM rows GROUP BY label
""")
def source_reconciliation_query(spark, sf_dir):
    """Orders claimed per status vs line items found for them."""
    orders = table(spark, sf_dir, "orders")
    claimed = orders.select(F.col("o_orderstatus").alias("source"), F.col("o_orderkey").alias("key"))
    return source_reconciliation(claimed, table(spark, sf_dir, "lineitem"), STATUSES, "l_orderkey",
                                 names=[s.lower() for s in STATUSES])


@register("category_counts", covers="category_counts R-23 (members per source in one scan)", oracle="""
SELECT CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' END AS source, COUNT(*) AS n
FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY 1
""")
def category_counts_query(spark, sf_dir):
    """Line items per category for two named sources in one filtered scan."""
    links = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("cl_to"))
    return category_counts(links, {"returned": "R", "accepted": "A"})
