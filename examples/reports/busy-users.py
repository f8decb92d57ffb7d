"""Users with at least five events on a day."""

from pyspark.sql import functions as F

LEAST = 5


def build(tables, params):
    per_day = tables["events"].groupBy(F.to_date("ts").alias("bucket"), "user_id").count()
    busy = per_day.where((F.col("count") >= LEAST) & (F.col("bucket") <= F.lit(params.as_of)))
    return busy.groupBy("bucket").agg(F.count(F.lit(1)).alias("users"))
