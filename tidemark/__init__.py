"""tidemark: contribution metrics on Spark.

Event logs and account tables become time series -- bucketed counts,
distinct users, dense calendars, funnels, rolling ratios, rolling cohorts,
title and user matching, retention and reconciliation summaries, and
incremental bucket-by-bucket refresh -- all as DataFrame plans.
"""

__version__ = "0.1.0"
