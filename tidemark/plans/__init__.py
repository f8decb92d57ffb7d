"""Query plans: the test-data query registry and the report catalogue."""

from .catalog import REGISTRY  # noqa: F401
from . import q_buckets, q_cohorts, q_matching, q_reports, q_series, q_timebox  # noqa: F401  (registers queries)
from . import q_accounts, q_files, q_refresh, q_shared, q_users, q_versions  # noqa: E402,F401  (after the reports whose oracles they share)
