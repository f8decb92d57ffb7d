"""Logical tables of the contribution-metrics reports.

Raw event tables come one per schema version and hold a 14-digit text
``timestamp``. The logical tables are unions over versions on a fixed
projection (``UNION`` = distinct where the reports used it), with the time
parsed once into ``ts``. Wiki tables get their ``*_timestamp`` parsed the
same way. Names, versions and projections below are fixed values that must
match the event schemas the reports were written for.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame

from ..functions.time import with_parsed_ts
from .versions import unify_versions

# Raw table names per logical table, in version order.
VERSIONS = {
    "upload_attempts": ["MobileAppUploadAttempts_5257716", "MobileAppUploadAttempts_5334329"],
    "edits_app": ["MobileWikiAppEdit_9003125"],
    "edits_web": ["MobileWebEditing_5644223", "MobileWebEditing_6077315", "MobileWebEditing_6637866",
                  "MobileWebEditing_7675117", "MobileWebEditing_8599025"],
    "login_attempts": ["MobileAppLoginAttempts_5257721"],
    "share_attempts": ["MobileAppShareAttempts_5346170"],
    "upload_web": ["MobileWebUploads_5281063", "MobileWebUploads_5383883", "MobileWebUploads_7967082",
                   "MobileWebUploads_8209043"],
    "cat_attempts": ["MobileAppCategorizationAttempts_5359208"],
    "account_creation": ["ServerSideAccountCreation_5487345"],
    "click_tracking": ["MobileWebClickTracking_5929948"],
    "option_tracking": ["MobileOptionsTracking_8101982"],
    "thanks": ["Echo_7731316"],
    "new_editor_edits": ["NewEditorEdit_6792669"],
}

# Projections of the derived tables (None = all columns, a
# plain rename), whether versions are unioned distinct, and literal fills.
PROJECTIONS = {
    "upload_attempts": ["id", "uuid", "clientIp", "isTruncated", "clientValidated", "timestamp", "webHost",
                        "wiki", "event_appversion", "event_device", "event_filename", "event_multiple",
                        "event_platform", "event_result", "event_source", "event_username"],
    "edits_app": ["timestamp", "wiki", "userAgent", "event_action"],
    "edits_web": ["timestamp", "wiki", "event_username", "event_action", "event_namespace",
                  "event_userEditCount"],
    "upload_web": ["timestamp", "wiki", "event_action", "event_funnel", "event_username"],
}
DISTINCT = {"upload_attempts": True, "edits_web": True, "upload_web": True}
FILLS = {"upload_attempts": {"event_multiple": 0}}

# Wiki tables and their text time column.
WIKI_TIMES = {
    "logging": "log_timestamp",
    "revision": "rev_timestamp",
    "archive": "ar_timestamp",
    "ipblocks": "ipb_timestamp",
    "tag_summary": None,
    "categorylinks": None,
    "page": None,
    "user": None,
}


def _snake(df: DataFrame) -> DataFrame:
    """Hyphenated column names (``event_files-count``) to snake case."""
    renames = {c: c.replace("-", "_") for c in df.columns if "-" in c}
    for old, new in renames.items():
        df = df.withColumnRenamed(old, new)
    return df


def logical_tables(raw: Mapping[str, DataFrame], day_partition: str | None = None) -> dict[str, DataFrame]:
    """Build every logical table whose raw versions are present in ``raw``.

    ``raw`` maps raw table names (event versions, wiki tables) to
    DataFrames. Event tables get ``ts`` from ``timestamp``; wiki tables get
    ``ts`` from their ``*_timestamp`` column. Text that does not parse
    becomes NULL. ``day_partition`` names the day-partition column of
    tables stored partitioned by day; time ranges then prune partitions.
    The partition must be the day of the row's own timestamp (not, say, an
    ingestion day): only then is the partition bound exact, and only then
    do equal rows of a ``UNION`` still collapse.
    """
    out: dict[str, DataFrame] = {}
    for name, versions in VERSIONS.items():
        present = [raw[v] for v in versions if v in raw]
        if not present:
            continue
        cols = PROJECTIONS.get(name)
        if cols is not None and day_partition and all(day_partition in p.columns for p in present):
            cols = cols + [day_partition]  # a function of the row's own time: dedup unchanged
        if cols is None and len(present) == 1:
            df = present[0]
        else:
            df = unify_versions(present, columns=cols, fill=FILLS.get(name),
                                dedup=DISTINCT.get(name, False))
        out[name] = with_parsed_ts(_snake(df), "timestamp", day_partition=day_partition)
    for name, tcol in WIKI_TIMES.items():
        if name in raw:
            df = raw[name]
            out[name] = df if tcol is None else with_parsed_ts(df, tcol, day_partition=day_partition)
    return out


class LogicalCatalog(Mapping):
    """Logical tables loaded on first use from named sources.

    ``conf['sources']`` names the sources (see :func:`load_source`); event
    versions come from ``event_source`` (default ``el``) and wiki tables from
    ``wiki_source``. A table that cannot be read raises, unless its name is in
    ``may_be_absent`` (versions that this deployment does not have), so no rows
    go missing unnoticed. With ``conf['discover']`` the versions are not the fixed
    list but all that the source has under the same names with other revisions, and columns
    whose types differ take a wider one (see :mod:`~tidemark.sources.discovery`). ``days``
    (first, last) makes partitioned reads of JDBC event tables: one range of the time text for
    each ``conf['jdbc_days']`` days (default 1). With ``materialize=True`` each distinct union over
    versions is written once to the shared folder, partitioned by day where the
    versions are, and read back, so reports sharing it do not repeat its shuffle
    (and the lineage is cut at a durable table).
    """

    def __init__(self, spark, conf: Mapping, event_source: str = "el", wiki_source: str = "commons",
                 materialize: bool = False, may_be_absent: Collection[str] = (), days: tuple | None = None):
        self.spark, self.conf, self.days = spark, conf, days
        self.may_be_absent = frozenset(may_be_absent)
        # ``conf['day_partition']``: day-partition column of partitioned tables.
        self.day_partition = conf.get("day_partition")
        self.event_source, self.wiki_source = event_source, wiki_source
        self.materialize = materialize
        self._cache: dict[str, DataFrame] = {}

    def for_source(self, wiki_source: str) -> "LogicalCatalog":
        if wiki_source in ("el", self.wiki_source):
            return self
        other = LogicalCatalog(self.spark, self.conf, self.event_source, wiki_source, self.materialize, self.may_be_absent, self.days)
        other._cache = {k: v for k, v in self._cache.items() if k in VERSIONS}
        return other

    def _read(self, source: str, table: str) -> DataFrame | None:
        from pyspark.errors import AnalysisException
        from .tables import load_source, time_predicates
        ranges = None
        if self.days and self.conf["sources"].get(source, {}).get("format") == "jdbc" and table not in WIKI_TIMES:
            ranges = time_predicates("timestamp", *self.days, days=self.conf.get("jdbc_days", 1))
        try:
            return load_source(self.spark, self.conf, source, table, predicates=ranges)
        except AnalysisException:
            if table not in self.may_be_absent:
                raise
            return None

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        if name in VERSIONS:
            raw = {v: df for v in self.versions(name) if (df := self._read(self.event_source, v)) is not None}
            if self.conf.get("discover") and len(raw) > 1:
                raw = {VERSIONS[name][0]: self._unified(name, raw)}
        elif name in WIKI_TIMES:
            df = self._read(self.wiki_source, name)
            raw = {name: df} if df is not None else {}
        else:
            raise KeyError(name)
        if not raw:
            raise KeyError(f"no version of {name!r} is readable")
        if self.materialize and name in VERSIONS and DISTINCT.get(name) and len(raw) > 1:
            cols = PROJECTIONS.get(name)
            if cols is not None and all(self.day_partition in df.columns for df in raw.values()):
                cols = [*cols, self.day_partition]
            raw = {VERSIONS[name][0]: self._durable(name, unify_versions(
                list(raw.values()), columns=cols, fill=FILLS.get(name)))}
        self._cache[name] = logical_tables(raw, day_partition=self.day_partition)[name]
        return self._cache[name]

    def versions(self, name: str) -> list[str]:
        """Raw tables of a logical event table, oldest first."""
        if not self.conf.get("discover"):
            return VERSIONS[name]
        from .discovery import find_versions, tables_in
        base = VERSIONS[name][0].rsplit("_", 1)[0]
        return find_versions(tables_in(self.spark, self.conf, self.event_source), base)

    def _unified(self, name: str, raw: Mapping[str, DataFrame]) -> DataFrame:
        from .discovery import unify_wider
        cols = PROJECTIONS.get(name)
        if cols is not None and self.day_partition and all(self.day_partition in df.columns for df in raw.values()):
            cols = [*cols, self.day_partition]
        return unify_wider(raw, columns=cols, fill=FILLS.get(name), dedup=DISTINCT.get(name, False))

    def _durable(self, name: str, df: DataFrame) -> DataFrame:
        from ..session import scratch_dir
        path = scratch_dir(self.spark, f"table-{name}")
        by_day = self.day_partition and self.day_partition in df.columns
        writer = df.write.partitionBy(self.day_partition) if by_day else df.write
        writer.parquet(path)
        return self.spark.read.parquet(path)

    def __iter__(self):
        return iter(list(VERSIONS) + list(WIKI_TIMES))

    def __len__(self):
        return len(VERSIONS) + len(WIKI_TIMES)
