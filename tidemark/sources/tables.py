"""Reading the driver's parquet tables and named sources."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.time import to_date_value

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder (``<sf_dir>/<name>.parquet``)."""
    if name not in TABLES:
        raise ValueError(f"No such table: {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_source(spark: SparkSession, conf: Mapping, name: str, table: str | None = None,
                predicates: Sequence[str] | None = None) -> DataFrame:
    """Read ``table`` from the named source in ``conf['sources']``.

    A source is ``{'format': 'parquet', 'path': '.../{table}'}`` (any
    file format Spark reads), ``{'format': 'catalog', 'database': ...}`` or
    ``{'format': 'jdbc', 'url': ..., 'options': {...}}``; of the last, ``predicates``
    (see :func:`time_predicates`, :func:`id_predicates`) are a partition each. Unknown
    names raise ``ValueError`` before any read.
    """
    try:
        src = conf["sources"][name]
    except KeyError:
        raise ValueError(f'No such source: "{name}"') from None
    fmt = src.get("format", "parquet")
    options = dict(src.get("options", {}))
    if fmt == "catalog":
        return spark.table(f"{src['database']}.{table}")
    if fmt == "jdbc":
        if predicates is not None:
            return spark.read.jdbc(src["url"], table, predicates=list(predicates), properties={k: str(v) for k, v in options.items()})
        reader = spark.read.format("jdbc").option("url", src["url"])
        if table is not None:
            options.setdefault("dbtable", table)
        return reader.options(**options).load()
    path = src["path"]
    if table is not None:
        path = path.format(table=table) if "{table}" in path else f"{path.rstrip('/')}/{table}"
    reader = spark.read.format(fmt).options(**options)
    if "schema" in src:
        reader = reader.schema(src["schema"])
    return reader.load(path)


def time_predicates(column: str, starts, ends, days: int = 1, text14: bool = True) -> list[str]:
    """Predicates that cut the days ``starts`` to ``ends`` (inclusive) into ranges of ``days``:
    half-open, so each row of the range meets exactly one, and a plain comparison
    of the column, so the database can use its index.

    ``text14``: the column is 14-digit text (else a timestamp). Rows with a NULL or other text meet none,
    as they meet no report's range.
    """
    if days < 1:
        raise ValueError("a range needs at least one day")
    lo, end = to_date_value(starts), to_date_value(ends) + _dt.timedelta(days=1)

    def literal(d: _dt.date) -> str:
        return f"'{d:%Y%m%d}000000'" if text14 else f"TIMESTAMP '{d.isoformat()} 00:00:00'"

    out = []
    while lo < end:
        hi = min(lo + _dt.timedelta(days=days), end)
        out.append(f"{column} >= {literal(lo)} AND {column} < {literal(hi)}")
        lo = hi
    return out


def id_predicates(column: str, first: int, last: int, parts: int) -> list[str]:
    """Predicates that cut the ids into ``parts`` ranges (fewer, if there are fewer ids) between ``first`` and
    ``last``; the first and the last are open, and NULL ids are with the first: every row meets exactly one."""
    if parts < 1 or last < first:
        raise ValueError("id_predicates needs parts >= 1 and first <= last")
    parts = min(parts, last - first + 1)
    cuts = [first + (last - first + 1) * k // parts for k in range(1, parts)]
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"({column} < {cuts[0]} OR {column} IS NULL)", *middle, f"{column} >= {cuts[-1]}"]
