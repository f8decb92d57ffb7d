"""Registry of named queries over the driver tables.

Each entry pairs a Spark builder ``(spark, sf_dir) -> DataFrame`` with the
DuckDB SQL that computes the same result (or ``None`` when the operator has no
SQL twin). ``__spark_entry__`` exposes both dicts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class QuerySpec:
    name: str
    build: Builder
    oracle: str | None
    covers: str  # SURVEY ids this query exercises


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, oracle: str | None, covers: str):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name!r}")
        REGISTRY[name] = QuerySpec(name, fn, oracle, covers)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)
