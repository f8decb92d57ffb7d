"""Schema versions found in a source by their suffix, and unified with wider types.

An event log has one table per schema version, ``Name_<revision>``. Instead of a
fixed list, the versions are those the source has; a column whose type differs between
them takes the narrowest type that holds all of their values exactly, and
one that has no such type is reported, not guessed.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Integer types from narrow to wide, with the decimal digits that hold them.
_INTEGERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_MAX_DIGITS = 38


class VersionConflict(ValueError):
    """Columns whose types in the versions have no common wider type."""

    def __init__(self, conflicts: Mapping[str, Mapping[str, str]]):
        self.conflicts = {c: dict(v) for c, v in conflicts.items()}
        lines = [f"{c}: " + ", ".join(f"{t} in {v}" for v, t in types.items()) for c, types in self.conflicts.items()]
        super().__init__("no common type for " + "; ".join(lines))


def find_versions(names: Iterable[str], base: str) -> list[str]:
    """Those of ``names`` that are ``base`` and a revision number, oldest first."""
    found = [(int(m.group(1)), n) for n in names if (m := re.fullmatch(re.escape(base) + r"_(\d+)", n))]
    return [n for _, n in sorted(found)]


def tables_in(spark: SparkSession, conf: Mapping, source: str) -> list[str]:
    """Names of a source's tables: of its database in the catalogue, or of the folders
    (files) that its path has. Names only; nothing is read."""
    try:
        src = conf["sources"][source]
    except KeyError:
        raise ValueError(f'No such source: "{source}"') from None
    if src.get("format") == "catalog":
        # the session's temporary views are listed with every database's tables
        return sorted(t.name for t in spark.catalog.listTables(src["database"]) if not t.isTemporary)
    if src.get("format") == "jdbc":
        raise ValueError("the tables of a JDBC source are not listed: name them")
    path = src["path"] if "{table}" in src["path"] else src["path"].rstrip("/") + "/{table}"
    head, _, tail = path.partition("{table}")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(head + "*" + tail)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []
    name = re.compile(".*/" + re.escape(head.rsplit("/", 1)[1]) + r"([^/]+)" + re.escape(tail) + "$")
    return sorted(m.group(1) for f in found if (m := name.match(f.getPath().toString())) and m.group(1)[0] not in "._")


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both exactly; None if there is none.

    byte < short < int < long < decimal; byte, short and int also < double;
    float < double; date < timestamp without zone; no type at all (NULL) < any.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    whole = [type(x) in _INTEGERS for x in (a, b)]
    if all(whole):
        return max(a, b, key=lambda x: _INTEGERS[type(x)])
    exact = [isinstance(x, T.DecimalType) or w for x, w in zip((a, b), whole)]
    if all(exact):
        digits = [(x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (_INTEGERS[type(x)], 0) for x in (a, b)]
        before, after = (max(d[k] for d in digits) for k in (0, 1))
        return T.DecimalType(before + after, after) if before + after <= _MAX_DIGITS else None
    kinds = {type(a), type(b)}
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if T.DoubleType in kinds and kinds & {T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if T.FloatType in kinds and kinds & {T.ByteType, T.ShortType}:
        return T.FloatType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None


def common_schema(schemas: Mapping[str, T.StructType], columns: Sequence[str] | None = None) -> dict[str, T.DataType]:
    """Column -> type over all versions (``columns``, or all in the order they are met).

    A column that no version has is NULL. Raises :class:`VersionConflict` with every
    column that has no common type.
    """
    names = list(columns) if columns is not None else list(dict.fromkeys(f.name for s in schemas.values() for f in s.fields))
    out, conflicts = {}, {}
    for name in names:
        types = {v: s[name].dataType for v, s in schemas.items() if name in s.names}
        kind = reduce(lambda a, b: None if a is None else wider(a, b), types.values(), T.NullType())
        # decimals do not depend on the order: the digits before and after the point are maxima
        if kind is None:
            conflicts[name] = {v: t.simpleString() for v, t in types.items()}
        else:
            out[name] = kind
    if conflicts:
        raise VersionConflict(conflicts)
    return out


def unify_wider(versions: Mapping[str, DataFrame], columns: Sequence[str] | None = None,
                fill: Mapping[str, object] | None = None, dedup: bool = True) -> DataFrame:
    """Union of the versions over ``columns`` in their common types.

    A version without a column has ``fill``'s literal for it, or NULL. ``dedup``
    is SQL ``UNION``: rows that are equal after widening collapse.
    """
    if not versions:
        raise ValueError("unify_wider needs at least one version")
    types = common_schema({v: df.schema for v, df in versions.items()}, columns)
    fill = dict(fill or {})
    parts = [df.select(*[(F.col(c) if c in df.columns else F.lit(fill.get(c))).cast(t).alias(c) for c, t in types.items()])
             for df in versions.values()]
    out = reduce(DataFrame.unionByName, parts)
    return out.distinct() if dedup else out


def version_report(versions: Mapping[str, T.StructType]) -> list[tuple[str, str, str | None, str | None]]:
    """``(column, version, type, common type)`` for every column and version; the type is None where a
    version lacks it, the common type where there is none. Schema metadata, so a plain list."""
    out = []
    for name in dict.fromkeys(f.name for s in versions.values() for f in s.fields):
        try:
            common = common_schema(versions, [name])[name].simpleString()
        except VersionConflict:
            common = None
        out += [(name, v, s[name].dataType.simpleString() if name in s.names else None, common) for v, s in versions.items()]
    return out
