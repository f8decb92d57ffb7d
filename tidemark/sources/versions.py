"""One logical table over several schema versions of an event log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unify_versions(versions: Sequence[DataFrame], columns: Sequence[str] | None = None,
                   fill: Mapping[str, object] | None = None, dedup: bool = True) -> DataFrame:
    """Union the versions by column name over a common projection.

    ``columns`` is the logical projection (default: columns of the first
    version); a version lacking a column gets ``fill[column]`` as a literal
    (``0 AS event_multiple``) or NULL. ``dedup=True`` is SQL ``UNION``:
    equal projected rows collapse, so the projection list is semantic and
    the dedup runs after it (one shuffle on the projected row).
    """
    if not versions:
        raise ValueError("unify_versions needs at least one DataFrame")
    fill = dict(fill or {})
    columns = list(columns or versions[0].columns)
    first_types = {}
    for v in versions:
        for f in v.schema.fields:
            first_types.setdefault(f.name, f.dataType)
    parts = []
    for v in versions:
        cols = []
        for c in columns:
            if c in v.columns:
                cols.append(F.col(c))
            else:
                lit = F.lit(fill.get(c))
                if c in first_types:
                    lit = lit.cast(first_types[c])
                cols.append(lit.alias(c))
        parts.append(v.select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct() if dedup else out
