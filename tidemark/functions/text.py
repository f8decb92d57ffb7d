"""Column functions for text: classifiers and key normalisation.

These are compositions of built-ins (``startswith``, ``contains``, ``upper``,
``replace``...), never Python UDFs, so prefix tests push down to Parquet as
``StringStartsWith`` and everything stays in generated code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def prefix_match(col: Column | str, prefix: str) -> Column:
    """``col LIKE 'prefix%'`` (NULL stays NULL, i.e. not matched)."""
    return _c(col).startswith(prefix)


def contains_any(col: Column | str, needles: str | Sequence[str]) -> Column:
    """``col LIKE '%a%' OR col LIKE '%b%' ...``."""
    if isinstance(needles, str):
        needles = [needles]
    cond = None
    for needle in needles:
        term = _c(col).contains(needle)
        cond = term if cond is None else (cond | term)
    return cond


def lacks_or_null(col: Column | str, needle: str) -> Column:
    """``col IS NULL OR col NOT LIKE '%needle%'`` (keeps NULL on purpose)."""
    return _c(col).isNull() | ~_c(col).contains(needle)


def classify(rules: Mapping[str, Column], default: str | None = None) -> Column:
    """First matching rule wins: ``CASE WHEN p1 THEN l1 WHEN p2 ... END``."""
    out = None
    for label, pred in rules.items():
        out = F.when(pred, F.lit(label)) if out is None else out.when(pred, F.lit(label))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default)) if default is not None else out


def classify_prefix(col: Column | str, rules: Mapping[str, str], default: str | None = None) -> Column:
    """Label by prefix, e.g. ``{'Android': 'Android', 'iOS': 'iOS'}``."""
    return classify({label: prefix_match(col, p) for label, p in rules.items()}, default)


def classify_contains(col: Column | str, rules: Mapping[str, str | Sequence[str]],
                      default: str | None = None) -> Column:
    """Label by substring(s), e.g. ``{'iOS': ['Darwin', 'iPhone OS']}``."""
    return classify({label: contains_any(col, n) for label, n in rules.items()}, default)


def upper_first(col: Column | str) -> Column:
    """First character upper-cased, the rest unchanged (not ``initcap``)."""
    s = _c(col)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30))


def normalise_title(col: Column | str, binary: bool = False) -> Column:
    """Canonical file title: first letter upper, ``File:`` removed, spaces to
    underscores -- in that order (``file:a b`` -> ``File:a b`` -> ``a_b``).

    Empty and NULL titles become NULL so they never match anything.
    """
    s = F.decode(_c(col), "UTF-8") if binary else _c(col)
    out = F.replace(F.replace(upper_first(s), F.lit("File:"), F.lit("")), F.lit(" "), F.lit("_"))
    return F.when(F.length(s) > 0, out)


def normalise_user(col: Column | str, binary: bool = False) -> Column:
    """Canonical user name: trimmed, first letter upper. Empty -> NULL."""
    s = F.trim(F.decode(_c(col), "UTF-8") if binary else _c(col))
    return F.when(F.length(s) > 0, upper_first(s))
