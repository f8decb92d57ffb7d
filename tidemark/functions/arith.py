"""Column functions for metrics: counts, totals, ratios, text forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def count_when(pred: Column) -> Column:
    """``SUM(IF(pred, 1, 0))`` as BIGINT: a NULL predicate counts 0, and an
    aggregate over no rows is NULL (unlike ``count_if``)."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def count_rows() -> Column:
    """``COUNT(*)``."""
    return F.count(F.lit(1))


def row_total(cols: Sequence[Column | str]) -> Column:
    """Sum across columns with NULL taken as 0 (``COALESCE(a,0)+...``)."""
    total = None
    for col in cols:
        term = F.coalesce(_c(col), F.lit(0))
        total = term if total is None else total + term
    return total if total is not None else F.lit(0)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """Division that gives NULL on a zero or NULL denominator (ANSI-safe)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def two_decimal(col: Column | str) -> Column:
    """Two-decimal text exactly as Python's ``'%.2f'``: half-even on the
    binary value (0.125 -> '0.12', 0.615 -> '0.61'), which no built-in
    reproduces (``format_string`` rounds half-up on the shortest decimal
    form). A display-only column of summary rows, so one Arrow-batched
    pandas UDF is the right tool; it runs inside the tasks. The function is a
    local one, so it is shipped by value and workers need no copy of the package.
    """
    def text(values):
        import pandas as pd
        return values.map(lambda v: None if pd.isna(v) else "%.2f" % v)

    fmt = F.pandas_udf(text, "string")
    return fmt(_c(col).cast("double"))
