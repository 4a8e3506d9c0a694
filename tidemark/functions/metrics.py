"""Column-expression builders used by the Silver and Gold stages.

All of them return built-in ``Column`` expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_negative(c: Column) -> Column:
    """Negative -> 0, NULL stays NULL (``greatest(c, 0)`` would turn NULL into 0)."""
    return F.when(c < 0, F.lit(0)).otherwise(c)


def ratio(num: Column, den: Column, scale: float, digits: int) -> Column:
    """``round(num / den * scale, digits)`` guarded to NULL unless ``den > 0``.

    The guard sits in a ``CASE`` so the quotient is never evaluated on a zero denominator
    (ANSI mode would raise).  ``round`` is Spark's half-up rounding.
    """
    scale_lit = F.lit(int(scale)) if float(scale).is_integer() else F.lit(scale)
    return F.when(den.isNotNull() & (den > 0), F.round(num / den * scale_lit, digits))


def threshold_label(c: Column, thresholds: Sequence[tuple[float, str]], low: str,
                    unknown: str) -> Column:
    """First label whose lower bound ``c >= bound`` holds (bounds descending); any other
    non-null value -> ``low``; NULL -> ``unknown``."""
    expr = None
    for bound, label in thresholds:
        expr = F.when(c >= F.lit(bound), label) if expr is None else expr.when(c >= F.lit(bound), label)
    nonnull = c.isNotNull()
    expr = F.when(nonnull, F.lit(low)) if expr is None else expr.when(nonnull, low)
    return expr.otherwise(unknown)


def date_label(c: Column, breakpoints: Sequence[_dt.date], labels: Sequence[str],
               null_label: bool = False) -> Column:
    """``labels[i]`` for the first breakpoint with ``c < breakpoints[i]``; the last label
    otherwise.  A NULL date falls through to the last label (the reference's behaviour) unless
    ``null_label`` asks for NULL."""
    if len(labels) != len(breakpoints) + 1:
        raise ValueError("need exactly one more label than breakpoints")
    expr = None
    for bp, label in zip(breakpoints, labels):
        cond = c < F.lit(bp)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    if null_label:
        expr = expr.when(c.isNull(), F.lit(None).cast("string"))
    return expr.otherwise(labels[-1])


def is_weekend(c: Column) -> Column:
    """Saturday or Sunday (``dayofweek``: 1 = Sunday, 7 = Saturday)."""
    return F.dayofweek(c).isin(1, 7)


def month_name(c: Column) -> Column:
    return F.date_format(c, "MMMM")
