"""Column expressions of the cleaning rules.

All are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (
    SLA_HOURS,
    STAMP_FRACTION_SUFFIX,
    STAMP_ZONE_SUFFIX,
    TIMESTAMP_FORMAT,
    UNCATEGORIZED,
    UNRECOGNIZED_PRIORITY,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: str | Column) -> Column:
    """Parse the extract's stamps to whole seconds.

    Accepts ``YYYY-MM-DD hh:mm:ss`` optionally followed by a fraction of a
    second and/or a ``+00:00`` offset: the offset is cut, then the fraction.
    Any other shape (other offsets, ISO ``T...Z``, blanks, junk) gives NULL
    instead of an error.
    """
    cleaned = F.regexp_replace(F.regexp_replace(_col(c), STAMP_ZONE_SUFFIX, ""),
                               STAMP_FRACTION_SUFFIX, "")
    return F.try_to_timestamp(cleaned, F.lit(TIMESTAMP_FORMAT))


def hours_between(start: str | Column, end: str | Column) -> Column:
    """Whole-second difference in hours; NULL when ``end`` is NULL."""
    end, start = _col(end), _col(start)
    return F.when(end.isNotNull(),
                  (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(3600.0))


def standardize_category(c: str | Column) -> Column:
    c = _col(c)
    return F.when(c.isNull(), F.lit(UNCATEGORIZED)).otherwise(F.initcap(F.trim(c)))


def standardize_priority(c: str | Column) -> Column:
    return F.initcap(F.trim(_col(c)))


def standardize_project(c: str | Column) -> Column:
    return F.upper(F.trim(_col(c)))


def priority_flag(priority: str | Column) -> Column:
    p = _col(priority)
    return F.when(p.isNotNull() & ~p.isin(*SLA_HOURS), F.lit(UNRECOGNIZED_PRIORITY))


def sla_threshold(priority: str | Column) -> Column:
    """Target hours for a standardized priority; NULL for unknown ones."""
    p = _col(priority)
    expr = None
    for name, hours in SLA_HOURS.items():
        expr = (F.when(p == name, F.lit(float(hours))) if expr is None
                else expr.when(p == name, F.lit(float(hours))))
    return expr


def target_met(hours: str | Column, priority: str | Column) -> Column:
    """Three-valued verdict: met when hours <= target (inclusive), NULL when
    unresolved or the priority has no target."""
    h, thr = _col(hours), sla_threshold(priority)
    return F.when(h.isNotNull() & thr.isNotNull(), h <= thr)


def met_as_false(met: str | Column) -> Column:
    """NULL verdicts count as not met."""
    return F.coalesce(_col(met), F.lit(False))


def month_start(ts: str | Column) -> Column:
    return F.date_trunc("month", _col(ts))


def month_label(ts: str | Column) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def round2(c: str | Column) -> Column:
    """Round half up to 2 places (on the shortest decimal form of a double)."""
    return F.round(_col(c), 2)


def mean_hours(c: str | Column) -> Column:
    """Mean of durations in hours: whole seconds are added up and divided
    once, so the result does not depend on the order of rows."""
    seconds = F.round(_col(c) * F.lit(3600.0)).cast("long")
    return F.try_divide(F.sum(seconds).cast("double"), F.count(seconds) * F.lit(3600.0))


def mean_at_rest(c: str | Column) -> Column:
    """Unrounded mean of stored (DECIMAL) hours from their exact sum."""
    return F.try_divide(F.sum(_col(c)).cast("double"), F.count(_col(c)).cast("double"))
