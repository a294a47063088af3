"""Day numbers and windows that count calendar days.

All windows of this package order by the single int column ``day_no`` (days
since 1970-01-01). One shared order keeps Spark at one sort per shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def with_day_no(df: DataFrame, date: str = "obs_date") -> DataFrame:
    return df.withColumn("day_no", F.unix_date(date))


def by_entity(*keys: str) -> WindowSpec:
    """Rows of one entity in day order."""
    return Window.partitionBy(*(keys or ("entity_id",))).orderBy("day_no")


def last_days(w: WindowSpec, days: int) -> WindowSpec:
    """The current calendar day and the ``days - 1`` before it."""
    return w.rangeBetween(-(days - 1), 0)


def at_offset(value: Column, w: WindowSpec, days: int) -> Column:
    """Value exactly ``days`` calendar days away; null where that day has no row.

    A one-day RANGE frame in place of a self join: it shares the shuffle and
    sort of the other windows. Needs at most one row per entity and day.
    """
    return F.max(value).over(w.rangeBetween(days, days))


def trailing_sum(value: Column, w: WindowSpec, days: int, min_count: int = 1) -> Column:
    """Sum over the last calendar days, null under ``min_count`` non-null values."""
    frame = last_days(w, days)
    return F.when(F.count(value).over(frame) >= min_count, F.sum(value).over(frame))


def previous_where(value: Column, keep: Column, w: WindowSpec) -> Column:
    """Value of the nearest earlier row for which ``keep`` holds.

    ``value`` must not be null on such rows.
    """
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return F.last(F.when(keep, value), ignorenulls=True).over(before)


def fiscal_year(date: Column, first_month: int = 9) -> Column:
    """Calendar year in which the fiscal year of ``date`` begins."""
    return F.year(date) - (F.month(date) < first_month).cast("int")


def with_missing(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add those of the columns that ``df`` does not have yet.

    Steps that look at neighbouring rows take such helper columns when an
    earlier step has added them for several steps at once: one window, not one each.
    """
    return df.withColumns({n: c for n, c in columns.items() if n not in df.columns})
