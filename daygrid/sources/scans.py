"""Reading tables by date and choosing what to read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.operators.grid import date_bounds

KEYS = ("obs_date", "entity_id")
DEFAULT_LOOKBACK = 10


def _as_column(day: dt.date | str | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def in_range(df: DataFrame, column: str, low: object, high: object) -> Column:
    """Closed range of a column's values; days named as bounds count whole, also on a timestamp column.

    Bounds that are literals reach the file reader.
    """
    if dict(df.dtypes)[column].startswith("timestamp"):
        return (F.col(column) >= _as_column(low)) & (F.col(column) < F.date_add(_as_column(high), 1))
    if dict(df.dtypes)[column] == "date":
        low, high = _as_column(low), _as_column(high)
    return F.col(column).between(low, high)


def range_between(df: DataFrame, ranges: Mapping[str, tuple[object, object]]) -> DataFrame:
    """Rows whose values all lie in their columns' closed ranges."""
    return df.filter(reduce(lambda a, b: a & b, (in_range(df, c, low, high) for c, (low, high) in ranges.items())))


def scan_date_range(
    df: DataFrame,
    start: dt.date | str | Column,
    end: dt.date | str | Column,
    columns: Sequence[str] | None = None,
    date: str = "obs_date",
    raise_if_empty: bool = False,
    clamp: bool = False,
) -> DataFrame:
    """Rows of a closed date range; key columns are always part of the result.

    On a table partitioned by ``date`` the filter prunes partitions. With
    ``clamp`` the range is first cut to the dates the table has.
    ``raise_if_empty`` reads up to one row and raises ``ValueError`` if there is none.
    """
    low, high = _as_column(start), _as_column(end)
    if clamp:
        low, high = clamp_range(df, low, high, date)
    out = df.filter(in_range(df, date, low, high))
    if columns is not None:
        keys = [k for k in dict.fromkeys((date, *KEYS)) if k in df.columns]
        out = out.select(*keys, *(c for c in columns if c not in keys))
    if raise_if_empty and out.isEmpty():
        raise ValueError(f"no rows from {start} to {end}")
    return out


def scan_one_date(
    df: DataFrame, day: dt.date | str | Column, columns: Sequence[str] | None = None, date: str = "obs_date"
) -> DataFrame:
    """Rows of one date, and only the named columns if any are named."""
    out = df.filter(in_range(df, date, day, day))
    return out.select(*columns) if columns else out


def clamp_range(df: DataFrame, start: Column, end: Column, date: str = "obs_date") -> tuple[Column, Column]:
    """A range cut to the first and last stored date."""
    first, last = date_bounds(df, date)
    return F.greatest(start, first), F.least(end, last)


def available_dates(df: DataFrame, date: str = "obs_date") -> DataFrame:
    return df.select(date).distinct()


def last_dates(df: DataFrame, n: int = 15, date: str = "obs_date") -> DataFrame:
    """The newest ``n`` stored dates (a per-task top-n, then a merge)."""
    return available_dates(df, date).orderBy(F.desc(date)).limit(n)


def allowed_columns(df: DataFrame, allowed: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The columns a target table has, in its order, and the names that were dropped."""
    kept = [c for c in allowed if c in df.columns]
    return df.select(*kept), [c for c in df.columns if c not in allowed]


def require_known_columns(df: DataFrame, target: Sequence[str], keys: Sequence[str]) -> None:
    """Reject a payload with columns the target table does not have."""
    unknown = [c for c in (*df.columns, *keys) if c not in target]
    if unknown:
        raise ValueError(f"columns not in the target table: {unknown}")


def _date_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "date" in c.lower()]


def dates_from_text(df: DataFrame, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Every column with "date" in its name as a date; unreadable text becomes null."""
    return df.withColumns(
        {c: F.to_date(F.try_to_timestamp(F.col(c), F.lit(fmt))) for c in _date_columns(df)}
    )


def dates_to_text(df: DataFrame, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Every column with "date" in its name as text; any other type is an error."""
    types = dict(df.dtypes)
    wrong = [c for c in _date_columns(df) if not types[c].startswith(("date", "timestamp"))]
    if wrong:
        raise ValueError(f"not date columns: {wrong}")
    return df.withColumns({c: F.date_format(c, fmt) for c in _date_columns(df)})


def widen(start: dt.date, end: dt.date, days: int = DEFAULT_LOOKBACK) -> dt.date:
    """First day to read so that the range up to ``end`` spans at least ``days`` days."""
    return min(start, end - dt.timedelta(days=days))


def with_lookback(
    df: DataFrame, start: dt.date, end: dt.date, days: int, compute, date: str = "obs_date", ahead: int = 0
) -> DataFrame:
    """Compute on a widened range and keep the days asked for.

    Spark does not push a date filter below a window by entity, so the input is
    filtered here by hand.
    """
    read_from = start - dt.timedelta(days=days)
    read_to = end + dt.timedelta(days=ahead)
    computed = compute(scan_date_range(df, read_from, read_to, date=date))
    return scan_date_range(computed, start, end, date=date)


def months_in_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """The calendar months a closed range touches, as (year, month)."""
    first = F.trunc(F.lit(start), "month")
    months = F.sequence(first, F.lit(end), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("m")).select(F.year("m").alias("year"), F.month("m").alias("month"))


def pick_files_by_date(
    files: DataFrame,
    start: dt.date,
    end: dt.date,
    kind: str,
    monthly: bool = False,
    path: str = "path",
    suffix: str = "xlsx",
) -> DataFrame:
    """Files of a date range by their names; adds ``file_date``.

    Daily files lie at ``<year>/<mm_Month>/<yymmdd> <kind>....xlsx`` and monthly
    ones at ``<year>/<mm_Month> <kind>....xlsx`` (``file_date`` is the first of
    the month). Letter case does not matter.
    """
    if monthly:
        pattern = rf"(?i)(?:^|/)(\d{{4}})/(\d{{2}}_[a-z]+)\s+{kind}[^/]*\.{suffix}$"
        year, month = (F.regexp_extract(path, pattern, i) for i in (1, 2))
        named = F.to_date(F.try_to_timestamp(F.concat(year, F.left(month, F.lit(2))), F.lit("yyyyMM")))
        matches = F.lower(F.date_format(named, "MM_MMMM")) == F.lower(month)
        first, last = F.trunc(F.lit(start), "month"), F.lit(end)
    else:
        pattern = rf"(?i)(?:^|/)(\d{{4}})/(\d{{2}}_[a-z]+)/[^/]*?(\d{{6}})\s+{kind}[^/]*\.{suffix}$"
        year, month, day = (F.regexp_extract(path, pattern, i) for i in (1, 2, 3))
        named = F.to_date(F.try_to_timestamp(F.concat(F.left(year, F.lit(2)), day), F.lit("yyyyMMdd")))
        matches = (F.date_format(named, "yyyy") == year) & (
            F.lower(F.date_format(named, "MM_MMMM")) == F.lower(month)
        )
        first, last = F.lit(start), F.lit(end)
    found = files.withColumn("file_date", named).filter(matches)
    return found.filter(F.col("file_date").between(first, last))


def scan_dated_files(
    df: DataFrame, start: dt.date, end: dt.date, kind: str, monthly: bool = False, suffix: str = "csv"
) -> DataFrame:
    """Rows read from files whose path names a date in the range; adds ``file_date``.

    ``df`` must come straight from a file reader, which knows each row's file.
    """
    source = F.regexp_replace(F.col("_metadata.file_path"), "%20", " ")
    return pick_files_by_date(df.withColumn("_path", source), start, end, kind, monthly, "_path", suffix).drop("_path")
