"""Stacking, reconciling and merging source sheets."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SERIAL_ORIGIN = "1899-12-30"
SERIAL_YEARS = (2017, 2055)


def union_by_name(frames: Sequence[DataFrame], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Stack frames with different columns; a column a frame lacks is null there."""
    renamed = [f.withColumnsRenamed(dict(rename or {})) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), renamed)


def select_sources(names: Sequence[str], include: Sequence[str] = (), ignore: Sequence[str] = ()) -> list[str]:
    """Source names to load: an include list, or an ignore list of names or ``SUBSTRING[x]``."""
    if include and ignore:
        raise ValueError("give either include or ignore, not both")
    if include:
        return [n for n in include if n in names]

    def ignored(name: str) -> bool:
        for rule in ignore:
            part = re.search(r"SUBSTRING\[(.+)\]", rule)
            if (part.group(1) in name) if part else (name == rule):
                return True
        return False

    return [n for n in names if not ignored(n)]


def union_sources_filtered(
    sources: Mapping[str, DataFrame], include: Sequence[str] = (), ignore: Sequence[str] = (), tag: str = "source_name"
) -> DataFrame:
    """Stack the chosen sources, each row tagged with its source."""
    chosen = select_sources(list(sources), include, ignore)
    return union_by_name([sources[n].withColumn(tag, F.lit(n)) for n in chosen])


def unpivot_entity_sheets(
    sheets: Mapping[str, DataFrame], date: str = "obs_date", fmt: str = "yyyy-MM-dd", entity: str = "entity_id"
) -> DataFrame:
    """One sheet per entity as one long table; rows with an unreadable date are dropped."""
    long = union_by_name([sheet.withColumn(entity, F.lit(name)) for name, sheet in sheets.items()])
    return long.withColumn(date, F.to_date(F.try_to_timestamp(date, F.lit(fmt)))).dropna(subset=[date])


def merge_on_key(
    frames: Sequence[DataFrame], keys: Sequence[str] = ("entity_id", "obs_date"), spread: Sequence[str] = ()
) -> DataFrame:
    """N-way full outer merge of frames whose rows are unique per key and whose other columns differ.

    Rows are stacked and grouped by key: one shuffle for any number of frames,
    where a chain of outer joins would shuffle the growing result every time.
    ``spread`` names the part of the key to shuffle by, if later steps can use
    the same partitioning.
    """
    widths = [c for f in frames for c in f.columns if c not in keys]
    repeated = sorted({c for c in widths if widths.count(c) > 1})
    if repeated:
        raise ValueError(f"columns in more than one sheet: {repeated}")
    stacked = union_by_name(frames)
    if spread:
        stacked = stacked.repartition(*spread)
    return stacked.groupBy(*keys).agg(*(F.first(c, ignorenulls=True).alias(c) for c in widths))


def reconcile_columns(
    sheets: Mapping[str, DataFrame],
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    per: Sequence[str] = ("obs_date",),
) -> DataFrame:
    """Merge sheets that hold the same columns, keeping for each column one sheet's values on each day.

    The sheet with the day's most values that are neither null nor 0 wins, the
    earliest on a tie, the last if all are empty. So several days together
    give what each day gives alone; ``per`` names the part of the key that is
    decided by itself. Keys of every sheet stay. Adds ``<column>_source``.
    Sheet rows must be unique per key.
    """
    names = list(sheets)
    shared = columns or [
        c for c in dict.fromkeys(c for f in sheets.values() for c in f.columns) if c not in keys
    ]
    stacked = union_sources_filtered(sheets, tag="_source")
    filled = stacked.groupBy(*per, "_source").agg(*(F.count_if(F.col(c).isNotNull() & (F.col(c) != 0)).alias(c) for c in shared))
    place = -F.array_position(F.lit(names), F.col("_source"))

    def winner(c: str) -> Column:
        most = F.max_by("_source", F.struct(c, place))
        return F.when(F.max(c) == 0, names[-1]).otherwise(most).alias(f"{c}_source")

    # One row for each day, whatever the number of columns and sheets.
    picks = filled.groupBy(*(F.col(k).alias(f"_at_{k}") for k in per)).agg(*(winner(c) for c in shared))
    same_day = [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in per]
    chosen = stacked.join(picks, reduce(lambda a, b: a & b, same_day))
    return chosen.groupBy(*keys).agg(
        *(
            F.first(F.when(F.col("_source") == F.col(f"{c}_source"), F.col(c)), ignorenulls=True).alias(c)
            for c in shared
        ),
        *(F.max(f"{c}_source").alias(f"{c}_source") for c in shared),
    )


def _serial_date(value: Column) -> Column:
    """The date of a spreadsheet day number, null outside the years such dates have."""
    date = F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), F.when(value.between(1, 100_000), value).cast("int"))
    return F.when(F.year(date).between(*SERIAL_YEARS), date)


def serial_date_columns(df: DataFrame, row: str = "row_no", columns: Sequence[str] | None = None) -> list[str]:
    """Integer columns that hold spreadsheet dates: those where more than half of all values are such dates.

    One aggregate over all rows, for sheets of any length.
    """
    integers = [c for c, t in df.dtypes if t in ("int", "bigint", "smallint") and c != row]
    candidates = [c for c in integers if columns is None or c in columns]
    if not candidates:
        return []
    verdict = df.agg(*((2 * F.count(_serial_date(F.col(c))) > F.count(c)).alias(c) for c in candidates)).first()
    return [c for c in candidates if verdict[c]]


def infer_serial_dates(df: DataFrame, row: str = "row_no", columns: Sequence[str] | None = None) -> DataFrame:
    """Spreadsheet day numbers turned into dates in the columns that hold them; other numbers there become null."""
    return df.withColumns({c: _serial_date(F.col(c)) for c in serial_date_columns(df, row, columns)})
