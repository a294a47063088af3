"""Dense entity-by-day grids and joins onto them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daygrid.sources.sheets import merge_on_key

EPOCH = dt.date(1970, 1, 1)


def day_column(day: dt.date | Column) -> Column:
    """A date as a day number."""
    return F.lit((day - EPOCH).days) if isinstance(day, dt.date) else F.unix_date(day)


def date_bounds(df: DataFrame, date: str = "obs_date") -> tuple[Column, Column]:
    """First and last date of a table as scalar subqueries (one aggregate, nothing collected)."""
    span = df.agg(F.struct(F.min(date).alias("first"), F.max(date).alias("last"))).scalar()
    return span.getField("first"), span.getField("last")


def calendar(spark: SparkSession, start: dt.date | Column, end: dt.date | Column, date: str = "obs_date") -> DataFrame:
    """One row per day of a closed range."""
    return entity_calendar(spark.range(1).select(), start, end, date)


def entity_calendar(
    entities: DataFrame, start: dt.date | Column, end: dt.date | Column, date: str = "obs_date"
) -> DataFrame:
    """Every entity on every day of a closed range; each entity row is expanded in place."""
    days = F.explode(F.sequence(day_column(start), day_column(end)))
    expanded = entities.select("*", days.alias("_day"))
    return expanded.select(*entities.columns, F.date_from_unix_date("_day").alias(date))


def grid_left_join(grid: DataFrame, facts: DataFrame, keys: Sequence[str] = ("entity_id", "obs_date")) -> DataFrame:
    """Facts on a grid: facts off the grid vanish, gaps become rows of nulls."""
    return grid.join(facts, list(keys), "left")


def densify(
    df: DataFrame,
    start: dt.date | Column | None = None,
    end: dt.date | Column | None = None,
    entities: DataFrame | None = None,
    keys: Sequence[str] = ("entity_id",),
    date: str = "obs_date",
) -> DataFrame:
    """Every entity on every day, facts where there are some, nulls elsewhere.

    Without bounds the range is the first to the last date of ``df``. Without
    ``entities`` the grid holds the entities of ``df``; with it exactly those
    listed, and facts of others vanish.

    The grid is not joined: each row is expanded over the days up to the
    entity's next row, so the one shuffle by entity also serves every later
    window by entity. Facts must be unique per entity and day.
    """
    low, high = date_bounds(df, date)
    first = day_column(low if start is None else start)
    last = day_column(high if end is None else end)
    facts = [c for c in df.columns if c not in (*keys, date, "day_no")]
    rows = df.select(*keys, *facts, F.unix_date(date).alias("_day"), F.lit(False).alias("_anchor"))
    rows = rows.filter(F.col("_day").between(first, last))
    if entities is not None:
        # The day before the grid opens: it carries the entity, not a fact.
        anchors = entities.select(*keys, (first - 1).alias("_day"), F.lit(True).alias("_anchor"))
        rows = rows.unionByName(anchors, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_day")
    is_first = F.lag("_day").over(w).isNull()
    rows = rows.withColumns(
        {
            "_from": F.when(is_first & ~F.col("_anchor"), first).otherwise(F.col("_day")),
            "_to": F.coalesce(F.lead("_day").over(w) - 1, last),
            "_listed": F.first("_anchor").over(w) if entities is not None else F.lit(True),
        }
    ).filter("_listed")
    days = F.sequence("_from", F.greatest("_from", "_to"))
    own_day = F.col("day_no") == F.col("_day")
    grid = rows.select(*keys, *facts, "_day", "_anchor", F.explode(days).alias("day_no"))
    return grid.filter(F.col("day_no") >= first).select(
        *keys,
        F.date_from_unix_date("day_no").alias(date),
        "day_no",
        *(F.when(own_day, F.col(c)).alias(c) for c in facts),
    )


def calendar_outer_join(
    site: DataFrame, start: dt.date | Column, end: dt.date | Column, date: str = "obs_date"
) -> DataFrame:
    """Site rows of a closed range plus an empty row for every missing day."""
    days = calendar(site.sparkSession, start, end, date)
    in_range = F.unix_date(date).between(day_column(start), day_column(end))
    return site.filter(in_range).join(days, date, "full")


def full_outer(frames: Sequence[DataFrame], keys: Sequence[str] = ("entity_id", "obs_date")) -> DataFrame:
    """Outer join of two or more frames that are unique per key and share no other column.

    One shuffle for any number of frames: rows are stacked and grouped by key.
    """
    return merge_on_key(frames, keys)


def attach_state(facts: DataFrame, state: DataFrame, keys: Sequence[str] = ("entity_id", "obs_date")) -> DataFrame:
    """Left join of a state table onto facts."""
    return facts.join(state, list(keys), "left")


def scaffold_missing_days(
    facts: DataFrame, entities: DataFrame, start: dt.date | Column, end: dt.date | Column, date: str = "obs_date"
) -> DataFrame:
    """One empty row per entity for every day of the range on which ``facts`` has no row at all.

    The list of missing days is no longer than the calendar range, so it
    travels as one array; each entity row is expanded over it.
    """
    days = calendar(facts.sparkSession, start, end, date)
    missing = days.join(facts.select(date).distinct(), date, "left_anti")
    listed = missing.agg(F.array_sort(F.collect_list(date))).scalar()
    return entities.withColumn(date, F.explode(listed))
