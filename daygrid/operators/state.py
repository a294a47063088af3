"""Activity state of an entity and run lengths between events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daygrid.functions.cleaning import present
from daygrid.functions.days import by_entity, last_days, with_missing

STATUS_LOOKBACK = 5


def active_status(
    df: DataFrame,
    w: WindowSpec | None = None,
    lookback: int = STATUS_LOOKBACK,
    readings: tuple[str, ...] = ("density", "fo"),
) -> DataFrame:
    """Add ``active``: a sampled reading within ``lookback`` days, not followed by a complete removal.

    A removal shows on the day after it: a row without a sample whose previous
    row has code HC, or which has code I itself after a row with code H.
    Reading columns that ``df`` lacks are ignored.
    """
    w = w or by_entity()
    measured = F.lit(False)
    for c in readings:
        if c in df.columns:
            measured = measured | present(F.col(c))
    sampled = F.col("sampled_at").isNotNull()
    before, code = F.col("_prev_code"), F.col("move_code")
    emptied = F.coalesce((before == "HC") | ((code == "I") & (before == "H")), F.lit(False))
    marked = with_missing(df, {"_prev_code": F.lag("move_code").over(w)}).withColumns(
        {
            "_hit": F.when(sampled & measured, F.col("day_no")),
            "_stop": F.when(~sampled & emptied, F.col("day_no")),
        }
    )
    frame = last_days(w, lookback + 1)
    marked = marked.withColumns({"_hit": F.max("_hit").over(frame), "_stop": F.max("_stop").over(frame)})
    hit, stop = F.col("_hit"), F.col("_stop")
    active = hit.isNotNull() & (stop.isNull() | (stop < hit))
    return marked.withColumn("active", active).drop("_prev_code", "_hit", "_stop")


def continuity(w: WindowSpec, days: int = 8, active: str = "active") -> Column:
    """True when each of the last ``days`` calendar days has a row and none is inactive."""
    frame = last_days(w, days)
    return (F.count(F.lit(1)).over(frame) == days) & (F.count(F.when(~F.col(active), 1)).over(frame) == 0)


def days_since_event(
    df: DataFrame,
    w: WindowSpec | None = None,
    events: tuple[str, ...] = ("est_removed_mass", "est_split_mass"),
    name: str = "days_since_event",
) -> DataFrame:
    """Length of the current run of active rows without an event.

    0 on rows that break the run, null on inactive rows. An event of exactly 0
    still breaks it. Where the frame has ``carried_run``, a row with such a
    value has that run length from an earlier run, and the entity's rows before
    it do not count; so a run may be as long as the entity's history.
    """
    w = w or by_entity()
    quiet = F.col("active")
    for c in events:
        quiet = quiet & F.col(c).isNull()
    out = df.withColumns({"_quiet": F.coalesce(quiet, F.lit(False)), "_row": F.row_number().over(w)})
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_break = F.max(F.when(~F.col("_quiet"), F.col("_row"))).over(so_far)
    if "carried_run" in df.columns:
        carried = F.col("carried_run")
        known = F.max(F.when(carried.isNotNull(), F.col("_row"))).over(so_far)
        start = F.max(F.col("_row") - carried).over(so_far)
        last_break = F.when(known.isNull() | (last_break > known), last_break).otherwise(start)
    run = F.col("_row") - F.coalesce(last_break, F.lit(0))
    inactive = F.coalesce(~F.col("active"), F.lit(False))
    return out.withColumn(name, F.when(~inactive, run)).drop("_quiet", "_row", "carried_run")


def last_event_date(date: Column, days_since: Column) -> Column:
    return F.date_sub(date, days_since)


def prev_day_fallback(df: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """Active rows: a missing depth or density takes the value of the calendar day before.

    Adds ``non_current_depth`` and ``non_current_density`` (null on inactive
    rows). Both measures become null when either is still missing.
    """
    w = w or by_entity()
    yesterday = w.rangeBetween(-1, -1)
    active = F.coalesce(F.col("active"), F.lit(False))

    def usable(c: Column) -> Column:
        return F.coalesce(c > 0, F.lit(False))

    depth, density = F.col("depth"), F.col("density")
    out = df.withColumns({"_depth": F.max(depth).over(yesterday), "_density": F.max(density).over(yesterday)})
    # The density of the day before counts when it is known, also when it is not above zero.
    old_depth = active & ~usable(depth) & usable(F.col("_depth"))
    old_density = active & ~usable(density) & F.col("_density").isNotNull()
    out = out.withColumns(
        {
            "_old_depth": old_depth,
            "_old_density": old_density,
            "_depth": F.when(old_depth, F.col("_depth")).otherwise(depth),
            "_density": F.when(old_density, F.col("_density")).otherwise(density),
        }
    )
    complete = usable(F.col("_depth")) & usable(F.col("_density"))
    out = out.withColumns(
        {
            "depth": F.when(~active | complete, F.col("_depth")),
            "density": F.when(~active | complete, F.col("_density")),
            "non_current_depth": F.when(active, complete & F.col("_old_depth")),
            "non_current_density": F.when(active, complete & F.col("_old_density")),
        }
    )
    return out.drop("_depth", "_density", "_old_depth", "_old_density")
