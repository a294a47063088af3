"""The daily load: every derived table from measurements and quality samples.

All steps after the merge of the sources work on one frame with one row per
entity and day. It is shuffled by entity once; later windows add sorts at most.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.durable import Scratch
from daygrid.functions.days import by_entity
from daygrid.functions.measures import mass_volume
from daygrid.operators.classify import status_code
from daygrid.operators.grid import date_bounds, day_column, densify
from daygrid.operators.growth import GROWTH_COLUMNS, growth_aggregate, growth_per_entity
from daygrid.operators.history import carry_measurements
from daygrid.operators.movement import (
    FILL_ROWS,
    estimate_fallback,
    standing_moves,
    volume_log_estimate,
)
from daygrid.operators.state import STATUS_LOOKBACK, days_since_event
from daygrid.sources.scans import scan_date_range, scan_one_date, widen
from daygrid.sources.sheets import merge_on_key

KEYS = ("entity_id", "obs_date")
# Site ratios sum growth over 14 days and a margin of 5.
SITE_LOOKBACK = 19
# Growth of the site's first day looks back furthest: 14 days of changes over 7 days each, corrected by the movements of
# 5 days and the day before, on readings filled over 5 rows and on the state.
READ_LOOKBACK = SITE_LOOKBACK + 14 + 7 + 6 + FILL_ROWS + STATUS_LOOKBACK
# First day whose state has all its look-back: quality carried by an earlier run enters here.
SEED_LOOKBACK = READ_LOOKBACK - STATUS_LOOKBACK

CALCULATED = (
    "active",
    "mass",
    "mass_corrected",
    "removable_inches",
    "removable_gallons",
    "removable_mass",
    "removable_mass_corrected",
    "est_removed_mass",
    "est_split_mass",
    "move_unmatched",
    *GROWTH_COLUMNS,
    "days_since_event",
    "status_code",
)
QUALITY = ("quality_val", "quality_total", "measured_on", "is_measured")


#: Late samples may change quality further back than late readings change the rest.
LOOKBACK, QUALITY_LOOKBACK = 10, 15


def seeds(
    samples: DataFrame, stored_quality: DataFrame, stored_calculated: DataFrame, seed_day: dt.date
) -> DataFrame:
    """The quality each entity carries into ``seed_day``, as sample rows of that day with ``carried_from``.

    That is the stored row of the day, unless an older sample is newer than the
    one it carries (or the same day's was corrected) and no inactive day lies
    between that sample and the seed day. So a sample counts however late it
    comes. Stored states are read only as far back as the oldest such sample.
    """
    values = ("quality_val", "quality_total")
    before = scan_one_date(stored_quality, seed_day).select(*KEYS, *values, F.col("measured_on").alias("carried_from"))
    older = samples.filter(F.col("obs_date") < F.lit(seed_day)).groupBy("entity_id")
    newest = older.agg(F.max_by(F.struct("obs_date", *values), "obs_date").alias("late")).alias("n")
    joined = newest.join(before.alias("b"), "entity_id", "left")
    late, carried = F.col("n.late"), F.col("b.carried_from")
    corrected = (late["obs_date"] == carried) & ~F.struct(*(late[c] for c in values)).eqNullSafe(
        F.struct(*(F.col(f"b.{c}") for c in values))
    )
    changed = joined.filter(carried.isNull() | (late["obs_date"] > carried) | corrected).select("entity_id", late.alias("late"))
    oldest = changed.agg(F.min("late.obs_date").alias("d")).scalar()
    idle = stored_calculated.filter(F.col("obs_date").between(oldest, F.lit(seed_day)) & ~F.col("active"))
    stopped = idle.groupBy("entity_id").agg(F.max("obs_date").alias("stopped"))
    counted = changed.join(stopped, "entity_id", "left").filter(
        F.col("stopped").isNull() | (F.col("stopped") < F.col("late.obs_date"))
    )
    new = counted.select(
        "entity_id", F.lit(seed_day).alias("obs_date"), *(F.col(f"late.{c}").alias(c) for c in values),
        F.col("late.obs_date").alias("carried_from"),
    )
    return before.join(new.select("entity_id"), "entity_id", "left_anti").unionByName(new)


def derive(
    measurements: DataFrame,
    samples: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    entities: DataFrame | None = None,
    stored: tuple[DataFrame, DataFrame] | None = None,
    margin: int = 0,
    bounds: tuple[Column, Column] | None = None,
    strict: bool = False,
) -> DataFrame:
    """All derived columns for a closed range of days, one row per entity and day.

    ``measurements`` and ``samples`` are unique per entity and day. Without a
    range everything is derived. With one, the range is widened to what the
    steps look back on, and cut again at the end. Quality and run lengths go
    back without limit: give ``stored`` (the tables quality and calculated of
    an earlier run) to start from what they hold, or all days up to the end
    are read. ``margin`` keeps that many days before ``start``; run lengths
    there are not right. ``bounds`` names the first and last stored date where
    the caller knows them more cheaply than by reading both inputs. With
    ``strict`` a movement that fits no rule stops the job.
    """
    facts = measurements
    read_from = None
    carried_run = None
    if start is not None:
        after = end + dt.timedelta(days=1)
        if stored is not None:
            quality, calculated = stored
            read_from = start - dt.timedelta(days=READ_LOOKBACK)
            seed_day = start - dt.timedelta(days=SEED_LOOKBACK)
            before = seeds(samples, quality, calculated, seed_day)
            recent = scan_date_range(samples, seed_day, end).join(before.select(*KEYS), list(KEYS), "left_anti")
            samples = recent.unionByName(before, True)
            # Each entity's newest stored run length; the days after it are derived again here.
            known = scan_date_range(calculated, seed_day, start - dt.timedelta(days=1)).groupBy("entity_id")
            run = F.coalesce("days_since_event", F.lit(0)).alias("carried_run")
            carried_run = known.agg(F.max_by(F.struct("obs_date", run), "obs_date").alias("k")).select("entity_id", "k.*")
            facts = scan_date_range(facts, read_from, after)
        else:
            facts = facts.filter(F.col("obs_date") <= F.lit(after))
            samples = samples.filter(F.col("obs_date") <= F.lit(end))
    if "carried_from" not in samples.columns:
        samples = samples.withColumn("carried_from", F.lit(None).cast("date"))
    # Unique per entity and day, so no entity is too large to be shuffled by: the grid needs nothing else.
    samples = samples.select(*KEYS, "quality_val", "quality_total", "carried_from")
    merged = merge_on_key([f for f in (facts, samples, carried_run) if f is not None], spread=["entity_id"])

    w = by_entity()
    # The day after the range is read only to close movements of its last day.
    last_read = None if end is None else end + dt.timedelta(days=1)
    # Min and max of the plain inputs; the merge need not run for them.
    low = high = None
    if read_from is None or end is None:
        low, high = bounds or date_bounds(facts.select("obs_date").union(samples.select("obs_date")))
    grid = densify(merged, low if read_from is None else read_from, high if end is None else last_read, entities)
    rows = standing_moves(mass_volume(grid), w, strict)
    if end is not None:
        rows = rows.filter(F.col("day_no") <= day_column(end))
    rows = estimate_fallback(volume_log_estimate(rows, w))
    rows = carry_measurements(rows, w)
    rows = days_since_event(rows, w)
    rows = status_code(growth_per_entity(rows, w), w)
    return rows if start is None else scan_date_range(rows, start - dt.timedelta(days=margin), end)


def daily_run(
    measurements: DataFrame,
    samples: DataFrame,
    run_start: dt.date,
    run_end: dt.date,
    entities: DataFrame | None = None,
    stored: tuple[DataFrame, DataFrame] | None = None,
    lookback: int = LOOKBACK,
    quality_lookback: int = QUALITY_LOOKBACK,
    scratch: Scratch | None = None,
    bounds: tuple[Column, Column] | None = None,
    strict: bool = False,
) -> dict[str, DataFrame]:
    """The tables of a scheduled run: its dates and the days before them that late data may still change.

    ``scratch`` freezes the rows behind them, which are then computed once;
    use it to write several tables.
    """
    start = widen(run_start, run_end, max(lookback, quality_lookback))
    rows = derive(measurements, samples, start, run_end, entities, stored, SITE_LOOKBACK, bounds, strict)
    rows = scratch.freeze(rows) if scratch else rows
    first = {"site_growth": widen(run_start, run_end, lookback)}
    return {name: scan_date_range(t, first.get(name, start), run_end) for name, t in tables(rows).items()}


def rebuild(
    measurements: DataFrame,
    samples: DataFrame,
    entities: DataFrame | None = None,
    only: str | None = None,
    bounds: tuple[Column, Column] | None = None,
    scratch: Scratch | None = None,
    strict: bool = False,
) -> dict[str, DataFrame]:
    """Every table over the full stored range, or one of them; Spark drops the steps it does not need."""
    rows = derive(measurements, samples, entities=entities, bounds=bounds, strict=strict)
    built = tables(scratch.freeze(rows) if scratch else rows)
    return built if only is None else {only: built[only]}


def tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The derived tables, ready for the keyed writer."""
    return {
        "calculated": rows.select(*KEYS, *CALCULATED),
        "quality": rows.select(*KEYS, *QUALITY),
        "site_growth": growth_aggregate(rows),
    }
