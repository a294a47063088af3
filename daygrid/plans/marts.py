"""Report tables for all asked dates in one pass, with the date as a column.

``rows`` is the frame of ``daygrid.plans.daily.derive``: readings and derived
columns, one row per entity and day, starting at least one day before the
first report date (90 days for the quality report). ``start`` and ``end``
limit the report dates; without them every date is reported.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.durable import Scratch, freeze
from daygrid.functions.cleaning import first_positive, suffix_group
from daygrid.operators.classify import candidate_order, indicator_flags, removal_candidates, value_bucket
from daygrid.operators.growth import GROWTH_COLUMNS, site_ratios
from daygrid.operators.history import HISTORY_DAYS, change_between, last_measurements
from daygrid.operators.ranking import running_totals
from daygrid.operators.rollups import (
    FISCAL_MONTH,
    area,
    area_counts,
    fill_active_mass,
    fiscal_start,
    group_mean_ratio,
    at_dates,
    period_intervals,
    period_to_date_at,
    status_rollup,
    unit_cost,
    with_trend,
)
from daygrid.operators.state import last_event_date, prev_day_fallback
from daygrid.sources.scans import scan_date_range


def _dates(df: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    return df if start is None else scan_date_range(df, start, end)


# ---- health ----------------------------------------------------------------


def health_overview(
    rows: DataFrame, indicators: DataFrame | None = None, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """One row per entity and date: readings with fallback, state, flags, growth.

    ``indicators`` holds the indicator readings per entity and day, unless
    ``rows`` has them.
    """
    out = prev_day_fallback(rows)
    out = _dates(out, start, end)
    if indicators is not None:
        # The flag for purity reads the entity's own measurement, which rows already have.
        extra = [c for c in indicators.columns if c not in rows.columns]
        out = out.join(indicators.select("entity_id", "obs_date", *extra), ["entity_id", "obs_date"], "left")
    return out.select(
        "obs_date",
        "entity_id",
        "active",
        "status_code",
        "depth",
        "density",
        "non_current_depth",
        "non_current_density",
        F.when(F.col("active"), F.col("quality_val")).alias("quality_val"),
        F.when(F.col("active"), F.col("measured_on")).alias("measured_on"),
        F.when(F.col("active"), F.array_join(indicator_flags(), ",")).alias("flags"),
        "mass_corrected",
        "removable_inches",
        "removable_mass_corrected",
        "norm_growth_5d",
        "norm_growth_14d",
        last_event_date(F.col("obs_date"), F.col("days_since_event")).alias("last_event_date"),
    )


def prior_day_summary(site: DataFrame, sums: dict[str, list[str]], notes: str | None = None) -> DataFrame:
    """The processing figures of the day before each report date.

    ``sums`` maps an output to its sources in priority order: with several,
    the first above zero counts. Missing figures are 0, missing notes empty.
    """
    def figure(sources: list[str]) -> Column:
        if len(sources) > 1:
            return first_positive(*(F.col(s) for s in sources))
        return F.coalesce(F.col(sources[0]), F.lit(0.0))

    columns = [figure(s).alias(n) for n, s in sums.items()]
    if notes is not None:
        columns.append(F.coalesce(F.col(notes), F.lit("")).alias(notes))
    return site.select(F.date_add("obs_date", 1).alias("obs_date"), *columns)


def health_summary(rows: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """One row per date: active entities, area, mass with short gaps filled, growth, and the any-old-reading flag.

    The frame is read once: all of it comes from one aggregate per date, from
    which the site ratios follow. ``rows`` must start 14 days before ``start``.
    """
    filled = fill_active_mass(prev_day_fallback(rows))
    old = F.coalesce(F.col("non_current_depth") | F.col("non_current_density"), F.lit(False))
    daily = filled.groupBy("obs_date").agg(
        *area_counts(),
        F.coalesce(F.sum("mass_filled"), F.lit(0.0)).alias("active_mass"),
        F.bool_or(old).alias("any_non_current"),
        *(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in GROWTH_COLUMNS[:3]),
    )
    kept = ("active_total", "active_small", "active_large", "active_area", "active_mass", "any_non_current")
    ratios = site_ratios(daily.withColumn("active_area", area()), keep=kept)
    return _dates(ratios, start, end).select("obs_date", *kept, "agg_norm_growth_5d", "agg_norm_growth_14d")


def health_status(rows: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Entities and mass per status code and date."""
    return status_rollup(_dates(rows, start, end))


# ---- removals --------------------------------------------------------------


def recommended_removals(
    rows: DataFrame, start: dt.date | None = None, end: dt.date | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """Candidates per date and layout group with running volume and mass in rank order.

    The candidates are computed and frozen here (``running_totals``).
    """
    candidates = removal_candidates(_dates(rows, start, end)).select(
        "obs_date",
        suffix_group(F.col("entity_id")).alias("entity_group"),
        "entity_id",
        "drop_to",
        "days_since_event",
        "removable_inches",
        "removable_gallons",
        "removable_mass_corrected",
    )
    return running_totals(
        candidates,
        ["obs_date", "entity_group"],
        candidate_order(),
        {"running_gallons": "removable_gallons", "running_mass": "removable_mass_corrected"},
        scratch,
    )


def recommended_totals(rows: DataFrame) -> DataFrame:
    """Total mass and volume of the candidates per date."""
    return removal_candidates(rows).groupBy("obs_date").agg(
        F.sum("removable_mass_corrected").alias("total_mass"),
        F.sum("removable_gallons").alias("total_gallons"),
        F.count(F.lit(1)).alias("candidates"),
    )


# ---- quality ---------------------------------------------------------------


def quality_overview(rows: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """One row per entity and date: newest measurements, change between them, bucket."""
    recent = _dates(last_measurements(rows), start, end)
    out = change_between(recent)
    return out.select(
        "obs_date",
        "entity_id",
        "active",
        "measurements",
        "latest_date",
        "latest_value",
        "change_1",
        "change_1_days",
        "change_1_sign",
        "change_2",
        "change_2_days",
        "change_2_sign",
        value_bucket(F.col("latest_value"), F.col("active")).alias("bucket"),
    )


def latest_sample_date(overview: DataFrame) -> DataFrame:
    """Newest measurement over all entities per report date."""
    return overview.groupBy("obs_date").agg(F.max("latest_date").alias("latest_sample_date"))


def quality_series(rows: DataFrame) -> DataFrame:
    """Daily group means with ratios."""
    return group_mean_ratio(rows.select("entity_id", "obs_date", "day_no", "quality_val", "quality_total", "density"))


def quality_trend(rows: DataFrame) -> DataFrame:
    """Daily group means with ratios, and ``fitted``, the line through each group's quality."""
    return with_trend(quality_series(rows), "quality_val", ["entity_group"])


# ---- expenses --------------------------------------------------------------


def _fiscal_rows(df: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """Rows that count for report dates of a range: those since its first fiscal year began."""
    if start is None:
        return df
    began = dt.date(start.year - (start.month < FISCAL_MONTH), FISCAL_MONTH, 1)
    return scan_date_range(df, began, end)


def _spent(costs: DataFrame, masses: DataFrame) -> DataFrame:
    """cost and est_removed_mass by entity and day; ``costs`` has one ``<input>_cost`` column per input."""
    parts = [F.coalesce(F.col(c), F.lit(0.0)) for c in costs.columns if c.endswith("_cost")]
    cost = reduce(lambda a, b: a + b, parts)
    return costs.select("entity_id", "obs_date", cost.alias("cost")).unionByName(
        masses.select("entity_id", "obs_date", "est_removed_mass"), allowMissingColumns=True
    )


SPENT = ("cost", "est_removed_mass")


def expense_intervals(
    costs: DataFrame, masses: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Year and month to date cost and removed mass per entity, as intervals of days on which they stay the same.

    The table to store (``store.save_intervals``): it grows with the days on
    which an entity has costs or removals. ``rollups.at_dates`` reads report
    dates from it. A range is widened to the fiscal years it touches.
    """
    # An entity has few rows a day, so adding up before the shuffle saves none and only takes memory in the tasks that
    # make ``costs`` and ``masses``.
    spent = _spent(*(_fiscal_rows(df, start, end) for df in (costs, masses))).repartition("entity_id", "obs_date")
    return period_intervals(spent, SPENT)


def expense_overview(
    costs: DataFrame,
    masses: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    reports: DataFrame | None = None,
) -> DataFrame:
    """Year and month to date cost and removed mass per entity for each report date.

    The report dates are those of ``reports``, or all dates of ``costs`` in the range.
    """
    dates = _dates(costs.select("obs_date") if reports is None else reports, start, end)
    return at_dates(expense_intervals(costs, masses, start, end), dates)


def expense_totals(
    costs: DataFrame,
    masses: DataFrame,
    site_costs: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    reports: DataFrame | None = None,
) -> DataFrame:
    """Site totals for each report date: entity and site cost, mass, and cost per kg.

    The entities' sums to date add up to the sums to date of the site's days,
    so nothing is computed per entity.
    """
    dates = _dates(costs.select("obs_date") if reports is None else reports, start, end)
    costs, masses, site_costs = (_fiscal_rows(df, start, end) for df in (costs, masses, site_costs))
    entity = period_to_date_at(_spent(costs, masses), SPENT, dates, keys=())
    site = period_to_date_at(site_costs, ("site_cost",), dates, keys=())
    out = entity.join(site, "report_date", "full")
    for p in ("ytd", "mtd"):
        total = F.coalesce(F.col(f"{p}_cost"), F.lit(0.0)) + F.coalesce(F.col(f"{p}_site_cost"), F.lit(0.0))
        out = out.withColumn(f"{p}_total_cost", total)
        out = out.withColumn(f"{p}_cost_per_kg", unit_cost(F.col(f"{p}_total_cost"), F.col(f"{p}_est_removed_mass")))
    return out.drop("ytd_cost", "mtd_cost")


# ---- backfill --------------------------------------------------------------


def backfill_marts(
    rows: DataFrame,
    costs: DataFrame,
    masses: DataFrame,
    indicators: DataFrame | None = None,
    days: int = 15,
    scratch: Scratch | None = None,
) -> dict[str, DataFrame]:
    """The four reports for the newest ``days`` dates, each in one pass over all of them.

    The report dates are taken first; only the days that the reports look back
    on are frozen, once, and all windows run on those. Give ``rows`` that begin
    no earlier than needed (``derive`` with a range). Every report carries its
    date as a column to partition a written table by. With ``scratch`` the
    frozen rows go when it does.
    """
    def since(df: DataFrame) -> Column:
        return df.select("obs_date").distinct().orderBy(F.desc("obs_date")).limit(days).agg(F.min("obs_date")).scalar()

    first = since(rows)
    cut = rows.filter(F.col("obs_date") >= F.date_sub(first, HISTORY_DAYS))
    shared = scratch.freeze(cut) if scratch else freeze(cut)
    newest = since(shared)

    def latest(report: DataFrame) -> DataFrame:
        return report.filter(F.col("obs_date") >= newest)

    paid = since(costs)
    began = fiscal_start(paid)
    recent = [df.filter(F.col("obs_date") >= began) for df in (costs, masses)]
    reports = costs.filter(F.col("obs_date") >= paid)
    return {
        "health": latest(health_overview(shared, indicators)),
        "removals": recommended_removals(latest(shared), scratch=scratch),
        "quality": latest(quality_overview(shared)),
        "expenses": expense_overview(*recent, reports=reports),
    }
