"""From raw source sheets to table payloads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.functions.cleaning import drop_null_keys, nan_to_null, suffix_group, tag_extract, zero_to_null
from daygrid.functions.labels import known_entities, parse_sample_labels
from daygrid.functions.measures import cost_by_rate, linear_cost, weather_conform
from daygrid.operators.grid import calendar_outer_join, scaffold_missing_days
from daygrid.operators.rollups import daily_event_rollup, mean_duplicates
from daygrid.sources.headers import clean_headers
from daygrid.sources.scans import allowed_columns, scan_date_range
from daygrid.sources.sheets import merge_on_key, reconcile_columns, union_by_name, union_sources_filtered, unpivot_entity_sheets

KEYS = ("entity_id", "obs_date")


def measurement_payload(
    sheets: Mapping[str, DataFrame],
    allowed: Sequence[str],
    label: str = "entity_id",
    rename: Mapping[str, str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """The sheets of one or more days as measurement rows, and the columns left out.

    Column names are cleaned first (``clean_headers``), ``rename`` goes by clean
    names. Each sheet has the unit label and ``obs_date``; a sheet without a
    label column is skipped. Columns that several sheets hold are reconciled, all
    others merged. Sheets are unique per unit and day.
    """
    cleaned: dict[str, DataFrame] = {}
    dropped: list[str] = []
    for name, sheet in sheets.items():
        sheet = clean_headers(sheet, name, rename)
        if label not in sheet.columns:
            continue
        sheet = tag_extract(drop_null_keys(nan_to_null(sheet), [label]), label).withColumnRenamed(label, "entity_id")
        if "density" in sheet.columns:
            sheet = sheet.withColumn("density", zero_to_null(F.col("density")))
        sheet, extra = allowed_columns(sheet, [*KEYS, *(c for c in allowed if c not in KEYS)])
        cleaned[name] = sheet
        dropped += [c for c in extra if c not in dropped]
    holders: dict[str, list[str]] = {}
    for name, sheet in cleaned.items():
        for c in sheet.columns:
            if c not in (*KEYS, "media_only"):
                holders.setdefault(c, []).append(name)
    shared = [c for c, names in holders.items() if len(names) > 1]
    parts = [s.select(*KEYS, *(c for c in s.columns if c in holders and c not in shared)) for s in cleaned.values()]
    if shared:
        same = {n: s.select(*KEYS, *(c for c in shared if c in s.columns)) for n, s in cleaned.items()}
        parts.append(reconcile_columns(same, KEYS, shared).drop(*(f"{c}_source" for c in shared)))
    # A tag on any sheet marks the unit.
    tagged = union_by_name([s.select(*KEYS, "media_only") for s in cleaned.values()])
    parts.append(tagged.groupBy(*KEYS).agg(F.bool_or("media_only").alias("media_only")))
    merged = merge_on_key(parts)
    return merged.withColumn("entity_group", suffix_group(F.col("entity_id"))), dropped


def with_missing_days(payload: DataFrame, entities: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Payload plus one empty row per entity for each day of the range without any source.

    Write these rows with their key columns only, so that a file that goes
    missing later erases nothing (``missing_day_keys``).
    """
    return union_by_name([payload, missing_day_keys(payload, entities, start, end)])


def missing_day_keys(payload: DataFrame, entities: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Keys of the days without any source."""
    return scaffold_missing_days(payload, entities.select("entity_id"), start, end)


def movement_payload(sheets: Mapping[str, DataFrame], start: dt.date, end: dt.date) -> DataFrame:
    """Movement codes from one sheet per entity, cut to the range."""
    return scan_date_range(unpivot_entity_sheets(sheets), start, end)


def sample_payload(files: Sequence[DataFrame], entities: DataFrame) -> DataFrame:
    """Parsed samples of all files; several of one key become their mean, unknown entities are dropped."""
    read = parse_sample_labels(union_by_name(files))
    return known_entities(mean_duplicates(read, ["quality_val", "quality_total"]), entities)


def site_usage_payload(
    sheets: Mapping[str, DataFrame], start: dt.date, end: dt.date, usage: str = "usage_qty", ignore: Sequence[str] = ()
) -> DataFrame:
    """Site usage of the chosen yearly sheets with its cost."""
    stacked = union_sources_filtered(sheets, ignore=ignore)
    in_range = scan_date_range(stacked, start, end).select("obs_date", usage)
    return linear_cost(in_range, usage)


def processing_payload(sheet: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Processing figures with an empty row for every day that has none."""
    return calendar_outer_join(sheet, start, end)


def removal_payload(sheets: Mapping[str, DataFrame]) -> DataFrame:
    """Logged removals of all source sheets, one row per entity and day."""
    log = union_sources_filtered(sheets, tag="source_tag")
    return daily_event_rollup(log).withColumnRenamed("volume", "removed_volume")


def weather_payload(station: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return scan_date_range(weather_conform(station), start, end)


def expense_payload(measurements: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Cost of every input per entity and day of a range."""
    return all_expenses(scan_date_range(measurements, start, end))


def all_expenses(measurements: DataFrame) -> DataFrame:
    """Cost of every input per entity and day."""
    return cost_by_rate(measurements.select(*KEYS, *(c for c in measurements.columns if c.startswith("in_"))))
