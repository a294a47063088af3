"""Growth per entity and for the whole site.

All steps add columns to one frame with one row per entity and day, so they
share a single shuffle by entity. Inactive rows stay in the frame but take no
part: values of theirs are masked before each window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from daygrid.functions.cleaning import pair_or_null
from daygrid.functions.days import at_offset, by_entity, previous_where, trailing_sum
from daygrid.functions.measures import liters, normalized_liters
from daygrid.operators.fill import blocked_fill
from daygrid.operators.state import continuity

FILL_ROWS = 5
PREVIOUS_DAYS = 7
SPANS = (5, 14)
FILLED = ("liters", "norm_liters", "filled_mass")
GROWTH_COLUMNS = (
    "mass_change_grams_7d",
    "prev_liters_7d",
    "prev_norm_liters_7d",
    "growth_5d",
    "norm_growth_5d",
    "growth_14d",
    "norm_growth_14d",
)


def _moved(removed: str = "est_removed_mass", split: str = "est_split_mass") -> Column:
    return F.coalesce(F.col(removed) > 0, F.lit(False)) | F.coalesce(F.col(split) > 0, F.lit(False))


def fill_growth_inputs(df: DataFrame, w: WindowSpec | None = None, rows: int = FILL_ROWS) -> DataFrame:
    """Add ``liters``, ``norm_liters`` and ``filled_mass``, filled both ways over missing days.

    A movement on a day without mass resets all three, also where a volume is
    known. Volume is not doubled for large units, as in the growth ratios the
    stored figures come from.
    """
    w = w or by_entity()
    density, depth = pair_or_null(F.col("density"), F.col("depth"))
    no_mass = F.col("mass_corrected").isNull() | (F.col("mass_corrected") == 0)
    volume = liters(depth)
    out = df.withColumns(
        {
            "liters": volume,
            "norm_liters": normalized_liters(volume, density),
            "filled_mass": F.col("mass_corrected"),
        }
    )
    return blocked_fill(out, FILLED, w, backward=rows, forward=rows, reset=_moved() & no_mass)


def movement_corrected(df: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """On movement days take the next calendar day's value of an active row, else the own value.

    Adds ``hc_<column>`` for the filled columns; null on inactive rows.
    """
    w = w or by_entity()

    def corrected(c: str) -> Column:
        own = F.when(F.col("active"), F.col(c))
        return F.when(F.col("active"), F.when(_moved(), at_offset(own, w, 1)).otherwise(F.col(c)))

    return df.withColumns({f"hc_{c}": corrected(c) for c in FILLED})


def shifted_rolling_sum(df: DataFrame, w: WindowSpec | None = None, days: int = PREVIOUS_DAYS - 1) -> DataFrame:
    """Mass moved before each active row: the previous active row's value, summed over calendar days.

    The shift goes by active rows and the sum by calendar days. Adds
    ``removed_before`` and ``split_before``; a missing value counts as 0.
    """
    w = w or by_entity()
    sums = {"removed_before": "est_removed_mass", "split_before": "est_split_mass"}
    active = F.coalesce(F.col("active"), F.lit(False))
    out = df.withColumns(
        {f"_{n}": previous_where(F.coalesce(F.col(c), F.lit(0.0)), active, w) for n, c in sums.items()}
    )
    return out.withColumns(
        {n: F.when(active, trailing_sum(F.when(active, F.col(f"_{n}")), w, days)) for n in sums}
    ).drop(*(f"_{n}" for n in sums))


def mass_change(df: DataFrame, w: WindowSpec | None = None, days: int = PREVIOUS_DAYS) -> DataFrame:
    """Net mass change over ``days`` in grams, with the volumes it started from.

    Not above zero, or unknown, counts as 0. Null on inactive rows.
    """
    w = w or by_entity()
    out = df.withColumns(
        {
            "prev_liters_7d": at_offset(F.col("hc_liters"), w, -days),
            "prev_norm_liters_7d": at_offset(F.col("hc_norm_liters"), w, -days),
            "_prev_mass": at_offset(F.col("hc_filled_mass"), w, -days),
        }
    )
    kg = F.col("removed_before") + F.col("split_before") + F.col("filled_mass") - F.col("_prev_mass")
    active = F.col("active")
    return out.withColumns(
        {
            "mass_change_grams_7d": F.when(active, F.when(kg > 0, kg).otherwise(0.0) * 1000),
            "prev_liters_7d": F.when(active, F.col("prev_liters_7d")),
            "prev_norm_liters_7d": F.when(active, F.col("prev_norm_liters_7d")),
        }
    ).drop("_prev_mass")


def rolling_ratio(numerator: Column, denominator: Column, w: WindowSpec, days: int) -> Column:
    """Ratio of two sums over calendar days, each needing a value on all of them."""
    return F.try_divide(trailing_sum(numerator, w, days, days), trailing_sum(denominator, w, days, days))


def rolling_growth(df: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """The four growth ratios from mass change and starting volumes; each sum is computed once."""
    w = w or by_entity()
    change, volume, norm = GROWTH_COLUMNS[:3]
    sums = {f"_{c}_{d}": trailing_sum(F.col(c), w, d, d) for c in (change, volume, norm) for d in SPANS}
    ratios = {}
    for d in SPANS:
        ratios[f"growth_{d}d"] = F.try_divide(f"_{change}_{d}", f"_{volume}_{d}")
        ratios[f"norm_growth_{d}d"] = F.try_divide(f"_{change}_{d}", f"_{norm}_{d}")
    out = df.withColumns(sums).withColumns({n: F.when(F.col("active"), r) for n, r in ratios.items()})
    return out.drop(*sums)


def growth_per_entity(df: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """Add the growth columns to a frame with readings, state, mass and movement estimates.

    A row is valid when the 8 calendar days up to it are present and none is
    inactive. Invalid rows lose their values only after the mass change was
    set to 0 where unknown.
    """
    w = w or by_entity()
    kept = df.columns
    out = df.withColumn("_valid", continuity(w, PREVIOUS_DAYS + 1))
    out = fill_growth_inputs(out, w)
    out = shifted_rolling_sum(movement_corrected(out, w), w)
    out = mass_change(out, w)
    out = out.withColumns({c: F.when(F.col("_valid"), F.col(c)) for c in GROWTH_COLUMNS[:3]})
    out = rolling_growth(out, w)
    return out.select(*kept, *GROWTH_COLUMNS)


def sum_by_day(df: DataFrame, columns: tuple[str, ...], date: str = "obs_date") -> DataFrame:
    """Sum over entities per day; a day without any value gives 0."""
    return df.groupBy(date).agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in columns))


def trailing_by_day(
    daily: DataFrame,
    columns: tuple[str, ...],
    spans: tuple[int, ...] = SPANS,
    date: str = "obs_date",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Sums over the last calendar days of a table with one row per day, without an entity key.

    Each row is sent to the days it counts for and summed there, so no single
    task sees the whole series. Adds ``<column>_<n>d``, null while fewer than
    ``n`` days have a value. The result has the days of ``daily`` and, of its
    other columns, those in ``keep``.
    """
    ahead = F.explode(F.sequence(F.lit(0), F.lit(max(spans) - 1)))
    sent = daily.select("*", ahead.alias("_back")).withColumn("_target", F.date_add(date, F.col("_back")))
    own = F.col("_back") == 0
    sums = [F.max(F.when(own, F.col(c))).alias(c) for c in (*columns, *keep)]
    for days in spans:
        for c in columns:
            value = F.when(F.col("_back") < days, F.col(c))
            sums.append(F.when(F.count(value) >= days, F.sum(value)).alias(f"{c}_{days}d"))
    spread = sent.groupBy(F.col("_target").alias(date)).agg(*sums, F.max(own).alias("_own"))
    return spread.filter("_own").drop("_own")


def site_ratios(daily: DataFrame, date: str = "obs_date", keep: tuple[str, ...] = ()) -> DataFrame:
    """Site growth ratios from the daily sums of mass change and starting volumes."""
    change, volume, norm = GROWTH_COLUMNS[:3]
    sums = trailing_by_day(daily, (change, volume, norm), SPANS, date, keep)
    ratios = {}
    for days in SPANS:
        ratios[f"agg_growth_{days}d"] = F.try_divide(f"{change}_{days}d", f"{volume}_{days}d")
        ratios[f"agg_norm_growth_{days}d"] = F.try_divide(f"{change}_{days}d", f"{norm}_{days}d")
    return sums.withColumns(ratios).select(date, change, volume, norm, *keep, *ratios)


def growth_aggregate(df: DataFrame, date: str = "obs_date") -> DataFrame:
    """Site growth: sums over entities per day, then the same ratios over days."""
    return site_ratios(sum_by_day(df, GROWTH_COLUMNS[:3], date), date)
