"""Aggregates per day, entity and group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daygrid.functions.cleaning import suffix_group
from daygrid.functions.days import by_entity, fiscal_year
from daygrid.operators.fill import UNLIMITED, blocked_fill

KEYS = ("entity_id", "obs_date")
# Layout groups by unit size, and area per unit.
SMALL_GROUPS = ("1", "2", "3", "4")
LARGE_GROUPS = ("6", "8")
SMALL_AREA = 1.1
LARGE_AREA = 2.2
FISCAL_MONTH = 9


def mean_duplicates(df: DataFrame, values: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Several measurements of one key become their mean."""
    return df.groupBy(*keys).agg(*(F.avg(v).alias(v) for v in values))


def daily_event_rollup(
    log: DataFrame, keys: Sequence[str] = KEYS, source: str = "source_tag", row: str = "row_no"
) -> DataFrame:
    """Logged events of one key as one row: max initial, min final, total volume, joined notes.

    Notes keep the order (source, row); missing ones leave no trace, and a key
    without notes gets an empty text. The joined notes of a key are one cell
    and so lie in one task; all else is reduced before the shuffle.
    """
    noted = F.collect_list(F.when(F.col("notes").isNotNull(), F.struct(source, row, "notes")))
    return log.dropna(subset=[keys[0], "volume"]).groupBy(*keys).agg(
        F.max("initial_depth").alias("initial_depth"),
        F.min("final_depth").alias("final_depth"),
        F.sum("volume").alias("volume"),
        F.array_join(F.transform(F.array_sort(noted), lambda r: r["notes"]), " / ").alias("notes"),
    )


def status_rollup(df: DataFrame, codes: Sequence[int] = tuple(range(7)), date: str = "obs_date") -> DataFrame:
    """Count and mass per day and status code; every code is listed on every day."""
    per_code = []
    for k in codes:
        hit = F.col("status_code") == k
        per_code.append(
            F.struct(
                F.lit(k).alias("status_code"),
                F.count_if(hit).alias("entity_count"),
                F.coalesce(F.sum(F.when(hit, F.col("mass_corrected"))), F.lit(0.0)).alias("mass_corrected"),
            )
        )
    return df.groupBy(date).agg(F.array(*per_code).alias("_codes")).select(date, F.inline("_codes"))


def area_counts() -> list[Column]:
    """Active entities, in all and by unit size, as aggregates."""
    active = F.coalesce(F.col("active"), F.lit(False))
    group = suffix_group(F.col("entity_id"))
    return [
        F.count_if(active).alias("active_total"),
        F.count_if(active & group.isin(*SMALL_GROUPS)).alias("active_small"),
        F.count_if(active & group.isin(*LARGE_GROUPS)).alias("active_large"),
    ]


def area() -> Column:
    """Area covered by the counted entities."""
    return F.col("active_small") * F.lit(SMALL_AREA) + F.col("active_large") * F.lit(LARGE_AREA)


def active_area(df: DataFrame, date: str = "obs_date") -> DataFrame:
    """Active entities per day, by unit size, and the area they cover."""
    return df.groupBy(date).agg(*area_counts()).withColumn("active_area", area())


def fill_active_mass(df: DataFrame, w: WindowSpec | None = None, rows: int = 2) -> DataFrame:
    """Add ``mass_filled``: mass carried over at most ``rows`` rows, not across inactive ones; active rows only."""
    w = w or by_entity()
    out = blocked_fill(
        df.withColumn("mass_filled", F.col("mass_corrected")), ["mass_filled"], w, forward=rows, block=~F.col("active")
    )
    return out.withColumn("mass_filled", F.when(F.col("active"), F.col("mass_filled")))


def active_mass_filled(df: DataFrame, w: WindowSpec | None = None, date: str = "obs_date") -> DataFrame:
    """Mass over active entities per day with short gaps filled."""
    filled = fill_active_mass(df, w)
    return filled.groupBy(date).agg(F.coalesce(F.sum("mass_filled"), F.lit(0.0)).alias("active_mass"))


def period_to_date(
    df: DataFrame, values: Sequence[str], keys: Sequence[str] = ("entity_id",), date: str = "obs_date",
    first_month: int = FISCAL_MONTH,
) -> DataFrame:
    """Fiscal-year and month-to-date sums of ``values`` on every row.

    Adds ``ytd_<value>`` and ``mtd_<value>``. Rows are spread by entity and
    fiscal year once; both windows share that partitioning and one sort. A
    group is one entity's days of one year.
    """
    year = fiscal_year(F.col(date), first_month)
    spread = df.withColumns({"_year": year, "_month": F.trunc(date, "month")}).repartition(*keys, "_year")
    in_year = Window.partitionBy(*keys, "_year").orderBy("_month", date)
    in_month = Window.partitionBy(*keys, "_year", "_month").orderBy(date)
    sums = {}
    for v in values:
        sums[f"ytd_{v}"] = F.coalesce(F.sum(v).over(in_year), F.lit(0.0))
        sums[f"mtd_{v}"] = F.coalesce(F.sum(v).over(in_month), F.lit(0.0))
    return spread.withColumns(sums).drop("_year", "_month")


def fiscal_start(date: Column, first_month: int = FISCAL_MONTH) -> Column:
    return F.make_date(fiscal_year(date, first_month), F.lit(first_month), F.lit(1))


#: Days of a bucket that intervals and dates meet in.
BUCKET_DAYS = 32


def period_intervals(
    df: DataFrame, values: Sequence[str], keys: Sequence[str] = ("entity_id",), date: str = "obs_date",
    first_month: int = FISCAL_MONTH,
) -> DataFrame:
    """Fiscal-year and month-to-date sums as intervals of days on which they stay the same.

    Columns: keys, ``fiscal_year``, ``valid_from``, ``valid_to`` (both within
    the year), and ``ytd_`` and ``mtd_`` of each value. A key's first day of
    a year and each day with a value other than zero begin an interval, and
    the next month does where the month's sums end; so rows grow with the
    changes, not with keys times days. Rows without a date count nowhere.
    """
    daily = df.groupBy(*keys, date).agg(*(F.sum(v).alias(v) for v in values))
    daily = daily.withColumns({"_year": fiscal_year(F.col(date), first_month), "_month": F.trunc(date, "month")})
    in_year = Window.partitionBy(*keys, "_year").orderBy("_month", date)
    in_month = Window.partitionBy(*keys, "_year", "_month").orderBy(date)
    sums = {"_first": F.lag(date).over(in_year).isNull()}
    changed = F.col("_first")
    for v in values:
        sums[f"ytd_{v}"] = F.coalesce(F.sum(v).over(in_year), F.lit(0.0))
        sums[f"mtd_{v}"] = F.coalesce(F.sum(v).over(in_month), F.lit(0.0))
        changed = changed | F.coalesce(F.col(v) != 0, F.lit(False))
    changes = daily.withColumns(sums).filter(changed & F.col(date).isNotNull())
    year_end = F.date_sub(F.add_months(fiscal_start(F.col(date), first_month), 12), 1)
    month_end = F.last_day(date)
    ended = changes.withColumns(
        {"_end": F.coalesce(F.date_sub(F.lead(date).over(in_year), 1), year_end), "_month_end": month_end}
    )
    month = [F.struct(F.col(date).alias("valid_from"), F.least("_end", "_month_end").alias("valid_to"), F.lit(True).alias("own"))]
    later = F.struct(F.date_add("_month_end", 1).alias("valid_from"), F.col("_end").alias("valid_to"), F.lit(False).alias("own"))
    parts = F.array_compact(F.array(*month, F.when(F.col("_end") > F.col("_month_end"), later)))
    out = ended.withColumn("_part", F.explode(parts))
    columns = []
    for v in values:
        columns.append(F.col(f"ytd_{v}"))
        columns.append(F.when(F.col("_part.own"), F.col(f"mtd_{v}")).otherwise(0.0).alias(f"mtd_{v}"))
    return out.select(*keys, F.col("_year").alias("fiscal_year"), "_part.valid_from", "_part.valid_to", *columns)


def at_dates(intervals: DataFrame, reports: DataFrame, date: str = "obs_date") -> DataFrame:
    """The rows of ``intervals`` that hold on each distinct date of ``reports``, with that date as ``report_date``.

    Both sides meet in buckets of ``BUCKET_DAYS`` days: an interval is sent to those it covers, so a date is compared
    with the intervals of its bucket only.
    """
    def bucket(day: Column) -> Column:
        return F.floor(F.unix_date(day) / BUCKET_DAYS)

    days = reports.select(F.col(date).alias("report_date")).distinct().withColumn("_bucket", bucket(F.col("report_date")))
    covered = F.explode(F.sequence(bucket(F.col("valid_from")), bucket(F.col("valid_to"))))
    sent = intervals.withColumn("_bucket", covered).join(days, "_bucket")
    held = sent.filter(F.col("report_date").between(F.col("valid_from"), F.col("valid_to")))
    return held.drop("_bucket", "fiscal_year", "valid_from", "valid_to")


def period_to_date_at(
    df: DataFrame, values: Sequence[str], reports: DataFrame, keys: Sequence[str] = ("entity_id",), date: str = "obs_date",
    first_month: int = FISCAL_MONTH,
) -> DataFrame:
    """Fiscal-year and month-to-date sums for each report date, also for entities without a row on it.

    ``reports`` holds the report dates, any number of them, in its column
    ``date``. The result has ``report_date``; it is what ``period_intervals``
    say at these dates.
    """
    sums = [f"{p}_{v}" for v in values for p in ("ytd", "mtd")]
    return at_dates(period_intervals(df, values, keys, date, first_month), reports, date).select(*keys, "report_date", *sums)


def unit_cost(cost: Column, mass: Column) -> Column:
    """Cost per kg; null while there is no mass."""
    return F.when(mass > 0, cost / mass)


def period_totals_unit_cost(
    costs: DataFrame, masses: DataFrame, site_costs: DataFrame, date: str = "obs_date", first_month: int = FISCAL_MONTH
) -> DataFrame:
    """Site totals to date for every day: entity costs plus site cost, mass, and cost per kg.

    ``costs`` has ``cost``, ``masses`` has ``est_removed_mass``, ``site_costs``
    has ``site_cost``. Everything is summed per day first; the windows then
    hold one row per day of a fiscal year.
    """
    wanted = ("cost", "est_removed_mass", "site_cost")
    parts = [f.select(date, v) for f, v in zip((costs, masses, site_costs), wanted)]
    stacked = parts[0].unionByName(parts[1], True).unionByName(parts[2], True)
    daily = stacked.groupBy(date).agg(*(F.coalesce(F.sum(v), F.lit(0.0)).alias(v) for v in wanted))
    out = period_to_date(daily, wanted, keys=(), date=date, first_month=first_month)
    for p in ("ytd", "mtd"):
        total = F.col(f"{p}_cost") + F.col(f"{p}_site_cost")
        out = out.withColumn(f"{p}_total_cost", total)
        out = out.withColumn(f"{p}_cost_per_kg", unit_cost(F.col(f"{p}_total_cost"), F.col(f"{p}_est_removed_mass")))
    return out.drop(*wanted, "ytd_cost", "mtd_cost")


def group_mean_ratio(df: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """Mean quality and density per day and layout group, and two ratios of them.

    ``df`` holds both per entity and day (join separate tables with
    ``attach_state`` first). A missing density takes the entity's last known
    one; rows before the first are dropped.
    """
    w = w or by_entity()
    known = blocked_fill(df, ["density"], w, forward=UNLIMITED).dropna(subset=["density"])
    means = known.groupBy("obs_date", suffix_group(F.col("entity_id")).alias("entity_group")).agg(
        *(F.avg(c).alias(c) for c in ("quality_val", "quality_total", "density"))
    )
    return means.withColumns(
        {
            "total_density_ratio": F.try_divide("quality_total", "density"),
            "quality_density_ratio": F.try_divide("quality_val", "density"),
        }
    )


def linear_trend(df: DataFrame, value: str, group: Sequence[str], date: str = "obs_date", origin: str = "2000-01-01"):
    """Least-squares line of ``value`` on the day per group.

    Days count from ``origin`` inside the fit, which keeps the sums small; the
    intercept returned is that of day number 0 (1970-01-01).
    """
    shift = F.unix_date(F.lit(origin).cast("date"))
    x = (F.unix_date(date) - shift).cast("double")
    fit = df.groupBy(*group).agg(
        F.regr_slope(F.col(value), x).alias("slope"),
        F.regr_intercept(F.col(value), x).alias("_intercept"),
        F.count(value).alias("points"),
    )
    return fit.select(*group, "slope", (F.col("_intercept") - F.col("slope") * shift).alias("intercept"), "points")


def with_trend(df: DataFrame, value: str, group: Sequence[str], date: str = "obs_date", origin: str = "2000-01-01") -> DataFrame:
    """Add ``fitted``, the value of each group's least-squares line on the row's day; the rows are read once."""
    x = (F.unix_date(date) - F.unix_date(F.lit(origin).cast("date"))).cast("double")
    w = Window.partitionBy(*group)
    slope, start = F.regr_slope(F.col(value), x).over(w), F.regr_intercept(F.col(value), x).over(w)
    return df.withColumn("fitted", start + slope * x)
