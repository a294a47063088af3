"""Views over the given tables that have the shape of the operators' inputs."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.functions.days import by_entity
from daygrid.functions.labels import known_entities, parse_sample_labels
from daygrid.functions.measures import mass_volume
from daygrid.operators.fill import UNLIMITED, blocked_fill
from daygrid.operators.grid import date_bounds, densify
from daygrid.operators.history import carry_measurements
from daygrid.operators.movement import movement_masses
from daygrid.operators.rollups import mean_duplicates
from daygrid.operators.state import active_status, days_since_event
from daygrid.sources.scans import scan_date_range
from daygrid.sources.sheets import merge_on_key


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def padded(number: Column, width: int = 4) -> Column:
    """Digits with leading zeros; longer numbers stay whole."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def cents(value: str) -> Column:
    """An amount with two decimals as an integer, so that sums do not depend on the order."""
    return F.round(F.col(value) * 100).cast("bigint")


def event_days(spark: SparkSession, sf: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Events with entity and day, of a range of days if one is given."""
    events = table(spark, sf, "events")
    if start is not None:
        events = scan_date_range(events, start, end, date="ts")
    return events.withColumns(
        {"entity_id": padded(F.col("user_id")), "obs_date": F.to_date("ts")}
    )


def entities(spark: SparkSession, sf: str) -> DataFrame:
    return event_days(spark, sf).select("entity_id").distinct()


def daily_obs(spark: SparkSession, sf: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Daily readings per entity, with gaps: event means by type, and a movement code."""
    def of(kind: str) -> Column:
        return F.col("event_type") == kind

    sums = []
    for kind in ("view", "click", "signup"):
        sums.append(F.sum(F.when(of(kind), cents("value"))).alias(f"{kind}_cents"))
        sums.append(F.count_if(of(kind)).alias(f"{kind}_n"))
    large_sale = of("purchase") & (F.col("value") >= 60)
    large_signup = of("signup") & (F.col("value") >= 80)
    raw = event_days(spark, sf, start, end).groupBy("entity_id", "obs_date").agg(
        *sums,
        F.sum(F.when(large_sale, cents("value"))).alias("removed_cents"),
        F.sum(F.when(large_signup, cents("value"))).alias("split_cents"),
        F.max(F.when(of("purchase"), F.col("value"))).alias("mp"),
        F.max(F.when(of("error"), F.col("value"))).alias("me"),
        F.min(F.when(of("view") | of("click"), F.col("ts"))).alias("sampled_at"),
    )

    def mean(kind: str, scale: float) -> Column:
        return F.try_divide(F.col(f"{kind}_cents").cast("double"), F.col(f"{kind}_n") * F.lit(scale))

    purity = mean("signup", 50.0)
    code = (
        F.when(F.col("me") >= 150, "I")
        .when(F.col("me") >= 140, "Q")
        .when(F.col("mp") >= 150, "HC")
        .when(F.col("mp") >= 100, "S")
        .when(F.col("mp") >= 60, "H")
    )
    return raw.select(
        "entity_id",
        "obs_date",
        mean("view", 10000.0).alias("density"),
        mean("click", 400.0).alias("depth"),
        F.when(purity >= 100, F.lit(100.0)).otherwise(purity).alias("purity_pct"),
        (F.col("removed_cents") / 100).alias("removed_volume"),
        (F.col("split_cents") / 100).alias("split_volume"),
        "sampled_at",
        code.alias("move_code"),
    )


def dense_obs(spark: SparkSession, sf: str) -> DataFrame:
    """Daily readings on every day: gaps hold the entity's last known readings."""
    days = densify(daily_obs(spark, sf), *bounds(spark, sf))
    return blocked_fill(days, ["density", "depth", "purity_pct"], by_entity(), forward=UNLIMITED).drop("day_no")


def lab_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Free-text sample labels with two readings as text; some cannot be read."""
    e = table(spark, sf, "events").filter("event_type = 'error'")
    number, stamp = F.col("event_id"), F.date_format("ts", "yyMMdd")
    short = F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0")
    label = (
        F.when(number % 11 == 0, "no id here")
        .when(number % 7 == 0, F.concat(F.lit("S "), short, F.lit(" "), stamp))
        .when(number % 13 == 0, F.concat(F.lit("S "), padded(F.col("user_id")), F.lit(" undated")))
        .when(number % 23 == 0, F.concat(F.lit("S "), padded(F.col("user_id") + 100_000), F.lit(" "), stamp))
        .otherwise(F.concat(F.lit("S "), padded(F.col("user_id")), F.lit(" "), stamp, F.lit(" rpt")))
    )
    reading = (
        F.when(number % 17 == 0, "0").when(number % 19 == 0, "n/d").otherwise((F.col("value") / 20).cast("string"))
    )
    return e.select(
        "event_id",
        label.alias("sample_label"),
        reading.alias("val_text"),
        (F.col("value") / 10).cast("string").alias("val_total_text"),
    )


def samples(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed samples of known entities, one row per entity and day; averaged before the join."""
    means = mean_duplicates(parse_sample_labels(lab_samples(spark, sf)), ["quality_val", "quality_total"])
    return known_entities(means, entities(spark, sf))


def removal_log(spark: SparkSession, sf: str) -> DataFrame:
    """Several rows per entity and day from two sources."""
    e = event_days(spark, sf).filter("event_type = 'purchase'")
    return e.select(
        F.col("event_id").alias("row_no"),
        F.when(F.col("event_id") % 2 == 0, "1.1").otherwise("2.2").alias("source_tag"),
        "entity_id",
        "obs_date",
        (F.col("value") / 4).alias("initial_depth"),
        (F.col("value") / 10).alias("final_depth"),
        (F.col("value") * 1000).alias("volume"),
        F.when(F.col("event_id") % 3 == 0, F.col("props")).alias("notes"),
    )


def _by_supplier(spark: SparkSession, sf: str, *sums: Column) -> DataFrame:
    """Sums per supplier and day; grouped by the number, which is shorter than the id."""
    days = table(spark, sf, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("obs_date")).agg(*sums)
    return days.select(padded(F.col("l_suppkey")).alias("entity_id"), *(c for c in days.columns if c != "l_suppkey"))


def daily_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """Seven consumption columns per entity and day."""
    amounts = [
        F.sum(F.when(F.col("l_linenumber") == i, F.col("l_quantity"))).alias(f"in_{i}") for i in range(1, 8)
    ]
    return _by_supplier(spark, sf, *amounts)


def shipped_back(spark: SparkSession, sf: str) -> DataFrame:
    """Mass removed per entity and day of the input table: what was returned."""
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
    return _by_supplier(spark, sf, F.sum(returned).alias("est_removed_mass"))


def site_daily(spark: SparkSession, sf: str) -> DataFrame:
    """One row a day, with missing days and missing figures."""
    def total(status: str | None = None) -> Column:
        amount = cents("o_totalprice")
        picked = amount if status is None else F.when(F.col("o_orderstatus") == status, amount)
        return F.sum(picked) / 100

    return table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("obs_date")).agg(
        total().alias("usage_qty"),
        total("F").alias("primary_qty"),
        total("O").alias("secondary_qty"),
        F.min(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))).alias("notes"),
    )


def sheet(spark: SparkSession, sf: str, *kinds: str) -> DataFrame:
    """A sheet of one metric from events of the given types."""
    e = event_days(spark, sf).filter(F.col("event_type").isin(*kinds))
    return e.groupBy("entity_id", "obs_date").agg(F.max("value").alias("metric"))


def indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Indicator readings per entity and day, from event values by type."""
    def top(kind: str, scale: float, shift: float = 0.0) -> Column:
        return F.max(F.when(F.col("event_type") == kind, F.col("value"))) / scale + shift

    return event_days(spark, sf).groupBy("entity_id", "obs_date").agg(
        top("view", 100.0, 7.5).alias("ph"),
        top("click", 80.0).alias("rotifers"),
        top("purchase", 90.0).alias("attached_fd"),
        top("error", 100.0).alias("floating_fd"),
        top("signup", 120.0).alias("golden_flagellates"),
        top("view", 160.0).alias("diatoms"),
        top("click", 200.0).alias("tetra"),
        top("purchase", 240.0).alias("green_algae"),
    )


def _shipped(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of keys per group of suppliers and day: whole numbers to make readings of seven years from."""
    lines = table(spark, sf, "lineitem")
    unit = padded(F.floor(F.col("l_suppkey") / 4)).alias("entity_id")
    return lines.groupBy(unit, F.to_date("l_shipdate").alias("obs_date")).agg(
        F.sum("l_orderkey").alias("k"), F.sum("l_partkey").alias("p")
    )


def long_obs(spark: SparkSession, sf: str) -> DataFrame:
    """Daily readings and movements over seven years, with gaps and long quiet times."""
    k, p = F.col("k"), F.col("p")
    code = (
        F.when((k % 97 == 0) & (p % 2 == 0), "H")
        .when((k % 89 == 0) & (p % 2 == 0), "S")
        .when(k % 199 == 0, "HC")
        .when(k % 211 == 0, "I")
        .when(k % 223 == 0, "Q")
    )
    return _shipped(spark, sf).select(
        "entity_id",
        "obs_date",
        F.when(k % 9 != 0, (k % 80 + 10) / 100).alias("density"),
        F.when(k % 11 != 0, (p % 12 + 6).cast("double")).alias("depth"),
        (60 + p % 40).cast("double").alias("purity_pct"),
        F.when(k % 97 == 0, 1000.0 * (1 + p % 9)).alias("removed_volume"),
        F.when(k % 89 == 0, 500.0 * (1 + p % 7)).alias("split_volume"),
        F.when(k % 13 != 0, F.col("obs_date").cast("timestamp_ntz")).alias("sampled_at"),
        code.alias("move_code"),
    )


def long_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Quality readings for ``long_obs``; on other days than most of its readings."""
    value = 1 + F.col("p") % 40 / 10
    days = _shipped(spark, sf).filter(F.col("k") % 17 == 0)
    return days.select("entity_id", "obs_date", value.alias("quality_val"), (value + 1).alias("quality_total"))


def bounds(spark: SparkSession, sf: str) -> tuple[Column, Column]:
    """First and last day of the events; reads one column."""
    return date_bounds(event_days(spark, sf))


# Each of the following reads the gappy readings, or with ``dense`` those of every day.


def grid(spark: SparkSession, sf: str, dense: bool = False) -> DataFrame:
    """Readings and samples on every day of every entity."""
    readings = dense_obs(spark, sf) if dense else daily_obs(spark, sf)
    return densify(merge_on_key([readings, samples(spark, sf)], spread=["entity_id"]), *bounds(spark, sf))


def state(spark: SparkSession, sf: str, dense: bool = False) -> DataFrame:
    return active_status(grid(spark, sf, dense))


def moves(spark: SparkSession, sf: str, dense: bool = False) -> DataFrame:
    """State, mass and movement estimates."""
    return movement_masses(mass_volume(grid(spark, sf, dense)))


def measured(spark: SparkSession, sf: str) -> DataFrame:
    """State with quality carried forward."""
    return carry_measurements(state(spark, sf))


def reported(spark: SparkSession, sf: str, dense: bool = False) -> DataFrame:
    """Moves with carried quality and run lengths."""
    return days_since_event(carry_measurements(moves(spark, sf, dense)))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
