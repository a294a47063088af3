"""The scheduled job: upsert source payloads, then the tables derived from them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.durable import Scratch, exists, remove
from daygrid.operators.growth import GROWTH_COLUMNS, site_ratios, sum_by_day
from daygrid.plans.daily import (
    CALCULATED,
    LOOKBACK,
    QUALITY,
    QUALITY_LOOKBACK,
    SEED_LOOKBACK,
    SITE_LOOKBACK,
    derive,
    rebuild,
)
from daygrid.plans.load import all_expenses, expense_payload
from daygrid.sources.scans import scan_date_range, scan_one_date, widen
from daygrid.sources.tables import SCHEMAS, claimed, create_table, read_table, stored_dates, upsert_table

ENTITY_KEYS = ("entity_id", "obs_date")
SITE_KEYS = ("obs_date",)


def keys_of(name: str) -> tuple[str, ...]:
    return ENTITY_KEYS if "entity_id" in SCHEMAS[name].fieldNames() else SITE_KEYS


def stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, f"{root}/{name}", SCHEMAS[name])


def save(spark: SparkSession, root: str, name: str, payload: DataFrame, densified: bool = True) -> bool:
    """Upsert into the table ``name``. Of measurements the keys that change are noted for the next run, before they do."""
    path, schema = f"{root}/{name}", SCHEMAS[name]
    create_table(spark, path, schema)
    seen = (lambda changed: _note(spark, root, changed)) if name == "measurements" else None
    return upsert_table(spark, path, payload, schema, keys_of(name), densified=densified, seen=seen)


READINGS = ("density", "depth", "purity_pct", "fo", "removed_volume", "split_volume", "sampled_at", "move_code")

#: Lanes of late entities begin up to so many days before the run, the last one anywhere before.
LANE_DAYS = (32, 128, 512, 2048)
#: Up to so many entities are named in a lane's filter, which files of other entities are skipped by.
NAMED = 1000


@dataclass
class Lane:
    """Entities that are derived from one day on, and whether stored rows are there to start from."""

    first: dt.date
    entities: DataFrame
    seeded: bool
    #: The lane of all entities with nothing late.
    usual: bool = False

    def only(self, df: DataFrame) -> DataFrame:
        """Rows of the lane's entities, by a filter that reaches the files if they are few; the usual lane takes all."""
        if self.usual:
            return df
        named = [r[0] for r in self.entities.select("entity_id").limit(NAMED + 1).collect()]
        if len(named) <= NAMED:
            return df.filter(F.col("entity_id").isin(named))
        return df.join(self.entities.select("entity_id"), "entity_id", "left_semi")


def _first_days(spark: SparkSession, root: str) -> DataFrame:
    """Each entity's first day with a row among the measurements."""
    return stored(spark, root, "first_days").groupBy("entity_id").agg(F.min("obs_date").alias("first_day"))


def _note(spark: SparkSession, root: str, changed: DataFrame) -> None:
    """Keep each entity's first changed day until a run has derived it, and its first day of all."""
    first = changed.groupBy("entity_id").agg(F.min("obs_date").alias("obs_date"))
    save(spark, root, "late_days", first.withColumn("is_late", F.lit(True)), densified=False)
    create_table(spark, f"{root}/first_days", SCHEMAS["first_days"])
    known = first.join(_first_days(spark, root), "entity_id", "left")
    earlier = known.filter(F.col("first_day").isNull() | (F.col("obs_date") < F.col("first_day")))
    save(spark, root, "first_days", earlier.select(*ENTITY_KEYS, F.lit(True).alias("is_first")), densified=False)


def _derived_all(spark: SparkSession, root: str) -> None:
    """Nothing is late any more."""
    for folder in ("late_days", "late_days.batches"):
        remove(spark, f"{root}/{folder}")


def _prepare(spark: SparkSession, root: str) -> None:
    """The tables a run begins with."""
    if exists(spark, f"{root}/measurements") and not exists(spark, f"{root}/first_days"):
        # A store from before that table.
        _note(spark, root, stored(spark, root, "measurements"))
        _derived_all(spark, root)
    for name in ("first_days", "late_days", "measurements", "quality", "calculated"):
        create_table(spark, f"{root}/{name}", SCHEMAS[name])


def _late_samples(spark: SparkSession, root: str, arrived: DataFrame, start: dt.date) -> DataFrame:
    """Of newly arrived samples before ``start``, those that the stored quality does not show."""
    before = arrived.filter(F.col("obs_date") < F.lit(start))
    values = ("quality_val", "quality_total")
    shown = stored(spark, root, "quality").select(*ENTITY_KEYS, "is_measured", *(F.col(c).alias(f"_{c}") for c in values))
    joined = before.join(shown, list(ENTITY_KEYS), "left")
    same = F.struct(*values).eqNullSafe(F.struct(*(f"_{c}" for c in values)))
    # A sample of an inactive day is measured and shows no value.
    blank = F.col("_quality_val").isNull()
    return joined.filter(~F.coalesce(F.col("is_measured"), F.lit(False)) | ~(same | blank)).select(*ENTITY_KEYS)


def lanes(
    spark: SparkSession, root: str, late: DataFrame, entities: DataFrame, start: dt.date, scratch: Scratch
) -> list[Lane]:
    """Which entities a run derives from which day on, every entity in one lane.

    Those with nothing late and a stored row to start from go from ``start``. One with a late row goes from
    ``QUALITY_LOOKBACK`` days before it, so far back derived days look ahead, but no further than the derived tables go; lanes begin at
    the earliest day of their entities, which are grouped by age so that one old correction takes few entities with it.
    An entity without a stored row on its lane's seed day, but with readings before it, starts from its own first
    reading.
    """
    quality = stored(spark, root, "quality")
    held = stored_dates(spark, f"{root}/calculated")
    cover = min(held[0], start) if held else start
    known = entities.select("entity_id").distinct().join(_first_days(spark, root), "entity_id", "left")
    back = F.date_sub(F.min("obs_date"), QUALITY_LOOKBACK)
    dirty = late.groupBy("entity_id").agg(F.greatest(back, F.lit(cover)).alias("first"))
    placed = known.join(dirty, "entity_id", "left").withColumn("first", F.coalesce("first", F.lit(start)))
    days = F.date_diff(F.lit(start), F.col("first"))
    lane = reduce(lambda rest, n: rest + (days > n).cast("int"), LANE_DAYS, (days > 0).cast("int"))
    placed = scratch.freeze(placed.withColumn("lane", lane))

    out, unseeded = [], []
    firsts = placed.groupBy("lane").agg(F.min("first").alias("first")).collect()  # a row for each lane
    for row in firsts:
        own = placed.filter(F.col("lane") == row["lane"])
        seed_day = row["first"] - dt.timedelta(days=SEED_LOOKBACK)
        there = scan_one_date(quality, seed_day, ["entity_id"])
        new = F.coalesce(F.col("first_day") >= F.lit(seed_day), F.lit(True))
        seeded = own.filter(new).unionByName(own.filter(~new).join(there, "entity_id", "left_semi"))
        seeded = scratch.freeze(seeded)
        out.append(Lane(row["first"], seeded, True, usual=row["lane"] == 0))
        unseeded.append(own.join(seeded, "entity_id", "left_anti"))
    if unseeded:
        # Derived rows of these go back as far as the tables do.
        rest = scratch.freeze(reduce(DataFrame.unionByName, unseeded))
        first = F.min(F.least("first", F.greatest("first_day", F.lit(cover))))
        day = rest.agg(first.alias("d")).first()["d"]
        if day is not None:
            out.append(Lane(day, rest, False))
    return [x for x in out if not x.entities.isEmpty()]


def _derived(
    spark: SparkSession, root: str, samples: DataFrame, chosen: list[Lane], end: dt.date, strict: bool
) -> DataFrame:
    """Rows of all lanes, each with the days before it that site sums look back on; ``lane_first`` is where it begins."""
    readings = stored(spark, root, "measurements").select(*ENTITY_KEYS, *READINGS)
    seed = stored(spark, root, "quality"), stored(spark, root, "calculated")
    parts = []
    for lane in chosen:
        own = [lane.only(df) for df in (readings, samples)]
        from_stored = tuple(lane.only(df) for df in seed) if lane.seeded else None
        ids = lane.entities.select("entity_id")
        rows = derive(*own, lane.first, end, ids, from_stored, SITE_LOOKBACK, strict=strict)
        parts.append(rows.withColumn("lane_first", F.lit(lane.first)))
    return reduce(DataFrame.unionByName, parts)


def _site_growth(spark: SparkSession, root: str, rows: DataFrame, start: dt.date, first: dt.date, end: dt.date) -> DataFrame:
    """Site growth from ``first`` on: newest days from ``rows``, days before those from the stored table."""
    sums = GROWTH_COLUMNS[:3]
    cut = start - dt.timedelta(days=SITE_LOOKBACK)
    days = rows.filter(F.col("obs_date") >= F.lit(cut)).select("obs_date", *sums)
    if first < start:
        older = scan_date_range(
            stored(spark, root, "calculated"), first - dt.timedelta(days=SITE_LOOKBACK), cut - dt.timedelta(days=1)
        )
        days = days.unionByName(older.select("obs_date", *sums))
    return scan_date_range(site_ratios(sum_by_day(days, sums)), first, end)


def _save_derived(
    spark: SparkSession, root: str, rows: DataFrame, chosen: list[Lane], start: dt.date, site_start: dt.date, end: dt.date
) -> dict[str, bool]:
    """Write what the lanes gave: each from its first day on, and the site's growth for every day they touch."""
    written = rows.filter(F.col("obs_date") >= F.col("lane_first"))
    tables = (("calculated", CALCULATED), ("quality", QUALITY))
    done = _written(spark, root, {name: written.select(*ENTITY_KEYS, *columns) for name, columns in tables})
    first = min([site_start, *(x.first for x in chosen if x.first < start)])
    return done | _written(spark, root, {"site_growth": _site_growth(spark, root, rows, start, first, end)})


def run(
    spark: SparkSession,
    root: str,
    payloads: Mapping[str, list[DataFrame]],
    samples: DataFrame,
    run_start: dt.date,
    run_end: dt.date,
    entities: DataFrame,
    lookback: int = LOOKBACK,
    strict: bool = False,
    new_samples: DataFrame | None = None,
) -> dict[str, bool]:
    """One run over the tables under ``root``: sources first, then what rests on them.

    ``payloads`` maps a table to its payloads in load order (measurements come
    from sheets, movement codes and the removal log). Returns per write
    whether it was done. The static order stands for the dependencies: state
    and movements read the codes, quality reads the state, status reads both.
    Movements that fit no rule are marked in the table (``rejected_moves``),
    or stop the run with ``strict``.

    Entities are derived from the stored state of the days before the run,
    except those whose past changed: readings before the run that differ from
    the stored ones, samples among ``new_samples`` that come late, entities
    with readings that were never derived. Only those start earlier, each from
    the first day that changed (``lanes``); of the others' older days only the
    site's sums are read again. What changed is kept in the tables first_days
    and late_days before the measurements are replaced, so a run that dies is
    made good by the next one. One run at a time owns ``root``.
    """
    done = {}
    start = widen(run_start, run_end, max(lookback, QUALITY_LOOKBACK))
    with claimed(spark, f"{root}/run"), Scratch(spark) as scratch:
        _prepare(spark, root)
        for name, frames in payloads.items():
            for i, payload in enumerate(frames):
                done[f"{name}/{i}"] = save(spark, root, name, payload)
        late = stored(spark, root, "late_days").filter(F.col("obs_date") < F.lit(start)).select(*ENTITY_KEYS)
        if new_samples is not None:
            late = late.unionByName(_late_samples(spark, root, new_samples, start))
        late = scratch.freeze(late)
        chosen = lanes(spark, root, late, entities, start, scratch)
        if chosen:
            rows = scratch.freeze(_derived(spark, root, samples, chosen, run_end, strict))
            done |= _save_derived(spark, root, rows, chosen, start, widen(run_start, run_end, lookback), run_end)
        measurements = stored(spark, root, "measurements")
        expenses = expense_payload(measurements, start, run_end)
        # The first late day of an entity stands for all days from it on.
        since = late.groupBy("entity_id").agg(F.min("obs_date").alias("since"))
        oldest = since.agg(F.min("since")).first()[0]
        if oldest is not None and oldest < start:
            old = scan_date_range(measurements, oldest, start - dt.timedelta(days=1)).join(since, "entity_id")
            expenses = expenses.unionByName(all_expenses(old.filter(F.col("obs_date") >= F.col("since")).drop("since")))
        days = F.explode(F.sequence(F.lit(run_start), F.lit(run_end)))
        loaded = spark.range(1).select(days.alias("obs_date"), F.lit(True).alias("is_loaded"))
        done |= _written(spark, root, {"expenses": expenses, "available_dates": loaded})
        _derived_all(spark, root)
    return done


def _written(spark: SparkSession, root: str, built: Mapping[str, DataFrame]) -> dict[str, bool]:
    return {name: save(spark, root, name, table, densified=False) for name, table in built.items()}


#: Days that a rebuild derives at a time.
SEGMENT_DAYS = 730


def rebuild_range(
    spark: SparkSession,
    root: str,
    samples: DataFrame,
    entities: DataFrame,
    start: dt.date,
    end: dt.date,
    segment_days: int = SEGMENT_DAYS,
    strict: bool = False,
) -> None:
    """Derive the tables calculated, quality and site_growth again for a range of days, segment after segment.

    A segment starts from the stored rows of the days before it, which the segment before has just written: the quality
    each entity carries and its run length. So no task holds more of an entity than a segment and what its steps look
    back and ahead on, and rows are those of one pass over all days. Days before ``start`` are taken as they are
    stored. A rebuild that dies is started again from the segment it was in.
    """
    with claimed(spark, f"{root}/run"):
        _prepare(spark, root)
        late = stored(spark, root, "late_days").select(*ENTITY_KEYS).limit(0)
        held = stored_dates(spark, f"{root}/measurements")
        begin = start
        while begin <= end:
            finish = min(begin + dt.timedelta(days=segment_days - 1), end)
            with Scratch(spark) as scratch:
                if held and begin <= held[0]:
                    # Nothing lies before: the grid begins here, as in one pass.
                    chosen = [Lane(begin, entities.select("entity_id").distinct(), False, usual=True)]
                else:
                    chosen = lanes(spark, root, late, entities, begin, scratch)
                if chosen:
                    # The last days look ahead, as far as a run looks back for them.
                    ahead = min(finish + dt.timedelta(days=QUALITY_LOOKBACK), end)
                    rows = _derived(spark, root, samples, chosen, ahead, strict).filter(F.col("obs_date") <= F.lit(finish))
                    _save_derived(spark, root, scratch.freeze(rows), chosen, begin, begin, finish)
            begin = finish + dt.timedelta(days=1)


def rebuild_tables(
    spark: SparkSession,
    root: str,
    samples: DataFrame,
    entities: DataFrame,
    only: str | None = None,
    strict: bool = False,
    segment_days: int = SEGMENT_DAYS,
) -> dict[str, bool]:
    """Derive all tables, or one, from the stored measurements over their full range.

    All tables are derived in segments of days (``rebuild_range``); one alone in a single pass, since segments start
    from what others hold.
    """
    measurements = stored(spark, root, "measurements")
    readings = measurements.select(*ENTITY_KEYS, *READINGS)
    held = stored_dates(spark, f"{root}/measurements")
    done, built = {}, {}
    if only not in ("expenses", "available_dates"):
        sampled = samples.agg(F.min("obs_date"), F.max("obs_date")).first()
        days = [*held[:1], *held[-1:], *(d for d in sampled if d is not None)]
        if only is not None:
            bounds = (F.lit(min(days)), F.lit(max(days))) if days else None
            built = rebuild(readings, samples, entities, only, bounds, strict=strict)
        elif days:
            rebuild_range(spark, root, samples, entities, min(days), max(days), segment_days, strict)
            done = dict.fromkeys(("calculated", "quality", "site_growth"), True)
    if only in (None, "expenses"):
        built["expenses"] = all_expenses(measurements)
    if only in (None, "available_dates"):
        built["available_dates"] = spark.createDataFrame([(d, True) for d in held], "obs_date date, is_loaded boolean")
    done |= _written(spark, root, built)
    if only is None:
        _derived_all(spark, root)
    return done


def rejected_moves(spark: SparkSession, root: str, start: dt.date, end: dt.date) -> DataFrame:
    """Logged movements of a range that fit no rule."""
    marked = scan_date_range(stored(spark, root, "calculated"), start, end).filter("move_unmatched").select(*ENTITY_KEYS)
    logged = scan_date_range(stored(spark, root, "measurements"), start, end)
    return logged.select(*ENTITY_KEYS, "move_code", "removed_volume", "split_volume").join(marked, list(ENTITY_KEYS), "left_semi")


def stored_range(
    spark: SparkSession, root: str, name: str, start: dt.date, end: dt.date, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of a closed date range, cut to the dates the table has; these come from the names of its partitions."""
    held = stored_dates(spark, f"{root}/{name}")
    if held:
        start, end = max(start, held[0]), min(end, held[-1])
    return scan_date_range(stored(spark, root, name), start, end, columns)


def save_intervals(root: str, name: str, intervals: DataFrame) -> None:
    """Intervals partitioned by fiscal year; the years they hold replace stored ones, others stay."""
    balanced = intervals.hint("rebalance", "fiscal_year")
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fiscal_year").parquet(
        f"{root}/intervals_{name}"
    )


def save_reports(root: str, reports: Mapping[str, DataFrame]) -> None:
    """Report tables partitioned by date; the dates they hold replace stored ones, others stay."""
    for name, report in reports.items():
        date = "report_date" if "report_date" in report.columns else "obs_date"
        balanced = report.hint("rebalance", date)
        balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(
            f"{root}/report_{name}"
        )
