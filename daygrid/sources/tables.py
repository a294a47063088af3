"""Keyed writes to date-partitioned tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygrid.durable import Scratch, age, create_file, exists, names, remove, text_of
from daygrid.operators.grid import calendar, date_bounds, densify
from daygrid.sources.scans import require_known_columns

KEYS = ("entity_id", "obs_date")


def _table(keys: str, doubles: str = "", **others: T.DataType) -> T.StructType:
    fields = [T.StructField("obs_date", T.DateType(), False)]
    if keys == "entity":
        fields.append(T.StructField("entity_id", T.StringType(), False))
    fields += [T.StructField(c, T.DoubleType()) for c in doubles.split()]
    fields += [T.StructField(c, t) for c, t in others.items()]
    return T.StructType(fields)


# Tables at rest, one parquet dataset each, partitioned by obs_date: the columns that operators read or write.
# Tables of a site's own figures have the schema their caller gives.
SCHEMAS = {
    "measurements": _table(
        "entity",
        "density depth purity_pct fo ph rotifers attached_fd floating_fd golden_flagellates diatoms tetra green_algae "
        "in_1 in_2 in_3 in_4 in_5 in_6 in_7 removed_volume split_volume initial_depth final_depth",
        sampled_at=T.TimestampNTZType(),
        move_code=T.StringType(),
        entity_group=T.StringType(),
        media_only=T.BooleanType(),
        notes=T.StringType(),
    ),
    "calculated": _table(
        "entity",
        "mass mass_corrected removable_inches removable_gallons removable_mass removable_mass_corrected "
        "est_removed_mass est_split_mass mass_change_grams_7d prev_liters_7d prev_norm_liters_7d "
        "growth_5d norm_growth_5d growth_14d norm_growth_14d",
        active=T.BooleanType(),
        move_unmatched=T.BooleanType(),
        days_since_event=T.IntegerType(),
        status_code=T.IntegerType(),
    ),
    "site_growth": _table(
        "site",
        "mass_change_grams_7d prev_liters_7d prev_norm_liters_7d "
        "agg_growth_5d agg_norm_growth_5d agg_growth_14d agg_norm_growth_14d",
    ),
    "quality": _table(
        "entity", "quality_val quality_total", measured_on=T.DateType(), is_measured=T.BooleanType()
    ),
    "expenses": _table("entity", "in_1_cost in_2_cost in_3_cost in_4_cost in_5_cost in_6_cost in_7_cost"),
    "site_usage": _table("site", "usage_qty site_cost"),
    "weather": _table("site", "temp_avg temp_min temp_max precipitation wind_speed pressure"),
    # A partitioned table needs a column beside the date.
    "available_dates": _table("site", is_loaded=T.BooleanType()),
    # The scheduled run's own: first days of entities (the earliest counts), and days before a run that changed.
    "first_days": _table("entity", is_first=T.BooleanType()),
    "late_days": _table("entity", is_late=T.BooleanType()),
}


def duplicate_keys(payload: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return payload.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def densify_payload(
    payload: DataFrame,
    keys: Sequence[str] = KEYS,
    date: str = "obs_date",
    bounds: tuple[dt.date | Column, dt.date | Column] | None = None,
) -> DataFrame:
    """All days between the payload's first and last for each entity in it.

    ``bounds`` names those days where the caller knows them; else the payload is read for them.
    """
    first, last = bounds or date_bounds(payload, date)
    entity = [k for k in keys if k != date]
    if entity:
        return densify(payload, first, last, keys=entity, date=date).drop("day_no")
    return calendar(payload.sparkSession, first, last, date).join(payload, date, "left")


def merge_upsert(
    target: DataFrame, payload: DataFrame, keys: Sequence[str] = KEYS, mark: str | None = None
) -> DataFrame:
    """Target rows with the payload's columns replaced where keys match, plus the payload's new keys.

    Nulls of the payload replace values too. Other columns keep their value,
    and are null on new rows. ``mark`` names a column more: whether the row is
    new or one of its values differs from what the target had.
    """
    require_known_columns(payload, target.columns, keys)
    changed = [c for c in payload.columns if c not in keys]
    new = payload.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in changed), F.lit(True).alias("_in_payload"))
    joined = target.withColumn("_in_target", F.lit(True)).join(new, list(keys), "full")
    replaced = F.col("_in_payload").isNotNull()
    differs = F.col("_in_target").isNull()
    for c in changed:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    marked = [] if mark is None else [(replaced & differs).alias(mark)]
    return joined.select(
        *(
            F.when(replaced, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in target.columns
        ),
        *marked,
    )


class TableBusyError(RuntimeError):
    """Another writer owns the table."""


#: A claim this old (seconds) is taken to be a dead writer's.
STALE = 6 * 3600
CHANGED = "_changed"


@contextmanager
def claimed(spark: SparkSession, path: str, stale: float = STALE) -> Iterator[None]:
    """Own the table at ``path``: a file beside it that only one writer can create. Readers need no claim.

    The claim of a writer that died is taken over after ``stale`` seconds.
    """
    claim, own = f"{path.rstrip('/')}.claim", uuid.uuid4().hex
    if not create_file(spark, claim, own):
        try:
            old = age(spark, claim) > stale
        except Py4JJavaError:  # given up meanwhile
            old = True
        if not (old and (remove(spark, claim) or not exists(spark, claim)) and create_file(spark, claim, own)):
            raise TableBusyError(f"{path} is being written; its claim is {claim}")
    # Where creation is not one step, the last one wins and the others see that here.
    if text_of(spark, claim) != own:
        raise TableBusyError(f"{path} was claimed by another writer")
    try:
        yield
    finally:
        if text_of(spark, claim) == own:
            remove(spark, claim)


def upsert_table(
    spark: SparkSession,
    path: str,
    payload: DataFrame,
    schema: T.StructType,
    keys: Sequence[str] = KEYS,
    date: str = "obs_date",
    densified: bool = True,
    seen: Callable[[DataFrame], None] | None = None,
    stale: float = STALE,
) -> bool:
    """Upsert a payload into the parquet table at ``path``; False leaves the table as it was.

    Nothing is written for an empty payload or one with a repeated key. Only the date partitions between the payload's
    first and last date are read, and of those only the ones in which a value changes are replaced (dynamic overwrite),
    so the cost follows the payload's days, not the table.

    One writer at a time (``claimed``; another one gets ``TableBusyError``). The new partitions are first written whole
    beside the table, then ``seen`` gets the keys that change, then the table's partitions are replaced. From the moment
    the batch is whole readers take its partitions in place of the table's, so a batch shows whole or not at all. A
    writer that dies later leaves it for the next writer to complete (``complete_write``).
    """
    target_columns = schema.fieldNames()
    require_known_columns(payload, target_columns, keys)
    with claimed(spark, path, stale), Scratch(spark) as scratch:
        complete_write(spark, path, schema, date, seen, keys)
        # Checked and written rows must be the same, and be computed once.
        payload = scratch.freeze(payload)
        span = payload.agg(F.min(date).alias("first"), F.max(date).alias("last")).first()
        if span["first"] is None:
            return False
        if not duplicate_keys(payload, keys).isEmpty():
            return False
        stored = read_table(spark, path, schema, date).filter(F.col(date).between(F.lit(span["first"]), F.lit(span["last"])))
        rows = densify_payload(payload, keys, date, (span["first"], span["last"])) if densified else payload
        merged = merge_upsert(stored, rows, keys, CHANGED).select(*target_columns, CHANGED)
        merged.hint("rebalance", date).write.partitionBy(date).parquet(f"{_batches(path)}/{uuid.uuid4().hex}")
        complete_write(spark, path, schema, date, seen, keys)
    return True


def _batches(path: str) -> str:
    return f"{path.rstrip('/')}.batches"


def _states(spark: SparkSession, path: str) -> dict[str, str]:
    """Batches beside a table: "part" (being written, or never finished), "whole", or "replaced" (in the table)."""
    out = {}
    for name in names(spark, _batches(path)):
        held = names(spark, f"{_batches(path)}/{name}")
        out[name] = "replaced" if "_REPLACED" in held else "whole" if "_SUCCESS" in held else "part"
    return out


def partition_dates(spark: SparkSession, path: str, date: str = "obs_date") -> list[dt.date]:
    """Dates of a table's partitions, from the names of its folders: no file is read."""
    found = (name.partition("=") for name in names(spark, path))
    return [dt.date.fromisoformat(value) for column, _, value in found if column == date and value[0] != "_"]


def stored_dates(spark: SparkSession, path: str, date: str = "obs_date") -> list[dt.date]:
    """Dates a reader of the table sees, a batch beside it included; no file is read."""
    whole = [name for name, state in _states(spark, path).items() if state == "whole"]
    dates = set(partition_dates(spark, path, date))
    return sorted(dates.union(*(partition_dates(spark, f"{_batches(path)}/{name}", date) for name in whole)))


def complete_write(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    date: str = "obs_date",
    seen: Callable[[DataFrame], None] | None = None,
    keys: Sequence[str] = KEYS,
) -> bool:
    """Replace the partitions of a batch that lies whole beside the table; for the writer that has claimed it.

    Doing it twice gives the same table. Batches that were replaced before, and what a dead writer left in part, are
    removed; the newest replaced one stays until the next batch, for readers that began with it.
    """
    states = _states(spark, path)
    whole = [name for name, state in states.items() if state == "whole"]
    for name in whole:
        folder = f"{_batches(path)}/{name}"
        batch = spark.read.schema(T.StructType([*schema.fields, T.StructField(CHANGED, T.BooleanType())])).parquet(folder)
        changed = batch.filter(CHANGED)
        if seen is not None:
            seen(changed.select(*keys))
        # As many as the batch has days.
        days = [r[0] for r in changed.select(date).distinct().collect()]
        if days:
            # Few files per date, yet a large day is split over several tasks; sorted, so that entities can be skipped.
            rows = batch.filter(F.col(date).isin(days)).select(*schema.fieldNames()).hint("rebalance", date)
            rows = rows.sortWithinPartitions(date, *(k for k in keys if k != date))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)
        create_file(spark, f"{folder}/_REPLACED")
    for name, state in states.items():
        if state == "part" or (state == "replaced" and whole):
            remove(spark, f"{_batches(path)}/{name}")
    return bool(whole)


def create_table(spark: SparkSession, path: str, schema: T.StructType, date: str = "obs_date") -> None:
    """An empty table, unless there is one already."""
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").partitionBy(date).parquet(path)


#: Times a reader looks again if a batch was replaced while it listed the table's files.
LOOKS = 20


def read_table(spark: SparkSession, path: str, schema: T.StructType, date: str = "obs_date") -> DataFrame:
    """The table at ``path`` with its declared columns and types; never writes.

    The partitions of a batch that lies whole beside the table stand in for the table's own, also while a writer replaces
    those. The frame stays readable until a later batch replaces partitions; read the table again then.
    """
    for _ in range(LOOKS):
        states = _states(spark, path)
        # The files are listed here, before the states are looked at again.
        table = spark.read.schema(schema).parquet(path)
        seen = _states(spark, path)
        if {n: s for n, s in states.items() if s != "part"} == {n: s for n, s in seen.items() if s != "part"}:
            break
    else:
        raise TableBusyError(f"{path} changed {LOOKS} times while its files were listed")
    table = table.select(*schema.fieldNames())
    for name in (n for n, state in states.items() if state == "whole"):
        folder = f"{_batches(path)}/{name}"
        days = partition_dates(spark, folder, date)
        batch = spark.read.schema(schema).parquet(folder).select(*schema.fieldNames())
        table = table.filter(~F.col(date).isin(days)).unionByName(batch)
    return table
