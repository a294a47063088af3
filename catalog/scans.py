"""Scans, sources, sinks and table maintenance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import views as v
from catalog.registry import query
from catalog.sql import W
from daygrid.functions.days import by_entity, trailing_sum
from daygrid.durable import freeze
from daygrid.operators.grid import densify
from daygrid.plans.daily import daily_run, derive, rebuild
from daygrid.plans.daily import tables as tables_of
from daygrid.sources import scans, sheets, tables

DAY = dt.date


@query(
    "scan_date_range",
    "o_orderdate:d o_orderkey o_totalprice",
    sql="select o_orderdate, o_orderkey, o_totalprice from orders "
    "where o_orderdate between date '1995-01-01' and date '1996-12-31'",
)
def scan_date_range(spark, sf):
    orders = v.table(spark, sf, "orders")
    return scans.scan_date_range(
        orders, DAY(1995, 1, 1), DAY(1996, 12, 31), ["o_orderkey", "o_totalprice"], date="o_orderdate"
    )


@query(
    "scan_event_days",
    "event_id event_type value",
    sql="select event_id, event_type, value from events where cast(ts as date) between date '2024-01-05' and date '2024-01-10'",
)
def scan_event_days(spark, sf):
    """Days on a timestamp column: the last one counts to its end."""
    return scans.scan_date_range(v.table(spark, sf, "events"), DAY(2024, 1, 5), DAY(2024, 1, 10), date="ts")


@query(
    "scan_one_date",
    "o_orderkey o_orderstatus o_totalprice",
    sql="select o_orderkey, o_orderstatus, o_totalprice from orders where o_orderdate = date '1996-07-01'",
)
def scan_one_date(spark, sf):
    orders = v.table(spark, sf, "orders")
    return scans.scan_one_date(
        orders, DAY(1996, 7, 1), ["o_orderkey", "o_orderstatus", "o_totalprice"], date="o_orderdate"
    )


@query(
    "clamp_range",
    "l_returnflag first_date:d last_date:d row_count",
    sql="select l_returnflag, first_date, last_date, count(*) as row_count from lineitem, "
    "(select greatest(date '1888-01-01', cast(min(l_shipdate) as date)) as first_date, "
    "least(date '2000-06-30', cast(max(l_shipdate) as date)) as last_date from lineitem) "
    "where cast(l_shipdate as date) between first_date and last_date group by all",
)
def clamp_range(spark, sf):
    items = v.table(spark, sf, "lineitem")
    start, end = F.lit(DAY(1888, 1, 1)), F.lit(DAY(2000, 6, 30))
    first, last = scans.clamp_range(items, start, end, date="l_shipdate")
    rows = scans.scan_date_range(items, start, end, date="l_shipdate", clamp=True)
    counts = rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumns({"first_date": first, "last_date": last})


@query(
    "available_dates",
    "obs_date:d first_date:d last_date:d",
    uses="site_daily",
    sql="select distinct obs_date, min(obs_date) over () as first_date, max(obs_date) over () as last_date from site_daily",
)
def available_dates(spark, sf):
    dates = v.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("obs_date"))
    first, last = scans.date_bounds(dates)
    return scans.available_dates(dates).withColumns({"first_date": first, "last_date": last})


@query(
    "allowed_columns",
    "o_orderkey o_totalprice dropped",
    sql="select o_orderkey, o_totalprice, 'o_custkey,o_orderstatus,o_orderdate,o_orderpriority' as dropped from orders",
)
def allowed_columns(spark, sf):
    kept, dropped = scans.allowed_columns(v.table(spark, sf, "orders"), ["o_orderkey", "o_totalprice", "o_comment"])
    return kept.withColumn("dropped", F.lit(",".join(dropped)))


@query(
    "coerce_dates",
    "o_orderkey order_date:d",
    sql="select o_orderkey, case when o_orderkey % 5 <> 0 then o_orderdate end as order_date from orders",
)
def coerce_dates(spark, sf):
    stored = scans.dates_to_text(v.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("order_date")))
    spoiled = stored.withColumn(
        "order_date", F.when(F.col("o_orderkey") % 5 == 0, F.lit("not known")).otherwise(F.col("order_date"))
    )
    return scans.dates_from_text(spoiled)


@query(
    "densify_payload",
    "entity_id obs_date:d density:6 depth:6 move_code",
    uses="daily_obs",
    sql="select k.entity_id, k.obs_date, o.density, o.depth, o.move_code from "
    "(select entity_id, cast(d as date) as obs_date from (select distinct entity_id from daily_obs), "
    "(select unnest(generate_series(cast(min(obs_date) as timestamp), cast(max(obs_date) as timestamp), interval 1 day)) as d "
    "from daily_obs)) k left join daily_obs o on o.entity_id = k.entity_id and o.obs_date = k.obs_date",
)
def densify_payload(spark, sf):
    return tables.densify_payload(v.daily_obs(spark, sf))


def _payload(spark, sf):
    """A correction of densities: it misses some keys of the target, adds others, and holds nulls."""
    e = v.event_days(spark, sf).filter("event_type = 'click'")
    shifted = e.withColumn("obs_date", F.date_add("obs_date", 3))
    best = shifted.groupBy("entity_id", "obs_date").agg(F.max("value").alias("best"))
    return best.select("entity_id", "obs_date", F.when(F.col("best") <= 100, F.col("best") / 50).alias("density"))


PAYLOAD_SQL = (
    "(select entity_id, obs_date + 3 as obs_date, case when max(value) <= 100 then max(value) / 50 end as density "
    "from event_days where event_type = 'click' group by 1, 2)"
)


@query(
    "keyed_upsert",
    "entity_id obs_date:d density:6 depth:6 move_code",
    uses="daily_obs event_days",
    sql="select entity_id, obs_date, case when p.entity_id is not null then p.density else t.density end as density, "
    f"depth, move_code from daily_obs t full join {PAYLOAD_SQL} p using (entity_id, obs_date)",
)
def keyed_upsert(spark, sf):
    target = v.daily_obs(spark, sf).select("entity_id", "obs_date", "density", "depth", "move_code")
    return tables.merge_upsert(target, _payload(spark, sf))


@query(
    "reject_duplicate_keys",
    "entity_id obs_date:d copies",
    uses="removal_log",
    sql="select entity_id, obs_date, count(*) as copies from removal_log group by 1, 2 having count(*) > 1",
)
def reject_duplicate_keys(spark, sf):
    return tables.duplicate_keys(v.removal_log(spark, sf))


@query(
    "lookback_window",
    "entity_id obs_date:d removed_5d:4",
    uses="grid",
    sql=f"select entity_id, obs_date, removed_5d from (select *, sum(removed_volume) over ({W} range between "
    "4 preceding and current row) as removed_5d from grid) where obs_date between date '2024-01-21' and date '2024-01-30'",
)
def lookback_window(spark, sf):
    start, end = DAY(2024, 1, 21), DAY(2024, 1, 30)
    read_from = start - dt.timedelta(days=4)
    entities = v.entities(spark, sf)

    def five_days(df):
        days = densify(df, read_from, end, entities)
        return days.select("entity_id", "obs_date", trailing_sum(F.col("removed_volume"), by_entity(), 5).alias("removed_5d"))

    # The events are cut to the widened range before anything is grouped or put on the grid.
    return scans.with_lookback(v.daily_obs(spark, sf, read_from, end), start, end, 4, five_days)


@query(
    "union_by_name",
    "entity_id obs_date:d metric other note",
    uses="event_days",
    sql="select entity_id, obs_date, max(value) as metric, null as other, 'a' as note from event_days "
    "where event_type = 'click' group by 1, 2 union all "
    "select entity_id, obs_date, null, max(value), null from event_days "
    "where event_type in ('click', 'view') group by 1, 2",
)
def union_by_name(spark, sf):
    first = v.sheet(spark, sf, "click").withColumn("remark", F.lit("a"))
    second = v.sheet(spark, sf, "click", "view").withColumnRenamed("metric", "other")
    return sheets.union_by_name([first, second], rename={"remark": "note"})


@query(
    "union_sources_filtered",
    "source_name entity_id obs_date:d metric",
    uses="event_days",
    sql="select event_type as source_name, entity_id, obs_date, max(value) as metric from event_days "
    "where event_type <> 'error' and not contains(event_type, 'ign') group by 1, 2, 3",
)
def union_sources_filtered(spark, sf):
    sources = {k: v.sheet(spark, sf, k) for k in ("click", "error", "purchase", "signup", "view")}
    return sheets.union_sources_filtered(sources, ignore=["error", "SUBSTRING[ign]"])


@query(
    "pick_files_by_date",
    "path file_date:d",
    uses="site_daily",
    sql="select strftime(obs_date, '%Y/%m_%B/') || case when day(obs_date) % 3 = 1 "
    "then 'Copy ' || strftime(obs_date, '%y%m%d') || ' daily data v2.XLSX' "
    "else strftime(obs_date, '%y%m%d') || ' Daily Data.xlsx' end as path, obs_date as file_date from site_daily "
    "where day(obs_date) % 3 <> 0 and obs_date between date '1995-03-15' and date '1997-06-30'",
)
def pick_files_by_date(spark, sf):
    day = F.col("obs_date")
    stamp = F.date_format(day, "yyMMdd")
    name = (
        F.when(F.dayofmonth(day) % 3 == 0, F.concat(stamp, F.lit(" Daily Notes.xlsx")))
        .when(F.dayofmonth(day) % 3 == 1, F.concat(F.lit("Copy "), stamp, F.lit(" daily data v2.XLSX")))
        .otherwise(F.concat(stamp, F.lit(" Daily Data.xlsx")))
    )
    listing = v.site_daily(spark, sf).select(F.concat(F.date_format(day, "yyyy/MM_MMMM/"), name).alias("path"))
    return scans.pick_files_by_date(listing, DAY(1995, 3, 15), DAY(1997, 6, 30), "Daily Data")


@query(
    "infer_serial_dates",
    "row_no seen_on:d amount owner",
    sql="select event_id as row_no, cast(ts as date) as seen_on, cast(floor(value) as bigint) as amount, "
    "user_id as owner from events",
)
def infer_serial_dates(spark, sf):
    sheet = v.table(spark, sf, "events").select(
        F.col("event_id").alias("row_no"),
        F.date_diff(F.to_date("ts"), F.lit(DAY(1899, 12, 30))).alias("seen_on"),
        F.floor("value").alias("amount"),
        F.col("user_id").alias("owner"),
    )
    return sheets.infer_serial_dates(sheet)


CALCULATED_SPEC = (
    "entity_id obs_date:d active mass:2 mass_corrected:2 removable_inches:4 removable_gallons:2 removable_mass:2 "
    "removable_mass_corrected:2 est_removed_mass:4 est_split_mass:4 mass_change_grams_7d:2 prev_liters_7d:2 "
    "prev_norm_liters_7d:2 growth_5d:8 norm_growth_5d:8 growth_14d:8 norm_growth_14d:8 days_since_event:i status_code:i "
    "move_unmatched"
)


@query("rebuild_range", CALCULATED_SPEC, uses="coded", sql="select * from coded", dense=True)
def rebuild_range(spark, sf):
    built = rebuild(v.dense_obs(spark, sf), v.samples(spark, sf), only="calculated", bounds=v.bounds(spark, sf))
    return built["calculated"]


@query(
    "daily_pipeline",
    CALCULATED_SPEC,
    uses="coded daily_obs",
    sql="select * from coded where obs_date >= (select max(obs_date) from daily_obs) - 15",
    long=True,
)
def daily_pipeline(spark, sf):
    """A run ten days after an earlier one, from the tables that one left, after seven years of readings."""
    readings, samples = freeze(v.long_obs(spark, sf)), freeze(v.long_samples(spark, sf))
    day = readings.agg(F.max("obs_date")).first()[0]
    earlier = F.col("obs_date") <= F.lit(day - dt.timedelta(days=10))
    left = tables_of(freeze(derive(readings.filter(earlier), samples.filter(earlier))))
    entities = readings.select("entity_id").distinct()
    return daily_run(readings, samples, day, day, entities, (left["quality"], left["calculated"]))["calculated"]
