"""Projection, cleaning and scalar transforms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import views as v
from catalog.registry import query
from catalog.sql import L
from daygrid.functions import cleaning, labels, measures
from daygrid.operators.grid import date_bounds, scaffold_missing_days
from daygrid.plans.marts import prior_day_summary
from daygrid.sources import headers, scans, sheets


@query(
    "drop_null_keys",
    "label value",
    sql="select cast(user_id as varchar) as label, value from events where not (event_type = 'error' and value < 20)",
)
def drop_null_keys(spark, sf):
    e = v.table(spark, sf, "events")
    unknown = (F.col("event_type") == "error") & (F.col("value") < 20)
    return cleaning.drop_null_keys(e.withColumn("label", F.when(~unknown, F.col("user_id"))), ["label"])


@query(
    "tag_extract",
    "event_id label media_only",
    uses="event_days",
    sql="select event_id, entity_id as label, event_id % 4 < 2 as media_only from event_days",
)
def tag_extract(spark, sf):
    e = v.event_days(spark, sf)
    kind = F.col("event_id") % 4
    tail = F.when(kind == 0, " (Media Only)").when(kind == 1, "  (MEDIA ONLY) ").otherwise(" ")
    return cleaning.tag_extract(e.withColumn("label", F.concat("entity_id", tail)), "label")


@query(
    "suffix_group",
    "entity_id obs_date:d entity_group is_large",
    uses="event_days",
    sql="select distinct entity_id, obs_date, right(entity_id, 1) as entity_group, "
    "right(entity_id, 2) in ('06', '08') as is_large from event_days",
)
def suffix_group(spark, sf):
    days = v.event_days(spark, sf).select("entity_id", "obs_date").distinct()
    return days.withColumns(
        {"entity_group": cleaning.suffix_group(F.col("entity_id")), "is_large": cleaning.is_large(F.col("entity_id"))}
    )


@query(
    "zero_to_null",
    "l_orderkey l_linenumber l_partkey l_discount",
    sql="select l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0) as l_discount from lineitem",
)
def zero_to_null(spark, sf):
    return v.table(spark, sf, "lineitem").withColumn("l_discount", cleaning.zero_to_null(F.col("l_discount")))


@query(
    "pair_or_null",
    "entity_id obs_date:d density:6 depth:6",
    uses="daily_obs",
    sql="select entity_id, obs_date, case when depth <> 0 then nullif(density, 0) end as density, "
    "case when density <> 0 then nullif(depth, 0) end as depth from daily_obs",
)
def pair_or_null(spark, sf):
    density, depth = cleaning.pair_or_null(F.col("density"), F.col("depth"))
    return v.daily_obs(spark, sf).select("entity_id", "obs_date", density.alias("density"), depth.alias("depth"))


def _three_sheets(spark, sf):
    zeros = v.sheet(spark, sf, "click", "view", "purchase", "error").withColumn("metric", F.lit(0.0))
    return {"A": v.sheet(spark, sf, "click", "purchase"), "B": v.sheet(spark, sf, "click", "view"), "C": zeros}


SHEET_SQL = "(select entity_id, obs_date, max(value) as metric from event_days where event_type in ({}) group by 1, 2)"


@query(
    "reconcile_columns",
    "entity_id obs_date:d metric metric_source",
    uses="event_days",
    sql=f"""
    with a as {SHEET_SQL.format("'click', 'purchase'")}, b as {SHEET_SQL.format("'click', 'view'")},
         c as (select entity_id, obs_date, 0.0 as metric from {SHEET_SQL.format("'click', 'view', 'purchase', 'error'")}),
         na as (select obs_date, count(*) as n from a where metric <> 0 group by 1),
         nb as (select obs_date, count(*) as n from b where metric <> 0 group by 1),
         won as (select entity_id, obs_date, a.metric as av, b.metric as bv, c.metric as cv,
                        case when coalesce(na.n, 0) + coalesce(nb.n, 0) = 0 then 'C'
                             when coalesce(na.n, 0) >= coalesce(nb.n, 0) then 'A' else 'B' end as metric_source
                 from c left join a using (entity_id, obs_date) left join b using (entity_id, obs_date)
                 left join na using (obs_date) left join nb using (obs_date))
    select entity_id, obs_date, metric_source,
           case metric_source when 'A' then av when 'B' then bv else cv end as metric from won""",
)
def reconcile_columns(spark, sf):
    return sheets.reconcile_columns(_three_sheets(spark, sf), ["entity_id", "obs_date"])


@query(
    "merge_sheets",
    "entity_id obs_date:d clicks views removed:4",
    uses="event_days removal_log",
    sql="select * from (select entity_id, obs_date, max(value) as clicks from event_days where event_type = 'click' group by 1, 2) "
    "full join (select entity_id, obs_date, max(value) as views from event_days where event_type = 'view' group by 1, 2) "
    "using (entity_id, obs_date) "
    "full join (select entity_id, obs_date, sum(volume) as removed from removal_log group by 1, 2) using (entity_id, obs_date)",
)
def merge_sheets(spark, sf):
    removed = v.removal_log(spark, sf).groupBy("entity_id", "obs_date").agg(F.sum("volume").alias("removed"))
    return sheets.merge_on_key(
        [
            v.sheet(spark, sf, "click").withColumnRenamed("metric", "clicks"),
            v.sheet(spark, sf, "view").withColumnRenamed("metric", "views"),
            removed,
        ]
    )


@query(
    "clean_headers",
    "entity_id obs_date:d depth filter_density remarks",
    uses="event_days",
    sql="select entity_id, obs_date, max(value) as depth, max(value) filter (where event_type = 'click') as filter_density, "
    "min(event_type) as remarks from event_days group by 1, 2",
)
def clean_headers(spark, sf):
    e = v.event_days(spark, sf).groupBy("entity_id", "obs_date")
    clicks = F.max(F.when(F.col("event_type") == "click", F.col("value")))
    rows = e.agg(F.max("value").alias("d"), clicks.alias("f"), F.min("event_type").alias("n"), F.lit(1).alias("x"), F.lit(2).alias("y"))
    kept_by_hand = rows.toDF(" Pond  ID", "Date (day) ", "Depth (inches)", "Density (Filter)", "Notes", "Unnamed: 5", "_c6")
    return headers.clean_headers(
        kept_by_hand,
        "A",
        {"Pond ID": "entity_id", "Date": "obs_date", "Depth": "depth", "Density (Filter)": "filter_density", "Notes-A": "remarks"},
    )


@query(
    "fold_headers",
    "label_no sample reading total",
    uses="",
    sql="select event_id + 4 as label_no, event_type as sample, cast(event_id % 7 as varchar) as reading, "
    "cast(user_id as varchar) as total from events",
)
def fold_headers(spark, sf):
    events = v.table(spark, sf, "events")
    body = events.select(
        (F.col("event_id") + 4).alias("label_no"), F.col("event_type").alias("a"), (F.col("event_id") % 7).cast("string").alias("b"),
        F.col("user_id").cast("string").alias("c"), F.lit("x").alias("d"),
    )
    top = [(0, None, None, "total", None), (1, None, "reading", "g", None), (2, " sample ", "mg", None, ""), (3, "code", None, None, None)]
    named = spark.createDataFrame(top, "label_no bigint, a string, b string, c string, d string")
    return headers.fold_headers(named.unionByName(body.filter(F.col("label_no") >= 4)), "label_no")


@query(
    "scaffold_missing_day",
    "entity_id obs_date:d",
    sql="select n_name as entity_id, cast(d as date) as obs_date from nation, "
    "(select unnest(generate_series(cast(min(o_orderdate) as timestamp), cast(max(o_orderdate) as timestamp), interval 1 day)) as d "
    "from orders) where cast(d as date) not in (select cast(o_orderdate as date) from orders where o_totalprice > 480000)",
)
def scaffold_missing_day(spark, sf):
    orders = v.table(spark, sf, "orders").withColumn("obs_date", F.to_date("o_orderdate"))
    units = v.table(spark, sf, "nation").select(F.col("n_name").alias("entity_id"))
    return scaffold_missing_days(orders.filter("o_totalprice > 480000"), units, *date_bounds(orders))


@query(
    "parse_sample_labels",
    "event_id entity_id obs_date:d quality_val:6 quality_total:6",
    uses="parsed_all",
    sql="select * from parsed_all",
)
def parse_sample_labels(spark, sf):
    return labels.parse_sample_labels(v.lab_samples(spark, sf))


@query(
    "unpivot_entity_sheets",
    "entity_id obs_date:d o_orderkey o_totalprice",
    sql="select o_orderstatus as entity_id, o_orderdate as obs_date, o_orderkey, o_totalprice from orders "
    "where o_orderkey % 6 <> 0",
)
def unpivot_entity_sheets(spark, sf):
    orders = v.table(spark, sf, "orders")
    text = F.when(F.col("o_orderkey") % 6 == 0, "sample?").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = orders.withColumn("obs_date", text)
    by_entity = {s: rows.filter(F.col("o_orderstatus") == s) for s in ("F", "O", "P")}
    return sheets.unpivot_entity_sheets(by_entity)


@query(
    "range_between",
    "l_orderkey l_linenumber l_quantity l_shipdate:d",
    sql="select l_orderkey, l_linenumber, l_quantity, l_shipdate from lineitem where l_quantity between 10 and 24 "
    "and l_shipdate between date '1997-01-01' and date '1998-12-31'",
)
def range_between(spark, sf):
    ranges = {"l_quantity": (10, 24), "l_shipdate": (dt.date(1997, 1, 1), dt.date(1998, 12, 31))}
    return scans.range_between(v.table(spark, sf, "lineitem"), ranges)


@query(
    "linear_cost",
    "obs_date:d primary_qty site_cost:4",
    uses="site_daily",
    sql="select obs_date, primary_qty, primary_qty * cast(0.15 as double) as site_cost from site_daily "
    "where primary_qty is not null",
)
def linear_cost(spark, sf):
    return measures.linear_cost(v.site_daily(spark, sf), "primary_qty")


COSTS = " ".join(f"in_{i}_cost" for i in range(1, 8))
# The cost of a unit of each input, written here by themselves as the check of those in the library.
RATES = (2.08, 4.25, 3.15, 0.41, 0.60, 3.17, 49.07)
COSTS_SQL = ", ".join(
    f"cast(round(cast(coalesce(in_{i}, 0) * cast({rate} as double) as decimal(38, 9)), 2) as double) as in_{i}_cost"
    for i, rate in enumerate(RATES, 1)
)


@query(
    "cost_by_rate_table",
    "entity_id obs_date:d " + " ".join(f"{c}:2" for c in COSTS.split()),
    uses="daily_inputs",
    sql=f"select entity_id, obs_date, {COSTS_SQL} from daily_inputs",
)
def cost_by_rate_table(spark, sf):
    return measures.cost_by_rate(v.daily_inputs(spark, sf))


@query(
    "mass_volume",
    "entity_id obs_date:d mass:2 mass_corrected:2 removable_inches:4 removable_gallons:2 removable_mass:2 "
    "removable_mass_corrected:2",
    uses="mass",
    sql="select * from mass",
)
def mass_volume(spark, sf):
    return measures.mass_volume(v.grid(spark, sf))


@query(
    "normalized_volume",
    "entity_id obs_date:d liters:3 norm_liters:3",
    uses="daily_obs",
    sql=f"select entity_id, obs_date, depth * {L} as liters, depth * {L} * (density / cast(0.5 as double)) as norm_liters "
    "from daily_obs",
)
def normalized_volume(spark, sf):
    liters = measures.liters(F.col("depth"))
    return v.daily_obs(spark, sf).withColumns(
        {"liters": liters, "norm_liters": measures.normalized_liters(liters, F.col("density"))}
    )


@query(
    "weather_conform",
    "obs_date:d temp_avg:4 temp_min:4 temp_max:4 precipitation:6 wind_speed:6 pressure:4",
    uses="event_days",
    sql="""select obs_date, avg_c * 9 / 5 + 32 as temp_avg, min_c * 9 / 5 + 32 as temp_min, max_c * 9 / 5 + 32 as temp_max,
           mm / 25.4 as precipitation, kmh * 0.621371 as wind_speed, hpa as pressure
    from (select obs_date, cast(sum(cast(round(value * 100) as bigint)) as double) / 100 / count(*) as avg_c, min(value) as min_c, max(value) as max_c,
                 max(value) filter (where event_type = 'view') as mm, max(value) filter (where event_type = 'click') as kmh,
                 1000 + cast(max(event_id) as double) / 1000 as hpa
          from event_days group by 1)""",
)
def weather_conform(spark, sf):
    e = v.event_days(spark, sf)
    station = e.groupBy("obs_date").agg(
        (F.sum(v.cents("value")) / 100 / F.count(F.lit(1))).alias("tavg"),
        F.min("value").alias("tmin"),
        F.max("value").alias("tmax"),
        F.max(F.when(F.col("event_type") == "view", F.col("value"))).alias("prcp"),
        F.max(F.when(F.col("event_type") == "click", F.col("value"))).alias("wspd"),
        (1000 + F.max("event_id") / 1000).alias("pres"),
    )
    return measures.weather_conform(station)


@query(
    "prior_day_summary",
    "obs_date:d volume:2 usage:2 notes",
    uses="site_daily",
    sql="select obs_date + 1 as obs_date, coalesce(case when primary_qty > 0 then primary_qty end, "
    "case when secondary_qty > 0 then secondary_qty end, 0) as volume, coalesce(usage_qty, 0) as usage, "
    "coalesce(notes, '') as notes from site_daily",
)
def prior_day(spark, sf):
    figures = {"volume": ["primary_qty", "secondary_qty"], "usage": ["usage_qty"]}
    return prior_day_summary(v.site_daily(spark, sf), figures, notes="notes")
