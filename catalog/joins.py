"""Joins onto grids, calendars and states."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import views as v
from catalog.registry import query
from daygrid.functions.days import at_offset, by_entity
from daygrid.functions.labels import known_entities
from daygrid.operators import grid

START, END = dt.date(2024, 1, 5), dt.date(2024, 1, 25)
DAYS_SQL = "(select cast(unnest(generate_series(timestamp '2024-01-05', timestamp '2024-01-25', interval 1 day)) as date) as obs_date)"


@query(
    "calendar_cross_entity",
    "entity_id obs_date:d",
    uses="entities",
    sql=f"select entity_id, obs_date from entities, {DAYS_SQL}",
)
def calendar_cross_entity(spark, sf):
    return grid.entity_calendar(v.entities(spark, sf), START, END)


@query(
    "grid_left_join",
    "entity_id obs_date:d density:6 depth:6 move_code",
    uses="entities daily_obs",
    sql=f"select g.entity_id, g.obs_date, density, depth, move_code from (select * from entities, {DAYS_SQL}) g "
    "left join daily_obs o on o.entity_id = g.entity_id and o.obs_date = g.obs_date",
)
def grid_left_join(spark, sf):
    days = grid.entity_calendar(v.entities(spark, sf), START, END)
    return grid.grid_left_join(days, v.daily_obs(spark, sf))


@query(
    "calendar_outer_join",
    "obs_date:d usage_qty:2 primary_qty:2",
    uses="site_daily",
    sql="select d.obs_date, usage_qty, primary_qty from (select cast(unnest(generate_series(timestamp '1991-12-15', "
    "timestamp '2002-01-15', interval 1 day)) as date) as obs_date) d left join site_daily s on s.obs_date = d.obs_date",
)
def calendar_outer_join(spark, sf):
    return grid.calendar_outer_join(v.site_daily(spark, sf), dt.date(1991, 12, 15), dt.date(2002, 1, 15))


@query(
    "multi_full_outer",
    "entity_id obs_date:d density:6 quality_val:6 volume:3",
    uses="daily_obs samples removal_log",
    sql="select * from (select entity_id, obs_date, density from daily_obs where density is not null) "
    "full join samples using (entity_id, obs_date) full join "
    "(select entity_id, obs_date, sum(volume) as volume from removal_log group by 1, 2) using (entity_id, obs_date)",
)
def multi_full_outer(spark, sf):
    density = v.daily_obs(spark, sf).select("entity_id", "obs_date", "density").dropna(subset=["density"])
    volume = v.removal_log(spark, sf).groupBy("entity_id", "obs_date").agg(F.sum("volume").alias("volume"))
    return grid.full_outer([density, v.samples(spark, sf), volume])


@query(
    "attach_state_left",
    "row_no entity_id obs_date:d volume:3 active",
    uses="removal_log state",
    sql="select l.*, s.active from removal_log l left join state s on s.entity_id = l.entity_id and s.obs_date = l.obs_date",
)
def attach_state_left(spark, sf):
    return grid.attach_state(v.removal_log(spark, sf), v.state(spark, sf).select("entity_id", "obs_date", "active"))


@query(
    "date_offset_lookup",
    "entity_id obs_date:d week_before:6 day_after:6",
    uses="state",
    sql="select s.entity_id, s.obs_date, p.density as week_before, n.density as day_after from state s "
    "left join (select * from state where active) p on p.entity_id = s.entity_id and p.day_no = s.day_no - 7 "
    "left join (select * from state where active) n on n.entity_id = s.entity_id and n.day_no = s.day_no + 1",
)
def date_offset_lookup(spark, sf):
    w = by_entity()
    density = F.when(F.col("active"), F.col("density"))
    return v.state(spark, sf).select(
        "entity_id", "obs_date", at_offset(density, w, -7).alias("week_before"), at_offset(density, w, 1).alias("day_after")
    )


@query(
    "known_entity_semi",
    "event_id entity_id obs_date:d value",
    uses="event_days",
    sql="select event_id, entity_id, obs_date, value from event_days where user_id in (select s_suppkey from supplier)",
)
def known_entity_semi(spark, sf):
    known = v.table(spark, sf, "supplier").select(v.padded(F.col("s_suppkey")).alias("entity_id"))
    return known_entities(v.event_days(spark, sf), known)
