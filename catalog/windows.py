"""Window and time-series operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as v
from catalog.registry import query
from catalog.rollups import CANDIDATES_SQL
from catalog.sql import growth_ratio
from daygrid.functions.cleaning import suffix_group
from daygrid.functions.days import by_entity
from daygrid.functions.measures import mass_volume
from daygrid.operators import growth, history, movement, state
from daygrid.operators.classify import candidate_order, removal_candidates
from daygrid.operators.ranking import running_totals

KEY = "entity_id obs_date:d "


@query("active_status", KEY + "active", uses="state", sql="select * from state")
def active_status(spark, sf):
    return state.active_status(v.grid(spark, sf))


@query(
    "blocked_fill",
    KEY + "quality_val:6 quality_total:6 measured_on:d is_measured liters:2 norm_liters:2 filled_mass:3",
    uses="filled",
    sql="select * from filled",
)
def blocked_fill(spark, sf):
    """Quality forward without limit, blocked by inactive days; volumes and mass both ways, reset by movements."""
    return growth.fill_growth_inputs(history.carry_measurements(v.moves(spark, sf)))


@query("continuity_check", KEY + "valid", uses="valid", sql="select * from valid")
def continuity_check(spark, sf):
    return v.state(spark, sf).withColumn("valid", state.continuity(by_entity()))


@query("movement_class", KEY + "move_class move_unmatched", uses="classed", sql="select * from classed")
def movement_class(spark, sf):
    return movement.movement_class(v.grid(spark, sf))


@query(
    "mass_differential",
    KEY + "move_class est_removed_mass:3 est_split_mass:3",
    uses="differential",
    sql="select * from differential",
    dense=True,
)
def mass_differential(spark, sf):
    return movement.mass_differential(movement.movement_class(mass_volume(v.grid(spark, sf, dense=True))))


@query(
    "volume_log_estimate",
    KEY + "est_removed_log:6 est_split_log:6",
    uses="log_estimate",
    sql="select *, cast(null as double) as est_split_log from log_estimate where active",
)
def volume_log_estimate(spark, sf):
    return movement.volume_log_estimate(v.state(spark, sf)).filter("active")


@query(
    "estimate_fallback",
    KEY + "move_class est_removed_mass:4 est_split_mass:4",
    uses="moves",
    sql="select * from moves",
    dense=True,
)
def estimate_fallback(spark, sf):
    return v.moves(spark, sf, dense=True)


@query(
    "movement_corrected",
    KEY + "hc_liters:2 hc_norm_liters:2 hc_filled_mass:3",
    uses="corrected moves",
    sql="select m.entity_id, m.obs_date, hc_liters, hc_norm_liters, hc_filled_mass from moves m left join corrected c "
    "on c.entity_id = m.entity_id and c.obs_date = m.obs_date",
    dense=True,
)
def movement_corrected(spark, sf):
    return growth.movement_corrected(growth.fill_growth_inputs(v.moves(spark, sf, dense=True)))


@query(
    "shifted_rolling_sum",
    KEY + "removed_before:3 split_before:3",
    uses="before moves",
    sql="select m.entity_id, m.obs_date, removed_before, split_before from moves m left join before b "
    "on b.entity_id = m.entity_id and b.obs_date = m.obs_date",
    dense=True,
)
def shifted_rolling_sum(spark, sf):
    return growth.shifted_rolling_sum(v.moves(spark, sf, dense=True))


@query(
    "mass_change_7d",
    KEY + "mass_change_grams_7d:2 prev_liters_7d:2 prev_norm_liters_7d:2",
    uses="changed moves",
    sql="select m.entity_id, m.obs_date, mass_change_grams_7d, prev_liters_7d, prev_norm_liters_7d from moves m "
    "left join changed c on c.entity_id = m.entity_id and c.obs_date = m.obs_date",
    dense=True,
)
def mass_change_7d(spark, sf):
    filled = growth.fill_growth_inputs(v.moves(spark, sf, dense=True))
    return growth.mass_change(growth.shifted_rolling_sum(growth.movement_corrected(filled)))


@query(
    "rolling_ratio",
    KEY + "ratio_5d:6 ratio_14d:6",
    uses="filled",
    sql=f"select entity_id, obs_date, {growth_ratio('liters', 'norm_liters', 5)} as ratio_5d, "
    f"{growth_ratio('liters', 'norm_liters', 14)} as ratio_14d from filled",
)
def rolling_ratio(spark, sf):
    w = by_entity()
    filled = growth.fill_growth_inputs(v.moves(spark, sf), w)
    return filled.withColumns(
        {f"ratio_{n}d": growth.rolling_ratio(F.col("liters"), F.col("norm_liters"), w, n) for n in (5, 14)}
    )


@query(
    "growth_per_entity",
    KEY + "mass_change_grams_7d:2 prev_liters_7d:2 prev_norm_liters_7d:2 growth_5d:8 norm_growth_5d:8 "
    "growth_14d:8 norm_growth_14d:8",
    uses="growth",
    sql="select * from growth",
    dense=True,
)
def growth_per_entity(spark, sf):
    return growth.growth_per_entity(v.moves(spark, sf, dense=True))


@query(
    "growth_aggregate",
    "obs_date:d mass_change_grams_7d:1 prev_liters_7d:1 prev_norm_liters_7d:1 agg_growth_5d:8 agg_norm_growth_5d:8 "
    "agg_growth_14d:8 agg_norm_growth_14d:8",
    uses="site_growth",
    sql="select * from site_growth",
)
def growth_aggregate(spark, sf):
    return growth.growth_aggregate(growth.growth_per_entity(v.moves(spark, sf)))


@query("days_since_event", KEY + "days_since_event:i", uses="reported", sql="select * from reported")
def days_since_event(spark, sf):
    return state.days_since_event(v.moves(spark, sf))


@query(
    "last_event_date",
    KEY + "last_event_date:d",
    uses="reported",
    sql="select *, obs_date - cast(days_since_event as integer) as last_event_date from reported",
)
def last_event_date(spark, sf):
    since = state.days_since_event(v.moves(spark, sf))
    return since.withColumn("last_event_date", state.last_event_date(F.col("obs_date"), F.col("days_since_event")))


# Every report row with the measurements that count for it, numbered from the newest.
RECENT_SQL = """
    select d.entity_id, d.obs_date, m.obs_date as on_date, m.quality_val as val,
           row_number() over (partition by d.entity_id, d.obs_date order by m.obs_date desc) as pos
    from measured d join measured m on m.entity_id = d.entity_id and m.obs_date between d.obs_date - 90 and d.obs_date
         and m.is_measured and m.quality_val is not null
    where not exists (select 1 from measured n where n.entity_id = d.entity_id and n.quality_val is null
                      and n.obs_date between m.obs_date and d.obs_date)"""


@query(
    "last_k_since_break",
    KEY + "pos:i on_date:d val:6",
    uses="measured",
    sql=f"select * from ({RECENT_SQL}) where pos <= 3",
)
def last_k_since_break(spark, sf):
    recent = history.last_measurements(v.measured(spark, sf))
    listed = recent.select("entity_id", "obs_date", F.posexplode("recent").alias("pos", "m"))
    return listed.select(
        "entity_id", "obs_date", (F.col("pos") + 1).alias("pos"),
        F.date_from_unix_date("m.day_no").alias("on_date"), F.col("m.value").alias("val"),
    )


CHANGE_SQL = f"""
    select b.*, l.d1 as latest_date, l.v1 as latest_value, coalesce(l.n, 0) as measurements,
           v1 - v2 as change_1, d1 - d2 as change_1_days, v1 - v3 as change_2, d1 - d3 as change_2_days,
           case when v1 - v2 > 0 then 'up' when v1 - v2 < 0 then 'down' when v1 - v2 = 0 then 'flat' end as change_1_sign,
           case when v1 - v3 > 0 then 'up' when v1 - v3 < 0 then 'down' when v1 - v3 = 0 then 'flat' end as change_2_sign,
           case when not active then 'inactive' when v1 is null then 'grey' when v1 < 2 then 'red'
                when v1 < 3 then 'yellow' else 'green' end as bucket
    from measured b left join (
        select entity_id as e, obs_date as o, count(*) as n,
               max(val) filter (where pos = 1) as v1, max(val) filter (where pos = 2) as v2, max(val) filter (where pos = 3) as v3,
               max(on_date) filter (where pos = 1) as d1, max(on_date) filter (where pos = 2) as d2,
               max(on_date) filter (where pos = 3) as d3
        from ({RECENT_SQL}) where pos <= 3 group by 1, 2) l on l.e = b.entity_id and l.o = b.obs_date"""
CHANGE_SPEC = (
    "measurements:i latest_date:d latest_value:6 change_1:6 change_1_days:i change_1_sign change_2:6 change_2_days:i "
    "change_2_sign"
)


@query("change_between", KEY + CHANGE_SPEC, uses="measured", sql=CHANGE_SQL)
def change_between(spark, sf):
    return history.change_between(history.last_measurements(v.measured(spark, sf)))


RUNNING_SQL = f"""
    select *, sum(removable_gallons) over w as running_gallons, sum(removable_mass_corrected) over w as running_mass
    from ({CANDIDATES_SQL})
    window w as (partition by obs_date, entity_group order by days_since_event desc nulls last,
                 removable_mass_corrected desc nulls last, entity_id rows unbounded preceding)"""


@query(
    "running_totals",
    "obs_date:d entity_group entity_id days_since_event:i running_gallons:2 running_mass:2",
    uses="reported",
    sql=RUNNING_SQL,
    dense=True,
)
def totals_in_order(spark, sf):
    candidates = removal_candidates(v.reported(spark, sf, dense=True)).withColumn("entity_group", suffix_group(F.col("entity_id")))
    return running_totals(
        candidates,
        ["obs_date", "entity_group"],
        candidate_order(),
        {"running_gallons": "removable_gallons", "running_mass": "removable_mass_corrected"},
    )


FALLBACK_SQL = """
    (select *, case when not active or whole then d1 end as new_depth, case when not active or whole then a1 end as new_density,
            case when active then whole and d1_old end as non_current_depth,
            case when active then whole and a1_old end as non_current_density
     from (select *, coalesce(d1 > 0 and a1 > 0, false) as whole
           from (select *, case when d1_old then prev_depth else depth end as d1,
                        case when a1_old then prev_density else density end as a1
                 from (select s.*, p.depth as prev_depth, p.density as prev_density,
                              s.active and not coalesce(s.depth > 0, false) and coalesce(p.depth > 0, false) as d1_old,
                              s.active and not coalesce(s.density > 0, false) and p.density is not null as a1_old
                       from {0} s left join {0} p on p.entity_id = s.entity_id and p.day_no = s.day_no - 1))))"""


@query(
    "prev_day_fallback",
    KEY + "depth:6 density:6 non_current_depth non_current_density",
    uses="state",
    sql="select * replace (new_depth as depth, new_density as density) from " + FALLBACK_SQL.format("state"),
)
def prev_day_fallback(spark, sf):
    return state.prev_day_fallback(v.state(spark, sf))
