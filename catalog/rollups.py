"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as v
from catalog.cleaning import COSTS, COSTS_SQL
from catalog.registry import query
from daygrid.functions.labels import parse_sample_labels
from daygrid.functions.measures import cost_by_rate, linear_cost, mass_volume
from daygrid.operators import rollups
from daygrid.operators.classify import status_code
from daygrid.operators.growth import sum_by_day
from daygrid.plans import marts


@query(
    "mean_duplicates",
    "entity_id obs_date:d quality_val:6 quality_total:6",
    uses="samples",
    sql="select * from samples",
)
def mean_duplicates(spark, sf):
    read = parse_sample_labels(v.lab_samples(spark, sf), entities=v.entities(spark, sf))
    return rollups.mean_duplicates(read, ["quality_val", "quality_total"])


@query(
    "daily_event_rollup",
    "entity_id obs_date:d initial_depth:6 final_depth:6 volume:3 notes",
    uses="removal_log",
    sql="select entity_id, obs_date, max(initial_depth) as initial_depth, min(final_depth) as final_depth, "
    "sum(volume) as volume, coalesce(string_agg(notes, ' / ' order by source_tag, row_no), '') as notes "
    "from removal_log group by 1, 2",
)
def daily_event_rollup(spark, sf):
    return rollups.daily_event_rollup(v.removal_log(spark, sf))


@query(
    "sum_by_day",
    "obs_date:d removed_volume:4 density:6",
    uses="grid",
    sql="select obs_date, coalesce(sum(removed_volume), 0) as removed_volume, coalesce(sum(density), 0) as density "
    "from grid group by 1",
)
def sum_days(spark, sf):
    return sum_by_day(v.grid(spark, sf), ("removed_volume", "density"))


STATUS_SQL = (
    "select d.obs_date, c.status_code, count(k.status_code) as entity_count, "
    "coalesce(sum(k.mass_corrected), 0) as mass_corrected from (select distinct obs_date from {0}) d "
    "cross join (select unnest([0, 1, 2, 3, 4, 5, 6]) as status_code) c left join {0} k "
    "on k.obs_date = d.obs_date and k.status_code = c.status_code group by 1, 2"
)


@query(
    "status_rollup",
    "obs_date:d status_code:i entity_count:i mass_corrected:3",
    uses="coded",
    sql=STATUS_SQL.format("coded"),
)
def status_rollup(spark, sf):
    return rollups.status_rollup(status_code(mass_volume(v.measured(spark, sf))))


@query(
    "active_area",
    "obs_date:d active_total active_small active_large active_area:4",
    uses="state",
    sql="select *, active_small * cast(1.1 as double) + active_large * cast(2.2 as double) as active_area from "
    "(select obs_date, count(*) filter (where active) as active_total, "
    "count(*) filter (where active and right(entity_id, 1) in ('1', '2', '3', '4')) as active_small, "
    "count(*) filter (where active and right(entity_id, 1) in ('6', '8')) as active_large from state group by 1)",
)
def active_area(spark, sf):
    return rollups.active_area(v.state(spark, sf))


# Day by day: the newest of three rows that is inactive or has a mass.
ACTIVE_MASS_SQL = """
    select obs_date, coalesce(sum(case when active then coalesce(m0, case when a1 then m1 end,
                                       case when a1 and m1 is null and a2 then m2 end) end), 0) as active_mass
    from (select obs_date, active, mass_corrected as m0,
                 lag(active, 1) over w as a1, lag(mass_corrected, 1) over w as m1,
                 lag(active, 2) over w as a2, lag(mass_corrected, 2) over w as m2
          from mass window w as (partition by entity_id order by day_no))
    group by 1"""


@query("active_mass_filled", "obs_date:d active_mass:3", uses="mass", sql=ACTIVE_MASS_SQL)
def active_mass_filled(spark, sf):
    return rollups.active_mass_filled(mass_volume(v.state(spark, sf)))


YEAR = "(year(obs_date) - case when month(obs_date) < 9 then 1 else 0 end)"


@query(
    "period_to_date",
    "entity_id obs_date:d ytd_cost:2 mtd_cost:2",
    uses="daily_inputs",
    sql=f"""
    select entity_id, obs_date, sum(cost) over (partition by entity_id, {YEAR} order by obs_date) as ytd_cost,
           sum(cost) over (partition by entity_id, {YEAR}, month(obs_date) order by obs_date) as mtd_cost
    from (select entity_id, obs_date, {' + '.join(COSTS.split())} as cost
          from (select entity_id, obs_date, {COSTS_SQL} from daily_inputs))""",
)
def period_to_date(spark, sf):
    costs = cost_by_rate(v.daily_inputs(spark, sf))
    total = sum((F.col(c) for c in COSTS.split()[1:]), F.col(COSTS.split()[0]))
    return rollups.period_to_date(costs.select("entity_id", "obs_date", total.alias("cost")), ["cost"])


TOTALS_SQL = f"""
    with days as (
        select obs_date, coalesce(sum(c), 0) as cost, coalesce(sum(m), 0) as mass, coalesce(sum(s), 0) as site from (
            select obs_date, {' + '.join(COSTS.split())} as c, null as m, null as s
            from (select entity_id, obs_date, {COSTS_SQL} from daily_inputs)
            union all select obs_date, null, est_removed_mass, null from shipped_back
            union all select obs_date, null, null, primary_qty * cast(0.15 as double) from site_daily where primary_qty is not null)
        group by 1),
    running as (
        select obs_date, sum(cost) over y + sum(site) over y as ytd_total_cost, sum(cost) over m + sum(site) over m as mtd_total_cost,
               sum(site) over y as ytd_site_cost, sum(site) over m as mtd_site_cost,
               sum(mass) over y as ytd_est_removed_mass, sum(mass) over m as mtd_est_removed_mass
        from days
        window y as (partition by {YEAR} order by obs_date), m as (partition by {YEAR}, month(obs_date) order by obs_date))
    select *, case when ytd_est_removed_mass > 0 then ytd_total_cost / ytd_est_removed_mass end as ytd_cost_per_kg,
           case when mtd_est_removed_mass > 0 then mtd_total_cost / mtd_est_removed_mass end as mtd_cost_per_kg
    from running"""


@query(
    "period_totals_unit_cost",
    "obs_date:d ytd_total_cost:4 mtd_total_cost:4 ytd_site_cost:4 mtd_site_cost:4 ytd_est_removed_mass:2 "
    "mtd_est_removed_mass:2 ytd_cost_per_kg:7 mtd_cost_per_kg:7",
    uses="daily_inputs shipped_back site_daily",
    sql=TOTALS_SQL,
)
def period_totals_unit_cost(spark, sf):
    costs = cost_by_rate(v.daily_inputs(spark, sf))
    total = sum((F.col(c) for c in COSTS.split()[1:]), F.col(COSTS.split()[0]))
    site = linear_cost(v.site_daily(spark, sf), "primary_qty")
    return rollups.period_totals_unit_cost(costs.select("obs_date", total.alias("cost")), v.shipped_back(spark, sf), site)


SERIES_SQL = """
    select obs_date, entity_group, avg(quality_val) as quality_val, avg(quality_total) as quality_total,
           avg(known) as density, avg(quality_total) / nullif(avg(known), 0) as total_density_ratio,
           avg(quality_val) / nullif(avg(known), 0) as quality_density_ratio
    from (select obs_date, right(entity_id, 1) as entity_group, quality_val, quality_total,
                 last_value(density ignore nulls) over (partition by entity_id order by day_no
                                                        rows unbounded preceding) as known
          from measured)
    where known is not null group by 1, 2"""
TREND_SQL = f"""
    select entity_group, slope, icept - slope * 10957 as intercept, points
    from (select entity_group, regr_slope(quality_val, x) as slope, regr_intercept(quality_val, x) as icept,
                 count(quality_val) as points
          from (select *, datediff('day', date '2000-01-01', obs_date) as x from ({SERIES_SQL})) group by 1)"""


@query(
    "group_mean_ratio",
    "obs_date:d entity_group quality_val:6 quality_total:6 density:6 total_density_ratio:6 quality_density_ratio:6",
    uses="measured",
    sql=SERIES_SQL,
)
def group_mean_ratio(spark, sf):
    return marts.quality_series(v.measured(spark, sf))


@query("linear_trend", "entity_group slope:6 intercept:3 points", uses="measured", sql=TREND_SQL)
def linear_trend(spark, sf):
    return rollups.linear_trend(marts.quality_series(v.measured(spark, sf)), "quality_val", ["entity_group"])


CANDIDATES_SQL = (
    "select *, right(entity_id, 1) as entity_group, depth - removable_inches as drop_to from reported "
    "where density >= 0.5 and quality_val >= 3 and removable_mass_corrected is not null"
)


@query(
    "recommended_totals",
    "obs_date:d total_mass:2 total_gallons:2 candidates",
    uses="reported",
    sql="select obs_date, sum(removable_mass_corrected) as total_mass, sum(removable_gallons) as total_gallons, "
    f"count(*) as candidates from ({CANDIDATES_SQL}) group by 1",
    dense=True,
)
def recommended_totals(spark, sf):
    return marts.recommended_totals(v.reported(spark, sf, dense=True))


@query(
    "latest_sample_date",
    "obs_date:d latest_sample_date:d",
    uses="measured",
    sql="""
    select d.obs_date, max(m.obs_date) as latest_sample_date
    from measured d left join measured m on m.entity_id = d.entity_id and m.obs_date <= d.obs_date
         and m.obs_date >= d.obs_date - 90 and m.is_measured and m.quality_val is not null
         and not exists (select 1 from measured n where n.entity_id = d.entity_id and n.quality_val is null
                         and n.obs_date between m.obs_date and d.obs_date)
    group by 1""",
)
def latest_sample_date(spark, sf):
    return marts.latest_sample_date(marts.quality_overview(v.measured(spark, sf)))
