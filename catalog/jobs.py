"""End-to-end report jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as v
from catalog.classes import FLAGS_SQL
from catalog.cleaning import COSTS, COSTS_SQL
from catalog.registry import query
from catalog.rollups import ACTIVE_MASS_SQL, SERIES_SQL, STATUS_SQL, TREND_SQL
from catalog.windows import CHANGE_SPEC, CHANGE_SQL, FALLBACK_SQL, RUNNING_SQL
from daygrid.functions.measures import cost_by_rate, linear_cost
from daygrid.plans import marts
from daygrid.plans.daily import derive


def _rows(spark, sf, dense=False):
    readings = v.dense_obs(spark, sf) if dense else v.daily_obs(spark, sf)
    return derive(readings, v.samples(spark, sf), bounds=v.bounds(spark, sf))


HEALTH_SPEC = (
    "obs_date:d entity_id active status_code:i depth:6 density:6 non_current_depth non_current_density quality_val:6 "
    "measured_on:d flags mass_corrected:2 removable_inches:4 removable_mass_corrected:2 norm_growth_5d:8 "
    "norm_growth_14d:8 last_event_date:d"
)
HEALTH_SQL = f"""
    select f.obs_date, f.entity_id, active, status_code, new_depth as depth, new_density as density, non_current_depth,
           non_current_density, case when active then quality_val end as quality_val,
           case when active then measured_on end as measured_on, case when active then {FLAGS_SQL} end as flags,
           mass_corrected, removable_inches, removable_mass_corrected, norm_growth_5d, norm_growth_14d,
           f.obs_date - cast(days_since_event as integer) as last_event_date
    from {FALLBACK_SQL.format('coded')} f
    left join indicators i on i.entity_id = f.entity_id and i.obs_date = f.obs_date"""


@query("health_overview", HEALTH_SPEC, uses="coded indicators", sql=HEALTH_SQL)
def health_overview(spark, sf):
    return marts.health_overview(_rows(spark, sf), v.indicators(spark, sf))


@query(
    "health_summary",
    "obs_date:d active_total active_small active_large active_area:4 active_mass:3 any_non_current "
    "agg_norm_growth_5d:8 agg_norm_growth_14d:8",
    uses="coded mass site_growth",
    sql=f"""
    select c.*, active_small * cast(1.1 as double) + active_large * cast(2.2 as double) as active_area,
           m.active_mass, g.agg_norm_growth_5d, g.agg_norm_growth_14d
    from (select obs_date, count(*) filter (where active) as active_total,
                 count(*) filter (where active and right(entity_id, 1) in ('1', '2', '3', '4')) as active_small,
                 count(*) filter (where active and right(entity_id, 1) in ('6', '8')) as active_large,
                 bool_or(coalesce(non_current_depth or non_current_density, false)) as any_non_current
          from {FALLBACK_SQL.format('coded')} group by 1) c
    left join ({ACTIVE_MASS_SQL}) m on m.obs_date = c.obs_date
    left join site_growth g on g.obs_date = c.obs_date""",
)
def health_summary(spark, sf):
    return marts.health_summary(_rows(spark, sf))


@query(
    "health_status",
    "obs_date:d status_code:i entity_count:i mass_corrected:3",
    uses="coded",
    sql=STATUS_SQL.format("coded"),
)
def health_status(spark, sf):
    return marts.health_status(_rows(spark, sf))


REMOVAL_SPEC = (
    "obs_date:d entity_group entity_id drop_to:6 days_since_event:i removable_inches:4 removable_gallons:2 "
    "removable_mass_corrected:2 running_gallons:2 running_mass:2"
)


@query("recommended_removals", REMOVAL_SPEC, uses="reported", sql=RUNNING_SQL, dense=True)
def recommended_removals(spark, sf):
    return marts.recommended_removals(_rows(spark, sf, dense=True))


@query(
    "quality_overview",
    "obs_date:d entity_id active " + CHANGE_SPEC + " bucket",
    uses="measured",
    sql=CHANGE_SQL,
)
def quality_overview(spark, sf):
    return marts.quality_overview(v.measured(spark, sf))


def _expenses(spark, sf):
    return cost_by_rate(v.daily_inputs(spark, sf)), v.shipped_back(spark, sf)


EXPENSE_SQL = f"""
    (with rows_ as (
        select entity_id, obs_date, {' + '.join(COSTS.split())} as cost, null as mass
        from (select entity_id, obs_date, {COSTS_SQL} from daily_inputs)
        union all select entity_id, obs_date, null, est_removed_mass from shipped_back),
    reports as (select distinct obs_date as report_date from daily_inputs)
    select entity_id, report_date, coalesce(sum(cost), 0) as ytd_cost, coalesce(sum(mass), 0) as ytd_est_removed_mass,
           coalesce(sum(cost) filter (where obs_date >= date_trunc('month', report_date)), 0) as mtd_cost,
           coalesce(sum(mass) filter (where obs_date >= date_trunc('month', report_date)), 0) as mtd_est_removed_mass
    from rows_ join reports on obs_date <= report_date
         and obs_date >= make_date(year(report_date) - case when month(report_date) < 9 then 1 else 0 end, 9, 1)
    group by 1, 2)"""


@query(
    "expense_overview",
    "report_date:d entity_id ytd_cost:2 mtd_cost:2 ytd_est_removed_mass:2 mtd_est_removed_mass:2",
    uses="daily_inputs shipped_back",
    sql=f"select * from {EXPENSE_SQL}",
)
def expense_overview(spark, sf):
    return marts.expense_overview(*_expenses(spark, sf))


@query(
    "expense_totals",
    "report_date:d ytd_total_cost:4 mtd_total_cost:4 ytd_est_removed_mass:2 mtd_est_removed_mass:2 ytd_cost_per_kg:7 "
    "mtd_cost_per_kg:7",
    uses="daily_inputs shipped_back site_daily",
    sql=f"""
    with e as (select report_date, sum(ytd_cost) as yc, sum(mtd_cost) as mc, sum(ytd_est_removed_mass) as ym,
                      sum(mtd_est_removed_mass) as mm from {EXPENSE_SQL} group by 1),
         s as (select report_date,
                      coalesce(sum(primary_qty) * cast(0.15 as double), 0) as ys,
                      coalesce(sum(primary_qty) filter (where obs_date >= date_trunc('month', report_date)) * cast(0.15 as double), 0) as ms
               from e left join site_daily on obs_date <= report_date
                    and obs_date >= make_date(year(report_date) - case when month(report_date) < 9 then 1 else 0 end, 9, 1)
               group by 1)
    select report_date, yc + ys as ytd_total_cost, mc + ms as mtd_total_cost, ym as ytd_est_removed_mass,
           mm as mtd_est_removed_mass, case when ym > 0 then (yc + ys) / ym end as ytd_cost_per_kg,
           case when mm > 0 then (mc + ms) / mm end as mtd_cost_per_kg
    from e join s using (report_date)""",
)
def expense_totals(spark, sf):
    costs, masses = _expenses(spark, sf)
    site = linear_cost(v.site_daily(spark, sf), "primary_qty")
    return marts.expense_totals(costs, masses, site)


@query(
    "quality_trend",
    "entity_group obs_date:d quality_val:6 fitted:6 total_density_ratio:6 quality_density_ratio:6",
    uses="measured",
    sql=f"select s.*, t.intercept + t.slope * datediff('day', date '1970-01-01', obs_date) as fitted "
    f"from ({SERIES_SQL}) s join ({TREND_SQL}) t using (entity_group)",
)
def quality_trend(spark, sf):
    return marts.quality_trend(v.measured(spark, sf))


@query(
    "backfill_marts",
    "report obs_date:d row_count total:2",
    uses="coded indicators measured reported daily_inputs shipped_back",
    sql=f"""
    with newest as (select distinct obs_date from coded order by 1 desc limit 15)
    select 'health' as report, obs_date, count(*) as row_count, sum(density) as total
    from ({HEALTH_SQL}) where obs_date in (select obs_date from newest) group by 2
    union all select 'removals', obs_date, count(*), sum(running_mass) from ({RUNNING_SQL})
    where obs_date in (select obs_date from newest) group by 2
    union all select 'quality', obs_date, count(*), sum(latest_value) from ({CHANGE_SQL})
    where obs_date in (select obs_date from newest) group by 2
    union all select 'expenses', report_date, count(*), sum(ytd_cost) from {EXPENSE_SQL}
    where report_date in (select distinct obs_date from daily_inputs order by 1 desc limit 15) group by 2""",
    dense=True,
)
def backfill_marts(spark, sf):
    """Rows and a control total per report and date."""
    costs = cost_by_rate(v.daily_inputs(spark, sf))
    reports = marts.backfill_marts(_rows(spark, sf, dense=True), costs, v.shipped_back(spark, sf), v.indicators(spark, sf))
    totals = {"health": "density", "removals": "running_mass", "quality": "latest_value", "expenses": "ytd_cost"}
    counted = []
    for name, report in reports.items():
        date = "report_date" if name == "expenses" else "obs_date"
        rows = report.groupBy(F.col(date).alias("obs_date")).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum(totals[name]).alias("total")
        )
        counted.append(rows.withColumn("report", F.lit(name)))
    return v.union_all(counted)
