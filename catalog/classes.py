"""Classification, filters and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as v
from catalog.registry import query
from catalog.rollups import CANDIDATES_SQL
from catalog.windows import CHANGE_SQL
from daygrid.functions.cleaning import suffix_group
from daygrid.operators import classify
from daygrid.operators.history import change_between, last_measurements

KEY = "entity_id obs_date:d "


@query("status_code", KEY + "status_code:i", uses="coded_only", sql="select * from coded_only")
def status_code(spark, sf):
    return classify.status_code(v.measured(spark, sf))


FLAGS_SQL = """concat_ws(',', case when coalesce(purity_pct, 0) < 80 then '%N' end,
    case when coalesce(ph, 0) < 7.8 or coalesce(ph, 0) > 8.2 then 'pH' end,
    case when rotifers >= 1 then 'R' end, case when attached_fd >= 1 then 'FD A' end,
    case when floating_fd >= 1 then 'FD FF' end, case when golden_flagellates >= 1 then 'GF' end,
    case when diatoms >= 0.5 then 'D' end, case when tetra >= 0.5 then 'T' end,
    case when green_algae >= 0.5 then 'GA' end)"""


@query(
    "indicator_flags",
    KEY + "flags",
    uses="daily_obs indicators",
    sql=f"select entity_id, obs_date, {FLAGS_SQL} as flags from daily_obs join indicators using (entity_id, obs_date)",
)
def indicator_flags(spark, sf):
    readings = v.daily_obs(spark, sf).select("entity_id", "obs_date", "purity_pct")
    both = readings.join(v.indicators(spark, sf), ["entity_id", "obs_date"])
    return both.withColumn("flags", F.array_join(classify.indicator_flags(), ","))


@query("value_bucket", KEY + "latest_value:6 bucket", uses="measured", sql=CHANGE_SQL)
def value_bucket(spark, sf):
    latest = change_between(last_measurements(v.measured(spark, sf)))
    return latest.withColumn("bucket", classify.value_bucket(F.col("latest_value"), F.col("active")))


@query(
    "candidate_filter_sort",
    "obs_date:d entity_group entity_id drop_to:6 days_since_event:i removable_mass_corrected:2",
    uses="reported",
    sql=f"select * from ({CANDIDATES_SQL}) order by obs_date, entity_group, days_since_event desc nulls last, "
    "removable_mass_corrected desc nulls last, entity_id",
    dense=True,
)
def candidate_filter_sort(spark, sf):
    kept = classify.removal_candidates(v.reported(spark, sf, dense=True)).withColumn("entity_group", suffix_group(F.col("entity_id")))
    return kept.orderBy("obs_date", "entity_group", *classify.candidate_order())
