"""Every registered query against its SQL, and a few plan properties."""

from __future__ import annotations

import time

import pytest

from __spark_entry__ import entry
from catalog import load
from compare import differences, engine
from support import DATA

QUERIES, ORACLES = load().QUERIES, load().ORACLES


@pytest.fixture(scope="module")
def db():
    return engine(DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert differences(QUERIES[name](spark, DATA), db, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python_in_plans(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for part in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert part not in plan


# A stored range, a batch or ranked rows to be frozen and names that stand in rows need jobs; all other frames are plans.
BUILT_WITH_JOBS = {
    "backfill_marts", "daily_pipeline", "fold_headers", "infer_serial_dates", "recommended_removals", "running_totals",
}


def test_frames_are_built_without_jobs(spark):
    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, group)
    started = {}
    for name, query in QUERIES.items():
        before = set(tracker.getJobIdsForGroup(group))
        query(spark, DATA)
        # Reading a parquet schema is a job of one task.
        new = [tracker.getJobInfo(j) for j in set(tracker.getJobIdsForGroup(group)) - before]
        stages = [tracker.getStageInfo(s) for j in new if j for s in j.stageIds]
        if any(s and s.name and not s.name.startswith("parquet") for s in stages):
            started[name] = len(new)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(started) <= BUILT_WITH_JOBS


def test_twelve_columns_of_five_sheets_plan_quickly(spark):
    from daygrid.sources.sheets import reconcile_columns

    columns = ", ".join(f"c{i} double" for i in range(12))
    frames = {f"s{k}": spark.createDataFrame([], f"entity_id string, obs_date date, {columns}") for k in range(5)}
    merged = reconcile_columns(frames, ["entity_id", "obs_date"])
    began = time.perf_counter()
    merged._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - began < 5


def test_look_back_reaches_the_scan(spark):
    text = QUERIES["lookback_window"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-17" in text
