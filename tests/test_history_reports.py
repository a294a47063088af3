"""Measurement history, running totals, roll-ups and period sums."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daygrid.durable import Scratch
from daygrid.functions.days import with_day_no
from daygrid.operators import classify, history, ranking, rollups
from daygrid.plans import marts, store

D = dt.date


def day(n: int) -> dt.date:
    return D(2024, 1, 1) + dt.timedelta(days=n)


def test_recent_measurements_equal_backward_loop(spark):
    rng = random.Random(5)
    rows = []
    for e in range(40):
        for n in range(130):
            value = None if rng.random() < 0.02 else round(rng.uniform(1, 5), 2)
            rows.append((f"{e:04d}", day(n), value, True if rng.random() < 0.05 else None))
    df = with_day_no(spark.createDataFrame(rows, "entity_id string, obs_date date, quality_val double, is_measured boolean"))
    got = {(r.entity_id, r.obs_date): [m.value for m in r.recent] for r in history.last_measurements(df).collect()}
    lengths = set()
    for e in range(40):
        mine = [r for r in rows if r[0] == f"{e:04d}"]
        for i, r in enumerate(mine):
            want = []
            for _, d, value, real in reversed([x for x in mine[: i + 1] if x[1] >= r[1] - dt.timedelta(days=90)]):
                if len(want) == 3 or value is None:
                    break
                if real:
                    want.append(value)
            assert got[r[0], r[1]] == want
            lengths.add(len(want))
    assert lengths == {0, 1, 2, 3}


def test_change_and_sign(spark):
    rows = [("a", day(0), 2.0), ("a", day(4), 3.5), ("a", day(9), 3.5), ("b", day(9), 1.0)]
    df = with_day_no(spark.createDataFrame(rows, "entity_id string, obs_date date, quality_val double")).withColumn("is_measured", F.lit(True))
    got = {(r.entity_id, r.obs_date): r for r in history.change_between(history.last_measurements(df)).collect()}
    last = got["a", day(9)]
    assert (last.change_1, last.change_1_days, last.change_1_sign) == (0.0, 5, "flat")
    assert (last.change_2, last.change_2_days, last.change_2_sign) == (1.5, 9, "up")
    assert (last.measurements, last.latest_date) == (3, day(9))
    only = got["b", day(9)]
    assert (only.change_1, only.change_1_sign, only.measurements) == (None, None, 1)


def test_carry_stops_at_inactive_days(spark):
    rows = [("a", day(0), 2.0, True), ("a", day(1), None, True), ("a", day(2), 9.0, False), ("a", day(3), None, True)]
    df = with_day_no(spark.createDataFrame(rows, "entity_id string, obs_date date, quality_val double, active boolean"))
    got = history.carry_measurements(df).orderBy("day_no").collect()
    assert [r.quality_val for r in got] == [2.0, 2.0, None, None]
    assert [r.measured_on for r in got] == [day(0), day(0), None, None]
    # The flag of the blanked measurement stays.
    assert [r.is_measured for r in got] == [True, None, True, None]


@pytest.mark.parametrize("parts", ["1", "8", "40"])
def test_running_totals_with_a_hot_group_and_ties(spark, parts):
    rng = random.Random(9)
    rows = []
    for i in range(900):
        group = "hot" if i % 3 == 0 else f"g{i % 7}"
        rows.append((group, f"{i:04d}", rng.choice([None, 0, 3, 45]), float(rng.choice([1, 2, 2, 2, 9])), 2.0))
    df = spark.createDataFrame(rows, "g string, entity_id string, days_since_event int, removable_mass_corrected double, gal double")
    totals = {"rm": "removable_mass_corrected", "rg": "gal"}
    shuffled = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ranking.running_totals(df, ["g"], classify.candidate_order(), totals)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = {r.entity_id: (r.rm, r.rg) for r in out.collect()}
    assert len(got) == len(rows)
    for g in {r[0] for r in rows}:
        mass = gallons = 0.0
        for r in sorted((r for r in rows if r[0] == g), key=lambda r: (r[2] is None, -(r[2] or 0), -r[3], r[1])):
            mass, gallons = mass + r[3], gallons + r[4]
            assert got[r[1]] == (mass, gallons)


def test_running_totals_read_their_input_once_and_cut_ties(spark, tmp_path):
    rows = [("hot", i, 1.0, None if i % 2 else 3.0) for i in range(4000)] + [("cold", -1, None, None), (None, 0, 2.0, 2.0)]
    spark.createDataFrame(rows, "g string, i int, x double, y double").write.parquet(str(tmp_path / "rows"))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.read.parquet(str(tmp_path / "rows")).mapInArrow(counted, "g string, i int, x double, y double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # All rows of a group tie in the order, and are cut into parts all the same.
        with Scratch(spark) as scratch:
            out = ranking.running_totals(df, ["g"], [F.lit(1).asc()], {"sx": "x", "sy": "y"}, scratch)
            assert not any("/rows/" in f for f in out.inputFiles())
            got = out.collect()
            stored = [spark.read.parquet(folder) for folder in scratch.folders]
            parts = next(d for d in stored if "_part" in d.columns).filter("g = 'hot'").select("_part").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert reads.value == len(rows) and parts > 4
    assert sorted(r.sx for r in got if r.g == "hot") == [float(n) for n in range(1, 4001)]
    assert max(r.sy for r in got if r.sy is not None) == 6000.0
    assert [(r.sx, r.sy) for r in got if r.g != "hot"] in ([(None, None), (2.0, 2.0)], [(2.0, 2.0), (None, None)])


def test_event_rollup_joins_notes_in_order(spark):
    rows = [
        (n, "2.2" if n % 2 else "1.1", "a", day(0), float(n), float(n), 1.0, None if n % 5 == 0 else f"n{n}") for n in range(100)
    ] + [(500, "1.1", "b", day(0), 3.0, 1.0, 2.0, None), (501, "1.1", None, day(0), 3.0, 1.0, 2.0, "x"), (502, "1.1", "b", day(0), 9.0, 0.0, None, "y")]
    log = spark.createDataFrame(rows, "row_no long, source_tag string, entity_id string, obs_date date, "
                                      "initial_depth double, final_depth double, volume double, notes string")
    got = {r.entity_id: r for r in rollups.daily_event_rollup(log).collect()}
    ordered = [r for tag in ("1.1", "2.2") for r in rows[:100] if r[1] == tag]
    assert got["a"].notes == " / ".join(r[7] for r in ordered if r[7])
    assert (got["a"].initial_depth, got["a"].final_depth, got["a"].volume) == (99.0, 0.0, 100.0)
    assert (got["b"].notes, got["b"].volume, got["b"].initial_depth) == ("", 2.0, 3.0)
    assert set(got) == {"a", "b"}


def test_period_sums_restart_in_september(spark):
    rows = [("a", D(2023, 8, 31), 1.0), ("a", D(2023, 9, 1), 2.0), ("a", D(2023, 12, 31), 4.0), ("a", D(2024, 1, 1), 8.0), ("a", D(2024, 8, 31), 16.0)]
    df = spark.createDataFrame(rows, "entity_id string, obs_date date, cost double")
    got = {r.obs_date: (r.ytd_cost, r.mtd_cost) for r in rollups.period_to_date(df, ["cost"]).collect()}
    assert got == {D(2023, 8, 31): (1.0, 1.0), D(2023, 9, 1): (2.0, 2.0), D(2023, 12, 31): (6.0, 4.0),
                   D(2024, 1, 1): (14.0, 8.0), D(2024, 8, 31): (30.0, 16.0)}
    days = [D(2023, 9, 1), D(2023, 11, 5), D(2024, 1, 15), D(2024, 2, 1), D(2024, 9, 1)]
    reports = spark.createDataFrame([(d,) for d in days + days[:1]], "obs_date date")
    at = {r.report_date: (r.ytd_cost, r.mtd_cost) for r in rollups.period_to_date_at(df, ["cost"], reports).collect()}
    assert at == {D(2023, 9, 1): (2.0, 2.0), D(2023, 11, 5): (2.0, 0.0), D(2024, 1, 15): (14.0, 8.0), D(2024, 2, 1): (14.0, 0.0)}


def test_intervals_grow_with_changes_and_hold_between_them(spark, tmp_path):
    """Sums at every day of three years equal loops; a day without a value adds no row."""
    rng = random.Random(5)
    first, days = D(2022, 1, 1), 1100
    rows = [(e, first + dt.timedelta(days=n), rng.choice([None, 0.0, 1.0, 2.5]) if rng.random() < 0.1 else rng.choice([None, 0.0]))
            for e in ("a", "b", "c") for n in range(days) if rng.random() < 0.5]
    rows += [("a", first, 1.0), ("a", first, 2.0), ("d", D(2023, 8, 31), 4.0), ("e", D(2022, 9, 1), 0.0), ("f", None, 7.0)]
    df = spark.createDataFrame(rows, "entity_id string, obs_date date, cost double")
    store.save_intervals(str(tmp_path), "x", rollups.period_intervals(df, ["cost"]))
    intervals = spark.read.parquet(str(tmp_path / "intervals_x"))
    year = lambda d: d.year - (d.month < 9)
    changes = {(e, d) for e, d, c in rows if d is not None and c}
    starts = {(e, year(d)) for e, d, _ in rows if d is not None}
    assert len(starts) <= intervals.count() <= 2 * (len(changes) + len(starts))
    reports = spark.createDataFrame([(first + dt.timedelta(days=n),) for n in range(-5, days + 5)], "obs_date date")
    got = {(r.entity_id, r.report_date): (r.ytd_cost, r.mtd_cost) for r in rollups.at_dates(intervals, reports).collect()}
    want = {}
    for e in "abcdef":
        own = [(d, c or 0.0) for x, d, c in rows if x == e and d is not None]
        for n in range(-5, days + 5):
            day = first + dt.timedelta(days=n)
            seen = [(d, c) for d, c in own if d <= day and year(d) == year(day)]
            if seen:
                month = sum(c for d, c in seen if (d.year, d.month) == (day.year, day.month))
                want[e, day] = (sum(c for _, c in seen), month)
    assert got == want


def test_unit_cost_is_null_without_mass(spark):
    costs = spark.createDataFrame([(D(2024, 1, 1), 10.0), (D(2024, 1, 2), 5.0)], "obs_date date, cost double")
    mass = spark.createDataFrame([(D(2024, 1, 2), 4.0)], "obs_date date, est_removed_mass double")
    site = spark.createDataFrame([(D(2024, 1, 1), 1.0)], "obs_date date, site_cost double")
    got = {r.obs_date: (r.ytd_total_cost, r.ytd_cost_per_kg) for r in rollups.period_totals_unit_cost(costs, mass, site).collect()}
    assert got == {D(2024, 1, 1): (11.0, None), D(2024, 1, 2): (16.0, 4.0)}


def test_status_rollup_lists_every_code(spark):
    df = spark.createDataFrame([("a", day(0), 3, 2.0), ("b", day(0), 3, None), ("c", day(0), 0, None), ("d", day(1), None, 1.0)],
                               "entity_id string, obs_date date, status_code int, mass_corrected double")
    got = {(r.obs_date, r.status_code): (r.entity_count, r.mass_corrected) for r in rollups.status_rollup(df).collect()}
    assert len(got) == 14
    assert got[day(0), 3] == (2, 2.0) and got[day(0), 0] == (1, 0.0) and got[day(1), 3] == (0, 0.0)


def test_active_mass_fills_two_rows_not_over_inactive(spark):
    rows = [("a", day(n), act, m) for n, (act, m) in enumerate([(True, 5.0), (True, None), (True, None), (True, None), (False, None), (True, None), (True, 7.0)])]
    df = with_day_no(spark.createDataFrame(rows, "entity_id string, obs_date date, active boolean, mass_corrected double"))
    got = [r.active_mass for r in rollups.active_mass_filled(df).orderBy("obs_date").collect()]
    assert got == [5.0, 5.0, 5.0, 0.0, 0.0, 0.0, 7.0]


def test_linear_trend_recovers_a_line(spark):
    rows = [("g", day(n), 3.0 - 0.25 * n) for n in range(20)]
    df = spark.createDataFrame(rows, "grp string, obs_date date, q double")
    line = rollups.linear_trend(df, "q", ["grp"]).first()
    first = (day(0) - D(1970, 1, 1)).days
    assert line.slope == pytest.approx(-0.25) and line.intercept + line.slope * first == pytest.approx(3.0)


def test_prior_day_takes_the_first_positive_source(spark):
    site = spark.createDataFrame([(day(0), 0.0, 7.0, None), (day(1), 3.0, 7.0, "ok"), (day(2), None, None, "")],
                                 "obs_date date, a double, b double, notes string")
    got = {r.obs_date: (r.volume, r.only, r.notes) for r in marts.prior_day_summary(site, {"volume": ["a", "b"], "only": ["a"]}, "notes").collect()}
    assert got == {day(1): (7.0, 0.0, ""), day(2): (3.0, 3.0, "ok"), day(3): (0.0, 0.0, "")}


def test_expenses_are_added_up_behind_the_shuffle(spark):
    rng = random.Random(8)
    costs = [(rng.choice(["a", "b", None]), rng.choice([day(n * 17) for n in range(20)] + [None]), rng.randint(0, 9) / 2, rng.randint(0, 4) / 4) for _ in range(80)]
    masses = [(rng.choice(["a", "b", "c", None]), rng.choice([day(n * 17) for n in range(20)] + [None]), float(rng.randint(0, 5))) for _ in range(50)]
    sides = [
        spark.createDataFrame(costs, "entity_id string, obs_date date, in_1_cost double, in_2_cost double"),
        spark.createDataFrame(masses, "entity_id string, obs_date date, est_removed_mass double"),
    ]
    per_day = [df.groupBy("entity_id", "obs_date").agg(*(F.sum(c).alias(c) for c in df.columns[2:])) for df in sides]
    # Between the union of both sides and the next shuffle no task may hold sums per entity and day once more.
    plan = marts.expense_intervals(*sides)._jdf.queryExecution().executedPlan().toString().splitlines()
    above = plan[: next(k for k, line in enumerate(plan) if line.lstrip(" :+-").startswith("Union"))]
    nearest = next(line for line in reversed(above) if "Exchange" in line or "Aggregate" in line)
    assert "Exchange" in nearest
    for given in (sides, per_day):
        got = {(r.entity_id, r.report_date): tuple(r[c] for c in ("ytd_cost", "mtd_cost", "ytd_est_removed_mass", "mtd_est_removed_mass")) for r in marts.expense_overview(*given).collect()}
        want = {}
        for at in {r[1] for r in costs if r[1]}:
            began = D(at.year - (at.month < 9), 9, 1)
            for e in ("a", "b", "c", None):
                mine = [(d, x + y, 0.0) for k, d, x, y in costs if k == e and d and began <= d <= at]
                mine += [(d, 0.0, m) for k, d, m in masses if k == e and d and began <= d <= at]
                if mine:
                    month = [r for r in mine if r[0] >= at.replace(day=1)]
                    want[e, at] = (sum(r[1] for r in mine), sum(r[1] for r in month), sum(r[2] for r in mine), sum(r[2] for r in month))
        assert got == want
