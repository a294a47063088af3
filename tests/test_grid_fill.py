"""Grid and fill against plain loops on random gappy data."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daygrid.functions.days import at_offset, by_entity, trailing_sum, with_day_no
from daygrid.operators import grid
from daygrid.operators.fill import UNLIMITED, blocked_fill

D = dt.date
BASE = D(2024, 1, 1)


def day(n: int) -> dt.date:
    return BASE + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def gappy():
    """Rows (entity, day, value, flag_a, flag_b) with missing days and missing values."""
    rng = random.Random(7)
    rows = []
    for e in range(40):
        for n in range(30):
            if rng.random() < 0.8:
                value = None if rng.random() < 0.5 else round(rng.uniform(1, 9), 2)
                rows.append((f"{e:04d}", day(n), value, rng.random() < 0.12, rng.random() < 0.12))
    return rows


def frame(spark, rows):
    return with_day_no(spark.createDataFrame(rows, "entity_id string, obs_date date, v double, a boolean, b boolean"))


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {k: sorted(v, key=lambda r: r[1]) for k, v in out.items()}


def loop_fill(values, reset, block, backward, forward):
    """Sentinels walked cell by cell: "M" is cleared between the passes, "I" after both."""
    cells = ["M" if r else "I" if k else v for v, r, k in zip(values, reset, block)]

    def carry(cells, limit):
        out, last, age = [], None, 0
        for c in cells:
            if c is not None:
                last, age = c, 0
                out.append(c)
            else:
                age += 1
                out.append(last if last is not None and age <= limit else None)
        return out

    if backward:
        cells = carry(cells[::-1], backward)[::-1]
    cells = [None if c == "M" else c for c in cells]
    if forward:
        cells = carry(cells, forward)
    return [None if c == "I" else c for c in cells]


@pytest.mark.parametrize("backward, forward", [(0, 2), (5, 5), (0, 10**6), (3, 0)])
def test_fill_equals_loop(spark, gappy, backward, forward):
    limit = UNLIMITED if forward == 10**6 else forward
    filled = blocked_fill(
        frame(spark, gappy), ["v"], by_entity(), backward=backward, forward=limit, block=F.col("b"), reset=F.col("a")
    )
    got = {(r.entity_id, r.obs_date): r.v for r in filled.collect()}
    for key, rows in by_key(gappy).items():
        want = loop_fill([r[2] for r in rows], [r[3] for r in rows], [r[4] for r in rows], backward, forward)
        assert [got[key, r[1]] for r in rows] == want


def test_block_can_differ_by_column(spark):
    rows = [("x", day(0), 1.0, False, False), ("x", day(1), None, False, True), ("x", day(2), None, False, False)]
    df = frame(spark, rows).withColumn("u", F.col("v"))
    got = blocked_fill(df, ["v", "u"], by_entity(), forward=5, block={"v": F.col("b")}).orderBy("day_no").collect()
    assert [r.v for r in got] == [1.0, None, None]
    assert [r.u for r in got] == [1.0, 1.0, 1.0]


def test_densify_holds_every_entity_and_day_once(spark, gappy):
    got = grid.densify(frame(spark, gappy)).collect()
    days = {r[1] for r in gappy}
    span = (max(days) - min(days)).days + 1
    assert len(got) == 40 * span == len({(r.entity_id, r.obs_date) for r in got})
    have = {(r[0], r[1]): r[2] for r in gappy}
    assert all(r.v == have.get((r.entity_id, r.obs_date)) for r in got)
    assert all(r.day_no == (r.obs_date - D(1970, 1, 1)).days for r in got)


def test_densify_on_listed_entities_and_range(spark, gappy):
    listed = spark.createDataFrame([("0001",), ("0002",), ("none",)], "entity_id string")
    got = grid.densify(frame(spark, gappy), day(-2), day(9), listed).collect()
    want = {(e, day(n)) for e in ("0001", "0002", "none") for n in range(-2, 10)}
    assert len(got) == len(want) and {(r.entity_id, r.obs_date) for r in got} == want
    have = {(r[0], r[1]): r[2] for r in gappy}
    assert all(r.v == have.get((r.entity_id, r.obs_date)) for r in got)


def test_densify_range_starting_on_a_fact(spark):
    facts = spark.createDataFrame([("a", day(0), 1.0), ("a", day(3), 2.0)], "entity_id string, obs_date date, v double")
    listed = spark.createDataFrame([("a",)], "entity_id string")
    got = sorted((r.obs_date, r.v) for r in grid.densify(facts, day(0), day(3), listed).collect())
    assert [v for _, v in got] == [1.0, None, None, 2.0]


def test_offset_lookup_and_trailing_sum_count_calendar_days(spark, gappy):
    w = by_entity()
    got = frame(spark, gappy).select(
        "entity_id", "obs_date", at_offset(F.col("v"), w, -7).alias("p"), at_offset(F.col("v"), w, 1).alias("n"),
        trailing_sum(F.col("v"), w, 5, 2).alias("s"),
    )
    have = {(r[0], r[1]): r[2] for r in gappy}
    for r in got.collect():
        assert r.p == have.get((r.entity_id, r.obs_date - dt.timedelta(days=7)))
        assert r.n == have.get((r.entity_id, r.obs_date + dt.timedelta(days=1)))
        near = [have.get((r.entity_id, r.obs_date - dt.timedelta(days=k))) for k in range(5)]
        near = [x for x in near if x is not None]
        assert r.s == (pytest.approx(sum(near)) if len(near) >= 2 else None)


def test_missing_days_are_scaffolded(spark):
    facts = spark.createDataFrame([("a", day(0)), ("b", day(0)), ("a", day(2))], "entity_id string, obs_date date")
    units = spark.createDataFrame([("a",), ("b",)], "entity_id string")
    got = grid.scaffold_missing_days(facts, units, day(0), day(3)).collect()
    assert {(r.entity_id, r.obs_date) for r in got} == {(e, day(n)) for e in "ab" for n in (1, 3)} and len(got) == 4


def test_grid_plan_has_one_shuffle_and_no_join(spark, gappy):
    plan = grid.densify(frame(spark, gappy), day(0), day(29))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
