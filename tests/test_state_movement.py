"""State, runs and movements against row-by-row loops and hand-made edge frames."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from daygrid.functions.days import by_entity, with_day_no
from daygrid.operators import movement, state

D = dt.date


def day(n: int) -> dt.date:
    return D(2024, 1, 1) + dt.timedelta(days=n)


SCHEMA = (
    "entity_id string, obs_date date, sampled_at timestamp_ntz, density double, fo double, move_code string, "
    "active boolean, est_removed_mass double, est_split_mass double"
)


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(11)
    rows = []
    for e in range(60):
        for n in range(30):
            if rng.random() < 0.15:
                continue
            sampled = dt.datetime(2024, 1, 1) if rng.random() < 0.35 else None
            density = rng.choice([None, 0.0, 0.4])
            fo = rng.choice([None, 0.0, 3.0])
            code = rng.choice([None] * 8 + ["HC", "H", "I", "S", "H", "HC"])
            active = rng.choice([True, True, True, False, None])
            rows.append(
                (f"{e:04d}", day(n), sampled, density, fo, code, active, rng.choice([None] * 6 + [5.0, 0.0]),
                 rng.choice([None] * 8 + [2.0]))
            )
    return rows


def groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def loop_status(rows, at):
    """Walk back from row ``at`` over the rows of the last five days."""
    window = [r for r in rows[: at + 1] if r[1] >= rows[at][1] - dt.timedelta(days=5)][::-1]
    for i, (_, _, sampled, density, fo, code, *_rest) in enumerate(window):
        older = window[i + 1][5] if i + 1 < len(window) else None
        if sampled is not None:
            if density or fo:
                return True
        elif older == "HC" or (code == "I" and older == "H"):
            return False
    return False


def test_active_status_equals_loop(spark, random_rows):
    df = with_day_no(spark.createDataFrame(random_rows, SCHEMA)).drop("active")
    got = {(r.entity_id, r.obs_date): r.active for r in state.active_status(df).collect()}
    for key, rows in groups(random_rows).items():
        for i, r in enumerate(rows):
            assert got[key, r[1]] == loop_status(rows, i), (key, r[1])


def test_inactive_gap_then_restart(spark):
    noon = dt.datetime(2024, 1, 1, 12)
    rows = [("x", day(0), noon, 0.5, None, "HC")] + [("x", day(n), None, None, None, None) for n in range(1, 4)]
    rows.append(("x", day(4), noon, 0.3, None, None))
    df = with_day_no(spark.createDataFrame(rows, "entity_id string, obs_date date, sampled_at timestamp_ntz, "
                                                 "density double, fo double, move_code string"))
    got = [r.active for r in state.active_status(df).orderBy("day_no").collect()]
    assert got == [True, False, False, False, True]


def test_continuity_equals_loop(spark, random_rows):
    df = with_day_no(spark.createDataFrame(random_rows, SCHEMA))
    got = {(r.entity_id, r.obs_date): r.ok for r in df.withColumn("ok", state.continuity(by_entity())).collect()}
    for key, rows in groups(random_rows).items():
        have = {r[1]: r[6] for r in rows}
        for r in rows:
            span = [r[1] - dt.timedelta(days=k) for k in range(8)]
            want = all(d in have for d in span) and not any(have[d] is False for d in span)
            assert got[key, r[1]] == want


def test_run_length_equals_loop(spark, random_rows):
    df = with_day_no(spark.createDataFrame(random_rows, SCHEMA))
    got = {(r.entity_id, r.obs_date): r.days_since_event for r in state.days_since_event(df).collect()}
    for key, rows in groups(random_rows).items():
        run = 0
        for r in rows:
            run = run + 1 if r[6] is True and r[7] is None and r[8] is None else 0
            assert got[key, r[1]] == (None if r[6] is False else run)


def test_prev_day_fallback(spark):
    rows = [
        ("a", day(0), True, 10.0, 0.5), ("a", day(1), True, None, 0.0), ("a", day(2), True, 8.0, None),
        ("b", day(0), True, None, 0.5), ("b", day(1), True, None, 0.4),
        ("c", day(0), True, 9.0, 0.5), ("c", day(1), False, None, None), ("c", day(3), True, 7.0, None),
    ]
    df = with_day_no(spark.createDataFrame(rows, "entity_id string, obs_date date, active boolean, depth double, density double"))
    got = {(r.entity_id, r.obs_date): (r.depth, r.density, r.non_current_depth, r.non_current_density)
           for r in state.prev_day_fallback(df).collect()}
    assert got["a", day(0)] == (10.0, 0.5, False, False)
    assert got["a", day(1)] == (10.0, 0.5, True, True)
    # The density of the day before counts although it is 0; the pair is then incomplete again.
    assert got["a", day(2)] == (None, None, False, False)
    assert got["b", day(1)] == (None, None, False, False)
    assert got["c", day(1)] == (None, None, None, None)
    assert got["c", day(3)] == (None, None, False, False)


MOVES = "entity_id string, obs_date date, move_code string, removed_volume double, split_volume double, mass_corrected double"


def moved(spark, rows):
    return with_day_no(spark.createDataFrame([("x", day(i), *r) for i, r in enumerate(rows)], MOVES))


@pytest.mark.parametrize(
    "rows, classes",
    [
        ([("H", None, None, 9.0), (None, None, None, 8.0)], ["H", None]),
        ([("h", None, None, 9.0), ("I", None, None, 8.0)], ["HC", None]),
        ([("HC", 5.0, None, 9.0), ("I", None, None, None)], ["HC", None]),
        ([("S", None, None, 9.0), ("I", None, None, None)], ["SC", None]),
        ([("SC", None, None, 9.0), (None, None, None, None)], ["SC", None]),
        ([(None, None, None, 9.0), ("I", None, None, None)], [None, None]),
        ([(None, 5.0, None, 9.0), ("I", None, None, None)], ["HC", None]),
        ([(None, 5.0, None, 9.0), (None, None, 4.0, 7.0), (None, None, None, 1.0)], ["H", "S", None]),
    ],
)
def test_movement_rules(spark, rows, classes):
    got = movement.movement_class(moved(spark, rows)).orderBy("day_no").collect()
    assert [r.move_class for r in got] == classes
    assert not any(r.move_unmatched for r in got)


def test_zero_volume_without_code_fits_no_rule(spark):
    df = moved(spark, [(None, 0.0, None, 9.0), (None, None, None, 9.0)])
    got = movement.movement_class(df).orderBy("day_no").collect()
    assert [(r.move_class, r.move_unmatched) for r in got] == [(None, True), (None, False)]
    with pytest.raises(Exception, match="no movement rule"):
        movement.movement_class(df, strict=True).collect()


def test_differential_uses_next_row_and_drops_negative(spark):
    rows = [("H", None, None, 9.0), ("S", None, None, 4.0), (None, None, None, 6.0), ("HC", None, None, 7.0), ("H", None, None, 3.0)]
    got = movement.mass_differential(movement.movement_class(moved(spark, rows))).orderBy("day_no").collect()
    assert [(r.move_class, r.est_removed_mass, r.est_split_mass) for r in got] == [
        ("H", 5.0, None), (None, None, None), (None, None, None), ("HC", 7.0, None), ("H", None, None),
    ]


def test_log_estimate_discards_readings_of_the_day(spark):
    rows = [("x", day(i), d, p, vol, act) for i, (d, p, vol, act) in enumerate(
        [(0.5, 100.0, None, True), (0.9, 50.0, 1000.0, True), (None, None, None, True), (0.7, 80.0, 1000.0, False)])]
    df = with_day_no(spark.createDataFrame(
        rows, "entity_id string, obs_date date, density double, purity_pct double, removed_volume double, active boolean"))
    got = movement.volume_log_estimate(df).orderBy("day_no").collect()
    # Day 1 uses the readings of day 0, inactive day 3 gets nothing.
    assert got[1].est_removed_log == pytest.approx(0.5 * 1.0 * 1000 * 3.78541 / 1000)
    assert got[3].est_removed_log is None and got[0].est_removed_log is None
    kept = movement.volume_log_estimate(df, reset_always=False).orderBy("day_no").collect()
    assert kept[1].est_removed_log == pytest.approx(0.9 * 0.5 * 1000 * 3.78541 / 1000)


def test_fallback_only_where_a_class_is_left(spark):
    df = spark.createDataFrame(
        [("a", "H", None, 3.0, None, None), ("b", None, None, 3.0, None, None), ("c", "H", 1.0, 3.0, None, None)],
        "entity_id string, move_class string, est_removed_mass double, est_removed_log double, est_split_mass double, est_split_log double",
    )
    got = {r.entity_id: r.est_removed_mass for r in movement.estimate_fallback(df).collect()}
    assert got == {"a": 3.0, "b": None, "c": 1.0}
