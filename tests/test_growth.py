"""Growth per entity and site against plain loops."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daygrid.functions.days import with_day_no
from daygrid.functions.measures import LITERS_PER_INCH
from daygrid.operators import growth
from test_grid_fill import loop_fill

D = dt.date
SCHEMA = (
    "entity_id string, obs_date date, density double, depth double, active boolean, mass_corrected double, "
    "est_removed_mass double, est_split_mass double"
)


def day(n: int) -> dt.date:
    return D(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for e in range(30):
        quiet = rng.random() < 0.6
        for n in range(40):
            if not quiet and rng.random() < 0.03:
                continue
            gap = rng.random() < 0.25
            density = None if gap else round(rng.uniform(0.3, 0.9), 3)
            depth = None if gap or rng.random() < 0.05 else round(rng.uniform(8, 14), 2)
            mass = round(density * depth * 100, 2) if density and depth and rng.random() < 0.95 else None
            removed = round(rng.uniform(0, 50), 2) if rng.random() < 0.12 else None
            split = round(rng.uniform(1, 30), 2) if rng.random() < 0.06 else None
            active = True if quiet else rng.choice([True] * 14 + [False, None])
            out.append((f"{e:04d}", day(n), density, depth, active, mass, removed, split))
    return out


def total(values, need=1):
    known = [x for x in values if x is not None]
    return sum(known) if len(known) >= need else None


def ratio(a, b):
    return None if a is None or not b else a / b


def loop_growth(rows):
    """One entity's rows in day order -> {date: growth columns}."""
    moved = [bool((r[6] or 0) > 0 or (r[7] or 0) > 0) for r in rows]
    reset = [m and not r[5] for m, r in zip(moved, rows)]
    none = [False] * len(rows)
    volume = [r[3] * LITERS_PER_INCH if r[2] and r[3] else None for r in rows]
    norm = [v * r[2] / 0.5 if v is not None else None for v, r in zip(volume, rows)]
    liters, norm, mass = (loop_fill(c, reset, none, 5, 5) for c in (volume, norm, [r[5] for r in rows]))
    present = {r[1]: r[4] for r in rows}
    act = {r[1]: i for i, r in enumerate(rows) if r[4] is True}

    def corrected(col):
        out = {}
        for d, i in act.items():
            if moved[i]:
                nxt = act.get(d + dt.timedelta(days=1))
                out[d] = None if nxt is None else col[nxt]
            else:
                out[d] = col[i]
        return out

    hc_l, hc_n, hc_m = corrected(liters), corrected(norm), corrected(mass)
    order = sorted(act)
    before = {d: order[k - 1] if k else None for k, d in enumerate(order)}

    def shifted_sum(d, at):
        near = [x for x in order if d - dt.timedelta(days=5) <= x <= d]
        return total([None if before[x] is None else (rows[act[before[x]]][at] or 0.0) for x in near])

    base = {}
    for d in order:
        week = d - dt.timedelta(days=7)
        span = [d - dt.timedelta(days=k) for k in range(8)]
        valid = all(x in present for x in span) and not any(present[x] is False for x in span)
        parts = [shifted_sum(d, 6), shifted_sum(d, 7), mass[act[d]], hc_m.get(week)]
        kg = None if None in parts else parts[0] + parts[1] + parts[2] - parts[3]
        change = (kg if kg is not None and kg > 0 else 0.0) * 1000
        base[d] = (change, hc_l.get(week), hc_n.get(week)) if valid else (None, None, None)
    out = {}
    for d in order:
        cols = list(base[d])
        for span in (5, 14):
            near = [base[x] for x in order if d - dt.timedelta(days=span - 1) <= x <= d]
            change, volume_, norm_ = (total([b[k] for b in near], span) for k in range(3))
            cols += [ratio(change, volume_), ratio(change, norm_)]
        out[d] = cols
    return out


def test_growth_equals_loop(spark, rows):
    df = with_day_no(spark.createDataFrame(rows, SCHEMA))
    got = {(r.entity_id, r.obs_date): [r[c] for c in growth.GROWTH_COLUMNS] for r in growth.growth_per_entity(df).collect()}
    assert len(got) == len(rows)
    seen = 0
    for key in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == key]
        want = loop_growth(mine)
        for r in mine:
            expected = want.get(r[1], [None] * 7)
            for g, e in zip(got[key, r[1]], expected):
                assert g == (None if e is None else pytest.approx(e, rel=1e-9)), (key, r[1], got[key, r[1]], expected)
            seen += expected[5] is not None
    assert seen > 50, "the data must reach the 14-day ratio"


def test_original_columns_stay(spark, rows):
    df = with_day_no(spark.createDataFrame(rows, SCHEMA))
    same = growth.growth_per_entity(df).select(*df.columns)
    assert sorted(map(str, same.collect())) == sorted(map(str, df.collect()))


def test_zero_denominator_is_null(spark):
    daily = spark.createDataFrame([(day(n), 1.0, 0.0, 2.0) for n in range(6)],
                                  "obs_date date, mass_change_grams_7d double, prev_liters_7d double, prev_norm_liters_7d double")
    got = growth.site_ratios(daily).orderBy("obs_date").collect()
    assert [r.agg_growth_5d for r in got] == [None] * 6
    assert [r.agg_norm_growth_5d for r in got] == [None] * 4 + [0.5, 0.5]
    assert all(r.agg_growth_14d is None for r in got)


def test_trailing_by_day_skips_missing_days(spark):
    days = [0, 1, 2, 3, 4, 6, 7, 20]
    daily = spark.createDataFrame([(day(n), float(n)) for n in days], "obs_date date, x double")
    got = {r.obs_date: r.x_5d for r in growth.trailing_by_day(daily, ("x",), (5,)).collect()}
    assert got == {day(n): (10.0 if n == 4 else None) for n in days}


def test_all_null_day_sums_to_zero(spark):
    df = spark.createDataFrame([(day(0), None), (day(0), None), (day(1), 2.5)], "obs_date date, x double")
    assert {r.obs_date: r.x for r in growth.sum_by_day(df, ("x",)).collect()} == {day(0): 0.0, day(1): 2.5}


def test_growth_has_one_shuffle(spark, rows):
    df = with_day_no(spark.createDataFrame(rows, SCHEMA))
    plan = growth.growth_per_entity(df).select(F.col("growth_14d"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
