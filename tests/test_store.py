"""Keyed writes, the scheduled run, and late data."""

from __future__ import annotations

import datetime as dt
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from catalog import views as v
from daygrid.durable import Scratch, freeze, settled, shared_folder
from daygrid.operators.state import active_status
from daygrid.plans import daily, store
from daygrid.sources import tables
from daygrid.sources.scans import scan_date_range
from support import DATA

D = dt.date


def _rows(df, *columns):
    return {tuple(r[c] for c in columns[:2]): tuple(r[c] for c in columns[2:]) for r in df.collect()}


@pytest.fixture()
def measurements(spark, tmp_path):
    path = str(tmp_path / "measurements")
    schema = tables.SCHEMAS["measurements"]
    tables.create_table(spark, path, schema)
    first = spark.createDataFrame(
        [("0101", D(2024, 1, 1), 0.5, 10.0), ("0101", D(2024, 1, 2), 0.6, 11.0), ("0202", D(2024, 1, 5), 0.7, 12.0)],
        "entity_id string, obs_date date, density double, depth double",
    )
    assert tables.upsert_table(spark, path, first, schema, densified=False)
    return path, schema


def test_upsert_replaces_only_payload_columns_and_keeps_other_partitions(spark, measurements):
    path, schema = measurements
    payload = spark.createDataFrame(
        [("0101", D(2024, 1, 2), None), ("0303", D(2024, 1, 3), 0.9)], "entity_id string, obs_date date, density double"
    )
    assert tables.upsert_table(spark, path, payload, schema, densified=False)
    got = _rows(tables.read_table(spark, path, schema), "entity_id", "obs_date", "density", "depth")
    assert got == {
        ("0101", D(2024, 1, 1)): (0.5, 10.0),
        ("0101", D(2024, 1, 2)): (None, 11.0),
        ("0303", D(2024, 1, 3)): (0.9, None),
        ("0202", D(2024, 1, 5)): (0.7, 12.0),
    }


def test_upsert_twice_is_upsert_once(spark, measurements):
    path, schema = measurements
    payload = spark.createDataFrame(
        [("0101", D(2024, 1, 1), 0.1), ("0404", D(2024, 1, 4), 0.2)], "entity_id string, obs_date date, density double"
    )
    tables.upsert_table(spark, path, payload, schema)
    once = sorted(map(str, tables.read_table(spark, path, schema).collect()))
    tables.upsert_table(spark, path, payload, schema)
    assert sorted(map(str, tables.read_table(spark, path, schema).collect())) == once
    # Densified: both entities on all four days, and the untouched row of another entity.
    assert len(once) == 2 * 4 + 1


def test_densified_keys_null_existing_values(spark, measurements):
    path, schema = measurements
    payload = spark.createDataFrame(
        [("0101", D(2024, 1, 1), 0.1), ("0101", D(2024, 1, 3), 0.3)], "entity_id string, obs_date date, density double"
    )
    tables.upsert_table(spark, path, payload, schema)
    got = _rows(tables.read_table(spark, path, schema), "entity_id", "obs_date", "density", "depth")
    assert got[("0101", D(2024, 1, 2))] == (None, 11.0)


def test_duplicate_key_leaves_table_alone(spark, measurements):
    path, schema = measurements
    before = sorted(map(str, tables.read_table(spark, path, schema).collect()))
    payload = spark.createDataFrame(
        [("0101", D(2024, 1, 1), 0.1), ("0101", D(2024, 1, 1), 0.2)], "entity_id string, obs_date date, density double"
    )
    assert tables.upsert_table(spark, path, payload, schema) is False
    assert sorted(map(str, tables.read_table(spark, path, schema).collect())) == before
    assert tables.upsert_table(spark, path, payload.limit(0), schema) is False


def test_unknown_column_is_rejected(spark, measurements):
    path, schema = measurements
    payload = spark.createDataFrame([("0101", D(2024, 1, 1), 0.1)], "entity_id string, obs_date date, colour double")
    with pytest.raises(ValueError, match="colour"):
        tables.upsert_table(spark, path, payload, schema)


def test_site_payload_is_densified_by_day(spark):
    payload = spark.createDataFrame([(D(2024, 1, 1), 1.0), (D(2024, 1, 4), 2.0)], "obs_date date, usage_qty double")
    got = tables.densify_payload(payload, keys=("obs_date",)).orderBy("obs_date").collect()
    assert [r.usage_qty for r in got] == [1.0, None, None, 2.0]


def test_scheduled_run_equals_rebuild(spark, tmp_path):
    """Two runs ten days apart, the second seeded by the first, give the rebuilt rows."""
    root = str(tmp_path)
    readings, samples, entities = v.daily_obs(spark, DATA), v.samples(spark, DATA), v.entities(spark, DATA)
    for day in (D(2024, 1, 20), D(2024, 1, 30)):
        new = readings.filter(F.col("obs_date") <= day)
        done = store.run(
            spark, root, {"measurements": [new]}, samples.filter(F.col("obs_date") <= day), day, day, entities
        )
        assert all(done.values()), done
    got = scan_date_range(store.stored(spark, root, "calculated"), D(2024, 1, 20), D(2024, 1, 30))
    whole = daily.derive(readings, samples, entities=entities)
    want = scan_date_range(whole, D(2024, 1, 20), D(2024, 1, 30))
    # The grid of the run begins before the first reading; there 8 days back exist where the rebuild has none.
    columns = ["entity_id", "obs_date", "active", "mass", "est_removed_mass", "est_split_mass", "days_since_event",
               "status_code"]
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    quality = scan_date_range(store.stored(spark, root, "quality"), D(2024, 1, 20), D(2024, 1, 30))
    columns = ["entity_id", "obs_date", "quality_val", "measured_on", "is_measured"]
    assert sorted(map(str, quality.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    dates = [r.obs_date for r in store.stored(spark, root, "available_dates").orderBy("obs_date").collect()]
    assert dates == [D(2024, 1, 20), D(2024, 1, 30)]


def test_seeded_run_carries_old_quality(spark):
    """A sample older than what a run reads still counts, by way of the stored table."""
    rng = random.Random(4)
    start, units = D(2024, 1, 1), ["0101", "0206", "0303"]
    rows, tests = [], []
    for e in units:
        for n in range(160):
            day = start + dt.timedelta(days=n)
            if rng.random() < 0.8:
                noon = dt.datetime(day.year, day.month, day.day, 12)
                code = "HC" if e == "0206" and n == 120 else "H" if rng.random() < 0.05 else None
                rows.append((e, day, round(rng.uniform(0.3, 0.9), 2), 12.0, 90.0, None, noon, code))
            if n in (5, 70):
                tests.append((e, day, 3.0 + n / 100, 5.0))
    measurements = spark.createDataFrame(
        rows, "entity_id string, obs_date date, density double, depth double, purity_pct double, removed_volume double, "
              "sampled_at timestamp_ntz, move_code string")
    samples = spark.createDataFrame(tests, "entity_id string, obs_date date, quality_val double, quality_total double")
    entities = spark.createDataFrame([(e,) for e in units], "entity_id string")
    end = start + dt.timedelta(days=155)
    whole = daily.derive(measurements, samples, start, end, entities)
    earlier = F.col("obs_date") <= end - dt.timedelta(days=20)
    stored = tuple(daily.tables(whole)[name].filter(earlier) for name in ("quality", "calculated"))
    day = end - dt.timedelta(days=1)
    columns = ["entity_id", "obs_date", "quality_val", "measured_on", "is_measured", "status_code", "growth_14d",
               "days_since_event", "est_removed_mass"]
    first = day - dt.timedelta(days=10)
    seeded = daily.derive(measurements, samples, first, day, entities, stored).select(*columns)
    plain = daily.derive(measurements, samples, first, day, entities).select(*columns)
    got = sorted(map(str, seeded.collect()))
    assert got == sorted(map(str, plain.collect())) and len(got) == 33
    assert any("2024, 3, 11" in r for r in got), "values must stem from the sample of day 70"


READINGS = ("entity_id string, obs_date date, density double, depth double, purity_pct double, removed_volume double, "
            "sampled_at timestamp_ntz, move_code string")


def _quiet_days(spark, days):
    start = D(2024, 1, 1)
    rows = []
    for n in range(days):
        day = start + dt.timedelta(days=n)
        rows.append(("0101", day, 0.6, 12.0, 90.0, None, dt.datetime(day.year, day.month, day.day, 9), None))
    return spark.createDataFrame(rows, READINGS), spark.createDataFrame([("0101",)], "entity_id string")


def test_a_long_quiet_time_is_counted_across_runs(spark, tmp_path):
    readings, entities = _quiet_days(spark, 130)
    samples = spark.createDataFrame([], "entity_id string, obs_date date, quality_val double, quality_total double")
    last = D(2024, 1, 1) + dt.timedelta(days=129)
    root = str(tmp_path)
    for day in (last - dt.timedelta(days=12), last - dt.timedelta(days=4), last):
        new = readings.filter(F.col("obs_date") <= F.lit(day))
        store.run(spark, root, {"measurements": [new]}, samples, day, day, entities)
    got = {r.obs_date: r.days_since_event for r in store.stored(spark, root, "calculated").collect()}
    assert got[last] == 130 and got[last - dt.timedelta(days=5)] == 125
    rebuilt = daily.rebuild(readings, samples, entities)["calculated"].filter(F.col("obs_date") == F.lit(last)).first()
    assert rebuilt.days_since_event == 130


@pytest.mark.parametrize("idle", [False, True])
def test_a_sample_that_comes_late_counts(spark, idle):
    readings, entities = _quiet_days(spark, 150)
    if idle:
        readings = readings.filter((F.col("obs_date") < "2024-03-10") | (F.col("obs_date") > "2024-03-20"))
    schema = "entity_id string, obs_date date, quality_val double, quality_total double"
    old = spark.createDataFrame([("0101", D(2024, 1, 3), 3.5, 5.0)], schema)
    both = old.union(spark.createDataFrame([("0101", D(2024, 2, 29), 9.9, 12.0)], schema))
    day = D(2024, 1, 1) + dt.timedelta(days=149)
    start = day - dt.timedelta(days=15)
    left = daily.tables(daily.derive(readings, old, entities=entities))
    before = F.col("obs_date") < F.lit(start)
    stored = (left["quality"].filter(before), left["calculated"].filter(before))
    columns = ["obs_date", "quality_val", "measured_on", "status_code", "days_since_event"]
    got = daily.derive(readings, both, start, day, entities, stored).select(*columns)
    want = scan_date_range(daily.derive(readings, both, entities=entities), start, day).select(*columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r.quality_val for r in got.collect()} == ({None} if idle else {9.9})


def test_rejected_movements_are_kept_or_stop_the_run(spark, tmp_path):
    readings, entities = _quiet_days(spark, 20)
    odd = F.col("obs_date") == F.lit(D(2024, 1, 15))
    readings = readings.withColumn("move_code", F.when(odd, "Q"))
    samples = spark.createDataFrame([], "entity_id string, obs_date date, quality_val double, quality_total double")
    day = D(2024, 1, 20)
    root = str(tmp_path / "a")
    store.run(spark, root, {"measurements": [readings]}, samples, day, day, entities)
    got = store.rejected_moves(spark, root, D(2024, 1, 10), day).collect()
    assert [(r.obs_date, r.move_code) for r in got] == [(D(2024, 1, 15), "Q")]
    with pytest.raises(Exception, match="no movement rule for 0101"):
        store.run(spark, str(tmp_path / "b"), {"measurements": [readings]}, samples, day, day, entities, strict=True)


def _whole_batch(spark, path, schema, density, name="b1"):
    """A batch that replaces all densities, whole beside the table, its writer dead."""
    rows = spark.read.schema(schema).parquet(path).select(*schema.fieldNames()).withColumn("density", F.lit(density))
    rows = spark.createDataFrame(rows.collect(), schema)
    folder = f"{path}.batches/{name}"
    rows.withColumn("_changed", F.lit(True)).write.partitionBy("obs_date").parquet(folder)
    return folder


def _files(path):
    return sorted(os.path.join(d, n) for d, _, found in os.walk(path) for n in found)


def test_readers_see_a_whole_batch_and_never_write(spark, measurements):
    path, schema = measurements
    folder = _whole_batch(spark, path, schema, 9.0)
    before = _files(path)
    assert {r.density for r in tables.read_table(spark, path, schema).collect()} == {9.0}
    assert tables.stored_dates(spark, path) == [D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 5)]
    assert _files(path) == before and os.path.exists(folder)
    # Without the mark of a finished write it does not count.
    os.remove(f"{folder}/_SUCCESS")
    assert {r.density for r in tables.read_table(spark, path, schema).collect()} == {0.5, 0.6, 0.7}


def test_a_dead_writers_batch_is_completed_by_the_next(spark, measurements):
    path, schema = measurements
    _whole_batch(spark, path, schema, 9.0)
    os.makedirs(f"{path}.batches/b0")
    seen = []
    new = spark.createDataFrame([("0101", D(2024, 1, 1), 0.1)], "entity_id string, obs_date date, density double")
    assert tables.upsert_table(spark, path, new, schema, seen=lambda keys: seen.append({tuple(r) for r in keys.collect()}))
    assert {r.density for r in tables.read_table(spark, path, schema).collect()} == {9.0, 0.1}
    assert seen == [
        {("0101", D(2024, 1, 1)), ("0101", D(2024, 1, 2)), ("0202", D(2024, 1, 5))}, {("0101", D(2024, 1, 1))},
    ]
    # The newest batch stays for readers that began with it.
    assert len(os.listdir(f"{path}.batches")) == 1 and not os.path.exists(f"{path}.claim")


def test_one_session_reads_while_another_completes(spark, measurements, monkeypatch):
    path, schema = measurements
    other = spark.newSession()
    payload = spark.createDataFrame(
        [("0101", D(2024, 1, 1), 7.0), ("0101", D(2024, 1, 2), 7.0), ("0202", D(2024, 1, 5), 7.0)],
        "entity_id string, obs_date date, density double",
    )
    looks, frames = [], []

    def look(keys=None):
        frames.append(tables.read_table(other, path, schema))
        looks.append(sorted(r.density for r in frames[-1].collect()))

    def half_way(spark, file, text=""):
        if file.endswith("_REPLACED"):
            # One of the replaced partitions is gone for a moment, as while a writer swaps its files.
            os.rename(f"{path}/obs_date=2024-01-02", f"{path}-aside")
            look()
            os.rename(f"{path}-aside", f"{path}/obs_date=2024-01-02")
        return plain(spark, file, text)

    plain = tables.create_file
    monkeypatch.setattr(tables, "create_file", half_way)
    assert tables.upsert_table(spark, path, payload, schema, densified=False, seen=look)
    # The batch is whole when its keys are shown, and all of it is seen from then on.
    assert looks == [[7.0] * 3, [7.0] * 3]
    # Frames that began with the batch can still be read.
    assert [sorted(r.density for r in f.collect()) for f in frames] == looks
    assert sorted(r.density for r in tables.read_table(other, path, schema).collect()) == [7.0] * 3


def test_one_writer_at_a_time(spark, measurements):
    path, schema = measurements
    new = spark.createDataFrame([("0101", D(2024, 1, 1), 0.1)], "entity_id string, obs_date date, density double")
    with tables.claimed(spark, path):
        with pytest.raises(tables.TableBusyError):
            tables.upsert_table(spark.newSession(), path, new, schema)
        assert tables.read_table(spark, path, schema).count() == 3
        # A claim that is old enough counts as a dead writer's.
        assert tables.upsert_table(spark, path, new, schema, stale=-1.0)
    assert not os.path.exists(f"{path}.claim")


def test_only_days_that_change_are_replaced(spark, measurements):
    path, schema = measurements
    before = _files(path)
    payload = spark.createDataFrame(
        [("0101", D(2024, 1, 1), 0.5), ("0101", D(2024, 1, 2), 0.9), ("0202", D(2024, 1, 5), 0.7)],
        "entity_id string, obs_date date, density double",
    )
    seen = []
    tables.upsert_table(spark, path, payload, schema, densified=False, seen=lambda keys: seen.extend(map(tuple, keys.collect())))
    assert seen == [("0101", D(2024, 1, 2))]
    changed = set(before) ^ set(_files(path))
    assert changed and all("obs_date=2024-01-02" in f or "_SUCCESS" in f for f in changed)
    assert tables.upsert_table(spark, path, payload, schema, densified=False)


# ---- late rows ---------------------------------------------------------------

CHECKED = ["entity_id", "obs_date", "active", "mass", "est_removed_mass", "est_split_mass", "days_since_event", "status_code",
           "mass_change_grams_7d", "growth_5d", "growth_14d"]
SHOWN = ["entity_id", "obs_date", "quality_val", "measured_on", "is_measured"]


def _history(spark, units, days, seed=6):
    rng = random.Random(seed)
    rows, tests = [], []
    for e in units:
        for n in range(days):
            day = D(2024, 1, 1) + dt.timedelta(days=n)
            if rng.random() < 0.85:
                noon = dt.datetime(day.year, day.month, day.day, 12)
                code = "H" if rng.random() < 0.04 else None
                rows.append((e, day, round(rng.uniform(0.3, 0.9), 2), 12.0, 90.0, None, noon, code))
            if rng.random() < 0.03:
                tests.append((e, day, round(rng.uniform(2, 5), 2), 6.0))
    return rows, tests


def _frames(spark, rows, tests):
    readings = spark.createDataFrame(rows, READINGS)
    return readings, spark.createDataFrame(tests, "entity_id string, obs_date date, quality_val double, quality_total double")


def _close(got, want):
    """Rows equal, doubles to nine places."""
    def plain(rows):
        return sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in rows)

    return plain(got) == plain(want)


def _equals_rebuild(spark, root, rows, tests, entities, first, last):
    readings, samples = _frames(spark, rows, tests)
    whole = daily.tables(daily.derive(readings, samples, entities=entities))
    for name, columns in (("calculated", CHECKED), ("quality", SHOWN), ("site_growth", ["obs_date", "mass_change_grams_7d", "agg_growth_14d"])):
        got = scan_date_range(store.stored(spark, root, name), first, last).select(*columns).collect()
        want = scan_date_range(whole[name], first, last).select(*columns).collect()
        assert len(got) == len(want) > 0 and _close(got, want), name


UNITS = ["0101", "0206", "0303", "0404"]


@pytest.fixture(scope="module")
def derived_store(spark, tmp_path_factory):
    """A store whose tables were built over 170 days."""
    root = str(tmp_path_factory.mktemp("store"))
    rows, tests = _history(spark, UNITS, 170)
    readings, samples = _frames(spark, rows, tests)
    entities = spark.createDataFrame([(e,) for e in UNITS], "entity_id string")
    store.save(spark, root, "measurements", readings, densified=False)
    store.rebuild_tables(spark, root, samples, entities)
    return root, rows, tests


@pytest.fixture()
def a_store(derived_store, tmp_path):
    root = str(tmp_path / "store")
    shutil.copytree(derived_store[0], root)
    return root, list(derived_store[1]), list(derived_store[2])


DAY = D(2024, 1, 1) + dt.timedelta(days=172)


def _spoilt(root, name, before):
    """Make files of older partitions unreadable."""
    n = 0
    for file in _files(f"{root}/{name}"):
        if "obs_date=" in file and file.endswith(".parquet") and dt.date.fromisoformat(file.split("obs_date=")[1][:10]) < before:
            os.chmod(file, 0o644)
            crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
            with open(file, "wb") as f:
                f.write(b"not parquet")
            n += 1
    return n


def _fresh(units, rng_seed=3):
    rng = random.Random(rng_seed)
    days = [DAY - dt.timedelta(days=n) for n in range(3)]
    return [(e, d, round(rng.uniform(0.3, 0.9), 2), 12.0, 90.0, None, dt.datetime(d.year, d.month, d.day, 12), None) for e in units for d in days]


def test_a_new_entity_leaves_old_partitions_of_the_rest_alone(spark, a_store):
    root, rows, tests = a_store
    new = _fresh([*UNITS, "0909"])
    entities = spark.createDataFrame([(e,) for e in [*UNITS, "0909"]], "entity_id string")
    payload, samples = _frames(spark, new, tests)
    old = D(2024, 1, 1) + dt.timedelta(days=90)
    assert _spoilt(root, "measurements", old) > 80 and _spoilt(root, "calculated", old) > 80
    done = store.run(spark, root, {"measurements": [payload]}, samples, DAY, DAY, entities)
    assert all(done.values())
    first = DAY - dt.timedelta(days=15)
    rest = [(e,) for e in UNITS]
    want = daily.tables(daily.derive(*_frames(spark, [*rows, *new], tests), entities=spark.createDataFrame([*rest, ("0909",)], "entity_id string")))
    got = scan_date_range(store.stored(spark, root, "calculated"), first, DAY).select(*CHECKED)
    assert _close(got.collect(), scan_date_range(want["calculated"], first, DAY).select(*CHECKED).collect())


def test_late_rows_of_one_entity_are_derived_again(spark, a_store):
    """Corrected and added readings 60 days back: the entity from there on equals a rebuild, others are not read for it."""
    root, rows, tests = a_store
    late_day = D(2024, 1, 1) + dt.timedelta(days=110)
    late = [(e, d, 0.88 if e == "0206" and d == late_day else x, *rest) for e, d, x, *rest in rows if e == "0206" and d >= late_day][:4]
    late = [r for r in late if r[1] <= late_day + dt.timedelta(days=4)]
    if not any(r[1] == late_day for r in late):
        late.append(("0206", late_day, 0.88, 12.0, 90.0, None, dt.datetime(late_day.year, late_day.month, late_day.day, 12), "H"))
    late = [(*r[:7], "H" if r[1] == late_day else r[7]) for r in late]
    new = _fresh(UNITS)
    entities = spark.createDataFrame([(e,) for e in UNITS], "entity_id string")
    frames = [spark.createDataFrame(part, READINGS) for part in (new, late)]
    samples = _frames(spark, rows, tests)[1]
    assert _spoilt(root, "measurements", D(2024, 1, 1) + dt.timedelta(days=20)) > 10
    done = store.run(spark, root, {"measurements": frames}, samples, DAY, DAY, entities)
    assert all(done.values())
    keyed = {(r[0], r[1]): r for r in [*rows, *new, *late]}
    _equals_rebuild(spark, root, list(keyed.values()), tests, entities, late_day - dt.timedelta(days=15), DAY)
    assert not os.path.exists(f"{root}/late_days") and not os.path.exists(f"{root}/run.claim")


def test_rebuild_in_segments_equals_one_pass(spark, a_store):
    """Every table of 170 days from segments of 45; then a late range alone, with older readings out of reach."""
    root, rows, tests = a_store
    entities = spark.createDataFrame([(e,) for e in UNITS], "entity_id string")
    samples = _frames(spark, rows, tests)[1]
    for name in ("calculated", "quality", "site_growth"):
        shutil.rmtree(f"{root}/{name}")
    done = store.rebuild_tables(spark, root, samples, entities, segment_days=45)
    assert set(done) == {"calculated", "quality", "site_growth", "expenses", "available_dates"} and all(done.values())
    first, last = min(r[1] for r in rows), max(r[1] for r in rows)
    _equals_rebuild(spark, root, rows, tests, entities, first, last)
    start = last - dt.timedelta(days=20)
    assert _spoilt(root, "measurements", start - dt.timedelta(days=daily.READ_LOOKBACK)) > 80
    for name in ("calculated", "quality", "site_growth"):
        for folder in os.listdir(f"{root}/{name}"):
            if folder >= f"obs_date={start}":
                shutil.rmtree(f"{root}/{name}/{folder}", ignore_errors=True)
    store.rebuild_range(spark, root, samples, entities, start, last, segment_days=8)
    _equals_rebuild(spark, root, rows, tests, entities, start, last)


def test_ranges_are_cut_by_partition_names(spark, a_store):
    root, rows, _ = a_store
    days = sorted({r[1] for r in rows})
    assert tables.stored_dates(spark, f"{root}/measurements") == days
    assert _spoilt(root, "measurements", days[-1]) > 100
    got = store.stored_range(spark, root, "measurements", days[-1], D(2030, 1, 1), ["density"])
    assert {r.obs_date for r in got.collect()} == {days[-1]}
    assert store.stored_range(spark, root, "measurements", D(2029, 1, 1), D(2030, 1, 1)).count() == 0


def test_a_run_that_died_is_made_good_by_the_next(spark, a_store, monkeypatch):
    root, rows, tests = a_store
    late_day = D(2024, 1, 1) + dt.timedelta(days=120)
    late = [("0303", late_day, 0.31, 12.0, 90.0, None, dt.datetime(late_day.year, late_day.month, late_day.day, 12), "H")]
    new = _fresh(UNITS)
    entities = spark.createDataFrame([(e,) for e in UNITS], "entity_id string")
    payload, samples = _frames(spark, [*new, *late], tests)
    plain = store.derive
    monkeypatch.setattr(store, "derive", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.run(spark, root, {"measurements": [payload.filter(F.col("obs_date") == F.lit(late_day)), payload.filter(F.col("obs_date") > F.lit(late_day))]}, samples, DAY, DAY, entities)
    monkeypatch.setattr(store, "derive", plain)
    store.run(spark, root, {}, samples, DAY, DAY, entities)
    keyed = {(r[0], r[1]): r for r in [*rows, *new, *late]}
    _equals_rebuild(spark, root, list(keyed.values()), tests, entities, late_day - dt.timedelta(days=15), DAY)


def test_readings_never_derived_and_late_samples(spark, a_store):
    """An entity that was not listed before, with readings of 150 days, and a sample that comes 50 days late."""
    root, rows, tests = a_store
    more, _ = _history(spark, ["0707"], 150, seed=11)
    store.save(spark, root, "measurements", spark.createDataFrame(more, READINGS), densified=False)
    shutil.rmtree(f"{root}/first_days", ignore_errors=True)
    day = D(2024, 1, 1) + dt.timedelta(days=120)
    late = [("0404", day, 9.25, 11.0)]
    new, all_units = _fresh(UNITS), [*UNITS, "0707"]
    entities = spark.createDataFrame([(e,) for e in all_units], "entity_id string")
    tests = [t for t in tests if t[:2] != ("0404", day)] + late
    payload, samples = _frames(spark, new, tests)
    store.run(spark, root, {"measurements": [payload]}, samples, DAY, DAY, entities, new_samples=_frames(spark, new, late)[1])
    _equals_rebuild(spark, root, [*rows, *more, *new], tests, entities, day - dt.timedelta(days=15), DAY)


def test_scratch_folders_go(spark):
    with Scratch(spark) as scratch:
        frozen = scratch.freeze(spark.range(5))
        folder = scratch.folders[0].removeprefix("file:")
        assert frozen.count() == 5 and os.path.exists(folder)
    assert not os.path.exists(folder)


def test_a_settled_result_leaves_no_tables_behind(spark):
    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))

    def build():
        return freeze(freeze(spark.range(5)).withColumn("x", F.col("id") * 2))

    out = settled(spark, build)
    left = set(os.listdir(shared_folder(spark).removeprefix("file:"))) - before
    assert [r.x for r in out.orderBy("id").collect()] == [0, 2, 4, 6, 8] and [n[:7] for n in left] == ["result-"]
    plain = spark.range(3)
    assert settled(spark, lambda: plain) is plain


def test_rebuild_writes_all_tables(spark, tmp_path):
    root = str(tmp_path)
    payload = v.daily_obs(spark, DATA).withColumn("in_1", F.lit(2.0))
    store.save(spark, root, "measurements", payload)
    done = store.rebuild_tables(spark, root, v.samples(spark, DATA), v.entities(spark, DATA))
    assert done == dict.fromkeys(["calculated", "quality", "site_growth", "expenses", "available_dates"], True)
    days = store.stored(spark, root, "measurements").select("obs_date").distinct().count()
    assert store.stored(spark, root, "available_dates").count() == days
    assert store.stored(spark, root, "expenses").agg(F.max("in_1_cost")).first()[0] == 4.16


def test_stored_tables_are_shuffled_once(spark, tmp_path):
    for name, columns in (("m", "density double, depth double, purity_pct double, removed_volume double, "
                                "sampled_at timestamp_ntz, move_code string"), ("s", "quality_val double, quality_total double")):
        empty = spark.createDataFrame([], f"entity_id string, obs_date date, {columns}")
        empty.write.parquet(str(tmp_path / name))
    measurements, samples = spark.read.parquet(str(tmp_path / "m")), spark.read.parquet(str(tmp_path / "s"))
    bounds = (F.lit(D(2024, 1, 1)), F.lit(D(2024, 2, 1)))
    plan = daily.derive(measurements, samples, bounds=bounds)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_a_busy_entity_is_reduced_before_the_shuffle(spark):
    plan = v.daily_obs(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("partial_sum"), plan.index("Exchange hashpartitioning")
    assert exchange < partial, "the plan prints from the result down: partial sums lie below the shuffle"


def test_reports_are_written_by_date(spark, tmp_path):
    first = spark.createDataFrame([(D(2024, 1, 1), "a", 1), (D(2024, 1, 2), "a", 2)], "obs_date date, entity_id string, x int")
    store.save_reports(str(tmp_path), {"health": first})
    store.save_reports(str(tmp_path), {"health": first.filter("x = 2").withColumn("x", F.lit(9))})
    got = spark.read.parquet(str(tmp_path / "report_health"))
    assert {(r.obs_date, r.x) for r in got.collect()} == {(D(2024, 1, 1), 1), (D(2024, 1, 2), 9)}


def test_range_run_equals_union_of_day_runs_with_lookback(spark):
    state = active_status(v.grid(spark, DATA)).select("entity_id", "obs_date", "active")
    want = sorted(map(str, scan_date_range(state, D(2024, 1, 20), D(2024, 1, 22)).collect()))
    got = []
    for day in (D(2024, 1, 20), D(2024, 1, 21), D(2024, 1, 22)):
        part = scan_date_range(v.grid(spark, DATA), day - dt.timedelta(days=6), day)
        got += map(str, scan_date_range(active_status(part).select("entity_id", "obs_date", "active"), day, day).collect())
    assert sorted(got) == want


def test_rebuild_of_one_table(spark, tmp_path):
    root = str(tmp_path)
    store.save(spark, root, "measurements", v.daily_obs(spark, DATA))
    done = store.rebuild_tables(spark, root, v.samples(spark, DATA), v.entities(spark, DATA), only="calculated")
    assert done == {"calculated": True}
    assert store.stored(spark, root, "calculated").count() == 450
