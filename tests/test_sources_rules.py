"""Scans, sheets, labels, measures and classification rules."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from catalog import views as v
from daygrid.durable import freeze
from daygrid.functions import cleaning, labels, measures
from daygrid.functions.days import with_day_no
from daygrid.operators import classify
from daygrid.plans import load
from daygrid.sources import headers, scans, sheets
from support import DATA

D = dt.date


def day(n: int) -> dt.date:
    return D(2024, 1, 1) + dt.timedelta(days=n)


def labelled(spark, rows):
    return spark.createDataFrame([r if len(r) == 3 else (*r, "1.5", "2.5") for r in rows],
                                 "sample_label string, val_text string, val_total_text string")


@pytest.mark.parametrize(
    "label, want",
    [
        ("Pond 0104 240105 rpt", ("0104", D(2024, 1, 5))),
        ("301 240105", ("0301", D(2024, 1, 5))),
        ("0104 691231", ("0104", D(1969, 12, 31))),
        ("S 12345 240105 rpt", ("12345", D(2024, 1, 5))),
        ("S 123456 240105", ("123456", D(2024, 1, 5))),
        ("S 301 of 240105", ("0301", D(2024, 1, 5))),
        ("240105 S 0104", None),
        ("x0104 240105", None),
        ("0104-240105", None),
        ("0104 undated", None),
        ("0104 241305", None),
        ("20240105 0104", None),
        (None, None),
    ],
)
def test_labels(spark, label, want):
    got = [(r.entity_id, r.obs_date) for r in labels.parse_sample_labels(labelled(spark, [(label,)])).collect()]
    assert got == ([want] if want else [])


def test_label_values_and_known_entities(spark):
    rows = [("0101 240105", "0", "2"), ("0101 240105", "n/d", "2"), ("0101 240105", "1.5", None),
            ("0101 240105", "1.5", "0"), ("0999 240105", "1.5", "2"), ("0101 240105", "0.0", "2"), ("0101 240105", "nan", "2")]
    known = spark.createDataFrame([("0101",)], "entity_id string")
    got = labels.parse_sample_labels(labelled(spark, rows), entities=known).collect()
    assert [(r.quality_val, r.quality_total) for r in got] == [(1.5, 0.0)]
    scaled = labels.parse_sample_labels(labelled(spark, [("0101 240105", "0.25", "0.5")]), scale=100).collect()
    assert [(r.quality_val, r.quality_total) for r in scaled] == [(25.0, 50.0)]


def test_mass_of_large_and_small_units(spark):
    rows = [("0101", 0.5, 14.0, 80.0), ("0106", 0.5, 14.0, 80.0), ("0208", 0.4, 14.0, None), ("0101", 0.0, 14.0, 80.0), ("0101", 0.5, 10.0, 80.0)]
    df = spark.createDataFrame(rows, "entity_id string, density double, depth double, purity_pct double")
    small, large, low, empty, drained = measures.mass_volume(df).collect()
    assert small.mass == round(0.5 * 35000 * 3.78541 * 14 / 1000, 2) and small.removable_inches == 3.5
    assert (small.removable_gallons, large.removable_gallons) == (122500.0, 245000.0)
    assert large.mass == round(0.5 * 35000 * 3.78541 * 2 * 14 / 1000, 2)
    assert small.mass_corrected == round(small.mass * 0.8, 2)
    assert low.mass is not None and low.mass_corrected is None and low.removable_inches is None
    assert empty.mass is None and drained.removable_mass is None


def test_costs(spark):
    df = spark.createDataFrame([("a", 2.0, None)], "entity_id string, in_1 double, in_7 double")
    got = measures.cost_by_rate(df, {"in_1": 2.08, "in_7": 49.07}).first()
    assert (got.in_1_cost, got.in_7_cost) == (4.16, 0.0)
    site = measures.linear_cost(spark.createDataFrame([(10.0,), (None,)], "u double"), "u").collect()
    assert [r.site_cost for r in site] == [1.5]


def test_nan_becomes_null(spark):
    df = cleaning.nan_to_null(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, n int"))
    assert [r.x for r in df.orderBy("n").collect()] == [None, 2.0]


def test_status_limits(spark):
    cases = [(False, 0.9, 4.0, 0), (True, None, 4.0, 1), (True, 0.9, None, 1), (True, 0.24, 4.0, 2), (True, 0.25, 2.4, 3),
             (True, 0.49, 4.0, 4), (True, 0.5, 2.9, 4), (True, 0.5, 3.0, 5), (True, 0.79, 3.0, 5), (True, 0.8, 3.0, 6), (None, 0.8, 3.0, 6)]
    rows = [(f"{i:04d}", day(0), *c) for i, c in enumerate(cases)]
    df = with_day_no(spark.createDataFrame(rows, "entity_id string, obs_date date, active boolean, density double, quality_val double, want int"))
    assert all(r.status_code == r.want for r in classify.status_code(df).collect())


def test_status_density_carries_two_rows(spark):
    rows = [("a", day(n), True, 0.9 if n == 0 else None, 4.0) for n in range(4)] + [("b", day(0), True, 0.9, 4.0), ("b", day(1), False, None, 4.0), ("b", day(2), True, None, 4.0)]
    df = with_day_no(spark.createDataFrame(rows, "entity_id string, obs_date date, active boolean, density double, quality_val double"))
    got = {(r.entity_id, r.obs_date): r.status_code for r in classify.status_code(df).collect()}
    assert [got["a", day(n)] for n in range(4)] == [6, 6, 6, 1]
    assert [got["b", day(n)] for n in range(3)] == [6, 0, 1]


def test_missing_indicators_count_as_zero(spark):
    names = [i[0] for i in classify.INDICATORS]
    df = spark.createDataFrame([tuple([None] * 9), (90.0, 8.0, 1.0, 0.0, 0.0, 0.0, 0.5, 0.4, 0.0)], ", ".join(f"{n} double" for n in names))
    got = [r.f for r in df.select(classify.indicator_flags().alias("f")).collect()]
    assert got == [["%N", "pH"], ["R", "D"]]


def test_buckets(spark):
    df = spark.createDataFrame([(1.99, True), (2.0, True), (3.0, True), (None, True), (5.0, False), (5.0, None)], "q double, a boolean")
    got = [r.b for r in df.select(classify.value_bucket(F.col("q"), F.col("a")).alias("b")).collect()]
    assert got == ["red", "yellow", "green", "grey", "inactive", "inactive"]


def test_scan_prunes_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(day(n), f"{n:04d}", float(n), "x") for n in range(10)]
    spark.createDataFrame(rows, "obs_date date, entity_id string, density double, notes string").write.partitionBy("obs_date").parquet(path)
    got = scans.scan_date_range(spark.read.parquet(path), day(2), day(4), ["density"])
    assert got.columns == ["obs_date", "entity_id", "density"] and got.count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(obs_date" in plan and "ReadSchema: struct<entity_id:string,density:double>" in plan
    with pytest.raises(ValueError):
        scans.scan_date_range(got, day(50), day(60), raise_if_empty=True)
    assert scans.scan_date_range(spark.read.parquet(path), D(1888, 1, 1), D(4000, 1, 1), clamp=True).count() == 10


def test_scan_filter_reaches_parquet(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    plan = scans.scan_date_range(orders, D(1995, 1, 1), D(1996, 1, 1), ["o_orderkey"], date="o_orderdate")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_date_text_round_trip(spark):
    df = spark.createDataFrame([("2024-01-05", "x"), ("2024-13-05", "y"), ("soon", "z")], "run_date string, note string")
    read = scans.dates_from_text(df)
    assert [r.run_date for r in read.orderBy("note").collect()] == [D(2024, 1, 5), None, None]
    assert scans.dates_to_text(read).orderBy("note").first().run_date == "2024-01-05"
    with pytest.raises(ValueError):
        scans.dates_to_text(df)


def test_months_and_monthly_files(spark):
    got = [tuple(r) for r in scans.months_in_range(spark, D(2023, 11, 30), D(2024, 2, 1)).collect()]
    assert got == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]
    names = ["2023/12_December Pond Log.xlsx", "2024/02_february  pond log (2).XLSX", "2024/03_March Pond Log.xlsx", "2024/01_Jan Pond Log.xlsx", "2024/01_January Notes.xlsx"]
    files = spark.createDataFrame([(n,) for n in names], "path string")
    picked = scans.pick_files_by_date(files, D(2023, 12, 15), D(2024, 2, 1), "pond log", monthly=True)
    assert {(r.path, r.file_date) for r in picked.collect()} == {(names[0], D(2023, 12, 1)), (names[1], D(2024, 2, 1))}


def test_rows_of_dated_files(spark, tmp_path):
    for folder, name in (("2024/01_January", "240105 Daily Data.csv"), ("2024/01_January", "240106 daily data v2.csv"),
                         ("2024/02_February", "240201 Daily Data.csv"), ("2024/01_January", "240107 Notes.csv")):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / name).write_text(f"entity_id,x\n0101,{name[4:6]}\n")
    df = spark.read.option("recursiveFileLookup", "true").schema("entity_id string, x int").csv(str(tmp_path), header=True)
    got = scans.scan_dated_files(df, day(4), day(20), "Daily Data").collect()
    assert {(r.x, r.file_date) for r in got} == {(5, day(4)), (6, day(5))}


def test_source_choice():
    names = ["2017", "2018", "2019 (old)", "Notes"]
    assert sheets.select_sources(names, ignore=["2017", "SUBSTRING[(old)]"]) == ["2018", "Notes"]
    assert sheets.select_sources(names, include=["2018", "none"]) == ["2018"]
    assert sheets.select_sources(names) == names
    with pytest.raises(ValueError):
        sheets.select_sources(names, include=["2018"], ignore=["2017"])


def test_reconcile_equals_fold(spark):
    rng = random.Random(2)
    for _ in range(4):
        content = {s: {k: rng.choice([None, None, 0.0, 1.0, 2.0]) for k in range(rng.choice([1, 3, 5]))} for s in "ABC"}
        schema = "k int, obs_date date, m double"
        frames = {s: spark.createDataFrame([(k, day(0), x) for k, x in rows.items()], schema) for s, rows in content.items()}
        best = None
        for s in "ABC":
            size = sum(1 for x in content[s].values() if x)
            if best is None or best[1] == 0 or size > best[1]:
                best = (s, size)
        got = {r.k: (r.m, r.m_source) for r in sheets.reconcile_columns(frames, ["k", "obs_date"]).collect()}
        keys = {k for rows in content.values() for k in rows}
        assert got == {k: (content[best[0]].get(k), best[0]) for k in keys}


def test_reconciled_range_equals_its_days(spark):
    rng = random.Random(8)
    schema = "entity_id string, obs_date date, m double, n double"
    value = lambda: rng.choice([None, 0.0, 1.0, 2.0])
    content = {s: [(f"{k}", day(d), value(), value()) for k in range(rng.choice([1, 3])) for d in range(6)] for s in "ABC"}
    frames = {s: spark.createDataFrame(rows, schema) for s, rows in content.items()}
    keys = ["entity_id", "obs_date"]
    together = sorted(map(str, sheets.reconcile_columns(frames, keys).collect()))
    alone = []
    for d in range(6):
        one = {s: f.filter(F.col("obs_date") == F.lit(day(d))) for s, f in frames.items()}
        alone += map(str, sheets.reconcile_columns(one, keys).collect())
    assert together == sorted(alone)


def test_days_on_a_timestamp_column_count_whole(spark):
    stamps = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 10), dt.datetime(2024, 1, 2, 23, 59, 59), dt.datetime(2024, 1, 3)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame([(s, i) for i, s in enumerate(stamps)], f"ts {kind}, n int")
        got = scans.scan_date_range(df, day(0), day(1), date="ts").collect()
        assert sorted(r.n for r in got) == [0, 1, 2]
        assert sorted(r.n for r in scans.scan_one_date(df, day(1), date="ts").collect()) == [1, 2]
        assert sorted(r.n for r in scans.range_between(df, {"ts": (day(1), day(1)), "n": (2, 9)}).collect()) == [2]


def test_merge_needs_distinct_columns(spark):
    a = spark.createDataFrame([("x", 1)], "k string, m int")
    with pytest.raises(ValueError, match="m"):
        sheets.merge_on_key([a, a], ["k"])


def test_serial_dates_are_judged_by_all_rows(spark):
    rows = [(i, 45000 + i if i != 30 else 999999, 45000 + i if i % 2 else 12, i * 100, None) for i in range(40)]
    df = spark.createDataFrame(rows, "row_no int, seen int, mixed int, amount int, none int")
    assert sheets.serial_date_columns(df) == ["seen"]
    assert sheets.serial_date_columns(df.filter("row_no < 3")) == ["seen"]
    assert sheets.serial_date_columns(df.limit(0)) == []
    got = {r.row_no: r.seen for r in sheets.infer_serial_dates(df).collect()}
    assert got[0] == D(2023, 3, 15) and got[30] is None and len(got) == 40


def test_measurement_payload_from_sheets(spark):
    lab = spark.createDataFrame([("0101 (Media Only)", day(0), 0.0, 1.0, "q"), ("0102", day(0), 0.5, 2.0, "r"), (None, day(0), 9.0, 9.0, "s")],
                                "Pond string, obs_date date, density double, ph double, junk string")
    field = spark.createDataFrame([("0102", day(0), 11.0, 2.0), ("0103", day(0), 12.0, 0.0)], "Pond string, obs_date date, depth double, ph double")
    notes = spark.createDataFrame([("n",)], "remark string")
    got, dropped = load.measurement_payload({"Lab": lab, "Field": field, "Notes": notes}, ["density", "depth", "ph", "media_only"], rename={"Pond": "entity_id"})
    rows = {r.entity_id: (r.density, r.depth, r.ph, r.media_only, r.entity_group) for r in got.collect()}
    assert rows == {"0101": (None, None, 1.0, True, "1"), "0102": (0.5, 11.0, 2.0, False, "2"), "0103": (None, 12.0, None, False, "3")}
    assert dropped == ["junk"]


def test_site_payloads(spark):
    usage = spark.createDataFrame([(day(0), 10.0, 1), (day(1), None, 2), (day(40), 5.0, 3)], "obs_date date, usage_qty double, other int")
    got = load.site_usage_payload({"2023": usage, "2024 (old)": usage}, day(0), day(9), ignore=["SUBSTRING[(old)]"]).collect()
    assert [(r.obs_date, r.usage_qty, r.site_cost) for r in got] == [(day(0), 10.0, 1.5)]
    figures = load.processing_payload(usage, day(0), day(2))
    assert figures.count() == 3
    keys = load.missing_day_keys(usage, spark.createDataFrame([("0101",)], "entity_id string"), day(0), day(2)).collect()
    assert [(r.entity_id, r.obs_date) for r in keys] == [("0101", day(2))]


def test_freeze_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    class Frame:
        sparkSession = Session()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        freeze(Frame())


def test_ids_longer_than_the_pad_stay_apart(spark):
    df = spark.createDataFrame([(7,), (12345,), (123456,)], "n long")
    assert [r.p for r in df.select(v.padded(F.col("n")).alias("p")).collect()] == ["0007", "12345", "123456"]


@pytest.mark.parametrize(
    "name, clean",
    [("Depth (in)", "Depth"), (" pH ", "pH"), ("AFDW (Filter)", "AFDW (Filter)"), ("AFDW (g/L) (filtered)", "AFDW (g/L) (filtered)"),
     ("a (x) b (y)", "a b"), ("two   spaces", "two spaces"), ("()", "")],
)
def test_clean_header(name, clean):
    assert headers.clean_header(name) == clean


def test_headers_of_a_sheet(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5, 6)], "a int, b int, c int, d int, e int, f int")
    df = df.toDF("Pond", "Unnamed: 1", " Notes", "Depth (in)", "we.ird `x` (g/L)", "_c5")
    out = headers.clean_headers(df, "Lab", {"Pond": "entity_id"})
    assert out.columns == ["entity_id", "Notes-Lab", "Depth", "we.ird `x`"] and tuple(out.first()) == (1, 3, 4, 5)
    same = df.select("Pond", "Depth (in)").toDF("Depth (in)", "Depth (cm)")
    with pytest.raises(ValueError, match="Depth"):
        headers.clean_headers(same, "Lab")


def test_folded_headers(spark):
    rows = [(0, None, "Sample", None), (1, "x", " y  z ", None), (2, "w", None, " "), (3, "1", "2", "3"), (4, None, "4", None)]
    df = spark.createDataFrame(rows, "n int, a string, b string, c string")
    out = headers.fold_headers(df, "n", rows=3)
    assert out.columns == ["n", "x", "Sample"] and sorted(map(tuple, out.collect())) == [(3, "1", "2"), (4, None, "4")]
    with pytest.raises(ValueError, match="one name"):
        headers.fold_headers(df.withColumn("d", F.col("b")), "n", rows=3)
