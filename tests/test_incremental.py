import datetime

import pytest
from pyspark.sql import functions as F

from aerolake import snapshots
from aerolake.operators.incremental import merge_frames, new_rows, upsert
from aerolake.plans import build, dims, fact, staging, telemetry
from aerolake.session import fresh_path

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_new_rows_first_load_and_mark(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-03")], "id int, ts string")
    empty = spark.createDataFrame([], "ingestion_timestamp string")
    assert new_rows(df, "ts", None).count() == 2
    assert new_rows(df, "ts", empty).count() == 2          # NULL mark = first load
    target = spark.createDataFrame([("2024-01-02",)], "ingestion_timestamp string")
    assert [r.id for r in new_rows(df, "ts", target).collect()] == [2]


def test_merge_newest_wins_regardless_of_order(spark):
    tgt = spark.createDataFrame([("a", 5, "t"), ("b", 1, "t")], "k string, ts int, src string")
    old = spark.createDataFrame([("a", 3, "b"), ("c", 2, "b")], "k string, ts int, src string")
    assert _rows(merge_frames(tgt, old, "k")) == [("a", 3, "b"), ("b", 1, "t"), ("c", 2, "b")]
    assert _rows(merge_frames(tgt, old, "k", ["ts"])) == [("a", 5, "t"), ("b", 1, "t"), ("c", 2, "b")]
    tie = spark.createDataFrame([("a", 5, "b"), ("a", 5, "b2")], "k string, ts int, src string")
    assert _rows(merge_frames(tgt, tie, "k", ["ts"])) == [("a", 5, "b"), ("a", 5, "b2"), ("b", 1, "t")]


def test_first_and_later_loads_follow_one_rule(spark):
    batch = spark.createDataFrame([("a", 1, "old", 1), ("a", 2, "new", 1)], "k string, ts int, v string, p int")
    other = spark.createDataFrame([("z", 1, "z", 1)], batch.schema)
    path = fresh_path(spark, "rule")
    upsert(spark, path, batch, "k", "p", order_by="ts")
    assert _rows(snapshots.read(spark, path).select("k", "v")) == [("a", "new")]
    upsert(spark, path, other, "k", "p", order_by="ts")
    assert _rows(snapshots.read(spark, path).select("k", "v")) == [("a", "new"), ("z", "z")]


def test_null_partition_survives(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "k string, d date")
    path = fresh_path(spark, "nullpart")
    day = datetime.date(2024, 1, 1)
    upsert(spark, path, rows(("k1", None), ("k2", day)), "k", "d")
    upsert(spark, path, rows(("k3", None), ("k4", day)), "k", "d")
    assert sorted(r.k for r in snapshots.read(spark, path).collect()) == ["k1", "k2", "k3", "k4"]


def test_upsert_refuses_other_columns(spark):
    path = fresh_path(spark, "cols")
    upsert(spark, path, spark.createDataFrame([("a", 1)], "k string, p int"), "k", "p")
    with pytest.raises(ValueError, match="extra"):
        upsert(spark, path, spark.createDataFrame([("b", 1, 2)], "k string, p int, extra int"), "k", "p")
    assert snapshots.read(spark, path).count() == 1


def test_upsert_quarantines_null_keys(spark):
    path = fresh_path(spark, "quarantine")
    df = spark.createDataFrame([(None, 1, "x"), ("a", 1, "y")], "k string, p int, v string")
    for _ in range(2):                      # a repeated run replaces what it set aside
        out = upsert(spark, path, df, "k", "p", on_null_key="quarantine", run_id="r")
        assert (out["batch_rows"], out["rejected_rows"]) == (1, 1)
    assert spark.read.parquet(f"{path}_rejected").count() == 1
    assert upsert(spark, path, df.limit(0), "k", "p")["batch_rows"] == 0
    assert snapshots.read(spark, path).count() == 1


def _full_fact(spark):
    return fact.fct_flights(staging.stg_flights(telemetry.bronze(spark, SF)), dims.dim_airports(spark),
                            n_airports=dims.N_AIRPORTS)


def test_upsert_twice_equals_once(spark):
    f = _full_fact(spark)
    p1, p2 = fresh_path(spark, "once"), fresh_path(spark, "twice")
    upsert(spark, p1, f, "flight_pk", "flight_date")
    upsert(spark, p2, f, "flight_pk", "flight_date")
    upsert(spark, p2, f, "flight_pk", "flight_date")
    cols = fact.FACT_COLUMNS
    assert _rows(snapshots.read(spark, p1).select(*cols)) == _rows(snapshots.read(spark, p2).select(*cols)) \
        == _rows(f.select(*cols))


@pytest.mark.parametrize("cuts", [["2024-01-10", "2024-01-20"], ["2024-01-05"]])
def test_incremental_slices_equal_full_build(spark, cuts):
    """Loads arrive in slices of insert time; every run dedups all of bronze
    so far, builds only rows past the mark and upserts them."""
    bronze = telemetry.bronze(spark, SF)
    airports = dims.dim_airports(spark)
    path = fresh_path(spark, "slices")
    bounds = cuts + ["2100-01-01"]
    for b in bounds:
        so_far = bronze.filter(F.col("inserted_at") < F.lit(b).cast("timestamp_ntz"))
        stg = staging.stg_flights(so_far)
        target = snapshots.read(spark, path) if b != bounds[0] else None
        batch = fact.fct_flights(new_rows(stg, "inserted_at", target), airports, n_airports=dims.N_AIRPORTS)
        upsert(spark, path, batch, "flight_pk", "flight_date")
    cols = fact.FACT_COLUMNS
    assert _rows(snapshots.read(spark, path).select(*cols)) == _rows(_full_fact(spark).select(*cols))


def test_upsert_rejects_null_keys(spark):
    df = spark.createDataFrame([(None, "2024-01-01")], "flight_pk string, flight_date string")
    with pytest.raises(Exception, match="NULL flight_pk"):
        upsert(spark, fresh_path(spark, "nullkey"), df, "flight_pk", "flight_date")


def test_build_star_materialisations_agree(spark):
    raw = telemetry.bronze(spark, SF)
    a = build.build_star(spark, raw, materialize=True).star()
    b = build.build_star(spark, raw, materialize=False).star()
    assert _rows(a) == _rows(b)


def test_upsert_by_date_and_hour_equals_by_date(spark):
    f = _full_fact(spark)
    half = f.filter(F.col("hour_24") < 12)
    p1, p2 = fresh_path(spark, "byday"), fresh_path(spark, "byhour")
    for p, parts in ((p1, "flight_date"), (p2, ["flight_date", "hour_24"])):
        upsert(spark, p, half, "flight_pk", parts)
        upsert(spark, p, f, "flight_pk", parts, order_by="ingestion_timestamp")
    cols = fact.FACT_COLUMNS
    assert _rows(snapshots.read(spark, p1).select(*cols)) == _rows(snapshots.read(spark, p2).select(*cols)) \
        == _rows(f.select(*cols))


@pytest.mark.parametrize("mark", [None, "2024-01-01 00:00:00", "2024-01-09 13:05:00", "2024-01-29 23:00:00",
                                  "2030-01-01 00:00:00"])
def test_filter_before_dedup_equals_filter_after(spark, mark):
    from aerolake.operators.incremental import newer_than
    raw = telemetry.bronze(spark, SF)
    after = newer_than(staging.stg_flights(raw), "inserted_at", mark)
    before = staging.stg_flights_since(raw, mark)
    assert _rows(after) == _rows(before)
