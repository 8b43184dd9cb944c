"""End to end: two daily batches through ingest -> load -> build, the second
carrying a newer copy of one signal; the fact keeps the newest and the
declared checks report as expected."""

import os

import pytest
from pyspark.sql import functions as F

from aerolake import jobs, loads, snapshots
from aerolake.session import fresh_path
from tests.fixtures import F1_AIRPORTS, F1_ROWS, write_document


def test_two_loads_end_to_end(spark, tmp_dir):
    day1, day2 = os.path.join(tmp_dir, "d1"), os.path.join(tmp_dir, "d2")
    os.makedirs(day1)
    os.makedirs(day2)
    write_document(os.path.join(day1, "flights_1.json"), F1_ROWS[:4])
    write_document(os.path.join(day1, "flights_2.json"), [])                      # empty batch file
    newer = list(F1_ROWS[2])
    newer[9] = 150.0                                                              # same signal, new speed
    write_document(os.path.join(day2, "flights_3.json"), F1_ROWS[4:] + [newer])
    pq, raw, root = fresh_path(spark, "pq"), fresh_path(spark, "raw"), fresh_path(spark, "wh")

    assert jobs.ingest(spark, day1, pq, "2026-01-29", "p1") == {
        "rows_in": 4, "malformed": 0, "bad_width": 0, "failed_casts": 0, "rows_out": 4}
    assert jobs.load(spark, pq, "2026-01-29", raw, "2026-01-29 10:00:00") == 4
    report1 = {(r.model, r.check_name, r.column_name): r.violations for r in jobs.build(spark, raw, root).collect()}
    assert jobs.ingest(spark, day2, pq, "2026-01-30")["rows_out"] == 3
    for _ in range(2):                                                            # a repeated load replaces itself
        assert jobs.load(spark, pq, "2026-01-30", raw, "2026-01-30 10:00:00") == 3
    assert jobs.load(spark, pq, "2026-02-01", raw) == 0                            # nothing landed that day
    assert jobs.read_mark(spark, root) == "2026-01-29 10:00:00"
    report2 = jobs.build(spark, raw, root).collect()
    assert jobs.read_mark(spark, root) == "2026-01-30 10:00:00"
    report3 = jobs.build(spark, raw, root).collect()                           # nothing new: no-op upsert
    assert jobs.read_mark(spark, root) == "2026-01-30 10:00:00" and len(report3) == 19 and all(r.passed for r in report3)

    fct = snapshots.read(spark, f"{root}/gold/fct_flights")
    assert fct.count() == 6
    assert fct.filter(F.col("aircraft_id") == "4851B3").first().speed_kmh == 150.0
    got = {r.aircraft_id: r.airport_code for r in fct.collect()}
    assert [got[r[0].upper()] for r in F1_ROWS] == F1_AIRPORTS
    ids = spark.read.parquet(raw).select("id_surrogate")
    assert ids.distinct().count() == 7
    # declared suite: all pass except the lower-case status vocabulary is matched case-insensitively
    assert all(r.passed for r in report2), [r for r in report2 if not r.passed]
    assert len(report2) == 19 and report1[("fct_flights", "unique", "flight_pk")] == 0


def test_incremental_builds_equal_a_full_build(spark):
    """Bronze loaded in three slices with a build after each equals one
    full build of the star over all of bronze (silver, dims and fact)."""
    from aerolake.plans import build as B
    from aerolake.plans import telemetry
    from aerolake.plans.fact import FACT_COLUMNS
    bronze = telemetry.bronze(spark, "/root/testdata/sf0.001")
    raw, root = fresh_path(spark, "raw"), fresh_path(spark, "wh")
    cuts = ["2024-01-08", "2024-01-20", "2100-01-01"]
    prev = "1900-01-01"
    for cut in cuts:
        part = bronze.filter((F.col("inserted_at") >= F.lit(prev).cast("timestamp_ntz"))
                             & (F.col("inserted_at") < F.lit(cut).cast("timestamp_ntz")))
        part.write.mode("append").parquet(raw)
        jobs.build(spark, raw, root)
        prev = cut
    full = B.build_star(spark, bronze, materialize=False)

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)
    assert rows(snapshots.read(spark, f"{root}/gold/fct_flights").select(*FACT_COLUMNS)) == rows(full.fct)
    assert rows(spark.read.parquet(f"{root}/gold/dim_aircrafts")) == rows(full.aircrafts)
    assert rows(spark.read.parquet(f"{root}/gold/dim_calendar")) == rows(full.calendar)
    stg_cols = full.stg.columns
    assert rows(snapshots.read(spark, f"{root}/silver/stg_flights").select(*stg_cols)) == rows(full.stg)


def test_polls_of_a_day_stay_side_by_side(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    os.makedirs(a)
    os.makedirs(b)
    write_document(os.path.join(a, "1.json"), F1_ROWS[:2])
    write_document(os.path.join(b, "2.json"), F1_ROWS[2:3])
    pq, raw = fresh_path(spark, "pq"), fresh_path(spark, "raw")
    for poll, batch in ((a, "p1"), (b, "p2"), (b, "p2")):
        jobs.ingest(spark, poll, pq, "2026-01-29", batch)
    assert spark.read.parquet(pq).count() == 3
    assert jobs.load(spark, pq, "2026-01-29", raw, "2026-01-29 10:00:00", "p1") == 2
    assert jobs.load(spark, pq, "2026-01-29", raw, "2026-01-29 10:05:00", "p2") == 1
    assert spark.read.parquet(raw).select("id_surrogate").distinct().count() == 3


def test_broken_input_aborts_or_is_quarantined(spark, tmp_dir):
    only_bad, empty, mixed = (os.path.join(tmp_dir, x) for x in ("bad", "empty", "mixed"))
    for folder in (only_bad, empty, mixed):
        os.makedirs(folder)
    for folder in (only_bad, mixed):
        with open(os.path.join(folder, "cut.json"), "w") as fh:
            fh.write('[["e4", 1, ')
    write_document(os.path.join(empty, "e.json"), [])
    write_document(os.path.join(mixed, "ok.json"), F1_ROWS[:3] + [F1_ROWS[3][:16]])
    pq = fresh_path(spark, "pq")
    for folder in (only_bad, mixed):
        with pytest.raises(jobs.ContractBroken):
            jobs.ingest(spark, folder, pq, "2026-01-29", "p")
    assert jobs.ingest(spark, empty, pq, "2026-01-29", "p")["rows_in"] == 0           # a no-op
    assert jobs.load(spark, pq, "2026-01-29", fresh_path(spark, "raw")) == 0
    out = jobs.ingest(spark, only_bad, pq, "2026-01-29", "p", on_violation="quarantine")
    assert (out["rows_in"], out["malformed"], out["rows_out"]) == (1, 1, 0)
    for _ in range(2):
        out = jobs.ingest(spark, mixed, pq, "2026-01-29", "q", on_violation="quarantine")
    assert (out["rows_in"], out["malformed"], out["bad_width"], out["rows_out"]) == (5, 1, 1, 3)
    assert spark.read.json(f"{pq}_quarantine").count() == 3 and spark.read.parquet(pq).count() == 3


def test_build_with_null_ids_and_times_equals_the_full_build(spark):
    from aerolake.plans import build as B
    from aerolake.plans import telemetry
    from aerolake.plans.fact import FACT_COLUMNS
    bronze = telemetry.bronze(spark, "/root/testdata/sf0.001").withColumns({
        "time_position": F.when(F.expr("event_id % 17 <> 0"), F.col("time_position")),
        "icao24": F.when(F.expr("event_id % 19 <> 0"), F.col("icao24"))})
    raw, root = fresh_path(spark, "raw"), fresh_path(spark, "wh")
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (F.col("inserted_at") < middle, F.col("inserted_at") >= middle):
        bronze.where(part).write.mode("append").parquet(raw)
        report = {(r.model, r.check_name, r.column_name): r.violations for r in jobs.build(spark, raw, root).collect()}
        assert report[("fct_flights", "not_null", "flight_pk")] > 0      # reported, not fatal
    full = B.build_star(spark, bronze, materialize=False)

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)
    assert rows(snapshots.read(spark, f"{root}/silver/stg_flights").select(*full.stg.columns)) == rows(full.stg)
    fact = snapshots.read(spark, f"{root}/gold/fct_flights").select(*FACT_COLUMNS)
    assert rows(fact) == rows(full.fct.where("flight_pk is not null"))
    aside = spark.read.parquet(f"{root}/gold/fct_flights_rejected")
    assert aside.where("flight_pk is null").count() == aside.count() >= full.fct.where("flight_pk is null").count()
    checked = {(r.model, r.check_name, r.column_name): r.violations for r in jobs.build(spark, raw, root, full_checks=True).collect()}
    assert checked[("fct_flights", "unique", "flight_pk")] == 0


def _verdict(report):
    return {(r.model, r.check_name, r.column_name): r.violations for r in report.collect()}


def _bronze_load(spark, raw, name, rows, stamp):
    """Rows with their own ids as a committed load."""
    from aerolake.sources import sinks
    from pyspark.sql import functions as F
    keyed = rows.drop("processing_date").withColumns({
        "inserted_at": F.lit(stamp).cast("timestamp_ntz"), "processing_date": F.lit(stamp[:10]).cast("date"), "load_id": F.lit(name)})
    loads.record(spark, raw, f"processing_date={stamp[:10]}/load_id={name}", keyed.count(), stamp,
                 lambda first: sinks.write_partitions(keyed, raw, ["processing_date", "load_id"]))


def test_an_idle_run_keeps_a_failing_verdict(spark):
    from aerolake.plans import telemetry
    bronze = telemetry.bronze(spark, "/root/testdata/sf0.001").limit(300)
    raw, root = fresh_path(spark, "raw"), fresh_path(spark, "wh")
    _bronze_load(spark, raw, "a", bronze.withColumn("velocity", F.when(F.expr("event_id % 90 < 3"), 5000.0).otherwise(F.col("velocity"))),
                 "2024-02-01 00:00:00")
    first = _verdict(jobs.build(spark, raw, root))
    assert first[("fct_flights", "accepted_range", "speed_kmh")] > 0
    assert _verdict(jobs.build(spark, raw, root)) == first                        # nothing new
    assert _verdict(jobs.build(spark, raw, root, full_checks=True)) == first
    _bronze_load(spark, raw, "b", bronze.where("false"), "2024-02-02 00:00:00")     # an empty load
    assert _verdict(jobs.build(spark, raw, root)) == first


def test_a_repeated_id_on_another_day_is_found(spark):
    from aerolake.operators import quality_state as Q
    from aerolake.plans import telemetry
    bronze = telemetry.bronze(spark, "/root/testdata/sf0.001")
    raw, root = fresh_path(spark, "raw"), fresh_path(spark, "wh")
    _bronze_load(spark, raw, "a", bronze.where("event_id < 300"), "2024-02-01 00:00:00")
    assert _verdict(jobs.build(spark, raw, root))[("stg_flights", "unique", "id_surrogate")] == 0
    other_day = bronze.where("event_id between 3 and 80").withColumn("time_position", F.col("time_position") + 86400 * 400)
    _bronze_load(spark, raw, "b", other_day, "2024-02-02 00:00:00")
    got = _verdict(jobs.build(spark, raw, root))
    silver = snapshots.read(spark, f"{root}/silver/stg_flights")
    wanted = silver.groupBy("id_surrogate").count().where("count > 1").count()
    assert got[("stg_flights", "unique", "id_surrogate")] == wanted > 0
    assert got == _verdict(jobs.build(spark, raw, root, full_checks=True))
    state = snapshots.read(spark, jobs._state(root, "quality"))
    assert Q.repeated_values(spark, state, {"stg_flights": f"{root}/silver/stg_flights"}) == {("stg_flights", "id_surrogate"): wanted}


def test_only_changed_partitions_are_described(spark):
    from aerolake.operators import quality_state as Q
    from aerolake.plans.q_quality import SUITE
    from aerolake.plans import build as B
    from aerolake.plans import telemetry
    rows = jobs._with_silver_key(B.staging.stg_flights(telemetry.bronze(spark, "/root/testdata/sf0.001")))
    table, state = fresh_path(spark, "silver"), fresh_path(spark, "state")
    checks = [c for c in SUITE if c.model == "stg_flights"]
    go = lambda **k: Q.refresh(spark, state, "stg_flights", table, "silver_key", checks, {}, **k)     # noqa: E731
    snapshots.upsert(spark, table, rows, "silver_key", "flight_date")
    every = snapshots.snapshot(spark, table).folders
    assert sorted(go()) == sorted(every) and go() == []
    day = rows.agg(F.min("flight_date")).first()[0]
    snapshots.upsert(spark, table, rows.where(F.col("flight_date") == F.lit(day)), "silver_key", "flight_date")
    assert go() == [f"flight_date={day}"] and sorted(go(everything=True)) == sorted(every)


def test_a_build_over_many_days_writes_few_files(spark):
    from aerolake.plans import telemetry
    bronze = telemetry.bronze(spark, "/root/testdata/sf0.001").withColumn(
        "time_position", F.col("time_position") + F.expr("event_id div 3") * 86_400)
    raw, root = fresh_path(spark, "raw"), fresh_path(spark, "wh")
    files = {}
    for n, half in enumerate((0, 1)):
        _bronze_load(spark, raw, f"half{half}", bronze.where(f"event_id % 2 = {half}"), f"2024-02-0{n + 1} 00:00:00")
        verdict = _verdict(jobs.build(spark, raw, root))
        for name in ("silver/stg_flights", "gold/fct_flights", "_state/quality"):
            files[name] = len(snapshots.read(spark, f"{root}/{name}").inputFiles())
    assert len(snapshots.snapshot(spark, f"{root}/silver/stg_flights").folders) > 300 and max(files.values()) <= 24
    assert verdict == _verdict(jobs.build(spark, raw, root, full_checks=True))
    assert verdict[("stg_flights", "unique", "id_surrogate")] == 0


def test_a_late_load_is_built(spark):
    from aerolake.plans import telemetry
    bronze = telemetry.bronze(spark, "/root/testdata/sf0.001").where("event_id % 3 = 0")
    raw, root = fresh_path(spark, "raw"), fresh_path(spark, "wh")
    _bronze_load(spark, raw, "new", bronze.where("event_id % 2 = 0"), "2024-02-02 00:00:00")
    jobs.build(spark, raw, root)
    n = snapshots.read(spark, f"{root}/gold/fct_flights").count()
    _bronze_load(spark, raw, "old", bronze.where("event_id % 2 = 1"), "2024-02-01 00:00:00")      # stamped before it
    jobs.build(spark, raw, root)
    both = snapshots.read(spark, f"{root}/gold/fct_flights")
    assert both.count() > n and both.where("ingestion_timestamp < timestamp_ntz'2024-02-02'").count() == both.count() - n
    assert jobs.read_mark(spark, root) == "2024-02-02 00:00:00"
    assert loads.pending(spark, raw, jobs._state(root, "built_loads")) == []
    _bronze_load(spark, raw, "old", bronze.where("event_id % 2 = 1"), "2024-02-03 00:00:00")      # repeated, newer
    assert [e["load"] for e in loads.pending(spark, raw, jobs._state(root, "built_loads"))] == ["processing_date=2024-02-03/load_id=old"]


def test_a_repeated_poll_replaces_both_sides(spark, tmp_dir):
    mixed, clean, bad = (os.path.join(tmp_dir, x) for x in ("mixed", "clean", "bad"))
    for folder in (mixed, clean, bad):
        os.makedirs(folder)
    write_document(os.path.join(mixed, "m.json"), F1_ROWS[:2] + [F1_ROWS[3][:16]])
    write_document(os.path.join(clean, "c.json"), F1_ROWS[:2])
    write_document(os.path.join(bad, "b.json"), [F1_ROWS[3][:16]])
    pq = fresh_path(spark, "pq")
    go = lambda folder: jobs.ingest(spark, folder, pq, "2026-01-29", "p", on_violation="quarantine")     # noqa: E731
    assert (go(mixed)["rows_out"], spark.read.json(f"{pq}_quarantine").count()) == (2, 1)
    go(clean)
    assert spark.read.parquet(pq).count() == 2 and not jobs.path_exists(spark, f"{pq}_quarantine/processing_date=2026-01-29/batch_id=p")
    assert go(bad)["rows_out"] == 0
    assert not jobs.path_exists(spark, f"{pq}/processing_date=2026-01-29/batch_id=p")
    assert spark.read.json(f"{pq}_quarantine").count() == 1


def test_ids_are_dense_over_loads_and_kept_by_a_repetition(spark):
    from aerolake.sources import sinks
    rows = spark.range(1000).selectExpr("id AS v").repartition(5)
    pq, raw = fresh_path(spark, "pq"), fresh_path(spark, "raw")
    for k in range(3):
        sinks.write_partitions(rows.where(f"v % 3 = {k}").withColumns(
            {"processing_date": F.lit(f"2024-02-0{k + 1}").cast("date"), "batch_id": F.lit("b")}), pq, ["processing_date", "batch_id"])
        jobs.load(spark, pq, f"2024-02-0{k + 1}", raw)
    ids = lambda: sorted(map(tuple, spark.read.parquet(raw).select("id_surrogate", "v").collect()))     # noqa: E731
    first = ids()
    assert [i for i, _ in first] == list(range(1, 1001))
    jobs.load(spark, pq, "2024-02-02", raw)
    assert ids() == first
