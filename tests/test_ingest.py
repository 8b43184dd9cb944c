import json
import os

import pytest
from pyspark.sql import functions as F

from aerolake.sources import ingest
from aerolake.sources.schemas import STATE_VECTOR_SCHEMA
from tests.fixtures import F1_ROWS, write_document


def _typed(spark, path, layout="document"):
    return ingest.typed_projection(ingest.read_state_vectors(spark, path, layout=layout))


def test_document_layout_compact_and_pretty(spark, tmp_dir):
    write_document(os.path.join(tmp_dir, "a.json"), F1_ROWS[:3])
    write_document(os.path.join(tmp_dir, "b.json"), F1_ROWS[3:], pretty=True)
    df = _typed(spark, tmp_dir)
    assert df.count() == 6
    row = df.filter(F.col("icao24") == "e49450").first()
    assert row.velocity == 0.0 and row.on_ground is True and row.baro_altitude is None
    assert row.time_position == 1769033656
    squawk = df.filter(F.col("icao24") == "e48c82").first().squawk
    assert squawk == "3674"
    assert df.schema == STATE_VECTOR_SCHEMA


def test_lines_layout(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "m.txt"), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in F1_ROWS))
    assert _typed(spark, tmp_dir, "lines").count() == 6


def test_empty_and_malformed_files(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "empty.json"), "w") as fh:
        fh.write("[]")
    write_document(os.path.join(tmp_dir, "ok.json"), F1_ROWS[:2])
    assert _typed(spark, tmp_dir).count() == 2
    with open(os.path.join(tmp_dir, "bad.json"), "w") as fh:
        fh.write("[[\"e4\", 1, ")
    with pytest.raises(Exception, match="MALFORMED INPUT"):
        _typed(spark, tmp_dir).collect()
    skipped = ingest.read_state_vectors(spark, tmp_dir, on_malformed="skip")
    assert skipped.count() == 2
    bad = ingest.malformed_inputs(spark, tmp_dir).collect()
    assert len(bad) == 1 and bad[0].source_file.endswith("bad.json")


def test_width_contract_fail_and_quarantine(spark, tmp_dir):
    rows = [F1_ROWS[0], F1_ROWS[1][:16], F1_ROWS[2] + [1]]
    write_document(os.path.join(tmp_dir, "w.json"), rows)
    raw = ingest.read_state_vectors(spark, tmp_dir)
    rep = ingest.contract_report(raw).first()
    assert (rep.n_rows, rep.n_bad_width, rep.min_width, rep.max_width) == (3, 2, 16, 18)
    good, bad = ingest.check_width(raw, on_violation="quarantine")
    assert good.count() == 1 and bad.count() == 2
    good2, _ = ingest.check_width(raw, STATE_VECTOR_SCHEMA, on_violation="quarantine")
    assert good2.count() == 1
    with pytest.raises(Exception, match="CONTRACT BROKEN"):
        ingest.typed_projection(ingest.check_width(raw)).collect()


def test_malformed_number_becomes_null_and_is_counted(spark, tmp_dir):
    row = list(F1_ROWS[2])
    row[7] = "21x3.6"
    write_document(os.path.join(tmp_dir, "n.json"), [row, F1_ROWS[0]])
    raw = ingest.read_state_vectors(spark, tmp_dir)
    typed = ingest.typed_projection(raw)
    assert typed.filter(F.col("icao24") == "4851b3").first().baro_altitude is None
    fails = ingest.cast_failures(raw).first()
    assert fails.baro_altitude == 1 and fails.velocity == 0


def test_unwrap_states_envelope_cases(spark):
    docs = [json.dumps({"time": 1, "states": F1_ROWS[:2]}), json.dumps({"time": 2}),
            json.dumps({"time": 3, "states": None}), json.dumps({"time": 4, "states": []})]
    df = spark.createDataFrame([(d,) for d in docs + ["", " "]], "value string")
    out = ingest.typed_projection(ingest.unwrap_states(df), keep=["poll_time"])
    assert [r.poll_time for r in out.collect()] == [1, 1]
    with pytest.raises(Exception):
        ingest.unwrap_states(spark.createDataFrame([('{"time": 5, "sta',)], "value string")).collect()


def test_processing_date_and_scan_partition(spark, tmp_dir):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    df.write.partitionBy("d").parquet(tmp_dir + "/t")
    one = ingest.scan_partition(spark, tmp_dir + "/t", "d", "2024-01-02")
    rows = one.collect()
    assert len(rows) == 1 and str(rows[0].d) == "2024-01-02"      # partition column kept
    stamped = ingest.with_processing_date(df, "2024-02-01")
    assert str(stamped.first().processing_date) == "2024-02-01"


def test_flight_leg_reader(spark, tmp_dir):
    rec = {"icao24": "e491a3", "firstSeen": 1768686000, "lastSeen": 1768689600, "estDepartureAirport": "SBGR",
           "estArrivalAirport": "SBSP", "callsign": "TAM3574"}
    with open(os.path.join(tmp_dir, "legs.json"), "w") as fh:
        fh.write(json.dumps(rec) + "\n")
    legs = ingest.read_flight_legs(spark, tmp_dir).first()
    assert legs.firstSeen == 1768686000 and legs.arrivalAirportCandidatesCount is None


def test_permuting_input_files_changes_nothing(spark, tmp_dir):
    import tempfile
    other = tempfile.mkdtemp(prefix="aerolake-perm-")
    chunks = [F1_ROWS[:2], F1_ROWS[2:4], F1_ROWS[4:]]
    for i, c in enumerate(chunks):
        write_document(os.path.join(tmp_dir, f"b{i}.json"), c)
        write_document(os.path.join(other, f"b{2 - i}.json"), list(reversed(c)))
    a = sorted(map(tuple, _typed(spark, tmp_dir).collect()), key=str)
    b = sorted(map(tuple, _typed(spark, other).collect()), key=str)
    assert a == b and len(a) == 6
