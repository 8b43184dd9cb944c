"""The membership index of the streamed dedup, the archive's ledger, and facts laid out by place."""

import datetime
import random

from pyspark.sql import functions as F

from aerolake import storage
from aerolake.operators import clustering as C
from aerolake.session import fresh_path
from aerolake.sources import sinks
from aerolake.streaming import archive as A
from aerolake.streaming import dedup_index as D
from aerolake.streaming import drain as S
from tests.fixtures import bronze_rows

rng = random.Random(6)


def _keys(spark, ids):
    day = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(f"a{i}", day + datetime.timedelta(hours=7 * i)) if i % 9 else (None, None) for i in ids],
                                 "id string, ts timestamp_ntz")


def test_new_keys_read_no_stored_key(spark):
    path = fresh_path(spark, "dedup")
    go = lambda ids, batch: D.add_keys(spark, path, _keys(spark, ids), ["id"], "ts", batch)      # noqa: E731
    first = go([*range(1, 9), *range(1, 9)], 0)
    assert first == {"new": 8, "maybe": 0, "buckets_read": 0}
    assert go(range(100, 108), 1) == {"new": 8, "maybe": 0, "buckets_read": 0}         # no bit is set: no key is read
    again = go([1, 2, 103, 200], 2)
    assert again["new"] == 1 and again["maybe"] == 3 and again["buckets_read"] <= 3
    assert go([9, 18], 3)["new"] == 1                                                   # NULL is a key
    assert go([27], 4)["new"] == 0
    assert D.read_keys(spark, path).count() == 18 == D.read_keys(spark, path).distinct().count()
    assert go([], 5)["new"] == 0


def test_a_retried_batch_replaces_its_keys(spark):
    path = fresh_path(spark, "dedup")
    writer = D.indexed_dedup_writer(path, "id", "ts")
    writer(_keys(spark, range(1, 6)), 0)
    for _ in range(2):
        writer(_keys(spark, range(3, 8)), 1)
    assert sorted(r.id for r in D.read_keys(spark, path).collect()) == [f"a{i}" for i in range(1, 8)]


def test_files_of_keys_do_not_follow_the_days(spark):
    path = fresh_path(spark, "dedup")
    rows = lambda k: spark.range(k, 3000, 2).selectExpr(                      # noqa: E731
        "concat('a', id div 3) AS id", "cast(date_add(date'2024-01-01', cast(id div 6 AS int)) AS timestamp_ntz) AS ts")
    done = [D.add_keys(spark, path, rows(k % 2), ["id"], "ts", k) for k in (0, 1, 2)]
    # three ids in a row share a key, so the odd ones have every key of the even ones
    assert [d["new"] for d in done] == [1000, 0, 0] and done[1]["maybe"] == 1000
    assert D.read_keys(spark, path).distinct().count() == 1000 == D.read_keys(spark, path).count()
    assert len(D.read_keys(spark, path).inputFiles()) <= 24
    index = D.snapshots.read(spark, D._index_path(path))
    assert index.selectExpr("sum(bit_count(bits))").first()[0] <= 1000 and index.count() <= 1000


def test_bits(spark):
    df = spark.range(40_000).where("id % 7 = 0 and id < 32768")
    bits = df.agg(F.bitmap_construct_agg("id").alias("bits"))
    got = spark.range(32_768).crossJoin(bits).select("id", D.bit_of("bits", "id").alias("set")).where("set").count()
    assert got == df.count()


def test_archive_by_ledger(spark):
    src, archive, ledger = (fresh_path(spark, x) for x in ("src", "arch", "ledger"))
    sinks.publish(bronze_rows(spark).select(*sinks.STATE_VECTOR_NAMES).repartition(3), fmt="text", path=src)
    out, ckpt = fresh_path(spark, "out"), fresh_path(spark, "ckpt")
    files = lambda: sorted(n for n in storage.file_names(spark, src) if n.startswith("part-"))     # noqa: E731
    n = len(files())
    stream = A.with_source_file(S.open_stream(spark, "text", src, options={"maxFilesPerTrigger": "1"}))
    S.drain(stream, ckpt, foreach_batch=A.noting_files(ledger, S.staging_writer(out, transform=S.ingest_messages)))
    assert len(files()) == n and A.archive_committed(spark, ledger, fresh_path(spark, "other"), archive) == 0     # nothing committed there
    assert A.archive_committed(spark, ledger, ckpt, archive) == n and files() == []
    assert len(storage.subfolders(spark, archive)) == n                 # one file a batch, under its id
    assert A.archive_committed(spark, ledger, ckpt, archive) == 0
    assert spark.read.text(archive).count() == 6 == spark.read.parquet(out).count()


def test_a_box_reads_few_files(spark):
    rows = [(i, rng.uniform(-60, 60), rng.uniform(-120, 120)) for i in range(20_000)] + [(-1, None, 3.0), (-2, None, None)]
    rows += [(100_000 + i, 10.0, 10.0) for i in range(3000)]               # a crowded place
    df = spark.createDataFrame(rows, "id long, latitude double, longitude double")
    path = fresh_path(spark, "z")
    C.write_clustered(df, path, files=64)
    whole = spark.read.parquet(f"{path}/rows")
    assert whole.count() == len(rows) and len(whole.inputFiles()) > 40
    for box in ((-23.7, -23.5, -46.8, -46.0), (-10, 0, 20, 35), (9.99, 10.01, 9.99, 10.01), (80, 85, 0, 1)):
        got = C.read_box(spark, path, df.schema, *box)
        want = df.where(F.col("latitude").between(*box[:2]) & F.col("longitude").between(*box[2:]))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert len(C.files_of_box(spark, path, -23.7, -23.5, -46.8, -46.0)) <= 6
    assert C.files_of_box(spark, path, 80, 85, 0, 1) == []


def test_z_order_interleaves(spark):
    df = spark.createDataFrame([(-90.0, -180.0), (90.0, 180.0), (-90.0, 180.0), (None, 1.0)], "latitude double, longitude double")
    assert [r[0] for r in df.select(C.z_order()).collect()] == [0, 0xFFFFFFFF, 0x55555555, None]
