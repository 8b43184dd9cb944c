import os

from pyspark.sql import functions as F

from aerolake.plans import layers
from aerolake.sources import ingest, sinks
from aerolake.session import fresh_path
from tests.fixtures import F1_ROWS, bronze_rows


def test_dynamic_partition_overwrite_keeps_other_partitions(spark):
    path = fresh_path(spark, "parts")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, d string")
    sinks.write_partitions(df, path, "d")
    sinks.write_partitions(spark.createDataFrame([(3, "2024-01-02")], "id int, d string"), path, "d")
    got = sorted((r.id, str(r.d)) for r in spark.read.parquet(path).collect())
    assert got == [(1, "2024-01-01"), (3, "2024-01-02")]


def test_publish_and_read_back_messages(spark):
    typed = bronze_rows(spark).select(*sinks.STATE_VECTOR_NAMES)
    path = fresh_path(spark, "topic")
    sinks.publish(typed, fmt="text", path=path)
    back = ingest.typed_projection(ingest.read_state_vectors(spark, path, layout="lines"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, typed.collect()), key=str)


def test_document_writer_round_trip(spark):
    typed = bronze_rows(spark).select(*sinks.STATE_VECTOR_NAMES)
    path = fresh_path(spark, "docs")
    sinks.write_state_vector_documents(typed, path, rows_per_file=2)
    files = [f for _, _, fs in os.walk(path.replace("file:", "")) for f in fs if f.endswith(".txt")]
    assert len(files) >= 2
    back = ingest.typed_projection(ingest.read_state_vectors(spark, path))
    assert back.count() == len(F1_ROWS)


def test_document_writer_spreads_equal_rows(spark):
    one = bronze_rows(spark).select(*sinks.STATE_VECTOR_NAMES).limit(1)
    equal = one.crossJoin(spark.range(500)).drop("id")
    path = fresh_path(spark, "docs")
    sinks.write_state_vector_documents(equal, path, rows_per_file=100)
    sizes = [r.n for r in spark.read.text(path, wholetext=True).selectExpr(
        "size(from_json(value, 'array<array<string>>')) AS n").collect()]
    assert sum(sizes) == 500 and len(sizes) == 5 and max(sizes) < 200


def test_replaced_table_recovers(spark):
    from aerolake import storage
    root = fresh_path(spark, "swap")
    path = f"{root}/t"
    storage.replace_table(spark.range(3).toDF("a"), path)
    out = storage.replace_table(spark.read.parquet(path).selectExpr("a + 10 AS a"), path)     # reads what it replaces
    assert sorted(r.a for r in out.collect()) == [10, 11, 12]
    # stopped after the old table was moved away and the new one complete
    spark.range(2).toDF("a").write.parquet(f"{root}/_t.new")
    storage.rename(spark, path, f"{root}/_t.old")
    storage.recover_table(spark, path)
    assert spark.read.parquet(path).count() == 2 and not storage.path_exists(spark, f"{root}/_t.old")
    # stopped before the new one was complete
    storage.rename(spark, path, f"{root}/_t.old")
    storage.recover_table(spark, path)
    assert spark.read.parquet(path).count() == 2


def test_bronze_defaults_unique_ids(spark):
    df = spark.range(1000).repartition(7)
    out = sinks.with_bronze_columns(df, "2024-02-01 00:00:00", id_offset=500)
    stats = out.agg(F.countDistinct("id_surrogate").alias("d"), F.min("id_surrogate").alias("m"),
                    F.countDistinct("inserted_at").alias("t")).first()
    assert stats.d == 1000 and stats.m >= 500 and stats.t == 1


def test_reconciliation_counts_in_one_pass(spark):
    rec = sinks.Reconciliation()
    df = rec.tap_in(spark.range(100))
    out = rec.tap_out(df.filter("id % 2 = 0"))
    out.write.format("noop").mode("overwrite").save()
    assert rec.result() == (100, 50)
    none = sinks.Reconciliation()
    none.tap_out(none.tap_in(spark.range(10).where("id < 0").select("id"))).write.format("noop").mode("overwrite").save()
    assert none.result() == (0, 0)


def test_land_raw_replaces_only_its_day(spark):
    path = fresh_path(spark, "land")
    df = spark.createDataFrame([(1,)], "id int")
    sinks.land_raw(df, path, "2024-01-01")
    sinks.land_raw(df.withColumn("id", F.lit(2)), path, "2024-01-02")
    sinks.land_raw(df.withColumn("id", F.lit(3)), path, "2024-01-01")
    got = sorted((r.id, str(r.dt)) for r in spark.read.json(path).collect())
    assert got == [(2, "2024-01-02"), (3, "2024-01-01")]


def test_jdbc_append_skips_empty_batch(spark):
    empty = spark.createDataFrame([], "id int")
    assert sinks.jdbc_append(empty, "jdbc:none", "raw.flights_raw", {}) is False


def test_materialise_view_and_table(spark):
    df = spark.range(5)
    v = layers.materialise(df, "things", "view", layer="silver")
    assert v.count() == 5 and spark.catalog.tableExists("silver_things")
    root = fresh_path(spark, "wh")
    assert layers.materialise(df, "things", "table", root=root).count() == 5
    t2 = layers.materialise(df.limit(2), "things", "table", root=root)
    assert t2.count() == 2 and layers.layer_path(root, " gold ", "x").endswith("/gold/x")


def test_source_resolves_declared_names(spark):
    from aerolake.sources.tables import source
    path = fresh_path(spark, "raw-flights")
    spark.range(3).write.parquet(path)
    df = spark.range(5)
    assert source(spark, {"raw.flights_raw": path}, "raw", "flights_raw").count() == 3
    assert source(spark, {"raw.flights_raw": df}, "raw", "flights_raw").count() == 5
    df.createOrReplaceTempView("flights_raw_view")
    assert source(spark, {"raw.flights_raw": "flights_raw_view"}, "raw", "flights_raw").count() == 5


def test_observed_counts_exact_through_partitioned_write(spark):
    rec = sinks.Reconciliation()
    df = rec.tap_out(rec.tap_in(spark.range(5000)).select("id", F.lit("2024-01-01").cast("date").alias("d")))
    sinks.write_partitions(df, fresh_path(spark, "obs"), "d")
    assert rec.result() == (5000, 5000)


def test_two_reconciliations_in_one_plan(spark):
    a, b = sinks.Reconciliation(), sinks.Reconciliation()
    df = b.tap_out(b.tap_in(a.tap_out(a.tap_in(spark.range(10))).filter("id < 4")))
    df.write.format("noop").mode("overwrite").save()
    assert a.result() == (10, 10) and b.result() == (4, 4)
