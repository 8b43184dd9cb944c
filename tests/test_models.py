import datetime as dt

from pyspark.sql import functions as F

from aerolake import constants as K
from aerolake.operators.dedup import dedup_latest
from aerolake.plans import build, dims, fact, staging
from tests.fixtures import F1_AIRPORTS, F1_ROWS, bronze_rows


def test_dedup_newest_wins_nulls_and_ties(spark):
    rows = [("a", 1, "2024-01-01", 1, "old"), ("a", 1, "2024-01-02", 2, "new"), ("a", 1, "2024-01-02", 3, "tie"),
            (None, 1, "2024-01-01", 4, "n1"), (None, 1, "2024-01-03", 5, "n2"), ("b", 2, None, 6, "nullts"),
            ("b", 2, "2024-01-01", 7, "b")]
    df = spark.createDataFrame(rows, "k string, t int, ins string, id int, v string")
    out = dedup_latest(df, ["k", "t"], "ins", tie_break="id")
    got = {(r.k, r.t): r.v for r in out.collect()}
    assert got == {("a", 1): "tie", (None, 1): "n2", ("b", 2): "b"}


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedup_latest(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_silver_merges_id_variants_and_keeps_newest(spark):
    b1 = bronze_rows(spark, inserted_at="2026-01-30 00:00:00", start_id=1)
    twin = list(F1_ROWS[0])
    twin[0] = " E491A3 "
    twin[9] = 99.0
    b2 = bronze_rows(spark, [twin], inserted_at="2026-01-31 00:00:00", start_id=100)
    stg = staging.stg_flights(b1.unionByName(b2))
    assert stg.count() == 6
    r = stg.filter(F.col("aircraft_id") == "E491A3").first()
    assert r.speed_kmh == 99.0 and r.flight_number == "TAM3574"


def test_fact_golden_values(spark):
    stg = staging.stg_flights(bronze_rows(spark))
    f = fact.fct_flights(stg, dims.dim_airports(spark), n_airports=dims.N_AIRPORTS)
    assert f.columns == fact.FACT_COLUMNS
    got = {r.aircraft_id: r for r in f.collect()}
    assert [got[r[0].upper()].airport_code for r in F1_ROWS] == F1_AIRPORTS
    klm = got["4851B3"]
    assert klm.flight_pk == "4851B3-2026-01-17 21:50:05" and klm.hour_24 == 21
    assert klm.flight_behavior == K.BEHAVIOR_LEVEL and klm.altitude_tier == K.ALT_LOW
    ground = got["E491A3"]
    assert ground.altitude_baro == 0.0 and ground.altitude_tier == K.TIER_GROUND
    assert ground.flight_status == K.STATUS_GROUND and ground.flight_date == dt.date(2026, 1, 17)


def test_tiers_partition_the_fact(spark):
    f = build.gold_fact(spark, "/root/testdata/sf0.001")
    n = f.count()
    for col in ("flight_status", "flight_behavior", "altitude_tier", "speed_tier", "airport_code"):
        assert sum(r["count"] for r in f.groupBy(col).count().collect()) == n


def test_dim_aircrafts_country_order(spark):
    stg = spark.createDataFrame([("A", "Brazil"), ("A", None), ("B", "Argentina"), ("B", "Chile"), ("C", None)],
                                "aircraft_id string, origin_country string")
    name_desc = {r.aircraft_id: r.origin_country for r in dims.dim_aircrafts(stg).collect()}
    assert name_desc == {"A": "Desconhecido", "B": "Chile", "C": "Desconhecido"}
    known = {r.aircraft_id: r.origin_country for r in dims.dim_aircrafts(stg, order="known_first").collect()}
    assert known == {"A": "Brazil", "B": "Chile", "C": "Desconhecido"}
    ranked = {r.aircraft_id: r.origin_country for r in dims.dim_aircrafts_ranked(stg).collect()}
    assert ranked == name_desc


def test_dim_calendar_one_row_per_date(spark):
    stg = staging.stg_flights(bronze_rows(spark))
    cal = dims.dim_calendar(stg).collect()
    assert sorted(str(r.flight_date) for r in cal) == ["2026-01-17", "2026-01-21", "2026-01-29"]


def test_star_keeps_fact_rows(spark):
    b = build.build_star(spark, bronze_rows(spark))
    s = b.star()
    assert s.count() == b.fct.count() == 6
    assert s.filter(F.col("airport_code") == "VCP").first().city == "Campinas"


def test_lookup_join_keeps_every_fact_row(spark):
    from aerolake.operators.star import lookup_join
    fact_df = spark.range(3000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    dim = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("attr"))
    got = lookup_join(fact_df, dim, "k").collect()
    assert len(got) == 3000 and all(r.attr == (r.k * 10 if r.k < 5 else None) for r in got)


def test_star_joins_only_named_dimensions(spark):
    b = build.build_star(spark, bronze_rows(spark))
    assert "city" in b.star("airports").columns and "origin_country" not in b.star("airports").columns
