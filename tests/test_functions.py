import datetime as dt

from pyspark.sql import functions as F

from aerolake import constants as K
from aerolake.functions import calendar as cal
from aerolake.functions import categorise as cat
from aerolake.functions import clean


def test_normalise_identifiers(spark):
    df = spark.createDataFrame([(" e48fb6 ", " tam-35-74  ", " Brazil "), (None, None, "")],
                               "icao24 string, callsign string, origin_country string")
    r = df.select(clean.normalise_id("icao24").alias("a"), clean.normalise_callsign("callsign").alias("c"),
                  clean.trim_text("origin_country").alias("o")).collect()
    assert (r[0].a, r[0].c, r[0].o) == ("E48FB6", "TAM3574", "Brazil")
    assert (r[1].a, r[1].c, r[1].o) == (None, None, "")


def test_epoch_to_ts_ignores_session_time_zone(spark):
    df = spark.createDataFrame([(1768686562,)], "t long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        r = df.select(clean.epoch_to_ts("t").alias("ts"), clean.hour_of(clean.epoch_to_ts("t")).alias("h"),
                      clean.signal_key(F.lit("E491A3"), clean.epoch_to_ts("t")).alias("k")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.ts == dt.datetime(2026, 1, 17, 21, 49, 22)
    assert r.h == 21 and r.k == "E491A3-2026-01-17 21:49:22"


def test_signal_key_null_parts(spark):
    df = spark.createDataFrame([("A", None), (None, dt.datetime(2024, 1, 1))], "i string, t timestamp_ntz")
    assert [r.k for r in df.select(clean.signal_key("i", "t").alias("k")).collect()] == [None, None]


def test_default_nulls_keeps_types(spark):
    df = spark.createDataFrame([(None, None, "x")], "speed_kmh double, origin_country string, z string")
    out = clean.default_nulls(df, {**clean.METRIC_DEFAULTS, **clean.COUNTRY_DEFAULT})
    r = out.first()
    assert r.speed_kmh == 0.0 and r.origin_country == K.UNKNOWN_COUNTRY and out.columns == df.columns


def test_categories_first_match_and_nulls(spark):
    rows = [(True, None, None, None), (False, 20000.0, 900.0, 800.0), (False, 1000.0, 600.0, 450.0),
            (False, 1000.0, -600.0, 100.0), (False, 12000.0, 0.0, None), (None, None, None, 10.0)]
    df = spark.createDataFrame(rows, "on_ground boolean, altitude_baro double, vertical_rate double, speed_kmh double")
    out = df.select(cat.flight_status().alias("s"), cat.flight_behavior().alias("b"),
                    cat.altitude_tier().alias("a"), cat.speed_tier().alias("v")).collect()
    assert [r.s for r in out] == [K.STATUS_GROUND] + [K.STATUS_AIR] * 5
    assert [r.b for r in out] == [K.BEHAVIOR_GROUND, K.BEHAVIOR_CRUISE, K.BEHAVIOR_CLIMB, K.BEHAVIOR_DESCENT,
                                  K.BEHAVIOR_LEVEL, K.BEHAVIOR_LEVEL]
    assert [r.a for r in out] == [K.TIER_GROUND, K.ALT_MID, K.ALT_LOW, K.ALT_LOW, K.ALT_MID, K.ALT_HIGH]
    assert [r.v for r in out] == [K.TIER_GROUND, K.SPEED_HIGH, K.SPEED_MID, K.SPEED_LOW, K.SPEED_HIGH, K.SPEED_LOW]


def test_category_and_continent(spark):
    df = spark.createDataFrame([("Brazil",), ("Desconhecido",), ("Chile",), ("Japan",), ("Spain",)], "c string")
    r = df.select(cat.aircraft_category("c").alias("k"), cat.continent("c").alias("t")).collect()
    assert [x.k for x in r] == ["Nacional", "Não Identificado", "Estrangeiro", "Estrangeiro", "Estrangeiro"]
    assert [x.t for x in r] == ["América do Sul", "Desconhecido", "América do Sul", "Outros Continentes", "Europa"]


def test_day_period(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias("h"))
    got = {r.h: r.p for r in df.select("h", cat.day_period("h").alias("p")).collect()}
    assert got[4] == "Noite" and got[5] == "Manhã" and got[11] == "Manhã" and got[12] == "Tarde"
    assert got[17] == "Tarde" and got[18] == "Noite"


def _brute_us_week(d: dt.date) -> int:
    jan1 = dt.date(d.year, 1, 1)
    first_sunday_offset = (jan1.weekday() + 1) % 7      # days since the Sunday on/before 1 Jan
    return ((d - jan1).days + first_sunday_offset) // 7 + 1


def test_us_week_matches_brute_force_calendar(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2019-01-01', DATE'2028-12-31')) AS d")
    got = {r.d: r.w for r in days.select("d", cal.us_week("d").alias("w")).collect()}
    assert len(got) == 3653
    assert all(w == _brute_us_week(d) for d, w in got.items())
    iso_diff = days.filter(cal.us_week("d") != F.weekofyear("d")).count()
    assert iso_diff > 1000          # the ISO week is a different calendar


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 17, 21, 0),)], "t timestamp_ntz")
    r = df.select(*cal.calendar_parts("t")).first()
    assert (r.year_num, r.quarter_name, r.month_num, r.week_of_year, r.day_num, r.day_of_week_num) == \
        (2026, "Q1", 1, 3, 17, 7)


def test_cluster_conf_sizes_partitions():
    from aerolake.session import cluster_conf
    conf = cluster_conf(100 * 2**40, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 524288
    assert int(cluster_conf(10 * 2**20, cores=8)["spark.sql.shuffle.partitions"]) == 16
