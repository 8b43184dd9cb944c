import datetime as dt

from aerolake.operators import measures as M
from aerolake.plans import questions as Q


def _fact(spark):
    rows = [("A-1", "A", "GRU", dt.date(2024, 1, 1), 10, 100.0, False, "Em Voo", "Subida"),
            ("A-2", "A", "GRU", dt.date(2024, 1, 1), 10, 50.0, True, "No Solo", "Táxi / Estacionado"),
            ("B-1", "B", "CGH", dt.date(2024, 1, 1), 11, 30.0, False, "Em Voo", "Descida / Aproximação"),
            ("C-1", "C", "N/A", dt.date(2024, 1, 2), 10, 200.0, False, "Em Voo", "Nivelado"),
            (None, "C", "N/A", dt.date(2024, 1, 2), 10, 0.0, False, "Em Voo", "Nivelado")]
    return spark.createDataFrame(rows, "flight_pk string, aircraft_id string, airport_code string, "
                                       "flight_date date, hour_24 int, speed_kmh double, on_ground boolean, "
                                       "flight_status string, flight_behavior string")


def test_core_measures(spark):
    f = _fact(spark)
    assert M.total_signals(f).first().total_signals == 4          # NULL keys are not counted
    by_day = {r.flight_date.day: r.active_aircraft for r in M.active_aircraft(f, "flight_date").collect()}
    assert by_day == {1: 2, 2: 1}
    approx = {r.flight_date.day: r.active_aircraft for r in M.active_aircraft(f, "flight_date", approx=True).collect()}
    assert approx == by_day
    assert {r.airport_code: r.avg_speed for r in M.avg_speed(f, "airport_code").collect()}["GRU"] == 75.0
    assert M.traffic_peak(f).first().traffic_peak == 1            # one aircraft per (date, hour)
    assert str(M.high_water(f, "flight_date").first().high_water_mark) == "2024-01-02"


def test_rollup_grouping_levels(spark):
    out = M.rollup_hierarchy(_fact(spark), ["airport_code", "hour_24"]).collect()
    levels = sorted({r.grouping_level for r in out})
    assert levels == [0, 1, 3]
    grand = [r for r in out if r.grouping_level == 3][0]
    assert grand.total_signals == 4 and grand.active_aircraft == 3


def test_questions_shares_and_topk(spark):
    f = _fact(spark)
    share = {r.airport_code: r.share_pct for r in Q.airport_share(f).collect()}
    assert share == {"GRU": 33.3333, "CGH": 33.3333, "N/A": 33.3333}
    assert [(r.hour_24, r.active_aircraft) for r in Q.peak_hours(f, k=1).collect()] == [(10, 2)]
    assert [(r.hour_24, r.active_aircraft) for r in Q.idle_hours(f, k=1).collect()] == [(11, 1)]
    g = {r.hour_24: (r.n_ground, r.n_signals) for r in Q.ground_share(f).collect()}
    assert g == {10: (1, 4), 11: (0, 1)}
