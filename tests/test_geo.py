import random

from pyspark.sql import functions as F

from aerolake.operators import geo
from aerolake.plans import dims

BOX_DDL = "airport_code string, lat_min double, lat_max double, lon_min double, lon_max double"


def _bag(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_near_any_centres_strict_and_nulls(spark):
    pts = spark.createDataFrame([(-23.63, -46.65), (-23.18, -46.47), (None, -46.6), (-23.0, -47.13),
                                 (-10.0, -40.0), (-23.43, -46.47 + 0.25)], "latitude double, longitude double")
    kept = geo.near_any(pts).collect()
    assert len(kept) == 2                     # 0.25 away on one axis is out, NULL dropped
    assert _bag(geo.near_any(pts), ["latitude", "longitude"]) == \
        _bag(geo.near_any(pts, max_or_terms=0), ["latitude", "longitude"])


def test_geofence_edges_margin_and_origin(spark):
    pts = spark.createDataFrame([(-23.685, -46.6), (-23.6851, -46.6), (0.004, -0.005), (-23.5, -46.4)],
                                "latitude double, longitude double")
    out = geo.geofence_join(pts, dims.dim_airports(spark), n_boxes=dims.N_AIRPORTS)
    got = {(r.latitude, r.longitude): r.airport_code for r in out.collect()}
    assert got[(-23.685, -46.6)] == "CGH"      # on the widened edge: closed bound
    assert got[(-23.6851, -46.6)] is None
    assert got[(0.004, -0.005)] == "N/A"       # the (0,0) box matches near the origin
    assert got[(-23.5, -46.4)] == "GRU"


def test_overlap_all_vs_first(spark):
    boxes = spark.createDataFrame([("A", 0.0, 1.0, 0.0, 1.0), ("B", 0.5, 2.0, 0.5, 2.0)], BOX_DDL)
    pts = spark.createDataFrame([(0.7, 0.7), (1.5, 1.5), (5.0, 5.0)], "latitude double, longitude double")
    allm = geo.geofence_join(pts, boxes, margin=0.0)
    assert allm.count() == 4
    first = geo.geofence_join(pts, boxes, margin=0.0, multi="first", order_col="airport_code")
    got = {(r.latitude, r.longitude): r.airport_code for r in first.collect()}
    assert got == {(0.7, 0.7): "A", (1.5, 1.5): "B", (5.0, 5.0): None}


def test_nested_loop_equals_grid(spark):
    rnd = random.Random(7)
    boxes = []
    for i in range(40):
        la, lo = rnd.uniform(-30, -20), rnd.uniform(-50, -40)
        size = rnd.choice([0.001, 0.05, 0.8, 6.0])
        boxes.append((f"B{i}", la, la + rnd.uniform(0.5, 1) * size, lo, lo + rnd.uniform(0.5, 1) * size))
    bdf = spark.createDataFrame(boxes, BOX_DDL)
    pts = spark.createDataFrame([(rnd.uniform(-31, -19), rnd.uniform(-51, -39)) for _ in range(3000)]
                                + [(b[1], b[3]) for b in boxes] + [(None, -45.0), (0.0, None)],
                                "latitude double, longitude double")
    bag = lambda df: sorted(map(tuple, df.select("latitude", "longitude", "airport_code").collect()), key=str)
    nl = bag(geo.geofence_join(pts, bdf, margin=0.005, nested_loop_max=100))
    assert nl == bag(geo.geofence_join_grid(pts, bdf, margin=0.005)) == bag(geo.geofence_join(pts, bdf, margin=0.005))
    assert sum(1 for r in nl if r[2] is not None) > 50
    best = {}
    for la, lo, code in nl:
        best[(la, lo)] = min(code, best.get((la, lo), code)) if code else None
    first = {(r.latitude, r.longitude): r.airport_code for r in geo.geofence_join(pts, bdf, margin=0.005, multi="first").collect()}
    assert first == best


def test_few_cells_however_unequal_the_boxes(spark):
    rnd = random.Random(1)
    boxes = [(f"S{i}", la, la + 0.01, lo, lo + 0.01) for i, (la, lo) in enumerate(
        (rnd.uniform(-60, 60), rnd.uniform(-90, 90)) for _ in range(200))] + [("L", -80.0, 80.0, -170.0, 170.0)]
    prepared = geo._prepared_boxes(spark.createDataFrame(boxes, BOX_DDL), 0.005, ["airport_code"], None)
    levels = geo._levels(prepared)
    assert len(levels) == 2
    assert sum(geo._explode_cells(b, cell).count() for cell, b in levels) <= 4 * len(boxes)


def test_grid_plan_is_hash_join(spark):
    pts = spark.createDataFrame([(-23.6, -46.6)], "latitude double, longitude double")
    plan = geo.geofence_join_grid(pts, dims.dim_airports(spark))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_boxes(spark):
    pts = spark.createDataFrame([(1.0, 2.0)], "latitude double, longitude double")
    none = spark.createDataFrame([], BOX_DDL)
    for out in (geo.geofence_join_grid(pts, none), geo.geofence_join(pts, none), geo.geofence_join(pts, none, multi="first")):
        assert [tuple(r) for r in out.collect()] == [(1.0, 2.0, None)]


def test_airport_dimension_rows(spark):
    d = dims.dim_airports(spark)
    assert d.count() == 4 and d.schema["lat_min"].dataType.simpleString() == "double"
    assert sorted(r.airport_code for r in d.collect()) == ["CGH", "GRU", "N/A", "VCP"]
    assert "ExistingRDD" not in d._jdf.queryExecution().executedPlan().toString()
    assert d.filter(F.col("airport_code") == "VCP").first().city == "Campinas"
