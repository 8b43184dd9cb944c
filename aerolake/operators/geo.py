"""Geofence predicates and joins of points to rectangular areas.

* ``near_any``          keep points within +-d degrees (strict) of any centre
* ``geofence_join``     LEFT range join of points to boxes (closed bounds,
                        widened by a margin); chooses the physical form
* ``geofence_join_grid`` same result as an equi-join on grid cells: every point
                        falls in exactly one cell, every box is replicated to
                        the cells it touches, the range test stays a residual
                        join condition, so LEFT semantics and multiplicity hold.

A box lies on the grid level whose cells are at least its size, so it touches
four cells at most however unequal the boxes are; a point probes each level once.
Joins carry no hints: adaptive execution broadcasts what it measures as small and
splits the partitions of a hot cell (one airport can hold a third of all signals).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.constants import GEOFENCE_MARGIN_DEG, PRODUCER_CENTRES, PRODUCER_MAX_DEG

NESTED_LOOP_MAX_BOXES = 16          # beyond this, per-point work favours the grid
LEVEL_FACTOR = 8                    # cell size from one grid level to the next
LEAST_CELL_DEG = 1e-4

_P = "__g_"                         # prefix for box-side helper columns


# --------------------------------------------------------------------------- P1
def near_any(df: DataFrame, centres=None, max_deg: float = PRODUCER_MAX_DEG,
             lat: str = "latitude", lon: str = "longitude", spark: SparkSession | None = None,
             max_or_terms: int = 64) -> DataFrame:
    """Keep rows whose point is strictly within ``max_deg`` of any centre.

    Rows with a NULL coordinate are dropped.  Few centres: one OR of
    ``abs()`` predicates (pushed into the scan's filter, no join).  Many
    centres: a left-semi grid join, so per-row work stays constant.
    """
    centres = centres if centres is not None else PRODUCER_CENTRES
    pts = list(centres.values()) if isinstance(centres, dict) else list(centres)
    base = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    if len(pts) <= max_or_terms:
        # A pure OR of slightly widened ranges (a superset Spark translates
        # into a Parquet filter, whose min/max statistics skip row groups)
        # AND the exact OR of abs() tests, which alone decides membership.
        eps = max_deg * 1e-6
        ranges = [F.col(lat).between(c_lat - max_deg - eps, c_lat + max_deg + eps)
                  & F.col(lon).between(c_lon - max_deg - eps, c_lon + max_deg + eps) for c_lat, c_lon in pts]
        exact = [(F.abs(F.col(lat) - F.lit(float(c_lat))) < max_deg)
                 & (F.abs(F.col(lon) - F.lit(float(c_lon))) < max_deg) for c_lat, c_lon in pts]
        return base.filter(reduce(lambda a, b: a | b, ranges) & reduce(lambda a, b: a | b, exact))
    spark = spark or df.sparkSession
    boxes = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)],
                                  "box_id long, c_lat double, c_lon double")
    # cells cover a slightly widened box; the residual is the exact predicate
    # (abs(x - c) < d is not bit-identical to c - d < x < c + d in floating point)
    pad = max_deg * 1e-6
    boxes = boxes.select(
        F.col("c_lat").alias(_P + "c_lat"), F.col("c_lon").alias(_P + "c_lon"),
        (F.col("c_lat") - max_deg - pad).alias(_P + "lo_lat"), (F.col("c_lat") + max_deg + pad).alias(_P + "hi_lat"),
        (F.col("c_lon") - max_deg - pad).alias(_P + "lo_lon"), (F.col("c_lon") + max_deg + pad).alias(_P + "hi_lon"))
    cell = max(2 * max_deg, 1e-6)
    cond = ((F.abs(F.col(lat) - F.col(_P + "c_lat")) < max_deg)
            & (F.abs(F.col(lon) - F.col(_P + "c_lon")) < max_deg))
    return _cell_join(base, _explode_cells(boxes, cell), cond, "left_semi", lat, lon, cell)


# --------------------------------------------------------------------------- J1/J2
def _prepared_boxes(boxes: DataFrame, margin: float, keep, order_col: str | None) -> DataFrame:
    cols = [F.col(k).alias(_P + k) for k in keep]
    if order_col:
        cols.append(F.col(order_col).alias(_P + "order"))
    return boxes.select(
        *cols,
        (F.col("lat_min").cast("double") - margin).alias(_P + "lo_lat"),
        (F.col("lat_max").cast("double") + margin).alias(_P + "hi_lat"),
        (F.col("lon_min").cast("double") - margin).alias(_P + "lo_lon"),
        (F.col("lon_max").cast("double") + margin).alias(_P + "hi_lon"),
    )


def _closed_cond(lat: str, lon: str) -> Column:
    return (F.col(lat).between(F.col(_P + "lo_lat"), F.col(_P + "hi_lat"))
            & F.col(lon).between(F.col(_P + "lo_lon"), F.col(_P + "hi_lon")))


def _explode_cells(boxes: DataFrame, cell: float) -> DataFrame:
    """One row per (box, grid cell it touches)."""
    def idx(c):
        return F.floor(F.col(c) / F.lit(cell)).cast("long")
    return (boxes
            .withColumn(_P + "cell_lat", F.explode(F.sequence(idx(_P + "lo_lat"), idx(_P + "hi_lat"))))
            .withColumn(_P + "cell_lon", F.explode(F.sequence(idx(_P + "lo_lon"), idx(_P + "hi_lon")))))


def _levels(boxes: DataFrame) -> list[tuple[float, DataFrame]]:
    """(cell size, boxes) of each grid level that has boxes: the least size, from
    ``LEAST_CELL_DEG`` up by ``LEVEL_FACTOR``, that a box fits in (seven levels
    reach beyond the globe)."""
    extent = F.greatest(F.col(_P + "hi_lat") - F.col(_P + "lo_lat"), F.col(_P + "hi_lon") - F.col(_P + "lo_lon"))
    level = F.greatest(F.lit(0), F.ceil(F.log(F.greatest(extent, F.lit(LEAST_CELL_DEG)) / LEAST_CELL_DEG)
                                        / math.log(LEVEL_FACTOR))).cast("int")
    leveled = boxes.withColumn(_P + "level", level)
    found = sorted(r[0] for r in leveled.select(_P + "level").where(F.col(_P + "level").isNotNull()).distinct().collect())
    return [(LEAST_CELL_DEG * LEVEL_FACTOR ** k, leveled.where(F.col(_P + "level") == k).drop(_P + "level")) for k in found]


def _cell_join(points: DataFrame, cells: DataFrame, cond: Column, how: str, lat: str, lon: str, cell: float) -> DataFrame:
    """Equi-join on the point's cell with ``cond`` as residual condition."""
    pts = points.select("*", F.floor(F.col(lat) / F.lit(cell)).cast("long").alias(_P + "pcell_lat"),
                        F.floor(F.col(lon) / F.lit(cell)).cast("long").alias(_P + "pcell_lon"))
    key = ((F.col(_P + "pcell_lat") == F.col(_P + "cell_lat"))
           & (F.col(_P + "pcell_lon") == F.col(_P + "cell_lon")))
    return pts.join(cells, key & cond, how).drop(_P + "pcell_lat", _P + "pcell_lon")


def geofence_join(points: DataFrame, boxes: DataFrame, margin: float = GEOFENCE_MARGIN_DEG,
                  multi: str = "all", lat: str = "latitude", lon: str = "longitude",
                  keep=("airport_code",), strategy: str = "auto", order_col: str | None = None,
                  n_boxes: int | None = None, nested_loop_max: int = NESTED_LOOP_MAX_BOXES) -> DataFrame:
    """LEFT join of points to boxes: ``lo - margin <= lat <= hi + margin`` on
    both axes.  Unmatched points keep NULL box columns; a point inside two
    boxes yields two rows (``multi="all"``) or only the box with the lowest
    ``order_col`` (``multi="first"``).

    ``strategy``: ``"nested_loop"`` (broadcast theta join; taken for up to
    ``nested_loop_max`` boxes only), ``"grid"`` (cell equi-join), or ``"auto"``.
    ``n_boxes`` may be passed when the caller knows it (constant dims).
    """
    keep = list(keep)
    if multi == "first":
        return _geofence_first(points, boxes, margin, lat, lon, keep, order_col)
    if n_boxes is None:
        n_boxes = boxes.count()       # a dimension: cheap, and bounds the broadcast
    if strategy == "grid" or n_boxes > nested_loop_max:
        return geofence_join_grid(points, boxes, margin, lat, lon, keep)
    b = _prepared_boxes(boxes, margin, keep, None)
    out = points.join(F.broadcast(b), _closed_cond(lat, lon), "left")
    return out.select(*points.columns, *[F.col(_P + k).alias(k) for k in keep])


def geofence_join_grid(points: DataFrame, boxes: DataFrame, margin: float = GEOFENCE_MARGIN_DEG,
                       lat: str = "latitude", lon: str = "longitude", keep=("airport_code",)) -> DataFrame:
    """The join on grid cells.  Boxes of one level: one LEFT join.  Of several: the
    points pass once, look up the candidates of their cell on each level, and give a
    row for each that holds them."""
    keep = list(keep)
    levels = _levels(_prepared_boxes(boxes, margin, keep, None))
    inside = _closed_cond(lat, lon)
    found = [F.col(_P + k).alias(k) for k in keep]
    if len(levels) == 1:
        cell, some = levels[0]
        return _cell_join(points, _explode_cells(some, cell), inside, "left", lat, lon, cell).select(*points.columns, *found)
    hit = _with_hits(points, levels, [_P + k for k in keep], lat, lon).withColumn(_P + "hit", F.explode_outer(_P + "hits"))
    kinds = {f.name: f.dataType for f in boxes.schema.fields}
    return hit.select(*points.columns, *[F.col(_P + "hit")[_P + k].cast(kinds[k]).alias(k) for k in keep])


def _with_hits(points: DataFrame, levels, fields: list[str], lat: str, lon: str) -> DataFrame:
    """``points`` with the array of boxes (``fields``) that hold each.  Boxes are
    grouped per level and cell into candidate arrays (a dimension-side aggregate,
    sized by how many boxes overlap one cell), so the points go once through a
    many-to-one lookup per level, without a shuffle of matches."""
    out, hits = points, []
    sides = [_P + x for x in ("lo_lat", "hi_lat", "lo_lon", "hi_lon")]
    for n, (cell, some) in enumerate(levels):
        cands = f"{_P}cands{n}"
        per_cell = _explode_cells(some, cell).groupBy(_P + "cell_lat", _P + "cell_lon").agg(
            F.collect_list(F.struct(*fields, *sides)).alias(cands))
        out = _cell_join(out, per_cell, F.lit(True), "left", lat, lon, cell).drop(_P + "cell_lat", _P + "cell_lon")
        held = F.filter(F.col(cands), lambda s: F.col(lat).between(s[sides[0]], s[sides[1]]) & F.col(lon).between(s[sides[2]], s[sides[3]]))
        hits.append(F.transform(F.coalesce(held, F.array()), lambda s: F.struct(*(s[f].alias(f) for f in fields))))
    if not hits:
        return points.withColumn(_P + "hits", F.array(F.struct(*(F.lit(None).alias(f) for f in fields))))
    found = hits[0] if len(hits) == 1 else F.concat(*hits)
    return out.withColumn(_P + "hits", found).drop(*(f"{_P}cands{n}" for n in range(len(hits))))


def _geofence_first(points, boxes, margin, lat, lon, keep, order_col):
    """At most one box per point: the lowest ``order_col`` among the boxes that hold
    it, without a dedup shuffle."""
    order_col = order_col or keep[0]
    fields = [_P + "order"] + [_P + k for k in keep]
    kinds = {f.name: f.dataType for f in boxes.schema.fields}
    hits = _with_hits(points, _levels(_prepared_boxes(boxes, margin, keep, order_col)), fields, lat, lon)
    best = hits.withColumn(_P + "best", F.array_min(_P + "hits"))
    return best.select(*points.columns, *[F.col(_P + "best")[_P + k].cast(kinds[k]).alias(k) for k in keep])
