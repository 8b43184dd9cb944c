"""Registered queries: data-quality checks (D1-D6) and foreign-key orphans (J4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolake import constants as K
from aerolake.operators import quality as D
from aerolake.plans import build, dims, layers, telemetry
from aerolake.plans.oracle import _q, sql
from aerolake.plans.registry import register
from aerolake.session import fresh_path
from aerolake.sources.tables import read_table

# ------------------------------------------------------------------ D1 unique
@register("dq_unique", sql(
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
    "WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"))
def q_dq_unique(spark, sf_dir):
    return D.dq_unique(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_unique_orders", sql(
    "SELECT o_orderkey, count(*) AS n_rows FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1"))
def q_dq_unique_orders(spark, sf_dir):
    return D.dq_unique(read_table(spark, sf_dir, "orders"), "o_orderkey")


@register("dq_unique_fact", sql(
    "SELECT flight_pk, count(*) AS n_rows FROM fct WHERE flight_pk IS NOT NULL GROUP BY 1 HAVING count(*) > 1", "fct"))
def q_dq_unique_fact(spark, sf_dir):
    return D.dq_unique(build.gold_fact(spark, sf_dir), "flight_pk")


# ------------------------------------------------------------------ D2 not_null
@register("dq_not_null", sql(
    "SELECT aircraft_id, position_timestamp, origin_country FROM stg WHERE origin_country IS NULL", "stg"))
def q_dq_not_null(spark, sf_dir):
    stg = build.silver(spark, sf_dir).select("aircraft_id", "position_timestamp", "origin_country")
    return D.dq_not_null(stg, "origin_country")


# ------------------------------------------------------------------ D3 accepted_values
_STATUS_IN = ", ".join(_q(v) for v in K.DECLARED_STATUS_VALUES)
_STATUS_IN_LOWER = ", ".join(_q(v.lower()) for v in K.DECLARED_STATUS_VALUES)


@register("dq_accepted_values", sql(
    f"SELECT flight_pk, flight_status FROM fct WHERE lower(flight_status) NOT IN ({_STATUS_IN_LOWER})", "fct"))
def q_dq_accepted_values(spark, sf_dir):
    f = build.gold_fact(spark, sf_dir).select("flight_pk", "flight_status")
    return D.dq_accepted_values(f, "flight_status", K.DECLARED_STATUS_VALUES, case_sensitive=False)


@register("dq_accepted_values_strict", sql(
    f"SELECT flight_pk, flight_status FROM fct WHERE flight_status NOT IN ({_STATUS_IN})", "fct"))
def q_dq_accepted_values_strict(spark, sf_dir):
    f = build.gold_fact(spark, sf_dir).select("flight_pk", "flight_status")
    return D.dq_accepted_values(f, "flight_status", K.DECLARED_STATUS_VALUES, case_sensitive=True)


_ALTERNATIVE = "('Taxiando/Parado', 'Decolagem/Pouso', 'Baixa Altitude (Aproximacao)', 'Voo de Cruzeiro')"
_ALT_STATUS = ("CASE event_id % 6 WHEN 0 THEN 'Taxiando/Parado' WHEN 1 THEN 'Decolagem/Pouso' "
               "WHEN 2 THEN 'Baixa Altitude (Aproximacao)' WHEN 3 THEN 'Voo de Cruzeiro' WHEN 4 THEN 'Em Voo' END")


@register("dq_accepted_values_alternative", sql(
    f"SELECT * FROM (SELECT event_id, {_ALT_STATUS} AS flight_status FROM telemetry) WHERE flight_status NOT IN {_ALTERNATIVE}",
    "telemetry"))
def q_dq_accepted_values_alternative(spark, sf_dir):
    """The vocabulary of the test file that is not loaded, over statuses of it and one of the other."""
    rows = telemetry.telemetry(spark, sf_dir).select("event_id", F.expr(_ALT_STATUS).alias("flight_status"))
    return D.dq_accepted_values(rows, "flight_status", K.ALTERNATIVE_STATUS_VALUES)


@register("dq_accepted_values_orders", sql(
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN "
    "('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')"))
def q_dq_accepted_values_orders(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return D.dq_accepted_values(o, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"])


# ------------------------------------------------------------------ D4 accepted_range
@register("dq_accepted_range", sql(
    "SELECT flight_pk, speed_kmh FROM fct WHERE speed_kmh < 0 OR speed_kmh > 1300", "fct"))
def q_dq_accepted_range(spark, sf_dir):
    f = build.gold_fact(spark, sf_dir).select("flight_pk", "speed_kmh")
    return D.dq_accepted_range(f, "speed_kmh", *K.SPEED_RANGE)


@register("dq_accepted_range_vrate", sql(
    "SELECT aircraft_id, position_timestamp, vertical_rate FROM stg "
    "WHERE vertical_rate < -1000 OR vertical_rate > 1000", "stg"))
def q_dq_accepted_range_vrate(spark, sf_dir):
    s = build.silver(spark, sf_dir).select("aircraft_id", "position_timestamp", "vertical_rate")
    return D.dq_accepted_range(s, "vertical_rate", -1000, 1000)


# ------------------------------------------------------------------ D5 relationships, J4 orphans
@register("dq_relationships", sql(
    "SELECT l_orderkey, count(*) AS n_rows FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN "
    "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey IS NOT NULL) GROUP BY l_orderkey"))
def q_dq_relationships(spark, sf_dir):
    # failing case: line items must belong to a finished order
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey")
    finished = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return D.dq_relationships(li, "l_orderkey", finished, "o_orderkey")


@register("dq_relationships_fact", sql(
    "SELECT aircraft_id, count(*) AS n_rows FROM fct WHERE aircraft_id IS NOT NULL AND aircraft_id NOT IN "
    "(SELECT aircraft_id FROM dim_aircrafts) GROUP BY aircraft_id", "fct", "dim_aircrafts"))
def q_dq_relationships_fact(spark, sf_dir):
    stg = build.silver(spark, sf_dir)
    f = build.fact.fct_flights(stg, dims.dim_airports(spark), n_airports=dims.N_AIRPORTS)
    return D.dq_relationships(f, "aircraft_id", dims.dim_aircrafts(stg), "aircraft_id")


@register("fk_orphans", sql(
    "SELECT l.* FROM lineitem l WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')"))
def q_fk_orphans(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    finished = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return D.orphans(li, "l_orderkey", finished, "o_orderkey")


@register("fk_orphans_orders", sql(
    "SELECT l.* FROM lineitem l WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)"))
def q_fk_orphans_orders(spark, sf_dir):
    return D.orphans(read_table(spark, sf_dir, "lineitem"), "l_orderkey",
                     read_table(spark, sf_dir, "orders"), "o_orderkey")


@register("fk_orphans_fact", sql(
    "SELECT f.* FROM fct f WHERE f.airport_code IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM airports a WHERE a.airport_code = f.airport_code)", "fct", "airports"))
def q_fk_orphans_fact(spark, sf_dir):
    return D.orphans(build.gold_fact(spark, sf_dir), "airport_code", dims.dim_airports(spark), "airport_code")


# ------------------------------------------------------------------ D6 the declared suite
SUITE = [
    D.Check("stg_flights", "unique", "id_surrogate"),
    D.Check("stg_flights", "not_null", "id_surrogate"),
    D.Check("stg_flights", "not_null", "aircraft_id"),
    D.Check("stg_flights", "accepted_range", "latitude", {"lo": -90, "hi": 90}),
    D.Check("stg_flights", "accepted_range", "longitude", {"lo": -180, "hi": 180}),
    D.Check("stg_flights", "accepted_range", "speed_kmh", {"lo": 0, "hi": 1300}),
    D.Check("dim_aircrafts", "unique", "aircraft_id"),
    D.Check("dim_aircrafts", "not_null", "aircraft_id"),
    D.Check("dim_airports", "unique", "airport_code"),
    D.Check("dim_airports", "not_null", "airport_code"),
    D.Check("dim_calendar", "unique", "flight_date"),
    D.Check("dim_calendar", "not_null", "flight_date"),
    D.Check("fct_flights", "unique", "flight_pk"),
    D.Check("fct_flights", "not_null", "flight_pk"),
    D.Check("fct_flights", "not_null", "aircraft_id"),
    D.Check("fct_flights", "relationships", "aircraft_id", {"to": "dim_aircrafts", "field": "aircraft_id"}),
    D.Check("fct_flights", "relationships", "airport_code", {"to": "dim_airports", "field": "airport_code"}),
    D.Check("fct_flights", "accepted_range", "speed_kmh", {"lo": 0, "hi": 1300}),
    D.Check("fct_flights", "accepted_values", "flight_status",
            {"values": K.DECLARED_STATUS_VALUES, "case_sensitive": False}),
]

_MODEL_CTE = {"stg_flights": "stg", "dim_aircrafts": "dim_aircrafts", "dim_airports": "airports",
              "dim_calendar": "dim_calendar", "fct_flights": "fct"}


def suite_sql(prefix: str = "", extra: dict | None = None) -> str:
    """The suite over the models, or over CTEs of ``extra`` named with ``prefix``."""
    cte = lambda model: prefix + _MODEL_CTE[model] if prefix + _MODEL_CTE[model] in (extra or {}) else _MODEL_CTE[model]     # noqa: E731
    parts = []
    for c in SUITE:
        t = cte(c.model)
        if c.kind == "unique":
            v = (f"(SELECT count(*) FROM (SELECT {c.column} FROM {t} WHERE {c.column} IS NOT NULL "
                 f"GROUP BY {c.column} HAVING count(*) > 1))")
        elif c.kind == "not_null":
            v = f"(SELECT count(*) FROM {t} WHERE {c.column} IS NULL)"
        elif c.kind == "accepted_range":
            v = (f"(SELECT count(*) FROM {t} WHERE {c.column} < {c.params['lo']} "
                 f"OR {c.column} > {c.params['hi']})")
        elif c.kind == "accepted_values":
            vals = ", ".join(_q(x.lower()) for x in c.params["values"])
            v = f"(SELECT count(*) FROM {t} WHERE lower({c.column}) NOT IN ({vals}))"
        else:
            pt, pf = cte(c.params["to"]), c.params["field"]
            v = (f"(SELECT count(DISTINCT {c.column}) FROM {t} WHERE {c.column} IS NOT NULL AND {c.column} "
                 f"NOT IN (SELECT {pf} FROM {pt} WHERE {pf} IS NOT NULL))")
        parts.append(f"SELECT {_q(c.model)} AS model, {_q(c.kind)} AS check_name, {_q(c.column)} AS column_name, "
                     f"CAST({v} AS BIGINT) AS violations")
    body = " UNION ALL ".join(parts)
    return sql(f"SELECT *, violations = 0 AS passed FROM ({body})", "stg", "fct", "dim_aircrafts",
               "dim_calendar", "airports", extra=extra)


def declared_models(spark, sf_dir) -> dict:
    """The built models, as a build would leave them: silver and fact are written
    once as Parquet and every check reads the columns it needs."""
    root = fresh_path(spark, "warehouse")
    stg = layers.materialise(build.silver(spark, sf_dir), "stg_flights", "table", root=root, layer="silver")
    airports = dims.dim_airports(spark)
    fct = layers.materialise(build.fact.fct_flights(stg, airports, n_airports=dims.N_AIRPORTS), "fct_flights", "table",
                             root=root)
    return {"stg_flights": stg, "dim_aircrafts": dims.dim_aircrafts(stg), "dim_airports": airports,
            "dim_calendar": dims.dim_calendar(stg), "fct_flights": fct}


@register("dq_report", suite_sql())
def q_dq_report(spark, sf_dir):
    return D.dq_run(declared_models(spark, sf_dir), SUITE)
