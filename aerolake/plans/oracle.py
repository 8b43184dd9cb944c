"""SQL spelling of the models for the DuckDB oracle.

Each model is one CTE; ``sql(body, *ctes)`` prepends the CTEs a query needs
(with their dependencies, in order).  The Spark side never runs this text:
it is the independent statement of the expected result.
"""

from __future__ import annotations

from aerolake.plans.telemetry import TELEMETRY_SQL


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# FIXED VALUES, stated here a second time so that a wrong bound or label on the Spark
# side shows as a difference.
AIRPORT_VALUES = """('Sudeste', 'Sao Paulo', 'Sao Paulo', 'GRU', 'Guarulhos International', -23.55::DOUBLE, -23.35::DOUBLE, -46.6::DOUBLE, -46.3::DOUBLE),
    ('Sudeste', 'Sao Paulo', 'Sao Paulo', 'CGH', 'Congonhas', -23.68::DOUBLE, -23.6::DOUBLE, -46.7::DOUBLE, -46.5::DOUBLE),
    ('Sudeste', 'Sao Paulo', 'Campinas', 'VCP', 'Viracopos', -23.05::DOUBLE, -22.95::DOUBLE, -47.18::DOUBLE, -47.1::DOUBLE),
    ('Não Mapeado', 'Não Mapeado', 'Em Rota', 'N/A', 'Espaço Aéreo Geral', 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE)"""


def _continent_case(col: str) -> str:
    return (f"CASE WHEN {col} IN ('Brazil', 'Argentina', 'Chile', 'Uruguay', 'Colombia', 'Peru') THEN 'América do Sul' "
            f"WHEN {col} IN ('United States', 'Canada', 'Mexico') THEN 'América do Norte' "
            f"WHEN {col} IN ('France', 'Germany', 'United Kingdom', 'Portugal', 'Spain', 'Italy', 'Switzerland') THEN 'Europa' "
            f"WHEN {col} = 'Desconhecido' THEN 'Desconhecido' ELSE 'Outros Continentes' END")


def behavior_case(p: str = "") -> str:
    return (f"CASE WHEN {p}on_ground = true THEN 'Táxi / Estacionado' WHEN {p}altitude_baro > 15000 THEN 'Cruzeiro' "
            f"WHEN {p}vertical_rate > 500 THEN 'Subida' WHEN {p}vertical_rate < -500 THEN 'Descida / Aproximação' ELSE 'Nivelado' END")


def altitude_case(p: str = "") -> str:
    return (f"CASE WHEN {p}on_ground = true THEN 'Solo' WHEN {p}altitude_baro < 10000 THEN 'Baixa Altitude (< 10k ft)' "
            f"WHEN {p}altitude_baro BETWEEN 10000 AND 25000 THEN 'Média Altitude (10k-25k ft)' ELSE 'Alta Altitude (> 25k ft)' END")


def speed_case(p: str = "") -> str:
    return (f"CASE WHEN {p}on_ground = true THEN 'Solo' WHEN {p}speed_kmh < 400 THEN 'Lento / Aproximação' "
            f"WHEN {p}speed_kmh BETWEEN 400 AND 700 THEN 'Cruzeiro Médio' ELSE 'Alta Velocidade' END")


def status_case(p: str = "") -> str:
    return f"CASE WHEN {p}on_ground = true THEN 'No Solo' ELSE 'Em Voo' END"


def us_week_sql(d: str) -> str:
    # DuckDB dayofweek is 0-based (Sunday = 0), hence -1 instead of -2.
    return (f"CAST(floor((dayofyear({d}) + dayofweek(date_trunc('year', {d})) - 1) / 7) + 1 AS INTEGER)")


def calendar_cols(ts: str) -> str:
    return (f"CAST({ts} AS DATE) AS flight_date, CAST(year({ts}) AS INTEGER) AS year_num, "
            f"'Q' || CAST(quarter({ts}) AS VARCHAR) AS quarter_name, CAST(month({ts}) AS INTEGER) AS month_num, "
            f"{us_week_sql(ts)} AS week_of_year, CAST(day({ts}) AS INTEGER) AS day_num, "
            f"CAST(dayofweek({ts}) + 1 AS INTEGER) AS day_of_week_num")


def period_case(h: str) -> str:
    return f"CASE WHEN {h} BETWEEN 5 AND 11 THEN 'Manhã' WHEN {h} BETWEEN 12 AND 17 THEN 'Tarde' ELSE 'Noite' END"


CTES: dict[str, tuple[list[str], str]] = {
    "telemetry": ([], TELEMETRY_SQL),
    "bronze": (["telemetry"],
               "SELECT *, event_id AS id_surrogate, CAST(inserted_at AS DATE) AS processing_date FROM telemetry"),
    "typed": (["bronze"], """SELECT
    left(upper(trim(icao24)), 50) AS aircraft_id,
    left(upper(trim(replace(callsign, '-', ''))), 50) AS flight_number,
    CAST(id_surrogate AS BIGINT) AS id_surrogate,
    trim(origin_country) AS origin_country,
    make_timestamp(CAST(time_position AS BIGINT) * 1000000) AS position_timestamp,
    CAST(longitude AS DOUBLE) AS longitude,
    CAST(latitude AS DOUBLE) AS latitude,
    CAST(baro_altitude AS DOUBLE) AS altitude_baro,
    CAST(velocity AS DOUBLE) AS speed_kmh,
    CAST(vertical_rate AS DOUBLE) AS vertical_rate,
    CAST(on_ground AS BOOLEAN) AS on_ground,
    CAST(processing_date AS TIMESTAMP) AS processing_date,
    inserted_at
  FROM bronze"""),
    "stg": (["typed"], """SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY aircraft_id, position_timestamp
                                 ORDER BY inserted_at DESC NULLS LAST, id_surrogate DESC NULLS LAST) AS rn
    FROM typed) WHERE rn = 1"""),
    "airports": ([], "SELECT * FROM (VALUES\n    " + AIRPORT_VALUES +
                 "\n  ) AS t(region, state, city, airport_code, airport_name, lat_min, lat_max, lon_min, lon_max)"),
    "fct": (["stg", "airports"], f"""SELECT
    left(s.aircraft_id, 50) || '-' || strftime(s.position_timestamp, '%Y-%m-%d %H:%M:%S') AS flight_pk,
    left(s.aircraft_id, 50) AS aircraft_id,
    CAST(s.position_timestamp AS DATE) AS flight_date,
    coalesce(a.airport_code, 'N/A') AS airport_code,
    s.latitude, s.longitude,
    coalesce(s.speed_kmh, 0) AS speed_kmh,
    coalesce(s.altitude_baro, 0) AS altitude_baro,
    coalesce(s.vertical_rate, 0) AS vertical_rate,
    s.on_ground,
    {status_case('s.')} AS flight_status,
    {behavior_case('s.')} AS flight_behavior,
    {altitude_case('s.')} AS altitude_tier,
    {speed_case('s.')} AS speed_tier,
    s.inserted_at AS ingestion_timestamp,
    CAST(hour(s.position_timestamp) AS INTEGER) AS hour_24
  FROM stg s LEFT JOIN airports a
    ON s.latitude BETWEEN a.lat_min - 0.005 AND a.lat_max + 0.005
   AND s.longitude BETWEEN a.lon_min - 0.005 AND a.lon_max + 0.005"""),
    "dim_aircrafts": (["stg"], f"""SELECT aircraft_id, origin_country,
    CASE WHEN origin_country = 'Brazil' THEN 'Nacional'
         WHEN origin_country = 'Desconhecido' THEN 'Não Identificado'
         ELSE 'Estrangeiro' END AS aircraft_category,
    {_continent_case('origin_country')} AS continent
  FROM (SELECT aircraft_id, max(coalesce(origin_country, 'Desconhecido')) AS origin_country
        FROM stg GROUP BY aircraft_id)"""),
    "dim_calendar": (["stg"], f"SELECT DISTINCT {calendar_cols('position_timestamp')} FROM stg"),
    "star": (["fct", "dim_aircrafts", "dim_calendar", "airports"], """SELECT f.*,
    d.origin_country, d.aircraft_category, d.continent,
    a.region, a.state, a.city, a.airport_name,
    c.year_num, c.quarter_name, c.month_num, c.week_of_year, c.day_num, c.day_of_week_num
  FROM fct f
  LEFT JOIN dim_aircrafts d ON f.aircraft_id = d.aircraft_id
  LEFT JOIN airports a ON f.airport_code = a.airport_code
  LEFT JOIN dim_calendar c ON f.flight_date = c.flight_date"""),
}


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        for dep in CTES[n][0]:
            visit(dep)
        if n not in seen:
            seen.append(n)
    for n in names:
        visit(n)
    return seen


def sql(body: str, *ctes: str, extra: dict | None = None) -> str:
    """``WITH`` the named CTEs (plus dependencies and ``extra`` CTEs) + body."""
    parts = [f"{n} AS (\n  {CTES[n][1]}\n)" for n in _order(ctes)]
    for n, text in (extra or {}).items():
        parts.append(f"{n} AS (\n  {text}\n)")
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


def stg_chain(source: str, prefix: str) -> dict[str, str]:
    """typed -> stg -> fct CTEs over another bronze source (e.g. one load)."""
    typed = CTES["typed"][1].replace("FROM bronze", f"FROM {source}")
    stg = CTES["stg"][1].replace("FROM typed", f"FROM {prefix}typed")
    fct = CTES["fct"][1].replace("FROM stg s", f"FROM {prefix}stg s")
    return {f"{prefix}typed": typed, f"{prefix}stg": stg, f"{prefix}fct": fct}
