"""Fixed values the results depend on.

FIXED VALUES — these must stay equal to the documented behaviour of the
telemetry marts (labels are Portuguese as published; box bounds in degrees).
They are listed plainly and in their natural order.
"""

# --- FIXED VALUES: airport dimension rows -----------------------------------
# (region, state, city, airport_code, airport_name, lat_min, lat_max, lon_min, lon_max)
AIRPORT_ROWS = [
    ("Sudeste", "Sao Paulo", "Sao Paulo", "GRU", "Guarulhos International", -23.55, -23.35, -46.60, -46.30),
    ("Sudeste", "Sao Paulo", "Sao Paulo", "CGH", "Congonhas", -23.68, -23.60, -46.70, -46.50),
    ("Sudeste", "Sao Paulo", "Campinas", "VCP", "Viracopos", -23.05, -22.95, -47.18, -47.10),
    ("Não Mapeado", "Não Mapeado", "Em Rota", "N/A", "Espaço Aéreo Geral", 0.0, 0.0, 0.0, 0.0),
]
UNKNOWN_AIRPORT = "N/A"
GEOFENCE_MARGIN_DEG = 0.005

# --- FIXED VALUES: producer-side airport centres (strict +-0.2 degree box) ---
PRODUCER_CENTRES = {
    "SBGR": (-23.43, -46.47),
    "SBSP": (-23.63, -46.65),
    "SBKP": (-23.01, -47.13),
}
PRODUCER_MAX_DEG = 0.2

# --- FIXED VALUES: status / behaviour / tier labels and thresholds -----------
STATUS_GROUND = "No Solo"
STATUS_AIR = "Em Voo"

BEHAVIOR_GROUND = "Táxi / Estacionado"
BEHAVIOR_CRUISE = "Cruzeiro"
BEHAVIOR_CLIMB = "Subida"
BEHAVIOR_DESCENT = "Descida / Aproximação"
BEHAVIOR_LEVEL = "Nivelado"
CRUISE_ALTITUDE = 15000
CLIMB_RATE = 500
DESCENT_RATE = -500

TIER_GROUND = "Solo"
ALT_LOW = "Baixa Altitude (< 10k ft)"
ALT_MID = "Média Altitude (10k-25k ft)"
ALT_HIGH = "Alta Altitude (> 25k ft)"
ALT_LOW_BELOW = 10000
ALT_MID_MAX = 25000

SPEED_LOW = "Lento / Aproximação"
SPEED_MID = "Cruzeiro Médio"
SPEED_HIGH = "Alta Velocidade"
SPEED_LOW_BELOW = 400
SPEED_MID_MAX = 700

# --- FIXED VALUES: aircraft dimension -----------------------------------------
UNKNOWN_COUNTRY = "Desconhecido"
HOME_COUNTRY = "Brazil"
CATEGORY_NATIONAL = "Nacional"
CATEGORY_UNKNOWN = "Não Identificado"
CATEGORY_FOREIGN = "Estrangeiro"

CONTINENT_OF_COUNTRY = {
    "Brazil": "América do Sul",
    "Argentina": "América do Sul",
    "Chile": "América do Sul",
    "Uruguay": "América do Sul",
    "Colombia": "América do Sul",
    "Peru": "América do Sul",
    "United States": "América do Norte",
    "Canada": "América do Norte",
    "Mexico": "América do Norte",
    "France": "Europa",
    "Germany": "Europa",
    "United Kingdom": "Europa",
    "Portugal": "Europa",
    "Spain": "Europa",
    "Italy": "Europa",
    "Switzerland": "Europa",
    "Desconhecido": "Desconhecido",
}
OTHER_CONTINENT = "Outros Continentes"

# --- FIXED VALUES: quality-check vocabularies ----------------------------------
# accepted flight_status values as declared for the gold fact (lower-case 's'/'v';
# they pass only under case-insensitive comparison).
DECLARED_STATUS_VALUES = ["No solo", "Em voo"]
# alternative vocabulary of the unloaded test file.
ALTERNATIVE_STATUS_VALUES = ["Taxiando/Parado", "Decolagem/Pouso",
                             "Baixa Altitude (Aproximacao)", "Voo de Cruzeiro"]
SPEED_RANGE = (0, 1300)

# --- period of day (hierarchy level without published limits; our default) ---
DAY_PERIODS = [("Manhã", 5, 11), ("Tarde", 12, 17)]
DAY_PERIOD_OTHER = "Noite"

# --- unit factors (opt-in conversion) ------------------------------------------
FEET_PER_METRE = 3.28084
KMH_PER_MS = 3.6
FPM_PER_MS = 196.850394
