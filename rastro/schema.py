"""Schemas and fixed values shared by the whole package."""

from pyspark.sql import types as T

# --- readings as they arrive -------------------------------------------------

LOCATIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("device_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("altitude", T.DoubleType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("battery", T.IntegerType()),
        T.StructField("signal", T.IntegerType()),
        T.StructField("sim_operator", T.StringType()),
        T.StructField("network_type", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("device_id", T.StringType()),
    ]
)
REQUIRED_COLUMNS = tuple(LOCATIONS.fieldNames())
OPTIONAL_COLUMNS = (
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("device_model", T.StringType()),
)

# --- star schema ---------------------------------------------------------------

_COORDINATE = T.DecimalType(10, 7)

DIM_TIEMPO = T.StructType(
    [
        T.StructField("tiempo_id", T.IntegerType()),
        T.StructField("fecha", T.DateType()),
        T.StructField("anio", T.IntegerType()),
        T.StructField("mes", T.IntegerType()),
        T.StructField("dia", T.IntegerType()),
        T.StructField("dia_semana", T.IntegerType()),
        T.StructField("nombre_dia", T.StringType()),
        T.StructField("nombre_mes", T.StringType()),
        T.StructField("trimestre", T.IntegerType()),
        T.StructField("es_fin_semana", T.BooleanType()),
    ]
)
DIM_HORA = T.StructType(
    [
        T.StructField("hora_id", T.IntegerType()),
        T.StructField("hora", T.IntegerType()),
        T.StructField("periodo", T.StringType()),
        T.StructField("nombre_hora", T.StringType()),
        T.StructField("es_hora_pico", T.BooleanType()),
    ]
)
DIM_OPERADOR = T.StructType(
    [
        T.StructField("operador_id", T.IntegerType()),
        T.StructField("nombre", T.StringType()),
        T.StructField("grupo", T.StringType()),
        T.StructField("es_principal", T.BooleanType()),
    ]
)
DIM_RED = T.StructType(
    [
        T.StructField("red_id", T.IntegerType()),
        T.StructField("tipo_red", T.StringType()),
        T.StructField("generacion", T.IntegerType()),
        T.StructField("velocidad_teorica", T.StringType()),
    ]
)
DIM_CALIDAD = T.StructType(
    [
        T.StructField("calidad_id", T.IntegerType()),
        T.StructField("rango_senal", T.StringType()),
        T.StructField("nivel", T.StringType()),
        T.StructField("descripcion", T.StringType()),
    ]
)
DIM_UBICACION = T.StructType(
    [
        T.StructField("ubicacion_id", T.LongType()),
        T.StructField("latitud", _COORDINATE),
        T.StructField("longitud", _COORDINATE),
        T.StructField("altitud", T.DecimalType(10, 2)),
        T.StructField("zona_id", T.IntegerType()),
        T.StructField("geohash", T.StringType()),
    ]
)
DIM_DISPOSITIVO = T.StructType(
    [
        T.StructField("dispositivo_id", T.LongType()),
        T.StructField("device_hash", T.StringType()),
        T.StructField("nombre_dispositivo", T.StringType()),
        T.StructField("modelo", T.StringType()),
        T.StructField("fabricante", T.StringType()),
    ]
)
DIM_ZONAS = T.StructType(
    [
        T.StructField("zona_id", T.IntegerType()),
        T.StructField("nombre", T.StringType()),
        T.StructField("latitud_centro", _COORDINATE),
        T.StructField("longitud_centro", _COORDINATE),
        T.StructField("radio_km", T.DecimalType(5, 2)),
    ]
)
FACT_MEDICIONES = T.StructType(
    [
        T.StructField("medicion_id", T.LongType()),
        T.StructField("source_id", T.LongType()),
        T.StructField("tiempo_id", T.IntegerType()),
        T.StructField("hora_id", T.IntegerType()),
        T.StructField("operador_id", T.IntegerType()),
        T.StructField("red_id", T.IntegerType()),
        T.StructField("calidad_id", T.IntegerType()),
        T.StructField("ubicacion_id", T.LongType()),
        T.StructField("dispositivo_id", T.LongType()),
        T.StructField("zona_id", T.IntegerType()),
        T.StructField("senal_dbm", T.DecimalType(6, 2)),
        T.StructField("velocidad", T.DecimalType(10, 2)),
        T.StructField("bateria", T.IntegerType()),
        T.StructField("timestamp_original", T.TimestampNTZType()),
        T.StructField("fecha_carga", T.TimestampNTZType()),
    ]
)

TABLES = {
    "dim_tiempo": DIM_TIEMPO,
    "dim_hora": DIM_HORA,
    "dim_operador": DIM_OPERADOR,
    "dim_red": DIM_RED,
    "dim_calidad": DIM_CALIDAD,
    "dim_ubicacion": DIM_UBICACION,
    "dim_dispositivo": DIM_DISPOSITIVO,
    "dim_zonas": DIM_ZONAS,
    "fact_mediciones": FACT_MEDICIONES,
}
# beside the nine tables: the stored source ids as runs, and what a load could not take as it was
ID_RANGES = T.StructType([T.StructField(name, T.LongType()) for name in ("bucket", "low", "high")])
LOAD_ERRORS = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("source_id", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("reading", T.StringType()),  # as JSON
    ]
)
# sums of facts per key, and the devices behind them
ROLLUP_DIARIO = T.StructType(
    [
        *[T.StructField(f"{name}_id", T.IntegerType()) for name in ("tiempo", "hora", "operador", "calidad", "zona")],
        *[T.StructField(name, T.LongType()) for name in ("n", "n_placed", "n_flagged")],
        T.StructField("bateria_sum", T.LongType()),
        T.StructField("bateria_n", T.LongType()),
        T.StructField("senal_dbm_sum", T.DecimalType(38, 2)),
        T.StructField("senal_dbm_n", T.LongType()),
        T.StructField("velocidad_sum", T.DecimalType(38, 2)),
        T.StructField("velocidad_n", T.LongType()),
        T.StructField("altitud_sum", T.DecimalType(38, 2)),
    ]
)
ROLLUP_DISPOSITIVOS = T.StructType(
    [
        T.StructField("dispositivo_id", T.LongType()),
        *[T.StructField(f"{name}_id", T.IntegerType()) for name in ("hora", "operador", "zona")],
    ]
)
NATURAL_KEYS = {
    "dim_tiempo": ("fecha",),
    "dim_hora": ("hora",),
    "dim_operador": ("nombre",),
    "dim_red": ("tipo_red",),
    "dim_calidad": ("rango_senal",),
    "dim_ubicacion": ("latitud", "longitud"),
    "dim_dispositivo": ("device_hash",),
    "dim_zonas": ("zona_id",),
    "fact_mediciones": ("source_id",),
}
# fact column -> the dimension it refers to (the column has the same name there)
FOREIGN_KEYS = {
    "tiempo_id": "dim_tiempo",
    "hora_id": "dim_hora",
    "operador_id": "dim_operador",
    "red_id": "dim_red",
    "calidad_id": "dim_calidad",
    "ubicacion_id": "dim_ubicacion",
    "dispositivo_id": "dim_dispositivo",
    "zona_id": "dim_zonas",
}

# --- district polygons ---------------------------------------------------------

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
DISTRICTS = T.StructType(
    [
        T.StructField("zona_id", T.IntegerType()),  # position in the file, from 1
        T.StructField("distrito_id", T.StringType()),
        T.StructField("nombre", T.StringType()),
        T.StructField("tipo", T.StringType()),
        T.StructField("rings", T.ArrayType(T.ArrayType(POINT))),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    ]
)

# --- fixed values ----------------------------------------------------------------

LATITUDE_RANGE = (-90.0, 90.0)
LONGITUDE_RANGE = (-180.0, 180.0)
DEFAULT_LATITUDE = -17.7833
DEFAULT_LONGITUDE = -63.1822
ALTITUDE_RANGE = (-500.0, 10000.0)
EARTH_RADIUS_KM = 6371.0

# daily analysis, speeds in km/h
IMPOSSIBLE_SPEED_KMH = 200.0
CRITICAL_BATTERY = 10.0
JUMP_KM = 500.0

# dashboard
FLAG_SPEED_KMH = 120
FLAG_BATTERY = 10
FLAG_SIGNAL_DBM = -100
MAP_POINTS = 10_000
SCATTER_POINTS = 5_000
FLAGGED_ROWS = 100
TOP_ZONES = 15
SIMILAR_NAMES = 15

UNKNOWN_OPERATOR = "Desconocido"
UNKNOWN_NETWORK = "Desconocida"
NO_SIGNAL = "Sin Senal"
UNKNOWN_TEXT = "Unknown"
UNKNOWN_DEVICE = "Dispositivo Desconocido"

OPERATOR_NAMES = {
    "entel": "ENTEL",
    "entel s.a bolivia": "ENTEL",
    "ladistancianoscuida": "ENTEL",
    "movil gsm": "ENTEL",
    "bomov": "ENTEL",
    "+18vacunate": "ENTEL",
    "tigo": "Tigo",
    "comunicaciones celulares s.a.": "Tigo",
    "comunicaciones celulares": "Tigo",
    "viva": "Viva",
    "nuevatel pcs de bolivia s.a.": "Viva",
    "nuevatel pcs": "Viva",
    "nuevatel": "Viva",
    "sin senal": "Sin Senal",
    "desconocido": "Desconocido",
    "": "Desconocido",
    "null": "Desconocido",
}

# (id, name)
OPERATORS = [
    (1, "ENTEL"),
    (2, "Tigo"),
    (3, "Viva"),
    (4, "Sin Senal"),
    (5, "Desconocido"),
]
# (id, type, generation, nominal rate)
NETWORKS = [
    (1, "5G", 5, "1-10 Gbps"),
    (2, "4G LTE", 4, "100-300 Mbps"),
    (3, "3G", 3, "2-10 Mbps"),
    (4, "2G", 2, "0.1-0.3 Mbps"),
    (5, "Desconocida", 0, "N/A"),
]
# (id, range name, level, description)
QUALITIES = [
    (1, "Excelente", "Excelente", ">= -70 dBm"),
    (2, "Buena", "Buena", "-70 a -85 dBm"),
    (3, "Regular", "Regular", "-85 a -100 dBm"),
    (4, "Debil", "Debil", "-100 a -110 dBm"),
    (5, "Sin Senal", "Sin Senal", "< -110 dBm"),
]
# text fragments that identify a network, strongest first
NETWORK_MARKS = [
    ("5G", ["5G"]),
    ("4G LTE", ["4G", "LTE"]),
    ("3G", ["3G", "HSPA", "WCDMA"]),
    ("2G", ["2G", "GSM", "EDGE"]),
]
# lowest dBm of each level, best first
SIGNAL_FLOORS = [("Excelente", -70), ("Buena", -85), ("Regular", -100), ("Debil", -110)]
# last hour of each period
DAY_PERIODS = [("Madrugada", 5), ("Mañana", 11), ("Tarde", 17), ("Noche", 23)]
UNKNOWN_PERIOD = "Desconocido"

WEEKDAYS = ["Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo"]
MONTHS = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]

# (id, name, latitude, longitude, radius in km): zones used when no polygons are given
ZONES = [
    (1, "Centro", -17.7833, -63.1822, 2.0),
    (2, "Equipetrol", -17.7650, -63.1950, 2.5),
    (3, "Plan 3000", -17.8200, -63.1400, 4.0),
    (4, "Villa 1ro de Mayo", -17.7500, -63.1600, 3.0),
    (5, "Pampa de la Isla", -17.7350, -63.1450, 3.5),
    (6, "Los Lotes", -17.8400, -63.1200, 4.0),
    (7, "UV-1", -17.7900, -63.1750, 2.0),
    (8, "Urbari", -17.7700, -63.2100, 2.5),
    (9, "Las Palmas", -17.8050, -63.2000, 3.0),
    (10, "Santos Dumont", -17.7600, -63.1350, 3.0),
    (11, "Radial 10", -17.8150, -63.1600, 2.5),
    (12, "Radial 13", -17.7950, -63.2200, 2.5),
    (13, "Radial 17", -17.7550, -63.2050, 2.5),
    (14, "Radial 19", -17.7450, -63.1750, 2.5),
    (15, "Radial 26", -17.7750, -63.1500, 2.5),
    (16, "El Bajio", -17.7300, -63.1900, 3.5),
    (17, "Palmasola", -17.7100, -63.1600, 4.0),
    (18, "La Guardia", -17.8800, -63.3300, 5.0),
    (19, "Warnes", -17.5100, -63.1700, 6.0),
    (20, "Cotoca", -17.7500, -62.9900, 5.0),
]
ZONE_RADIUS_TO_DEGREES = 0.01
DISTRICT_RADIUS_KM = 5.0

DEVICE_HASH_LENGTH = 64
TEXT_LENGTH = 200
ZONE_NAME_LENGTH = 100
CELL_KEY_LENGTH = 25
