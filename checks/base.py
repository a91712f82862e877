"""Registry, shared inputs and shared SQL of the check queries."""

from pyspark.sql import functions as F

from rastro import schema as S
from rastro.derived import LOCATIONS_SQL, locations_from_events
from rastro.operators.cleaning import clean_readings
from rastro.plans.load import load_warehouse
from rastro.plans.star import prepare_measurements
from rastro.session import scratch_path
from rastro.sources.warehouse import read_star

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register a query under ``name``; ``sql`` may refer to the tables of ``with_tables``."""

    def register(run):
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return run

    return register


# --- inputs ------------------------------------------------------------------------------


def events(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def locations(spark, sf_dir):
    return locations_from_events(events(spark, sf_dir))


def cleaned(spark, sf_dir):
    return clean_readings(locations(spark, sf_dir))


# Fixed rings of the four test districts: (id, name, rings of (longitude, latitude)).
DISTRICT_RINGS = [
    (1, "Distrito 1", [
        [(-63.25, -17.85), (-63.18, -17.85), (-63.18, -17.75), (-63.25, -17.75), (-63.25, -17.85)],
        [(-63.23, -17.82), (-63.20, -17.82), (-63.20, -17.79), (-63.23, -17.79), (-63.23, -17.82)],
    ]),
    (2, "Norte", [[(-63.18, -17.80), (-63.10, -17.80), (-63.14, -17.70), (-63.18, -17.80)]]),
    (3, "Sur", [
        [(-63.20, -17.89), (-63.12, -17.89), (-63.12, -17.86), (-63.20, -17.86), (-63.20, -17.89)],
    ]),
    (4, "Este", [
        [(-63.15, -17.82), (-63.09, -17.82), (-63.09, -17.76), (-63.15, -17.76), (-63.15, -17.82)],
    ]),
]


def districts(spark):
    rows = [
        (zid, f"demo.{zid}", name, "DISTRITO", rings, {}) for zid, name, rings in DISTRICT_RINGS
    ]
    return spark.createDataFrame(rows, S.DISTRICTS)


def prepared(spark, sf_dir):
    return prepare_measurements(locations(spark, sf_dir), districts(spark))


_loaded = {}


def warehouse_root(spark, sf_dir):
    """Folder of the warehouse loaded from the events, once per application."""
    key = (spark.sparkContext.applicationId, str(sf_dir))
    if key not in _loaded:
        root = scratch_path(spark, "warehouse")
        load_warehouse(spark, root, locations(spark, sf_dir), districts(spark), full_reload=True)
        _loaded[key] = root
    return _loaded[key]


def star(spark, sf_dir):
    return read_star(spark, warehouse_root(spark, sf_dir))


def rounded(df, **digits):
    """Round columns, as doubles."""
    return df.withColumns(
        {name: F.round(F.col(name).cast("double"), n) for name, n in digits.items()}
    )


# --- SQL ------------------------------------------------------------------------------------


def _edges():
    rows = []
    for zid, name, rings in DISTRICT_RINGS:
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                rows.append(f"({zid},'{name}',{x1}::DOUBLE,{y1}::DOUBLE,{x2}::DOUBLE,{y2}::DOUBLE)")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t(zid,nombre,x1,y1,x2,y2)"


def values(rows, names):
    def literal(v):
        if v is None:
            return "NULL"
        return f"'{v}'" if isinstance(v, str) else (f"{v}::DOUBLE" if isinstance(v, float) else str(v))

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({names})"


def place_sql(points):
    """District of each point (lat, lon): contained first, then nearest, then file order."""
    return f"""
SELECT lat, lon, zid, inside FROM (
 SELECT lat, lon, zid, inside, row_number() OVER (PARTITION BY lat, lon ORDER BY inside DESC, CASE WHEN inside = 1 THEN 0::DOUBLE ELSE d END, zid) AS rn FROM (
  SELECT lat, lon, zid, CASE WHEN odd = 1 AND edge_dist > 1e-9 THEN 1 ELSE 0 END AS inside, round(edge_dist, 9) AS d FROM (
   SELECT lat, lon, zid, sum(crossing) % 2 AS odd, min(sqrt((lon-(x1+t*(x2-x1)))*(lon-(x1+t*(x2-x1)))+(lat-(y1+t*(y2-y1)))*(lat-(y1+t*(y2-y1))))) AS edge_dist FROM (
    SELECT lat, lon, zid, x1, y1, x2, y2,
     CASE WHEN (y1 > lat) <> (y2 > lat) AND lon < (x2-x1)*(lat-y1)/(y2-y1)+x1 THEN 1 ELSE 0 END AS crossing,
     greatest(0::DOUBLE, least(1::DOUBLE, ((lon-x1)*(x2-x1)+(lat-y1)*(y2-y1))/((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)))) AS t
    FROM ({points}) AS pts CROSS JOIN edges) AS pe
   GROUP BY lat, lon, zid) AS pd) AS k) AS r
WHERE rn = 1"""


OPERATOR_SQL = (
    "CASE "
    + " ".join(
        "WHEN lower(trim(sim_operator)) IN ("
        + ", ".join(f"'{raw}'" for raw, to in S.OPERATOR_NAMES.items() if to == name)
        + f") THEN '{name}'"
        for _, name in S.OPERATORS
    )
    + " ELSE 'Desconocido' END"
)
NETWORK_SQL = (
    "CASE "
    + " ".join(
        "WHEN "
        + " OR ".join(f"contains(upper(network_type), '{mark}')" for mark in marks)
        + f" THEN '{name}'"
        for name, marks in S.NETWORK_MARKS
    )
    + " ELSE 'Desconocida' END"
)
SIGNAL_SQL = (
    "CASE WHEN signal IS NULL THEN 'Sin Senal' WHEN signal >= -70 THEN 'Excelente' "
    "WHEN signal >= -85 THEN 'Buena' WHEN signal >= -100 THEN 'Regular' "
    "WHEN signal >= -110 THEN 'Debil' ELSE 'Sin Senal' END"
)
SPEED_SQL = (
    "CASE WHEN speed IS NULL OR speed < 0 THEN 0::DOUBLE "
    "WHEN speed * 3.6::DOUBLE > 200 THEN 200::DOUBLE ELSE round(speed * 3.6::DOUBLE, 2) END"
)
_HAS_ID = "(device_id IS NOT NULL AND lower(trim(device_id)) NOT IN ('', 'none', 'null'))"
_HAS_NAME = "(device_name IS NOT NULL AND trim(device_name) <> '')"
IDENTIFIER_SQL = (
    f"CASE WHEN {_HAS_ID} THEN trim(device_id) WHEN {_HAS_NAME} THEN 'NAME_' || trim(device_name) "
    "ELSE 'UNKNOWN_' || CAST(CAST('0x' || md5(CAST(id AS VARCHAR))[1:8] AS BIGINT) % 100000 AS VARCHAR) END"
)
DISPLAY_SQL = (
    f"CASE WHEN {_HAS_ID} THEN coalesce(nullif(device_name, ''), 'Device_' || trim(device_id)) "
    f"WHEN {_HAS_NAME} THEN trim(device_name) ELSE 'Dispositivo Desconocido' END"
)
PERIOD_SQL = (
    "CASE WHEN hora BETWEEN 0 AND 5 THEN 'Madrugada' WHEN hora BETWEEN 6 AND 11 THEN 'Mañana' "
    "WHEN hora BETWEEN 12 AND 17 THEN 'Tarde' WHEN hora BETWEEN 18 AND 23 THEN 'Noche' "
    "ELSE 'Desconocido' END"
)


def _pick(names, column):
    whens = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"CASE {column} {whens} END"


CALENDAR_SQL = f"""
 CAST(year(fecha) AS INT) AS anio, CAST(month(fecha) AS INT) AS mes, CAST(day(fecha) AS INT) AS dia,
 CAST(isodow(fecha) - 1 AS INT) AS dia_semana, {_pick(S.WEEKDAYS, "isodow(fecha) - 1")} AS nombre_dia,
 {_pick(S.MONTHS, "month(fecha) - 1")} AS nombre_mes, CAST(quarter(fecha) AS INT) AS trimestre,
 isodow(fecha) >= 6 AS es_fin_semana"""

LOCATION_KEY_SQL = (
    "((CAST(latitud AS DECIMAL(10,7)) * 10000000)::BIGINT + 900000000) * 3600000001"
    " + (CAST(longitud AS DECIMAL(10,7)) * 10000000)::BIGINT + 1800000000"
)
DATE_KEY_SQL = "CAST(year(fecha) * 10000 + month(fecha) * 100 + day(fecha) AS INT)"
_DEVICE_UNSIGNED = "CAST(CAST('0x' || device_hash AS UBIGINT) AS HUGEINT)"
DEVICE_KEY_SQL = (
    f"CAST(CASE WHEN {_DEVICE_UNSIGNED} >= 9223372036854775808 "
    f"THEN {_DEVICE_UNSIGNED} - 18446744073709551616 ELSE {_DEVICE_UNSIGNED} END AS BIGINT)"
)

# name -> (tables it needs, SQL)
TABLES = {
    "locations": LOCATIONS_SQL.replace("{K}", "json_extract_string(props,'$.k')").replace(
        "{EVENTS}", "events"
    ),
    "cleaned": "SELECT * FROM locations WHERE latitude BETWEEN -90 AND 90"
    " AND longitude BETWEEN -180 AND 180 AND timestamp IS NOT NULL AND device_id IS NOT NULL",
    "features": "SELECT *, CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INT) AS hour,"
    " CAST(dayofweek(timestamp) + 1 AS INT) AS day_of_week, dayname(timestamp) AS weekday_name FROM cleaned",
    "lagged": """SELECT *, lag(latitude) OVER w AS prev_latitude, lag(longitude) OVER w AS prev_longitude,
 lag(timestamp) OVER w AS prev_timestamp FROM features
 WINDOW w AS (PARTITION BY device_id ORDER BY timestamp, id)""",
    "moves": """SELECT *,
 12742.0::DOUBLE * asin(sqrt(least(1::DOUBLE,
   pow(sin((radians(latitude) - radians(prev_latitude)) / 2), 2)
   + cos(radians(prev_latitude)) * cos(radians(latitude)) * pow(sin((radians(longitude) - radians(prev_longitude)) / 2), 2)))) AS distance_km,
 (floor(epoch(timestamp)) - floor(epoch(prev_timestamp))) / 3600 AS time_diff_hours FROM lagged""",
    "edges": _edges(),
    "built_in_zones": values(S.ZONES, "zid,nombre,zlat,zlon,radius"),
    "timed": "SELECT *, coalesce(timestamp, created_at) AS ts, coalesce(latitude, -17.7833::DOUBLE) AS lat,"
    " coalesce(longitude, -63.1822::DOUBLE) AS lon FROM locations WHERE coalesce(timestamp, created_at) IS NOT NULL",
    "placed": place_sql("SELECT DISTINCT lat, lon FROM timed"),
    "named": f"""SELECT *, {IDENTIFIER_SQL} AS device_identifier, {DISPLAY_SQL} AS device_display_name,
 'Unknown' AS device_model FROM timed""",
    "prepared": f"""SELECT id AS source_id, ts, CAST(ts AS DATE) AS fecha, CAST(hour(ts) AS INT) AS hora,
 {OPERATOR_SQL} AS operador, {NETWORK_SQL} AS red, {SIGNAL_SQL} AS calidad, signal AS senal,
 {SPEED_SQL} AS velocidad_kmh, battery AS bateria,
 greatest(-90::DOUBLE, least(90::DOUBLE, lat)) AS latitud, greatest(-180::DOUBLE, least(180::DOUBLE, lon)) AS longitud,
 coalesce(altitude, 0::DOUBLE) AS altitud, placed.zid AS zona_id, device_identifier, device_display_name, device_model,
 md5(lower(trim(device_identifier || '_' || device_model)))[1:16] AS device_hash
 FROM named JOIN placed USING (lat, lon)""",
    "dim_operador": "SELECT operador_id, nombre, CAST(NULL AS VARCHAR) AS grupo, true AS es_principal"
    f" FROM ({values(S.OPERATORS, 'operador_id,nombre')})",
    "dim_red": values(S.NETWORKS, "red_id,tipo_red,generacion,velocidad_teorica"),
    "dim_calidad": values(S.QUALITIES, "calidad_id,rango_senal,nivel,descripcion"),
    "dim_hora": f"""SELECT hora + 1 AS hora_id, hora, {PERIOD_SQL} AS periodo,
 lpad(CAST(hora AS VARCHAR), 2, '0') || ':00' AS nombre_hora, CAST(NULL AS BOOLEAN) AS es_hora_pico
 FROM (SELECT CAST(range AS INT) AS hora FROM range(24))""",
    "dim_tiempo": f"SELECT {DATE_KEY_SQL} AS tiempo_id, fecha, {CALENDAR_SQL}"
    " FROM (SELECT DISTINCT fecha FROM prepared)",
    "dim_ubicacion": f"""SELECT {LOCATION_KEY_SQL} AS ubicacion_id, latitud, longitud,
 CASE WHEN altitud BETWEEN -500 AND 10000 THEN altitud ELSE 0 END AS altitud, zona_id,
 CAST(trunc(latitud * 10000) AS INT)::VARCHAR || '_' || CAST(trunc(longitud * 10000) AS INT)::VARCHAR AS geohash
 FROM (SELECT *, row_number() OVER (PARTITION BY latitud, longitud ORDER BY source_id) AS rn FROM prepared) WHERE rn = 1""",
    "dim_dispositivo": f"""SELECT {DEVICE_KEY_SQL} AS dispositivo_id, device_hash,
 device_display_name AS nombre_dispositivo, device_model AS modelo, 'Unknown' AS fabricante
 FROM (SELECT *, row_number() OVER (PARTITION BY device_hash ORDER BY source_id) AS rn FROM prepared) WHERE rn = 1""",
    "boxes": "SELECT zid, nombre, min(least(x1, x2)) AS minx, min(least(y1, y2)) AS miny,"
    " max(greatest(x1, x2)) AS maxx, max(greatest(y1, y2)) AS maxy FROM edges GROUP BY zid, nombre",
    "dim_zonas": "SELECT zid AS zona_id, nombre, (miny + maxy) / 2 AS latitud_centro,"
    " (minx + maxx) / 2 AS longitud_centro, 5::DOUBLE AS radio_km FROM boxes",
    "fact": f"""SELECT source_id AS medicion_id, source_id, {DATE_KEY_SQL} AS tiempo_id, hora + 1 AS hora_id,
 operador_id, red_id, calidad_id, {LOCATION_KEY_SQL} AS ubicacion_id, {DEVICE_KEY_SQL} AS dispositivo_id,
 zona_id, CAST(senal AS DOUBLE) AS senal_dbm, velocidad_kmh AS velocidad, bateria, ts AS timestamp_original
 FROM prepared JOIN dim_operador ON operador = dim_operador.nombre JOIN dim_red ON red = tipo_red
 JOIN dim_calidad ON calidad = rango_senal""",
}


def with_tables(sql):
    """Prepend those tables that ``sql`` needs, directly or through another table."""
    needed = set()

    def visit(text):
        for name, body in TABLES.items():
            if name not in needed and _mentions(text, name):
                needed.add(name)
                visit(body)

    visit(sql)
    if not needed:
        return sql.strip()
    parts = [f"{name} AS ({body})" for name, body in TABLES.items() if name in needed]
    return f"WITH {', '.join(parts)} {sql.strip()}"


def _mentions(text, name):
    padded = "".join(c if c.isalnum() or c == "_" else " " for c in text)
    words = padded.split()
    return any(a.upper() in ("FROM", "JOIN", "USING") and b == name for a, b in zip(words, words[1:]))
