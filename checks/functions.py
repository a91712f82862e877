"""Column helpers, each applied to every reading."""

from pyspark.sql import functions as F

from checks.base import (
    CALENDAR_SQL,
    DEVICE_KEY_SQL,
    DISPLAY_SQL,
    IDENTIFIER_SQL,
    LOCATION_KEY_SQL,
    NETWORK_SQL,
    OPERATOR_SQL,
    PERIOD_SQL,
    SIGNAL_SQL,
    SPEED_SQL,
    cleaned,
    locations,
    prepared,
    query,
    rounded,
)
from rastro import schema as S
from rastro.functions import calendar as C
from rastro.functions import keys as K
from rastro.functions import measures as M
from rastro.functions import text as X
from rastro.operators.cleaning import drop_unparseable_timestamps
from rastro.operators.movement import add_distance_from_previous
from rastro.operators.temporal import add_temporal_features


def _each(name, sql):
    """Register a query that shows columns of every reading next to its id."""

    def register(columns):
        @query(name, f"SELECT id, {sql} FROM locations")
        def run(spark, sf_dir):
            readings = locations(spark, sf_dir)
            return readings.select(readings["id"], *columns())

        return columns

    return register


@_each("normalize_operator", f"sim_operator, {OPERATOR_SQL} AS operador")
def _():
    return "sim_operator", X.normalize_operator(F.col("sim_operator")).alias("operador")


@_each("normalize_network", f"network_type, {NETWORK_SQL} AS red")
def _():
    return "network_type", X.normalize_network(F.col("network_type")).alias("red")


@_each(
    "sanitize_string",
    "nullif(trim(coalesce(sim_operator, '')), '') AS operator_text,"
    " trim(trim(coalesce(sim_operator, '')) || ' x') AS messy",
)
def _():
    text = F.coalesce("sim_operator", F.lit(""))
    messy = F.concat(F.lit("  \t"), text, F.lit("  \u0001x\n"))
    return X.sanitize_string(text).alias("operator_text"), X.sanitize_string(messy).alias("messy")


@_each(
    "truncate_string",
    "substr(trim(sim_operator), 1, 8) AS short, coalesce(length(trim(sim_operator)) > 8, false) AS cut",
)
def _():
    name = F.col("sim_operator")
    return X.truncate_string(name, 8).alias("short"), X.was_truncated(name, 8).alias("cut")


_LAT = "greatest(-90::DOUBLE, least(90::DOUBLE, coalesce(latitude, -17.7833::DOUBLE)))"
_LON = "greatest(-180::DOUBLE, least(180::DOUBLE, coalesce(longitude, -63.1822::DOUBLE)))"


@_each(
    "cell_key",
    f"CAST(trunc({_LAT} * 10000) AS INT)::VARCHAR || '_' ||"
    f" CAST(trunc({_LON} * 10000) AS INT)::VARCHAR AS cell",
)
def _():
    return (M.cell_key(F.col("latitude"), F.col("longitude")).alias("cell"),)


@_each("clamp_coordinates", f"{_LAT} AS lat, {_LON} AS lon")
def _():
    place = M.clamp_coordinates(F.col("latitude"), F.col("longitude"))
    return place["lat"].alias("lat"), place["lon"].alias("lon")


def _device():
    return X.device_identifier(F.col("device_id"), F.col("device_name"), F.col("id"))


@_each("device_identifier", f"{IDENTIFIER_SQL} AS identifier, {DISPLAY_SQL} AS display")
def _():
    device = _device()
    return device["identifier"].alias("identifier"), device["display"].alias("display")


@_each("device_hash", f"md5(lower(trim({IDENTIFIER_SQL} || '_Unknown')))[1:16] AS device_hash")
def _():
    return (X.device_hash(_device()["identifier"], F.lit("Unknown")).alias("device_hash"),)


@_each(
    "format_district_id",
    "CASE WHEN id % 3 = 0 THEN CAST(id AS VARCHAR) ELSE 'Distrito ' || CAST(id AS VARCHAR) END AS district_name",
)
def _():
    number = F.col("id").cast("string")
    dotted = F.when(F.col("id") % 3 == 0, number).otherwise(F.concat(F.lit("a.b."), number))
    return (X.format_district_id(dotted).alias("district_name"),)


@_each("hour_label", "lpad(CAST(hour(timestamp) AS VARCHAR), 2, '0') || ':00' AS label")
def _():
    label = X.hour_label(F.hour("timestamp"))
    return (F.when(F.col("timestamp").isNotNull(), label).alias("label"),)


@_each(
    "weekday_dimension",
    "CAST(dayofweek(timestamp) + 1 AS VARCHAR) || '-' || dayname(timestamp) AS dimension",
)
def _():
    name = F.date_format("timestamp", "EEEE")
    return (X.weekday_dimension(F.dayofweek("timestamp"), name).alias("dimension"),)


def _origin():
    return F.lit(S.DEFAULT_LATITUDE), F.lit(S.DEFAULT_LONGITUDE)


@_each(
    "haversine_km",
    """round(12742.0::DOUBLE * asin(sqrt(least(1::DOUBLE,
 pow(sin((radians(-17.7833::DOUBLE) - radians(latitude)) / 2), 2)
 + cos(radians(latitude)) * cos(radians(-17.7833::DOUBLE)) * pow(sin((radians(-63.1822::DOUBLE) - radians(longitude)) / 2), 2)))), 6) AS km""",
)
def _():
    km = M.haversine_km(F.col("latitude"), F.col("longitude"), *_origin())
    return (F.round(km, 6).alias("km"),)


@_each(
    "planar_distance_deg",
    "round(sqrt((latitude + 17.7833::DOUBLE) * (latitude + 17.7833::DOUBLE)"
    " + (longitude + 63.1822::DOUBLE) * (longitude + 63.1822::DOUBLE)), 6) AS degrees",
)
def _():
    degrees = M.planar_distance_deg(F.col("latitude"), F.col("longitude"), *_origin())
    return (F.round(degrees, 6).alias("degrees"),)


@_each("speed_kmh", f"{SPEED_SQL} AS kmh")
def _():
    return (M.speed_kmh(F.col("speed")).alias("kmh"),)


@_each("classify_signal", f"{SIGNAL_SQL} AS calidad")
def _():
    return (M.classify_signal(F.col("signal")).alias("calidad"),)


@_each(
    "signal_band",
    "CASE WHEN signal > -70 THEN 'good' WHEN signal > -90 THEN 'medium' ELSE 'poor' END AS band",
)
def _():
    return (M.signal_band(F.col("signal")).alias("band"),)


@_each(
    "validate_numeric",
    "CASE WHEN altitude BETWEEN 200 AND 400 THEN altitude ELSE 0::DOUBLE END AS altitud",
)
def _():
    return (M.validate_numeric(F.col("altitude"), 200, 400, 0).alias("altitud"),)


@_each(
    "classify_anomaly",
    f"CASE WHEN {SPEED_SQL} > 120 THEN 'Velocidad Alta' WHEN battery < 10 THEN 'Bateria Critica'"
    " WHEN signal < -100 THEN 'Senal Debil' ELSE 'Normal' END AS tipo_anomalia",
)
def _():
    label = M.classify_anomaly(M.speed_kmh(F.col("speed")), F.col("battery"), F.col("signal"))
    return (label.alias("tipo_anomalia"),)


@_each("day_period", PERIOD_SQL.replace("hora", "hour(timestamp)") + " AS periodo")
def _():
    return (C.day_period(F.hour("timestamp")).alias("periodo"),)


@_each("calendar_attributes", CALENDAR_SQL.replace("fecha", "CAST(timestamp AS DATE)"))
def _():
    return C.calendar_attributes(F.to_date("timestamp"))


@query(
    "add_temporal_features",
    "SELECT id, date, hour, day_of_week, weekday_name FROM features",
)
def temporal_features(spark, sf_dir):
    return add_temporal_features(cleaned(spark, sf_dir)).select(
        "id", "date", "hour", "day_of_week", "weekday_name"
    )


@query("hours_between", "SELECT id, round(time_diff_hours, 6) AS hours FROM moves")
def hours_between(spark, sf_dir):
    moved = add_distance_from_previous(cleaned(spark, sf_dir))
    gap = C.hours_between(F.col("prev_timestamp"), F.col("timestamp"))
    return moved.select("id", F.round(gap, 6).alias("hours"))


def _texts(spark, sf_dir):
    """Readings with ISO 8601 text for times; some of it cannot be read."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    bad = F.when(F.col("id") % 5 == 0, F.lit("not a time"))
    return locations(spark, sf_dir).withColumns(
        {
            "timestamp": F.coalesce(bad, F.date_format("timestamp", iso)),
            "created_at": F.date_format("created_at", iso),
        }
    )


_EVENT_TIME = "CASE WHEN id % 5 = 0 THEN NULL ELSE coalesce(timestamp, created_at) END"


@query("event_time", f"SELECT id, {_EVENT_TIME} AS ts FROM locations")
def event_time(spark, sf_dir):
    texts = _texts(spark, sf_dir)
    return texts.select("id", C.event_time(texts).cast("timestamp_ntz").alias("ts"))


@query(
    "drop_unparseable_timestamps",
    f"SELECT id, {_EVENT_TIME} AS ts FROM locations WHERE ({_EVENT_TIME}) IS NOT NULL",
)
def unparseable(spark, sf_dir):
    kept = drop_unparseable_timestamps(_texts(spark, sf_dir))
    return kept.select("id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query(
    "surrogate_keys",
    f"SELECT source_id, CAST(year(fecha) * 10000 + month(fecha) * 100 + day(fecha) AS INT) AS tiempo_id,"
    f" hora + 1 AS hora_id, {LOCATION_KEY_SQL} AS ubicacion_id, latitud, longitud,"
    f" {DEVICE_KEY_SQL} AS dispositivo_id FROM prepared",
)
def surrogate_keys(spark, sf_dir):
    keyed = prepared(spark, sf_dir).select(
        "source_id",
        K.date_key(F.col("fecha")).alias("tiempo_id"),
        K.hour_key(F.col("hora")).alias("hora_id"),
        K.location_key(F.col("latitud"), F.col("longitud")).alias("ubicacion_id"),
        K.device_key(F.col("device_hash")).alias("dispositivo_id"),
    )
    lat, lon = K.location_from_key(F.col("ubicacion_id"))
    return keyed.withColumns({"latitud": lat.cast("double"), "longitud": lon.cast("double")})


@query(
    "round_kpis",
    "SELECT count(*) AS n, round(avg(battery), 1) AS battery, round(avg(signal), 0) AS signal,"
    " round(avg(coalesce(altitude, 0)), 0) AS altitude FROM locations",
)
def round_kpis(spark, sf_dir):
    height = F.coalesce("altitude", F.lit(0.0))
    figures = locations(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("battery").alias("battery"),
        F.avg("signal").alias("signal"),
        F.avg(height).alias("altitude"),
    )
    return rounded(figures, battery=1, signal=0, altitude=0)
