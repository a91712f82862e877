"""The star schema as DataFrames: prepared measurements, dimensions, fact."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro import schema as S
from rastro.functions import keys as K
from rastro.functions import measures as M
from rastro.functions import text as X
from rastro.functions.calendar import calendar_attributes, day_period
from rastro.operators.cleaning import drop_unparseable_timestamps
from rastro.operators.skew import salted_left_join
from rastro.operators.zones import assign_district_zone, district_centers


@dataclass(frozen=True)
class Star:
    """The nine tables of the warehouse, and its rollups if it keeps some."""

    dim_tiempo: DataFrame
    dim_hora: DataFrame
    dim_operador: DataFrame
    dim_red: DataFrame
    dim_calidad: DataFrame
    dim_ubicacion: DataFrame
    dim_dispositivo: DataFrame
    dim_zonas: DataFrame
    fact_mediciones: DataFrame
    rollup_diario: DataFrame | None = None
    rollup_dispositivos: DataFrame | None = None

    def tables(self):
        return {name: getattr(self, name) for name in S.TABLES}


def _first_column(df, names, type_name):
    """The first of the columns that exists, else null."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    return F.lit(None).cast(type_name)


def _number(column):
    """The column as a finite double; unreadable text, NaN and infinity are missing."""
    number = column.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def prepare_measurements(locations, districts=None, zones=None):
    """Readings with a time, normalised for the warehouse; a chain of projections.

    Speed is read as m/s and becomes km/h. Missing coordinates become the city centre;
    the zone is taken there, and coordinates out of range are clamped for the location.
    """
    timed = drop_unparseable_timestamps(locations)
    lat = F.coalesce(_number(F.col("latitude")), F.lit(S.DEFAULT_LATITUDE))
    lon = F.coalesce(_number(F.col("longitude")), F.lit(S.DEFAULT_LONGITUDE))
    signal = _number(_first_column(locations, ("signal", "signal_strength", "dbm"), "int")).try_cast("int")
    battery = _number(_first_column(locations, ("battery", "battery_level"), "int")).try_cast("int")
    device = X.device_identifier(F.col("device_id"), F.col("device_name"), F.col("id"))
    model = F.coalesce(_first_column(locations, ("device_model",), "string"), F.lit(S.UNKNOWN_TEXT))
    placed = assign_district_zone(
        timed.withColumns({"_lat": lat, "_lon": lon}), districts, zones, "_lat", "_lon"
    )
    clamped = M.clamp_coordinates(F.col("_lat"), F.col("_lon"))
    return (
        placed.withColumns({"_device": device, "_place": clamped})
        .select(
            F.col("id").alias("source_id"),
            "ts",
            F.to_date("ts").alias("fecha"),
            F.hour("ts").alias("hora"),
            X.normalize_operator(
                _first_column(locations, ("sim_operator", "operator_name"), "string")
            ).alias("operador"),
            X.normalize_network(_first_column(locations, ("network_type",), "string")).alias("red"),
            M.classify_signal(signal).alias("calidad"),
            signal.alias("senal"),
            M.speed_kmh(_first_column(locations, ("speed", "velocidad"), "double")).alias(
                "velocidad_kmh"
            ),
            battery.alias("bateria"),
            F.col("_place.lat").cast("decimal(10,7)").alias("latitud"),
            F.col("_place.lon").cast("decimal(10,7)").alias("longitud"),
            F.coalesce(_number(F.col("altitude")), F.lit(0.0)).alias("altitud"),
            "zona_id",
            F.col("_device.identifier").alias("device_identifier"),
            F.col("_device.display").alias("device_display_name"),
            model.alias("device_model"),
        )
        .withColumn("device_hash", X.device_hash(F.col("device_identifier"), F.col("device_model")))
    )


# --- fixed dimensions ------------------------------------------------------------


def dim_hour(spark):
    """The 24 hours; es_hora_pico is never set."""
    hour = F.col("id").cast("int")
    return spark.range(24).select(
        K.hour_key(hour).alias("hora_id"),
        hour.alias("hora"),
        day_period(hour).alias("periodo"),
        X.hour_label(hour).alias("nombre_hora"),
        F.lit(None).cast("boolean").alias("es_hora_pico"),
    )


def dim_operator(spark):
    """The five operators; grupo is never set."""
    return spark.createDataFrame([(*row, None, True) for row in S.OPERATORS], S.DIM_OPERADOR)


def dim_network(spark):
    return spark.createDataFrame(S.NETWORKS, S.DIM_RED)


def dim_quality(spark):
    return spark.createDataFrame(S.QUALITIES, S.DIM_CALIDAD)


def dim_zone(spark, districts=None):
    """Zones of the districts, else the built-in ones."""
    if districts is not None:
        zones = district_centers(districts)
    else:
        zones = spark.createDataFrame(
            S.ZONES,
            "zona_id int, nombre string, latitud_centro double, longitud_centro double, "
            "radio_km double",
        )
    return zones.select(*[F.col(f.name).cast(f.dataType) for f in S.DIM_ZONAS])


# --- dimensions from measurements ----------------------------------------------------


def distinct_dates(prepared):
    return prepared.select("fecha").distinct()


def distinct_locations(prepared):
    return prepared.select("latitud", "longitud", "altitud", "zona_id").distinct()


def distinct_devices(prepared):
    return prepared.select("device_hash", "device_display_name", "device_model").distinct()


def dim_date(prepared):
    return distinct_dates(prepared).select(
        K.date_key(F.col("fecha")).alias("tiempo_id"), "fecha", *calendar_attributes(F.col("fecha"))
    )


def dim_location(prepared):
    """One row per coordinate pair; altitude and zone come from its first reading (by id)."""
    place = prepared.select(
        K.location_key(F.col("latitud"), F.col("longitud")).alias("ubicacion_id"),
        M.validate_numeric(F.col("altitud"), *S.ALTITUDE_RANGE, 0).alias("altitud"),
        "zona_id",
        "source_id",
    )
    # all buffers have fixed width, so the partial aggregation hashes instead of sorting
    first = place.groupBy("ubicacion_id").agg(
        F.min_by("altitud", "source_id").alias("altitud"),
        F.min_by("zona_id", "source_id").alias("zona_id"),
    )
    lat, lon = K.location_from_key(F.col("ubicacion_id"))
    return first.select(
        "ubicacion_id",
        lat.alias("latitud"),
        lon.alias("longitud"),
        F.col("altitud").cast("decimal(10,2)").alias("altitud"),
        "zona_id",
        M.cell_key(lat, lon).alias("geohash"),
    )


def dim_device(prepared):
    """One row per device hash; name and model come from its first reading (by id).

    The first grouping leaves few rows per device, so the second one is small.
    """
    members = prepared.groupBy("device_hash", "device_display_name", "device_model").agg(
        F.min("source_id").alias("source_id")
    )
    first = members.groupBy("device_hash").agg(
        F.min_by("device_display_name", "source_id").alias("name"),
        F.min_by("device_model", "source_id").alias("model"),
    )

    def text(name):
        short = X.truncate_string(X.sanitize_string(F.col(name)), S.TEXT_LENGTH)
        return F.coalesce(short, F.lit(S.UNKNOWN_TEXT))

    return first.select(
        K.device_key(F.col("device_hash")).alias("dispositivo_id"),
        X.truncate_string(F.col("device_hash"), S.DEVICE_HASH_LENGTH).alias("device_hash"),
        text("name").alias("nombre_dispositivo"),
        text("model").alias("modelo"),
        F.lit(S.UNKNOWN_TEXT).alias("fabricante"),
    )


# --- fact ------------------------------------------------------------------------------


def _stored_measures():
    """Measures as they are stored; a value that the column cannot hold is null."""
    return {
        "senal_dbm": F.col("senal").try_cast("decimal(6,2)"),
        "velocidad": F.col("velocidad_kmh").try_cast("decimal(10,2)"),
        "bateria": F.col("bateria").try_cast("int"),
    }


def unstorable():
    """True for a prepared reading with a measure that the fact table cannot hold."""
    measured = (F.col("senal"), F.col("velocidad_kmh"), F.col("bateria"))
    stored = _stored_measures().values()
    return reduce(
        lambda a, b: a | b, [m.isNotNull() & s.isNull() for m, s in zip(measured, stored)]
    )


def _measures():
    return [
        *[value.alias(name) for name, value in _stored_measures().items()],
        F.col("ts").cast("timestamp_ntz").alias("timestamp_original"),
        F.current_timestamp().cast("timestamp_ntz").alias("fecha_carga"),
    ]


def build_fact(prepared):
    """Fact rows. Every key is computed from its natural key, so nothing is joined."""
    return prepared.select(
        F.col("source_id").alias("medicion_id"),
        "source_id",
        K.date_key(F.col("fecha")).alias("tiempo_id"),
        K.hour_key(F.col("hora")).alias("hora_id"),
        K.operator_key(F.col("operador")).alias("operador_id"),
        K.network_key(F.col("red")).alias("red_id"),
        K.quality_key(F.col("calidad")).alias("calidad_id"),
        K.location_key(F.col("latitud"), F.col("longitud")).alias("ubicacion_id"),
        K.device_key(F.col("device_hash")).alias("dispositivo_id"),
        "zona_id",
        *_measures(),
    )


def fact_lookup(prepared, star):
    """The same rows by looking every natural key up in its dimension.

    For dimensions whose keys were not made by this package. Unknown operators, networks
    and qualities become the dimension's own unknown member; other misses stay null.
    """

    def ids(dim, key, natural, alias):
        return dim.select(F.col(key), F.col(natural).alias(alias))

    def unknown(dim, key, natural, member):
        return dim.filter(F.col(natural) == member).select(key).scalar()

    joined = (
        prepared.join(ids(star.dim_tiempo, "tiempo_id", "fecha", "fecha"), "fecha", "left")
        .join(ids(star.dim_hora, "hora_id", "hora", "hora"), "hora", "left")
        .join(ids(star.dim_operador, "operador_id", "nombre", "operador"), "operador", "left")
        .join(ids(star.dim_red, "red_id", "tipo_red", "red"), "red", "left")
        .join(ids(star.dim_calidad, "calidad_id", "rango_senal", "calidad"), "calidad", "left")
    )
    # the place of readings without coordinates, or one device, may have a third of the rows
    places = star.dim_ubicacion.select("ubicacion_id", "latitud", "longitud")
    joined = salted_left_join(joined, places, ["latitud", "longitud"], ["source_id"])
    devices = star.dim_dispositivo.select("dispositivo_id", "device_hash")
    joined = salted_left_join(joined, devices, ["device_hash"], ["source_id"])
    defaults = {
        "operador_id": unknown(star.dim_operador, "operador_id", "nombre", S.UNKNOWN_OPERATOR),
        "red_id": unknown(star.dim_red, "red_id", "tipo_red", S.UNKNOWN_NETWORK),
        "calidad_id": unknown(star.dim_calidad, "calidad_id", "rango_senal", S.NO_SIGNAL),
    }
    return joined.select(
        F.col("source_id").alias("medicion_id"),
        "source_id",
        "tiempo_id",
        "hora_id",
        *[F.coalesce(F.col(key), member).alias(key) for key, member in defaults.items()],
        "ubicacion_id",
        "dispositivo_id",
        "zona_id",
        *_measures(),
    )


def build_star(spark, locations, districts=None):
    """All nine tables, lazily, from readings with distinct ids."""
    prepared = prepare_measurements(locations, districts)
    return Star(
        dim_tiempo=dim_date(prepared),
        dim_hora=dim_hour(spark),
        dim_operador=dim_operator(spark),
        dim_red=dim_network(spark),
        dim_calidad=dim_quality(spark),
        dim_ubicacion=dim_location(prepared),
        dim_dispositivo=dim_device(prepared),
        dim_zonas=dim_zone(spark, districts),
        fact_mediciones=build_fact(prepared),
    )
