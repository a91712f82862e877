"""Numeric and conditional helpers."""

from pyspark.sql import functions as F

from rastro import schema as S


def haversine_km(lat1, lon1, lat2, lon2):
    """Great-circle distance in kilometres."""
    half_dlat = (F.radians(lat2) - F.radians(lat1)) / 2
    half_dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.sin(half_dlat) * F.sin(half_dlat) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.sin(half_dlon) * F.sin(half_dlon)
    # rounding can push antipodal points just above 1
    return F.lit(2 * S.EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def planar_distance_deg(lat1, lon1, lat2, lon2):
    """Straight-line distance in degrees."""
    dlat, dlon = lat1 - lat2, lon1 - lon2
    return F.sqrt(dlat * dlat + dlon * dlon)


def speed_kmh(speed_ms):
    """m/s to km/h: missing or negative is 0, more than 200 is 200, else two decimals."""
    speed = speed_ms.try_cast("double")
    kmh = speed * F.lit(3.6)
    return (
        F.when(speed.isNull() | F.isnan(speed) | (speed < 0), F.lit(0.0))
        .when(kmh > S.IMPOSSIBLE_SPEED_KMH, F.lit(S.IMPOSSIBLE_SPEED_KMH))
        .otherwise(F.round(kmh, 2))
    )


def classify_signal(dbm):
    """Quality level of a signal in dBm; null is 'Sin Senal'."""
    result = F.lit(S.NO_SIGNAL)
    for level, floor in reversed(S.SIGNAL_FLOORS):
        result = F.when(dbm >= floor, F.lit(level)).otherwise(result)
    return result


def signal_band(dbm):
    """Map colour band of a signal in dBm."""
    return F.when(dbm > -70, "good").when(dbm > -90, "medium").otherwise("poor")


def clamp_coordinates(lat, lon):
    """Struct (lat, lon): missing or unreadable becomes the city centre, the rest is clamped."""

    def inside(value, default, limits):
        number = value.try_cast("double")
        known = F.coalesce(F.when(~F.isnan(number), number), F.lit(default))
        return F.greatest(F.lit(limits[0]), F.least(F.lit(limits[1]), known))

    return F.struct(
        inside(lat, S.DEFAULT_LATITUDE, S.LATITUDE_RANGE).alias("lat"),
        inside(lon, S.DEFAULT_LONGITUDE, S.LONGITUDE_RANGE).alias("lon"),
    )


def validate_numeric(value, low, high, default):
    """The number if it lies in [low, high], else the default."""
    number = value.try_cast("double")
    return F.when(number.between(low, high), number).otherwise(F.lit(float(default)))


def cell_key(lat, lon, length=S.CELL_KEY_LENGTH):
    """Grid key 'lat_lon' in ten-thousandths of a degree, cut toward zero."""
    place = clamp_coordinates(lat, lon)
    parts = [(place[axis] * 10000).cast("int").cast("string") for axis in ("lat", "lon")]
    return F.substring(F.concat_ws("_", *parts), 1, length)


def classify_anomaly(speed, battery, signal):
    """Label of a flagged measurement; the first rule that holds wins."""
    return (
        F.when(speed > S.FLAG_SPEED_KMH, "Velocidad Alta")
        .when(battery < S.FLAG_BATTERY, "Bateria Critica")
        .when(signal < S.FLAG_SIGNAL_DBM, "Senal Debil")
        .otherwise("Normal")
    )


def percentage(part, whole):
    """part / whole x 100."""
    return part / whole * 100
