"""Anomalies in location readings (speeds in km/h)."""

from pyspark.sql import functions as F

from rastro import schema as S

_WHO = ["id", "device_id", "timestamp"]
_WHERE = ["latitude", "longitude"]


def _is_speed():
    return F.col("speed") > S.IMPOSSIBLE_SPEED_KMH


def _is_battery():
    return F.col("battery") < S.CRITICAL_BATTERY


def _is_jump():
    return (F.col("time_diff_hours") > 0) & (F.col("distance_km") > S.JUMP_KM)


def _detect(df, rule, evidence, label):
    return df.filter(rule).select(*_WHO, *evidence, *_WHERE, F.lit(label).alias("anomaly_type"))


def speed_anomalies(df):
    """Readings faster than 200 km/h."""
    return _detect(df, _is_speed(), ["speed"], "impossible_speed")


def battery_anomalies(df):
    """Readings with less than 10 % battery."""
    return _detect(df, _is_battery(), ["battery"], "critical_battery")


def geographic_jumps(df):
    """Readings more than 500 km from the device's previous one, at a later second.

    Needs the columns of ``add_distance_from_previous``.
    """
    return _detect(df, _is_jump(), ["distance_km", "time_diff_hours"], "geographic_jump")


def union_anomalies(*frames):
    """Stack anomaly frames by column name; columns a frame lacks are null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def all_anomalies(df):
    """Every anomaly of every type, one row per reading and type, from one pass over ``df``.

    Columns of another type's evidence are null, as in a union of the three detectors.
    """
    rules = {
        "impossible_speed": (_is_speed(), {"speed"}),
        "critical_battery": (_is_battery(), {"battery"}),
        "geographic_jump": (_is_jump(), {"distance_km", "time_diff_hours"}),
    }
    labels = F.filter(
        F.array(*[F.when(rule, F.lit(label)) for label, (rule, _) in rules.items()]),
        lambda label: label.isNotNull(),
    )

    def only_for(name):
        label = next(key for key, (_, used) in rules.items() if name in used)
        return F.when(F.col("anomaly_type") == label, F.col(name)).alias(name)

    return df.withColumn("anomaly_type", F.explode(labels)).select(
        *_WHO,
        only_for("speed"),
        *_WHERE,
        "anomaly_type",
        *[only_for(name) for name in ("battery", "distance_km", "time_diff_hours")],
    )
