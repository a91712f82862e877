"""Cleaning, previous reading and anomalies."""

from pyspark.sql import functions as F

from checks.base import cleaned, locations, query, rounded
from rastro.operators import anomalies as A
from rastro.operators import cleaning as C
from rastro.operators.movement import add_distance_from_previous
from rastro.operators.temporal import add_temporal_features
from rastro.plans.daily import daily_pipeline
from rastro.session import scratch_path


@query(
    "clean_coordinates",
    "SELECT id, latitude, longitude FROM locations"
    " WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180",
)
def clean_coordinates(spark, sf_dir):
    return C.clean_coordinates(locations(spark, sf_dir)).select("id", "latitude", "longitude")


@query("clean_timestamps", "SELECT id, timestamp FROM locations WHERE timestamp IS NOT NULL")
def clean_timestamps(spark, sf_dir):
    return C.clean_timestamps(locations(spark, sf_dir)).select("id", "timestamp")


@query(
    "remove_null_critical_fields",
    "SELECT id, device_id, device_name FROM locations"
    " WHERE device_id IS NOT NULL AND device_name IS NOT NULL",
)
def critical_fields(spark, sf_dir):
    kept = C.remove_null_critical_fields(locations(spark, sf_dir), ["device_id", "device_name"])
    return kept.select("id", "device_id", "device_name")


@query(
    "quality_report",
    """SELECT step, initial_count, valid_count, initial_count - valid_count AS discarded_count,
 round((initial_count - valid_count) * 100.0::DOUBLE / initial_count, 6) AS discarded_percent FROM (
 SELECT 'coordinates' AS step, n0 AS initial_count, n1 AS valid_count FROM (
  SELECT count(*) AS n0, count(*) FILTER (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180) AS n1 FROM locations)
 UNION ALL SELECT 'timestamps', count(*), count(timestamp) FROM locations
  WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
 UNION ALL SELECT 'critical_fields', count(*), count(device_id) FROM locations
  WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND timestamp IS NOT NULL
 UNION ALL SELECT 'total', (SELECT count(*) FROM locations), (SELECT count(*) FROM cleaned))""",
)
def quality_report(spark, sf_dir):
    return rounded(C.quality_report(locations(spark, sf_dir)), discarded_percent=6)


_MOVES = (
    "id, device_id, prev_latitude, prev_longitude, prev_timestamp,"
    " round(distance_km, 6) AS distance_km, round(time_diff_hours, 6) AS time_diff_hours"
)


@query("distance_from_previous", f"SELECT {_MOVES} FROM moves")
def distance_from_previous(spark, sf_dir):
    moved = add_distance_from_previous(cleaned(spark, sf_dir)).select(
        "id",
        "device_id",
        "prev_latitude",
        "prev_longitude",
        "prev_timestamp",
        "distance_km",
        "time_diff_hours",
    )
    return rounded(moved, distance_km=6, time_diff_hours=6)


@query("distance_from_previous_split", f"SELECT {_MOVES} FROM moves")
def distance_from_previous_split(spark, sf_dir):
    """The same with other cuts of a device's readings."""
    moved = add_distance_from_previous(cleaned(spark, sf_dir), bucket="minute")
    shown = moved.select(
        "id",
        "device_id",
        "prev_latitude",
        "prev_longitude",
        "prev_timestamp",
        "distance_km",
        "time_diff_hours",
    )
    return rounded(shown, distance_km=6, time_diff_hours=6)


def _moved(spark, sf_dir):
    return add_distance_from_previous(add_temporal_features(cleaned(spark, sf_dir)))


_SPEED = (
    "SELECT id, device_id, timestamp, speed, latitude, longitude, 'impossible_speed' AS anomaly_type"
    " FROM cleaned WHERE speed > 200"
)
_BATTERY = (
    "SELECT id, device_id, timestamp, battery, latitude, longitude, 'critical_battery' AS anomaly_type"
    " FROM cleaned WHERE battery < 10"
)
_JUMPS = (
    "SELECT id, device_id, timestamp, round(distance_km, 6) AS distance_km,"
    " round(time_diff_hours, 6) AS time_diff_hours, latitude, longitude,"
    " 'geographic_jump' AS anomaly_type FROM moves WHERE time_diff_hours > 0 AND distance_km > 500"
)
ANOMALIES_SQL = f"{_SPEED} UNION ALL BY NAME {_BATTERY} UNION ALL BY NAME {_JUMPS}"


@query("speed_anomalies", _SPEED)
def speed_anomalies(spark, sf_dir):
    return A.speed_anomalies(cleaned(spark, sf_dir))


@query("battery_anomalies", _BATTERY)
def battery_anomalies(spark, sf_dir):
    return A.battery_anomalies(cleaned(spark, sf_dir))


@query("geographic_jumps", _JUMPS)
def geographic_jumps(spark, sf_dir):
    return rounded(A.geographic_jumps(_moved(spark, sf_dir)), distance_km=6, time_diff_hours=6)


@query("all_anomalies", ANOMALIES_SQL)
def all_anomalies(spark, sf_dir):
    return rounded(A.all_anomalies(_moved(spark, sf_dir)), distance_km=6, time_diff_hours=6)


@query("union_anomalies", ANOMALIES_SQL)
def union_anomalies(spark, sf_dir):
    moved = _moved(spark, sf_dir)
    stacked = A.union_anomalies(
        A.speed_anomalies(moved), A.battery_anomalies(moved), A.geographic_jumps(moved)
    )
    return rounded(stacked, distance_km=6, time_diff_hours=6)


@query(
    "daily_pipeline",
    f"""SELECT (SELECT count(*) FROM locations) AS initial_records, (SELECT count(*) FROM cleaned) AS clean_records,
 (SELECT count(*) FROM locations) - (SELECT count(*) FROM cleaned) AS discarded_records,
 round(((SELECT count(*) FROM locations) - (SELECT count(*) FROM cleaned)) * 100.0::DOUBLE / (SELECT count(*) FROM locations), 6) AS discard_percent,
 (SELECT count(DISTINCT device_id) FROM cleaned) AS unique_devices, (SELECT count(*) FROM ({ANOMALIES_SQL})) AS anomalies""",
)
def daily(spark, sf_dir):
    out = scratch_path(spark, "daily")
    summary = daily_pipeline(spark, locations(spark, sf_dir), out)
    return summary.withColumn("discard_percent", F.round("discard_percent", 6))
