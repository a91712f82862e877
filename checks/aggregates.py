"""Aggregations over readings, and device lookup."""

from pyspark.sql import functions as F

from checks.base import cleaned, locations, query, rounded
from rastro.operators import aggregates as A
from rastro.operators import lookup as L
from rastro.operators import temporal as T

METRICS_SQL = """SELECT device_id, count(*) AS total_records, round(avg(battery), 6) AS avg_battery,
 min(battery) AS min_battery, round(avg(signal), 6) AS avg_signal, round(avg(speed), 6) AS avg_speed,
 max(speed) AS max_speed, min(timestamp) AS first_activity, max(timestamp) AS last_activity,
 count(DISTINCT device_name) AS device_name_count,
 round((floor(epoch(max(timestamp))) - floor(epoch(min(timestamp)))) / 3600, 6) AS activity_window_hours
 FROM cleaned GROUP BY device_id"""


@query("device_metrics", METRICS_SQL)
def device_metrics(spark, sf_dir):
    return rounded(
        A.device_metrics(cleaned(spark, sf_dir)),
        avg_battery=6,
        avg_signal=6,
        avg_speed=6,
        activity_window_hours=6,
    )


NETWORK_SQL = """SELECT sim_operator, network_type, count(*) AS record_count,
 round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM cleaned), 6) AS percentage
 FROM cleaned GROUP BY sim_operator, network_type"""


@query("network_distribution", NETWORK_SQL)
def network_distribution(spark, sf_dir):
    return rounded(A.network_distribution(cleaned(spark, sf_dir)), percentage=6)


@query(
    "percentage_of_total",
    "SELECT device_name, count(*) AS record_count, round(count(*) * 100.0::DOUBLE /"
    " (SELECT count(*) FROM locations), 6) AS percentage FROM locations GROUP BY device_name",
)
def percentage_of_total(spark, sf_dir):
    counted = locations(spark, sf_dir).groupBy("device_name")
    counted = counted.agg(F.count(F.lit(1)).alias("record_count"))
    return rounded(A.add_percentage_of_total(counted), percentage=6)


@query(
    "sort_by_count",
    "SELECT network_type, count(*) AS n FROM locations GROUP BY network_type"
    " ORDER BY n DESC, network_type NULLS LAST",
)
def sort_by_count(spark, sf_dir):
    counted = locations(spark, sf_dir).groupBy("network_type").agg(F.count(F.lit(1)).alias("n"))
    return A.sort_by_count(counted, "n", "network_type")


PATTERNS_SQL = """SELECT 'hourly' AS pattern_type, CAST(hour AS VARCHAR) AS dimension, count(*) AS record_count
 FROM features GROUP BY hour UNION ALL
 SELECT 'weekday', CAST(day_of_week AS VARCHAR) || '-' || weekday_name, count(*)
 FROM features GROUP BY day_of_week, weekday_name"""


@query("temporal_patterns", PATTERNS_SQL)
def temporal_patterns(spark, sf_dir):
    return T.temporal_patterns(T.add_temporal_features(cleaned(spark, sf_dir)))


@query("union_patterns", PATTERNS_SQL)
def union_patterns(spark, sf_dir):
    patterns = T.temporal_patterns(T.add_temporal_features(cleaned(spark, sf_dir)))
    kind = F.col("pattern_type")
    return T.union_patterns(patterns.filter(kind == "hourly"), patterns.filter(kind == "weekday"))


@query(
    "value_counts",
    "SELECT device_name, count(*) AS records FROM locations WHERE device_name IS NOT NULL GROUP BY device_name",
)
def value_counts(spark, sf_dir):
    return A.value_counts(locations(spark, sf_dir), "device_name")


_NAME = "MODEL-3"


@query(
    "find_device_ids",
    f"SELECT device_id, count(*) AS records FROM locations WHERE device_name = '{_NAME}' GROUP BY device_id",
)
def find_device_ids(spark, sf_dir):
    return L.find_device_ids(locations(spark, sf_dir), _NAME)


@query(
    "device_id_examples",
    f"SELECT device_id, min(id) AS id, '{_NAME}' AS device_name FROM locations"
    f" WHERE device_name = '{_NAME}' GROUP BY device_id",
)
def device_id_examples(spark, sf_dir):
    return L.device_id_examples(locations(spark, sf_dir), _NAME)


@query(
    "similar_device_names",
    """SELECT device_name, name_records, device_id, count(*) AS records FROM locations JOIN (
 SELECT device_name, count(*) AS name_records FROM locations WHERE device_name ILIKE '%model-1%'
 GROUP BY device_name ORDER BY name_records DESC, device_name LIMIT 15) USING (device_name)
 GROUP BY device_name, name_records, device_id""",
)
def similar_device_names(spark, sf_dir):
    return L.similar_device_names(locations(spark, sf_dir), "model-1 pro")


@query(
    "device_name_variations",
    "SELECT device_name, count(*) AS records FROM locations"
    " WHERE device_id = 'dev-7' AND device_name IS NOT NULL GROUP BY device_name",
)
def device_name_variations(spark, sf_dir):
    return L.device_name_variations(locations(spark, sf_dir), "dev-7")
