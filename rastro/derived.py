"""The ``locations`` view derived from an ``events`` table.

Its values are fixed by ``FIXTURES.md`` section 3, so that Spark and a second engine can be
compared on the same rows.
"""

from pyspark.sql import functions as F

# Fixed SQL text; {K} is the engine's way to read key "k" of the JSON text in ``props``.
LOCATIONS_SQL = """
SELECT event_id AS id,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE concat('MODEL-', CAST(user_id % 12 AS STRING), CASE WHEN event_id % 17 = 0 THEN ' v2' ELSE '' END) END AS device_name,
  CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 89 = 0 THEN CAST(95.0 AS DOUBLE)
       ELSE CAST(-177800 + (event_id * 37 + user_id * 11) % 2400 - 1200 + CASE WHEN event_id % 211 = 0 THEN 100000 ELSE 0 END AS DOUBLE) / CAST(10000 AS DOUBLE) END AS latitude,
  CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN CAST(200.0 AS DOUBLE)
       ELSE CAST(-631800 + (event_id * 53 + user_id * 29) % 2000 - 1000 AS DOUBLE) / CAST(10000 AS DOUBLE) END AS longitude,
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(300 + event_id % 600 AS DOUBLE) / CAST(2 AS DOUBLE) END AS altitude,
  CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 67 = 0 THEN -value ELSE value END AS speed,
  CASE WHEN event_id % 43 = 0 THEN NULL ELSE CAST({K} AS INT) END AS battery,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(-50 - (event_id * 7 + user_id) % 70 AS INT) END AS signal,
  CASE event_id % 11 WHEN 0 THEN 'entel' WHEN 1 THEN ' Entel S.A Bolivia ' WHEN 2 THEN 'TIGO' WHEN 3 THEN 'Comunicaciones Celulares' WHEN 4 THEN 'Viva' WHEN 5 THEN 'nuevatel' WHEN 6 THEN 'Sin Senal' WHEN 7 THEN '' WHEN 8 THEN 'BOMOV' WHEN 9 THEN 'ACME' ELSE NULL END AS sim_operator,
  CASE event_id % 9 WHEN 0 THEN '5G NR' WHEN 1 THEN '4g' WHEN 2 THEN 'LTE' WHEN 3 THEN 'HSPA+' WHEN 4 THEN 'wcdma' WHEN 5 THEN 'EDGE' WHEN 6 THEN 'GSM' WHEN 7 THEN 'wifi' ELSE NULL END AS network_type,
  CASE WHEN event_id % 71 = 0 THEN NULL ELSE ts END AS timestamp,
  CASE WHEN event_id % 142 = 0 THEN NULL ELSE ts END AS created_at,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 109 = 0 THEN 'null' ELSE concat('dev-', CAST(user_id AS STRING)) END AS device_id
FROM {EVENTS}
"""
SPARK_KEY = "get_json_object(props, '$.k')"


def locations_from_events(events):
    """Location readings, one per row of ``events``."""
    sql = LOCATIONS_SQL.replace("{K}", SPARK_KEY).replace("{EVENTS}", "{events}")
    return events.sparkSession.sql(sql, events=events).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )
