"""Previous reading per device, safe against devices that hold much of the data."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from rastro.functions.calendar import hours_between
from rastro.functions.measures import haversine_km


def _reading():
    return F.struct("latitude", "longitude", "timestamp")


def previous_reading(df, bucket="hour"):
    """Add ``_prev``: the device's reading before this one (struct), null for its first.

    Readings are sorted per device and hour, so that a device, or a placeholder that many devices
    share, is spread over as many tasks as it has hours. The first reading of an hour takes the last
    one of the device's latest hour before, from a table with one row per device and hour.
    ``bucket`` may be any unit of ``date_trunc``; the result is the same. Readings without a
    time come first, in a bucket of their own.
    """
    cut = df.withColumn("_bucket", F.date_trunc(bucket, "timestamp"))
    inside = Window.partitionBy("device_id", "_bucket").orderBy("timestamp", "id")
    across = Window.partitionBy("device_id").orderBy("_bucket")
    tails = cut.groupBy("device_id", "_bucket").agg(
        F.max_by(_reading(), F.struct("timestamp", "id")).alias("_tail")
    )
    carried = tails.select(
        F.col("device_id").alias("_device"),
        F.col("_bucket").alias("_at"),
        F.lag("_tail").over(across).alias("_carried"),
    )
    same = F.col("device_id").eqNullSafe(F.col("_device")) & F.col("_bucket").eqNullSafe(F.col("_at"))
    return (
        cut.withColumn("_prev", F.lag(_reading()).over(inside))
        .join(carried, same, "left")
        .withColumn("_prev", F.coalesce("_prev", "_carried"))
        .drop("_bucket", "_device", "_at", "_carried")
    )


def add_distance_from_previous(df, bucket="hour"):
    """Add the previous position and time of the device, distance_km and time_diff_hours.

    Readings are ordered by timestamp, then id.
    """
    prev = F.col("_prev")
    return (
        previous_reading(df, bucket)
        .withColumns(
            {
                "prev_latitude": prev["latitude"],
                "prev_longitude": prev["longitude"],
                "prev_timestamp": prev["timestamp"],
            }
        )
        .withColumns(
            {
                "distance_km": haversine_km(
                    F.col("prev_latitude"),
                    F.col("prev_longitude"),
                    F.col("latitude"),
                    F.col("longitude"),
                ),
                "time_diff_hours": hours_between(F.col("prev_timestamp"), F.col("timestamp")),
            }
        )
        .drop("_prev")
    )
