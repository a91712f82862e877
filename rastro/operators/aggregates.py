"""Aggregations over location readings."""

from pyspark.sql import functions as F

from rastro.functions.calendar import hours_between
from rastro.functions.measures import percentage


def device_metrics(df):
    """Per device: counts, battery, signal and speed (km/h) figures and active hours."""
    return (
        df.groupBy("device_id")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.avg("battery").alias("avg_battery"),
            F.min("battery").alias("min_battery"),
            F.avg("signal").alias("avg_signal"),
            F.avg("speed").alias("avg_speed"),
            F.max("speed").alias("max_speed"),
            F.min("timestamp").alias("first_activity"),
            F.max("timestamp").alias("last_activity"),
            F.count_distinct("device_name").alias("device_name_count"),
        )
        .withColumn(
            "activity_window_hours", hours_between(F.col("first_activity"), F.col("last_activity"))
        )
    )


def add_percentage_of_total(counted, count="record_count"):
    """Add each row's share of the summed count, in percent.

    The total is a scalar subquery, so no task sees all rows as one window would.
    """
    total = counted.agg(F.sum(count)).scalar()
    return counted.withColumn("percentage", percentage(F.col(count), total))


def sort_by_count(counted, count, *ties):
    """Largest count first, then the tie columns."""
    return counted.orderBy(F.col(count).desc(), *[F.col(name).asc_nulls_last() for name in ties])


def network_distribution(df):
    """Readings and percentage per raw operator and network type, largest first."""
    counted = df.groupBy("sim_operator", "network_type").agg(
        F.count(F.lit(1)).alias("record_count")
    )
    return sort_by_count(
        add_percentage_of_total(counted), "record_count", "sim_operator", "network_type"
    )


def value_counts(df, name):
    """Rows per value of a column, largest first; null is not counted."""
    counted = df.filter(F.col(name).isNotNull()).groupBy(name).agg(
        F.count(F.lit(1)).alias("records")
    )
    return sort_by_count(counted, "records", name)
