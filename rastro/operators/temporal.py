"""Calendar features and usage patterns."""

from pyspark.sql import functions as F

from rastro.functions.text import weekday_dimension


def add_temporal_features(df):
    """Add date, hour, day_of_week (Sunday is 1) and weekday_name (English)."""
    ts = F.col("timestamp")
    return df.withColumns(
        {
            "date": F.to_date(ts),
            "hour": F.hour(ts),
            "day_of_week": F.dayofweek(ts),
            "weekday_name": F.date_format(ts, "EEEE"),
        }
    )


def temporal_patterns(df):
    """Readings per hour and per weekday as (pattern_type, dimension, record_count).

    The rows are first counted per hour and weekday, so the two groupings work on at most
    a few hundred rows instead of expanding the input.
    """
    counted = df.groupBy("hour", "day_of_week", "weekday_name").agg(
        F.count(F.lit(1)).alias("n")
    )
    day = ["day_of_week", "weekday_name"]
    grouped = counted.groupingSets([["hour"], day], "hour", *day).agg(
        F.grouping("hour").alias("by_day"), F.sum("n").alias("record_count")
    )
    return grouped.select(
        F.when(F.col("by_day") == 1, "weekday").otherwise("hourly").alias("pattern_type"),
        F.when(F.col("by_day") == 1, weekday_dimension(F.col("day_of_week"), F.col("weekday_name")))
        .otherwise(F.col("hour").cast("string"))
        .alias("dimension"),
        "record_count",
    )


def union_patterns(hourly, weekday):
    """Stack two pattern frames by position."""
    return hourly.union(weekday)
