"""Row filters and the report on what they discard."""

from functools import reduce

from pyspark.sql import functions as F

from rastro import schema as S
from rastro.functions.calendar import event_time


def _valid_coordinates():
    return F.col("latitude").between(*S.LATITUDE_RANGE) & F.col("longitude").between(
        *S.LONGITUDE_RANGE
    )


def _all_present(names):
    if not names:
        raise ValueError("name at least one critical field")
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in names])


def clean_coordinates(df):
    """Keep rows whose coordinates are present and in range (limits included)."""
    return df.filter(_valid_coordinates())


def clean_timestamps(df):
    """Keep rows that have a timestamp."""
    return df.filter(F.col("timestamp").isNotNull())


def remove_null_critical_fields(df, critical_fields):
    """Keep rows in which none of the fields is null."""
    return df.filter(_all_present(critical_fields))


def clean_readings(df):
    """The three filters of the daily analysis, one after the other."""
    return remove_null_critical_fields(clean_timestamps(clean_coordinates(df)), ["device_id"])


def quality_report(df, critical_fields=("device_id",)):
    """What each cleaning step keeps and discards, and the total, from one pass over ``df``."""
    passed = F.coalesce(_valid_coordinates(), F.lit(False))
    steps = [("coordinates", passed)]
    passed = passed & F.col("timestamp").isNotNull()
    steps.append(("timestamps", passed))
    passed = passed & _all_present(list(critical_fields))
    steps.append(("critical_fields", passed))

    counted = df.agg(
        F.count(F.lit(1)).alias("n0"),
        *[F.count_if(kept).alias(f"n{i}") for i, (_, kept) in enumerate(steps, 1)],
    )
    spans = [(name, i - 1, i) for i, (name, _) in enumerate(steps, 1)]
    spans.append(("total", 0, len(steps)))
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("step"),
                F.col(f"n{before}").alias("initial_count"),
                F.col(f"n{after}").alias("valid_count"),
            )
            for name, before, after in spans
        ]
    )
    discarded = F.col("initial_count") - F.col("valid_count")
    return counted.select(F.inline(rows)).select(
        "*",
        discarded.alias("discarded_count"),
        F.coalesce(F.try_divide(discarded * 100, F.col("initial_count")), F.lit(0.0)).alias(
            "discarded_percent"
        ),
    )


def drop_unparseable_timestamps(df):
    """Add the event time ``ts`` and keep the rows that have one."""
    return df.withColumn("ts", event_time(df)).filter(F.col("ts").isNotNull())


def count_unparseable_timestamps(df):
    """One row: readings in all, and those without a readable time."""
    return df.select(event_time(df).alias("ts")).agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("ts").isNull()).alias("invalid")
    )


def moving_only(measurements):
    """Keep measurements with a speed above zero."""
    return measurements.filter(F.col("velocidad") > 0)
