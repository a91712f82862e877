"""Date and time helpers."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastro import schema as S


def hours_between(earlier, later):
    """Whole seconds between two times, in hours."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / 3600


def as_timestamp(df, name):
    """The column as a timestamp: text is parsed (unreadable is null), the rest kept."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name)


def event_time(df):
    """Time of a reading: ``timestamp``, or ``created_at`` where that is null."""
    if "created_at" not in df.columns:
        return as_timestamp(df, "timestamp")
    fallback = F.when(F.col("timestamp").isNull(), as_timestamp(df, "created_at"))
    return F.coalesce(as_timestamp(df, "timestamp"), fallback)


def day_period(hour):
    """Part of the day of an hour 0-23."""
    result = F.lit(S.UNKNOWN_PERIOD)
    for name, last in reversed(S.DAY_PERIODS):
        result = F.when(hour <= last, F.lit(name)).otherwise(result)
    return F.when(hour.between(0, 23), result).otherwise(F.lit(S.UNKNOWN_PERIOD))


def calendar_attributes(date):
    """Columns of the date dimension; Monday is 0."""
    weekday = F.weekday(date)
    month = F.month(date)
    names = F.array(*[F.lit(day) for day in S.WEEKDAYS])
    months = F.array(*[F.lit(name) for name in S.MONTHS])
    return [
        F.year(date).alias("anio"),
        month.alias("mes"),
        F.dayofmonth(date).alias("dia"),
        weekday.alias("dia_semana"),
        F.get(names, weekday).alias("nombre_dia"),
        F.get(months, month - 1).alias("nombre_mes"),
        F.quarter(date).alias("trimestre"),
        (weekday >= 5).alias("es_fin_semana"),
    ]
