"""Location readings from files, tables and databases."""

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastro import schema as S

_log = logging.getLogger(__name__)


class SchemaValidationError(Exception):
    """Required columns are missing."""


class EmptySourceError(Exception):
    """The source holds no readings."""


def locations_schema():
    """The fixed schema of location readings."""
    return S.LOCATIONS


def validate_schema(df):
    """Return ``df`` if it has all required columns; more columns are kept with a warning."""
    missing = sorted(set(S.REQUIRED_COLUMNS) - set(df.columns))
    if missing:
        raise SchemaValidationError("Missing columns: " + ", ".join(missing))
    known = {*S.REQUIRED_COLUMNS, *(field.name for field in S.OPTIONAL_COLUMNS)}
    extra = sorted(set(df.columns) - known)
    if extra:
        _log.warning("Extra columns: %s", ", ".join(extra))
    return df


def read_locations_csv(spark, path, infer_schema=False):
    """Readings from CSV files with a header line.

    By default every column is read as text and converted by ``coerce_types``, which saves
    the extra pass that type inference takes over the files and leaves column order free.
    """
    try:
        # an empty field is null, a quoted empty one is empty text
        raw = spark.read.csv(
            str(path), header=True, inferSchema=infer_schema, nullValue="\u0000"
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"CSV file not found: {path}") from error
        raise
    validate_schema(raw)
    return raw if infer_schema else coerce_types(raw)


def _whole_number(column, kind, target):
    """A column as whole numbers without loss; '7.0' and '1e3' are whole numbers too, '7.5' is none.

    Plain digits are read as they stand, other text as a decimal that a double agrees is whole, so that neither digits
    beyond a double's precision nor tiny fractions are lost.
    """
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.try_cast(target)
    if isinstance(kind, T.DecimalType):
        return F.when(column == F.floor(column), column).try_cast(target)
    near = column.try_cast("double")
    if not isinstance(kind, T.StringType):
        return F.when(near == F.floor(near), near).try_cast(target)
    exact = column.try_cast("decimal(38,18)")
    whole = F.when((exact == F.floor(exact)) & (near == F.floor(near)), exact)
    return F.coalesce(column.try_cast(target), whole.try_cast(target))


def coerce_types(df):
    """Convert each known column to its type; unreadable numbers and times become null."""
    types = {field.name: field.dataType for field in (*S.LOCATIONS, *S.OPTIONAL_COLUMNS)}

    def convert(field):
        target = types.get(field.name)
        column = F.col(field.name)
        if target is None or field.dataType == target:
            return column
        if isinstance(target, T.TimestampNTZType):
            if isinstance(field.dataType, T.StringType):
                column = F.try_to_timestamp(column)
            return column.cast(target).alias(field.name)
        if isinstance(target, T.StringType):
            return column.cast(target).alias(field.name)
        if isinstance(target, (T.IntegerType, T.LongType)):
            return _whole_number(column, field.dataType, target).alias(field.name)
        return column.try_cast(target).alias(field.name)

    return df.select(*[convert(field) for field in df.schema])


def jdbc_options(url, table, lower, upper, partitions, fetch_rows=10_000):
    """Reader options that split a database table by ranges of its id."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": "id",
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_rows),
    }


def read_locations_jdbc(spark, url, table="locations", partitions=64, max_records=None, **options):
    """Readings from a database table, read by many tasks at once, each a range of ids."""
    limits = f"SELECT MIN(id) AS lo, MAX(id) AS hi FROM {table}"
    reader = spark.read.format("jdbc").options(**options, url=url, query=limits)
    low, high = reader.load().first()
    if low is None:
        raise EmptySourceError(f"No data found in table '{table}'")
    split = jdbc_options(url, table, low, high + 1, partitions)
    df = spark.read.format("jdbc").options(**options, **split).load()
    return _checked(df, max_records)


def read_locations_table(spark, name, file_format=None, max_records=None):
    """Readings from a catalogue table, or from files of ``file_format`` at a path."""
    df = spark.read.format(file_format).load(str(name)) if file_format else spark.table(name)
    if df.isEmpty():
        raise EmptySourceError(f"No data found in table '{name}'")
    return _checked(df, max_records)


def _checked(df, max_records):
    df = coerce_types(validate_schema(df))
    return df.orderBy("id").limit(max_records) if max_records else df


def last_loaded_id(fact):
    """The largest source id in the fact table, 0 if it is empty."""
    return fact.agg(F.coalesce(F.max("source_id"), F.lit(0)).alias("last_id")).first()["last_id"]


def above_cursor(locations, cursor):
    """Readings with an id above ``cursor``, and those without an id, for the loader to count."""
    return locations.filter((F.col("id") > cursor) | F.col("id").isNull())


def read_incremental(locations, fact):
    """Readings with an id above the largest one loaded; the filter reaches the scan."""
    return locations.filter(F.col("id") > last_loaded_id(fact))


def table_profile(df, name="locations"):
    """One row: table name, columns, their number, number of rows and one sample row."""
    sample = df.limit(1).select(F.to_json(F.struct("*")).alias("sample_record"))
    counted = df.agg(F.count(F.lit(1)).alias("total_records"))
    return counted.select(
        F.lit(name).alias("table_name"),
        F.array(*[F.lit(column) for column in df.columns]).alias("columns"),
        F.lit(len(df.columns)).alias("column_count"),
        "total_records",
        sample.scalar().alias("sample_record"),
    )
