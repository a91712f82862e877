"""Readers, schema checks and type coercion."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rastro import schema as S
from rastro.session import scratch_path
from rastro.sources import locations as L
from rastro.sources import sinks


def _row(**changes):
    row = {
        "id": 1, "device_name": "p", "latitude": 1.0, "longitude": 2.0, "altitude": 3.0, "speed": 4.0, "battery": 5,
        "signal": -60, "sim_operator": "", "network_type": None, "timestamp": datetime(2024, 1, 1, 1, 2, 3, 456789),
        "device_id": " d ",
    }
    return tuple({**row, **changes}.values())


def test_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        L.read_locations_csv(spark, scratch_path(spark, "nothing"))


def test_csv_round_trip_keeps_spaces_empty_text_and_microseconds(spark):
    df = spark.createDataFrame([_row(), _row(id=2, device_name='a "b", c', device_id=None)], S.LOCATIONS)
    path = scratch_path(spark, "csv")
    assert sinks.write_csv(df, path) == 2
    read = L.read_locations_csv(spark, path)
    assert read.schema == S.LOCATIONS
    assert sorted(read.collect()) == sorted(df.collect())
    assert L.read_locations_csv(spark, path, infer_schema=True).count() == 2


def test_csv_column_order_does_not_matter(spark):
    df = spark.createDataFrame([_row()], S.LOCATIONS)
    path = scratch_path(spark, "csv")
    sinks.write_csv(df.select(*reversed(df.columns)), path)
    assert L.read_locations_csv(spark, path).select(*df.columns).collect() == df.collect()


def test_writing_nothing(spark):
    assert sinks.write_csv(spark.createDataFrame([], S.LOCATIONS), scratch_path(spark, "csv")) == 0


def test_validate_schema(spark, caplog):
    df = spark.createDataFrame([_row()], S.LOCATIONS)
    with pytest.raises(L.SchemaValidationError, match="Missing columns: altitude, speed$"):
        L.validate_schema(df.drop("speed", "altitude"))
    more = df.withColumn("extra", F.lit(1))
    assert L.validate_schema(more).columns == more.columns
    assert "extra" in caplog.text


def test_coerce_types(spark):
    rows = [("7", "x", "1.5", "12.0", "12.5", "2024-01-01T10:00:00Z"), ("8", None, "", "a", "-3", "never")]
    df = spark.createDataFrame(
        rows, "id string, latitude string, speed string, battery string, signal string, timestamp string"
    )
    found = [tuple(r) for r in L.coerce_types(df).collect()]
    assert found == [
        (7, None, 1.5, 12, None, datetime(2024, 1, 1, 10)),
        (8, None, None, None, -3, None),
    ]


def test_empty_table_is_an_error(spark):
    path = scratch_path(spark, "empty")
    spark.createDataFrame([], S.LOCATIONS).write.parquet(path)
    with pytest.raises(L.EmptySourceError):
        L.read_locations_table(spark, path, "parquet")


def test_table_with_a_cap(spark):
    path = scratch_path(spark, "table")
    spark.createDataFrame([_row(id=i) for i in range(20)], S.LOCATIONS).write.parquet(path)
    read = L.read_locations_table(spark, path, "parquet", max_records=5)
    assert sorted(r["id"] for r in read.collect()) == [0, 1, 2, 3, 4]
    assert L.read_locations_table(spark, path, "parquet").count() == 20


def test_jdbc_reads_are_split_by_id():
    options = L.jdbc_options("jdbc:x", "locations", 1, 1001, 8)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "1001")


def test_incremental(spark):
    readings = spark.createDataFrame([_row(id=i) for i in (1, 5, 9)], S.LOCATIONS)
    fact = spark.createDataFrame([(5,), (2,)], "source_id long")
    assert [r["id"] for r in L.read_incremental(readings, fact).collect()] == [9]
    assert L.last_loaded_id(fact.limit(0)) == 0


def test_table_profile(spark):
    df = spark.createDataFrame([_row()], S.LOCATIONS)
    row = L.table_profile(df, "t").first()
    assert (row["table_name"], row["column_count"], row["total_records"]) == ("t", 12, 1)
    assert row["columns"] == df.columns and '"id":1' in row["sample_record"]
    assert L.table_profile(df.limit(0)).first()["sample_record"] is None
