"""Cleaning, calendar features, aggregates, anomalies and lookup."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rastro import schema as S
from rastro.operators import aggregates as A
from rastro.operators import anomalies as N
from rastro.operators import cleaning as C
from rastro.operators import lookup as L
from rastro.operators import movement as V
from rastro.operators import temporal as T
from rastro.plans.daily import daily_pipeline, daily_results
from rastro.session import scratch_path
from rastro.sources.sinks import write_csv

NOON = datetime(2024, 1, 1, 12)


def test_clean_coordinates(spark):
    """Limits are in; whatever lies beyond, is missing on either side, or is no number goes."""
    step, nan, inf = 1e-9, float("nan"), float("inf")
    kept = [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (-17.78, -63.18), (90.0 - step, -180.0 + step)]
    gone = [(90.0 + step, 0.0), (-90.0 - step, 0.0), (0.0, 180.0 + step), (0.0, -180.0 - step), (nan, 1.0), (1.0, nan), (inf, 1.0),
            (1.0, -inf), (None, -63.0), (-17.0, None), (None, None)]
    df = spark.createDataFrame(kept + gone, "latitude double, longitude double")
    once = C.clean_coordinates(df)
    assert sorted(map(tuple, once.collect())) == sorted(kept)
    assert C.clean_coordinates(once).count() == len(kept)


def test_clean_timestamps(spark):
    df = spark.createDataFrame([("1", NOON), ("2", None)], "id string, timestamp timestamp")
    assert C.clean_timestamps(df).count() == 1


def test_remove_null_critical_fields(spark):
    """Every field that is named counts; empty text, zero and NaN are values."""
    rows = [("a", 1, 0.5), (None, 2, 1.0), ("", 3, None), ("b", None, 2.0), ("c", 0, float("nan")), (None, None, None)]
    df = spark.createDataFrame(rows, "phone string, level int, speed double")

    def left(*fields):
        return [r["phone"] for r in C.remove_null_critical_fields(df, list(fields)).collect()]

    assert left("phone") == ["a", "", "b", "c"]
    assert left("level", "speed") == ["a", None, "c"]
    assert left("phone", "level", "speed") == ["a", "c"]
    with pytest.raises(ValueError):
        left()


def test_quality_report_of_nothing(spark):
    rows = C.quality_report(spark.createDataFrame([], S.LOCATIONS)).collect()
    assert [r["step"] for r in rows] == ["coordinates", "timestamps", "critical_fields", "total"]
    assert all(r["initial_count"] == 0 and r["discarded_percent"] == 0 for r in rows)


def test_quality_report_agrees_with_the_cleaners(spark):
    rows = [
        (1, 0.0, 0.0, NOON, "a"),
        (2, 91.0, 0.0, NOON, "a"),
        (3, None, 0.0, None, None),
        (4, 0.0, 0.0, None, "a"),
        (5, 0.0, 0.0, NOON, None),
    ]
    df = spark.createDataFrame(
        rows, "id long, latitude double, longitude double, timestamp timestamp, device_id string"
    )
    found = {r["step"]: (r["initial_count"], r["valid_count"]) for r in C.quality_report(df).collect()}
    assert found == {"coordinates": (5, 3), "timestamps": (3, 2), "critical_fields": (2, 1), "total": (5, 1)}
    assert C.clean_readings(df).count() == 1


def test_count_unparseable(spark):
    df = spark.createDataFrame([("2024-01-01",), ("x",), (None,)], "timestamp string")
    assert tuple(C.count_unparseable_timestamps(df).first()) == (3, 2)
    assert C.drop_unparseable_timestamps(df).count() == 1


def test_temporal_features(spark):
    # the last second of a leap day, the first of the next, and none at all
    rows = [(datetime(2020, 2, 29, 23, 59, 59),), (datetime(2020, 3, 1),), (None,)]
    df = T.add_temporal_features(spark.createDataFrame(rows, "timestamp timestamp"))
    assert {"date", "hour", "day_of_week", "weekday_name"} <= set(df.columns)
    found = [(str(r["date"]), r["hour"], r["day_of_week"], r["weekday_name"]) for r in df.collect()]
    assert found[:2] == [("2020-02-29", 23, 7, "Saturday"), ("2020-03-01", 0, 1, "Sunday")]
    assert found[2][:3] == ("None", None, None)


def test_device_metrics(spark):
    start = datetime(2023, 2, 28, 23, 30)
    rows = [
        ("left", 12.0, -99.5, None, start, "old name"),
        ("left", None, -60.5, 7.25, start + timedelta(minutes=90), None),
        ("left", 48.0, None, 3.75, start + timedelta(minutes=45), "new name"),
        (None, 5.0, -51.0, 0.0, start, "nobody's"),
        ("right", None, None, None, start, None),
    ]
    df = spark.createDataFrame(
        rows,
        "device_id string, battery double, signal double, speed double, timestamp timestamp, device_name string",
    )
    found = {r["device_id"]: r for r in A.device_metrics(df).collect()}
    left, right = found["left"], found["right"]
    assert set(found) == {"left", "right", None}
    assert (left["total_records"], left["avg_battery"], left["min_battery"]) == (3, 30.0, 12.0)
    assert (left["avg_signal"], left["avg_speed"], left["max_speed"]) == (-80.0, 5.5, 7.25)
    assert (left["activity_window_hours"], left["device_name_count"]) == (1.5, 2)
    assert (left["first_activity"], left["last_activity"]) == (start, start + timedelta(minutes=90))
    assert (right["avg_battery"], right["device_name_count"], right["activity_window_hours"]) == (None, 0, 0.0)


def test_network_distribution_sums_to_100(spark):
    rows = [("west", "LTE")] * 3 + [("east", "LTE"), ("west", None), (None, None), (None, None), ("east", "LTE")]
    found = A.network_distribution(
        spark.createDataFrame(rows, "sim_operator string, network_type string")
    ).collect()
    assert sum(r["percentage"] for r in found) == pytest.approx(100)
    assert [r["record_count"] for r in found] == [3, 2, 2, 1]
    assert [r["sim_operator"] for r in found] == ["west", "east", None, "west"]
    assert found[0]["percentage"] == pytest.approx(37.5)


def _readings(spark, devices=5, rows=400, ties=False, seed=1):
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        # one device holds a third of the rows; one id is null
        device = "hot" if rng.random() < 1 / 3 else rng.choice([None, *(f"d{k}" for k in range(devices))])
        moment = NOON + timedelta(seconds=rng.randrange(3 if ties else 100000))
        data.append((i, device, moment, rng.uniform(-90, 90), rng.uniform(-180, 180)))
    return data, spark.createDataFrame(
        data, "id long, device_id string, timestamp timestamp_ntz, latitude double, longitude double"
    )


def _previous(data):
    """Brute force: the reading before each one."""
    seen, expected = {}, {}
    for i, device, moment, lat, lon in sorted(data, key=lambda r: (r[2], r[0])):
        expected[i] = seen.get(device, (None, None, None))
        seen[device] = (lat, lon, moment)
    return expected


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("bucket", ["minute", "hour", "day", "year"])
def test_previous_reading_with_hot_devices(spark, ties, bucket):
    data, df = _readings(spark, ties=ties)
    moved = V.add_distance_from_previous(df, bucket)
    found = {
        r["id"]: (r["prev_latitude"], r["prev_longitude"], r["prev_timestamp"]) for r in moved.collect()
    }
    assert found == _previous(data)
    assert moved.columns == [
        *df.columns, "prev_latitude", "prev_longitude", "prev_timestamp", "distance_km", "time_diff_hours"
    ]


def test_previous_reading_over_gaps_and_missing_times(spark):
    """Gaps of days, ties across the hour, readings without a time."""
    moments = [None, None, NOON, NOON, NOON + timedelta(minutes=59, seconds=59), NOON + timedelta(hours=1)]
    moments += [NOON + timedelta(hours=1), NOON + timedelta(days=9), NOON + timedelta(days=9, hours=1)]
    data = [(i, "d", m, float(i), 0.0) for i, m in enumerate(moments)]
    df = spark.createDataFrame(
        data[::-1], "id long, device_id string, timestamp timestamp_ntz, latitude double, longitude double"
    )
    found = {r["id"]: r["prev_latitude"] for r in V.add_distance_from_previous(df).collect()}
    assert found == {i: None if i == 0 else float(i - 1) for i in range(len(data))}


def test_previous_reading_runs_no_job_when_built(spark):
    _, df = _readings(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    V.add_distance_from_previous(df)
    assert len(tracker.getJobIdsForGroup("build")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_similar_names_of_a_blank_name(spark):
    df = spark.createDataFrame([(1, "a", "x")], "id long, device_name string, device_id string")
    assert L.similar_device_names(df, "  ").isEmpty()


def test_anomalies(spark):
    rows = [
        (1, "a", NOON, 0.0, 0.0, 201.0, 5),
        (2, "a", NOON + timedelta(hours=1), 0.0, 10.0, 200.0, 10),
        (3, "a", NOON + timedelta(hours=1), 0.0, 30.0, None, 9),
        (4, "b", NOON, 0.0, 0.0, 1.0, None),
    ]
    df = V.add_distance_from_previous(
        spark.createDataFrame(
            rows,
            "id long, device_id string, timestamp timestamp, latitude double, longitude double, speed double, battery int",
        )
    )
    found = {(r["id"], r["anomaly_type"]) for r in N.all_anomalies(df).collect()}
    # reading 3 jumps far, but within the same second
    assert found == {
        (1, "impossible_speed"), (1, "critical_battery"), (3, "critical_battery"), (2, "geographic_jump")
    }
    separate = N.union_anomalies(
        N.speed_anomalies(df), N.battery_anomalies(df), N.geographic_jumps(df)
    )
    whole = N.all_anomalies(df)
    assert whole.columns == separate.columns
    assert whole.exceptAll(separate).isEmpty() and separate.exceptAll(whole).isEmpty()


def test_lookup(spark):
    rows = [
        (1, "HUAWEI A", "d1"), (2, "HUAWEI A", "d1"), (3, "HUAWEI A", "d2"), (4, "huawei_b", "d3"),
        (5, "x Huawei", "d1"), (6, None, "d1"), (7, "HUAWEI A", None), (8, "hua%wei", "d4"),
    ]
    df = spark.createDataFrame(rows, "id long, device_name string, device_id string")
    assert [tuple(r) for r in L.find_device_ids(df, "HUAWEI A").collect()] == [("d1", 2), ("d2", 1), (None, 1)]
    assert {tuple(r)[:2] for r in L.device_id_examples(df, "HUAWEI A").collect()} == {("d1", 1), ("d2", 3), (None, 7)}
    similar = {r["device_name"] for r in L.similar_device_names(df, "Huawei P30").collect()}
    assert similar == {"HUAWEI A", "huawei_b", "x Huawei"}
    assert L.similar_device_names(df, "HUAWEI A").isEmpty()
    assert {r["device_name"] for r in L.similar_device_names(df, "hua% z").collect()} == {"hua%wei"}
    names = [tuple(r) for r in L.device_name_variations(df, "d1").collect()]
    assert names == [("HUAWEI A", 2), ("x Huawei", 1)]


def test_daily_pipeline_from_csv(spark, sf_dir):
    from rastro.derived import locations_from_events

    locations = locations_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    folder = scratch_path(spark, "daily")
    write_csv(locations, f"{folder}/in")
    from_text = daily_pipeline(spark, f"{folder}/in", f"{folder}/a").collect()
    from_table = daily_pipeline(spark, locations, f"{folder}/b").collect()
    assert from_text == from_table
    sizes = {name: df.count() for name, df in daily_results(locations).items()}
    assert from_text[0]["unique_devices"] == sizes["device_stats"]
    assert from_text[0]["anomalies"] == sizes["anomalies"]
    network = spark.read.csv(f"{folder}/a/network_analysis", header=True, inferSchema=True)
    assert network.count() == sizes["network_analysis"]
    counts = [r["record_count"] for r in network.collect()]
    assert counts == sorted(counts, reverse=True)
    kinds = spark.read.csv(f"{folder}/a/anomalies", header=True).select("anomaly_type").distinct()
    assert kinds.count() <= 3
    total = A.network_distribution(C.clean_readings(locations)).agg(F.sum("percentage")).first()[0]
    assert total == pytest.approx(100)
