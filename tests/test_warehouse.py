"""Star schema, loading in slices, insert-ignore, upserts, checks, stream."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.base import districts
from rastro import schema as S
from rastro.derived import locations_from_events
from rastro.plans import star as P
from rastro.plans.dashboard import Filters, activity_heatmap, filter_measurements, kpis, map_points, zone_counts, zone_distribution
from rastro.plans.load import load_batch, load_static_dimensions, load_warehouse
from rastro.session import scratch_path
from rastro.sources import warehouse as W
from rastro.streaming.load import stream_load_warehouse


@pytest.fixture(scope="module")
def readings(spark, sf_dir):
    """The first 150 readings of the derived table."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return locations_from_events(events).filter("id < 150").coalesce(1)


@pytest.fixture(scope="module")
def single(spark, readings):
    root = scratch_path(spark, "single")
    load_warehouse(spark, root, readings, districts(spark), full_reload=True)
    return W.read_star(spark, root)


def _content(star):
    """All tables as sorted rows, without the time of loading."""
    return {
        name: sorted(map(tuple, df.drop("fecha_carga").collect()), key=repr)
        for name, df in star.tables().items()
    }


def test_slices_give_the_single_load(spark, readings, single):
    root = scratch_path(spark, "slices")
    W.create_warehouse(spark, root)
    known = districts(spark)
    load_static_dimensions(spark, root, known)
    counts = [
        load_batch(spark, root, readings.filter(part), known)
        for part in ("id < 100", "id between 90 and 149", "id < 150")
    ]
    assert _content(W.read_star(spark, root)) == _content(single)
    assert [c["records_read"] for c in counts] == [100, 60, 150]
    assert counts[1]["already_present"] > 0
    last = counts[2]
    assert (last["records_inserted"], last["new_dates"], last["new_locations"], last["new_devices"]) == (0, 0, 0, 0)
    assert last["already_present"] + last["invalid_timestamps"] == 150
    assert all(c["prepare_seconds"] > 0 and c["write_seconds"] > 0 for c in counts)


def test_incremental_load_takes_new_ids_only(spark, readings, single):
    root = scratch_path(spark, "incremental")
    known = districts(spark)
    first = load_warehouse(spark, root, readings.filter("id < 100"), known).first()
    second = load_warehouse(spark, root, readings, known).first()
    third = load_warehouse(spark, root, readings, known).first()
    assert first["records_inserted"] + second["records_inserted"] == single.fact_mediciones.count()
    assert (second["already_present"], third["records_inserted"]) == (0, 0)
    assert _content(W.read_star(spark, root)) == _content(single)


def test_stream_resumes_and_ignores_repeats(spark, readings, single):
    folder = scratch_path(spark, "stream")
    for part in ("id < 100", "id between 90 and 149", "id < 150"):
        readings.filter(part).write.mode("append").parquet(f"{folder}/in")
        stream_load_warehouse(
            spark, f"{folder}/in", f"{folder}/dw", f"{folder}/cp", readings.schema, districts(spark)
        )
    assert _content(W.read_star(spark, f"{folder}/dw")) == _content(single)


def test_integrity(single):
    assert all(r["violations"] == 0 for r in W.integrity_report(single).collect())
    counts = {r["table_name"]: r["row_count"] for r in W.warehouse_counts(single).collect()}
    assert counts["dim_hora"] == 24 and counts["dim_operador"] == 5 and counts["dim_zonas"] == 4


def test_integrity_finds_violations(single):
    from dataclasses import replace

    fact = single.fact_mediciones
    broken = replace(
        single,
        fact_mediciones=fact.unionAll(fact.limit(2)).withColumn("zona_id", F.lit(99)),
        dim_hora=single.dim_hora.unionAll(single.dim_hora.limit(1)),
    )
    found = {r["constraint_name"]: r["violations"] for r in W.integrity_report(broken).collect()}
    assert found["unique fact_mediciones(source_id)"] == 2
    assert found["fact_mediciones(zona_id) in dim_zonas"] == fact.count() + 2
    assert found["unique dim_hora(hora)"] == 1
    assert found["fact_mediciones(hora_id) in dim_hora"] == 0


def test_append_keeps_one_row_per_source_id(spark, single):
    root = scratch_path(spark, "append")
    W.create_warehouse(spark, root)
    fact = single.fact_mediciones
    other = fact.withColumn("velocidad", F.col("velocidad") + 1)
    # a third of the rows share one id
    hot = fact.withColumn("source_id", F.when(F.col("source_id") % 3 == 0, 3).otherwise(F.col("source_id")))
    assert W.append_facts(spark, root, hot.unionAll(hot)) == hot.select("source_id").distinct().count()
    assert W.append_facts(spark, root, other.filter("source_id = 3")) == 0
    assert W.append_facts(spark, root, fact.limit(0)) == 0
    stored = W.read_warehouse_table(spark, root, "fact_mediciones")
    assert stored.count() == stored.select("source_id").distinct().count()


def test_dates_insert_ignore(spark):
    root = scratch_path(spark, "dates")
    W.create_warehouse(spark, root)
    dates = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3)], "fecha date")
    assert W.insert_ignore_dimension(spark, root, "dim_tiempo", P.dim_date(dates)) == 3
    assert W.insert_ignore_dimension(spark, root, "dim_tiempo", P.dim_date(dates)) == 0
    stored = W.read_warehouse_table(spark, root, "dim_tiempo")
    assert W.existing_dates(stored, dates.limit(2)).count() == 2


def test_zones_upsert_and_rename(spark):
    root = scratch_path(spark, "zones")
    W.create_warehouse(spark, root)
    W.upsert_zones(spark, root, P.dim_zone(spark))
    W.upsert_zones(spark, root, P.dim_zone(spark, districts(spark)))
    zones = {r["zona_id"]: r for r in W.read_warehouse_table(spark, root, "dim_zonas").collect()}
    assert len(zones) == 20 and zones[2]["nombre"] == "Norte" and zones[5]["nombre"] == "Pampa de la Isla"
    assert zones[1]["latitud_centro"] == Decimal("-17.8000000") and zones[1]["radio_km"] == 5
    W.update_zone_names(spark, root, spark.createDataFrame([(5, "Cinco"), (99, "x")], "zona_id int, nombre string"))
    zones = {r["zona_id"]: r["nombre"] for r in W.read_warehouse_table(spark, root, "dim_zonas").collect()}
    assert len(zones) == 20 and zones[5] == "Cinco" and zones[2] == "Norte"


def test_scalar_query(spark, readings):
    root = scratch_path(spark, "scalar")
    load_warehouse(spark, root, readings, districts(spark))
    assert W.execute_scalar(spark, root, "SELECT max(hora) FROM {dim_hora}") == 23
    assert W.execute_scalar(spark, root, "SELECT hora FROM {dim_hora} WHERE hora > 99") is None


def _reading(i, **changes):
    row = {
        "id": i, "device_name": "p", "latitude": -17.8, "longitude": -63.22, "altitude": 100.0, "speed": 5.0,
        "battery": 50, "signal": -60, "sim_operator": "tigo", "network_type": "4G",
        "timestamp": datetime(2024, 1, 1, 1) + timedelta(hours=i or 0), "device_id": "d",
    }
    return tuple({**row, **changes}.values())


def test_preparation_rules(spark):
    rows = [
        _reading(1, latitude=None, longitude=None, altitude=None, battery=None, signal=None),
        _reading(2, latitude=95.0, speed=-1.0),
        _reading(3, altitude=20000.0, speed=100.0, device_id=None),
        _reading(4, latitude=-17.80000004, altitude=7.0),
        _reading(5, timestamp=None),
    ]
    df = spark.createDataFrame(rows, S.LOCATIONS)
    star = P.build_star(spark, df, districts(spark))
    fact = {r["source_id"]: r for r in star.fact_mediciones.collect()}
    assert set(fact) == {1, 2, 3, 4}
    assert fact[1]["bateria"] is None and fact[1]["calidad_id"] == 5
    assert (fact[2]["velocidad"], fact[3]["velocidad"]) == (0, 200)
    places = {r["ubicacion_id"]: r for r in star.dim_ubicacion.collect()}
    place = places[fact[1]["ubicacion_id"]]
    assert (float(place["latitud"]), float(place["longitud"]), place["altitud"]) == (-17.7833, -63.1822, 0)
    assert float(places[fact[2]["ubicacion_id"]]["latitud"]) == 90
    # the same seven decimals are one place; its altitude is that of the first reading
    assert fact[3]["ubicacion_id"] == fact[4]["ubicacion_id"]
    assert places[fact[4]["ubicacion_id"]]["altitud"] == 0
    devices = {r["dispositivo_id"]: r["nombre_dispositivo"] for r in star.dim_dispositivo.collect()}
    assert fact[3]["dispositivo_id"] != fact[4]["dispositivo_id"] and set(devices.values()) == {"p"}
    assert all(r["violations"] == 0 for r in W.integrity_report(star).collect())


def test_column_aliases(spark):
    df = spark.createDataFrame([_reading(1)], S.LOCATIONS)
    renamed = df.withColumnsRenamed(
        {"signal": "dbm", "speed": "velocidad", "battery": "battery_level", "sim_operator": "operator_name"}
    )
    columns = ["senal", "velocidad_kmh", "bateria", "operador", "calidad"]
    expected = P.prepare_measurements(df).select(columns).collect()
    assert P.prepare_measurements(renamed).select(columns).collect() == expected
    assert tuple(expected[0]) == (-60, 18.0, 50, "Tigo", "Excelente")


def test_lookup_join_gives_the_computed_keys(spark, readings, single):
    prepared = P.prepare_measurements(readings, districts(spark))
    looked_up = P.fact_lookup(prepared, single).drop("fecha_carga")
    assert looked_up.exceptAll(single.fact_mediciones.drop("fecha_carga")).isEmpty()
    assert looked_up.count() == single.fact_mediciones.count()


def _adds_up(report):
    parts = ("invalid_ids", "invalid_timestamps", "already_present", "repeated_in_batch", "records_inserted")
    return report["records_read"] == sum(report[p] for p in parts)


def test_readings_without_an_id_are_counted_not_merged(spark):
    rows = [_reading(None), _reading(None), _reading(None, timestamp=None), _reading(1), _reading(1), _reading(2, timestamp=None)]
    df = spark.createDataFrame(rows, S.LOCATIONS)
    for full in (True, False):
        root = scratch_path(spark, "no-id")
        report = load_warehouse(spark, root, df, districts(spark), full_reload=full).first()
        assert _adds_up(report)
        assert (report["records_read"], report["invalid_ids"], report["records_inserted"]) == (6, 3, 1)
        assert [r["source_id"] for r in W.read_warehouse_table(spark, root, W.FACT).collect()] == [1]


def test_late_ids_are_counted(spark):
    root = scratch_path(spark, "late")
    first = spark.createDataFrame([_reading(5), _reading(6)], S.LOCATIONS)
    load_warehouse(spark, root, first, districts(spark))
    later = spark.createDataFrame([_reading(4), _reading(6), _reading(7), _reading(None)], S.LOCATIONS)
    report = load_warehouse(spark, root, later, districts(spark)).first()
    assert _adds_up(report)
    assert (report["late_ids"], report["records_read"], report["invalid_ids"], report["records_inserted"]) == (2, 2, 1, 1)


def test_no_value_stops_a_load(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        _reading(1, signal=2147483647, battery=2147483647),
        _reading(2, latitude=nan, longitude=nan, altitude=nan, speed=nan),
        _reading(3, latitude=None, longitude=None, altitude=inf, speed=inf),
        _reading(4, latitude=inf),
    ]
    df = spark.createDataFrame(rows, S.LOCATIONS)
    root = scratch_path(spark, "values")
    report = load_warehouse(spark, root, df, districts(spark), full_reload=True).first()
    assert (report["records_inserted"], report["invalid_measures"]) == (4, 1)
    fact = {r["source_id"]: r for r in W.read_warehouse_table(spark, root, W.FACT).collect()}
    assert fact[1]["senal_dbm"] is None and fact[1]["bateria"] == 2147483647
    # unreadable coordinates are missing ones, for the zone as for the place
    assert fact[2]["zona_id"] == fact[3]["zona_id"] and fact[2]["ubicacion_id"] == fact[3]["ubicacion_id"]
    assert all(r["violations"] == 0 for r in W.integrity_report(W.read_star(spark, root)).collect())


def test_text_aliases(spark):
    df = spark.createDataFrame([_reading(1), _reading(2)], S.LOCATIONS)
    text = df.select(
        "id", "device_name", "latitude", "longitude", "altitude", "sim_operator", "network_type", "timestamp", "device_id",
        F.when(F.col("id") == 1, "-70.0").otherwise("none").alias("dbm"),
        F.when(F.col("id") == 1, "55").otherwise("?").alias("battery_level"),
        F.when(F.col("id") == 1, "2.5").otherwise("NaN").alias("velocidad"),
    )
    found = P.prepare_measurements(text).select("senal", "bateria", "velocidad_kmh").collect()
    assert [tuple(r) for r in found] == [(-70, 55, 9.0), (None, None, 0.0)]


def test_staged_rows_are_fresh_and_removed(spark):
    root = scratch_path(spark, "staged")
    df = spark.createDataFrame([_reading(1)], S.LOCATIONS)
    load_warehouse(spark, root, df, districts(spark), full_reload=True)
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    assert not [f.getPath().getName() for f in files if f.getPath().getName().startswith("_staged")]
    with pytest.raises(ZeroDivisionError):
        with W.staged_path(spark, root, "x") as one, W.staged_path(spark, root, "x") as other:
            assert one != other
            raise ZeroDivisionError


def test_query_parameters(spark, single, readings):
    root = scratch_path(spark, "params")
    load_warehouse(spark, root, readings, districts(spark))
    sql = "SELECT count(*) FROM {dim_hora} WHERE hora >= :low AND nombre_hora <> :name"
    assert W.execute_scalar(spark, root, sql, {"low": 20, "name": "x' OR '1'='1"}) == 4


def test_stream_reports_batches(spark, readings):
    folder = scratch_path(spark, "stream-report")
    readings.filter("id < 50").write.parquet(f"{folder}/in")
    (report,) = stream_load_warehouse(
        spark, f"{folder}/in", f"{folder}/dw", f"{folder}/cp", readings.schema, districts(spark)
    )
    assert report["batch"] == 0 and report["records_read"] == 50 and _adds_up(report)


# --- dashboard ----------------------------------------------------------------------------


def test_no_filter_keeps_all(single):
    assert filter_measurements(single).count() == single.fact_mediciones.count()
    half_open = Filters(bateria_min=50)
    assert filter_measurements(single, half_open).count() == single.fact_mediciones.count()


def test_ranges_drop_nulls_and_hours_are_values(single):
    fact = single.fact_mediciones
    everything = Filters(bateria_min=0, bateria_max=100, hora_min=0, hora_max=23)
    assert filter_measurements(single, everything).count() == fact.filter("bateria is not null").count()
    late = filter_measurements(single, Filters(hora_min=23, hora_max=23))
    assert late.count() == fact.filter(F.hour("timestamp_original") == 23).count() > 0


def test_quotes_in_a_filter_are_harmless(single):
    assert filter_measurements(single, Filters(operators=("x' OR '1'='1",))).isEmpty()


def test_kpis_of_nothing_are_zero(single):
    row = kpis(single, Filters(operators=("nobody",))).first()
    assert tuple(row) == (0, 0, 0, 0, 0, 0)


def test_heatmap_has_all_hours_and_days_in_order(single):
    heat = activity_heatmap(single)
    assert heat.columns == ["nombre_dia", *map(str, range(24))]
    days = [r["nombre_dia"] for r in heat.collect()]
    assert days == [d for d in S.WEEKDAYS if d in days]
    total = sum(sum(r[1:]) for r in map(tuple, heat.collect()))
    assert total == single.fact_mediciones.count()


def test_top_k_order(single):
    times = [r["timestamp_original"] for r in map_points(single, points=10).collect()]
    newest = single.fact_mediciones.orderBy(F.desc("timestamp_original")).limit(10).collect()
    assert times == [r["timestamp_original"] for r in newest]
    assert zone_counts(single).agg(F.sum("count")).first()[0] == single.fact_mediciones.count()
    counts = [r["count"] for r in zone_distribution(single).collect()]
    assert counts == sorted(counts, reverse=True) and sum(counts) == single.fact_mediciones.count()
