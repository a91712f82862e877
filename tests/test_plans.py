"""Physical plans: what must not appear, and what must reach the scan."""

import pytest

from checks import QUERIES
from checks.base import locations, star, warehouse_root
from rastro.operators.aggregates import device_metrics, network_distribution
from rastro.operators.cleaning import clean_readings
from rastro.operators.movement import add_distance_from_previous
from rastro.operators.temporal import add_temporal_features
from rastro.plans import dashboard as D
from rastro.plans import star as P
from rastro.plans import views as V
from rastro.plans.daily import daily_results
from rastro.sources import warehouse as W


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return [line for line in plan(df).splitlines() if "FileScan" in line]


def test_prepared_measurements_and_fact_need_no_shuffle(spark, sf_dir):
    fact = P.build_fact(P.prepare_measurements(locations(spark, sf_dir)))
    assert "Exchange" not in plan(fact)


def test_zone_grid_is_the_only_join(spark, sf_dir):
    from checks.base import prepared

    text = plan(P.build_fact(prepared(spark, sf_dir)))
    assert text.count("BroadcastHashJoin") == 1
    assert "SortMergeJoin" not in text and "NestedLoop" not in text and "hashpartitioning" not in text


def test_daily_results_only_sort_for_anomalies(spark, sf_dir):
    results = daily_results(locations(spark, sf_dir))
    assert "Window" in plan(results["anomalies"])
    for name in ("device_stats", "network_analysis", "temporal_patterns"):
        assert "Window" not in plan(results[name]), name


def test_anomalies_read_the_table_for_readings_and_for_hours(spark, sf_dir):
    results = daily_results(locations(spark, sf_dir))
    assert len(scans(results["anomalies"])) == 2


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    df = clean_readings(locations(spark, sf_dir))
    for result in (device_metrics(df), network_distribution(df)):
        assert "partial_count" in plan(result)
        assert "SortAggregate" not in plan(result)


def test_location_dimension_hashes(spark, sf_dir):
    text = plan(P.dim_location(P.prepare_measurements(locations(spark, sf_dir))))
    assert "SortAggregate" not in text and text.count("Exchange hashpartitioning") == 1


def test_map_view_does_not_join_locations(spark, sf_dir):
    tables = star(spark, sf_dir)
    text = plan(V.map_view(tables))
    assert "dim_ubicacion" not in text and "SortMergeJoin" not in text


def test_filters_reach_the_scan(spark, sf_dir):
    tables = star(spark, sf_dir)
    rows = D.filter_measurements(tables, D.Filters(bateria_min=10, bateria_max=90, velocidad_min=1, velocidad_max=50))
    (scan,) = scans(rows)
    assert "GreaterThanOrEqual(bateria,10)" in scan and "LessThanOrEqual(velocidad,50" in scan


def test_scans_read_only_needed_columns(spark, sf_dir):
    tables = star(spark, sf_dir)
    fact = [line for line in scans(D.operator_distribution(tables)) if "fact_mediciones" in line]
    assert all(line.rstrip().endswith("ReadSchema: struct<operador_id:int>") for line in fact)


def test_days_prune_folders(spark, sf_dir):
    fact = star(spark, sf_dir).fact_mediciones.filter("tiempo_id = 20240105")
    (scan,) = scans(fact)
    assert "PartitionFilters: [isnotnull(tiempo_id" in scan


def test_top_k_picks_rows_before_joining(spark, sf_dir):
    tables = star(spark, sf_dir)
    for result in (D.map_points(tables), D.flagged_measurements(tables), D.speed_altitude(tables)):
        text = plan(result)
        scan = text.index("fact_mediciones")
        assert "TakeOrderedAndProject" in text[:scan]


_NO_CROSS = [
    "distance_from_previous", "all_anomalies", "assign_district_zone", "build_fact", "fact_lookup", "kpis_filtered",
    "map_view", "map_points", "flagged_measurements_filtered", "operator_zone_summary", "network_distribution",
    "integrity_report", "similar_device_names", "dim_location", "dim_device", "append_facts",
]


@pytest.mark.parametrize("name", _NO_CROSS)
def test_no_cross_joins(spark, sf_dir, name):
    warehouse_root(spark, sf_dir)
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_previous_readings_are_sorted_per_device_and_hour(spark, sf_dir):
    df = add_temporal_features(clean_readings(locations(spark, sf_dir)))
    text = plan(add_distance_from_previous(df))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "hashpartitioning(device_id" in text and "_bucket" in text


def test_map_points_and_flags_read_newest_days_without_locations(spark, sf_dir):
    tables = star(spark, sf_dir)
    for result in (D.map_points(tables), D.flagged_measurements(tables)):
        assert "dim_ubicacion" not in plan(result)
        assert any("PartitionFilters" in s and "tiempo_id" in s and "Subquery" in s for s in scans(result))


def test_integrity_report_reads_facts_few_times(spark, sf_dir):
    text = [s for s in scans(W.integrity_report(star(spark, sf_dir))) if "fact_mediciones" in s]
    assert len(text) <= 5
