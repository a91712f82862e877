"""Rollups: the same answers as from the facts, whatever the loads and the filter; what is read."""

from dataclasses import replace

import pytest
from test_plans import plan, scans

from checks.base import districts
from rastro.derived import locations_from_events
from rastro.plans import dashboard as D
from rastro.plans.load import load_warehouse
from rastro.session import scratch_path
from rastro.sources import warehouse as W

FILTERS = [
    D.NO_FILTERS,
    D.Filters(zones=("Norte",), hora_min=6, hora_max=18),
    D.Filters(operators=("Tigo",), bateria_min=10, bateria_max=60),
    D.Filters(velocidad_min=1, velocidad_max=150, hora_min=0, hora_max=11),
]
QUERIES = [
    D.kpis, D.operator_distribution, D.zone_distribution, D.hourly_pattern, D.quality_by_operator, D.hour_day_counts,
    D.activity_heatmap,
    lambda star, filters: D.map_points(star, filters, points=40),
    lambda star, filters: D.flagged_measurements(star, filters, rows=25),
]


@pytest.fixture(scope="module")
def star(spark, sf_dir):
    """Loaded in three overlapping parts, so that keys have several rows in the rollups."""
    readings = locations_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    root = scratch_path(spark, "rollups")
    for part in ("id % 3 = 0", "id % 3 < 2 AND id > 100", "true"):
        load_warehouse(spark, root, readings.filter(part), districts(spark), take_late=True)
    W.compact_table(spark, root, "dim_ubicacion")
    return W.read_star(spark, root)


@pytest.fixture(scope="module")
def without(star):
    return replace(star, rollup_diario=None, rollup_dispositivos=None)


@pytest.mark.parametrize("filters", FILTERS, ids=range(len(FILTERS)))
def test_rollups_give_what_the_facts_give(star, without, filters):
    for query in QUERIES:
        assert query(star, filters).collect() == query(without, filters).collect()


def test_a_kpi_reads_neither_facts_nor_locations(star):
    for query in QUERIES[:7]:
        text = plan(query(star, FILTERS[2]))
        assert "fact_mediciones" not in text and "dim_ubicacion" not in text


def test_newest_days_are_chosen_from_the_rollup(star):
    for query in QUERIES[7:]:
        facts = [s for s in scans(query(star, D.NO_FILTERS)) if "fact_mediciones" in s]
        assert len(facts) == 1 and "Subquery" in facts[0]


def test_compacted_rollups_have_one_row_per_key(spark, sf_dir):
    readings = locations_from_events(spark.read.parquet(f"{sf_dir}/events.parquet")).filter("id < 300")
    root = scratch_path(spark, "compact-rollups")
    for part in ("id < 200", "true"):
        load_warehouse(spark, root, readings.filter(part), districts(spark))
    before = D.kpis(W.read_star(spark, root)).collect()
    for name in W.ROLLUPS:
        n = W.compact_table(spark, root, name)
        rows = W.read_warehouse_table(spark, root, name)
        assert n == rows.count() == rows.select(*(W.KEYS if name == "rollup_diario" else rows.columns)).distinct().count()
    assert D.kpis(W.read_star(spark, root)).collect() == before
