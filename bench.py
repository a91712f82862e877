"""Time the headline queries; prints one line of JSON.

BENCH_SF_DIR is the folder with the tables, BENCH_CPUS the number of local threads. The first
run of each query warms the JVM up, the second is timed; the load is timed both times, by phases, and once more
with nothing new.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import QUERIES  # noqa: E402
from checks.base import districts, locations, warehouse_root  # noqa: E402
from rastro.plans.load import load_warehouse  # noqa: E402
from rastro.session import build_session, scratch_path  # noqa: E402

HEADLINE = [
    "device_metrics",
    "network_distribution",
    "temporal_patterns",
    "distance_from_previous",
    "distance_from_previous_split",
    "all_anomalies",
    "quality_report",
    "assign_district_zone",
    "build_fact",
    "dim_location",
    "operator_zone_summary",
    "temporal_summary",
    "quality_summary",
    "map_view",
    "global_kpis",
    "kpis",
    "operator_distribution",
    "zone_distribution",
    "hourly_pattern",
    "quality_by_operator",
    "speed_altitude",
    "activity_heatmap",
    "map_points",
    "flagged_measurements",
    "kpis_filtered",
    "map_points_filtered",
    "find_device_ids",
    "similar_device_names",
]


def seconds(run):
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # several files, as a source of this size would have; reading them is the fetch phase
    source = scratch_path(spark, "bench-source")
    locations(spark, sf_dir).repartition(int(cpus)).write.parquet(source)
    readings = spark.read.parquet(source)
    records = readings.count()
    fetch = seconds(lambda: readings.write.format("noop").mode("overwrite").save())
    reports = []

    def load(full_reload=True, root=None):
        root = root or scratch_path(spark, "bench")
        report = load_warehouse(spark, root, readings, districts(spark), full_reload=full_reload)
        reports.append(report.first())
        return root

    cold, warm = seconds(load), seconds(load)
    phases = reports[-1]
    loaded = load()
    repeat = seconds(lambda: load(full_reload=False, root=loaded))
    timed = {"load_warehouse": warm}
    warehouse_root(spark, sf_dir)
    for name in HEADLINE:
        def run(name=name):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        timed[name] = seconds(run)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "records": records,
                "load_cold_sec": cold,
                "load_again_sec": repeat,
                "load_phases_sec": {
                    "fetch": fetch,
                    "setup": phases["setup_seconds"],
                    "transform": phases["prepare_seconds"],
                    "write": phases["write_seconds"],
                },
                "load_records_per_sec": round(records / warm),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
