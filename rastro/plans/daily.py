"""The daily analysis: clean, derive, aggregate, export."""

from pyspark.sql import functions as F

from rastro.operators.aggregates import device_metrics, network_distribution
from rastro.operators.anomalies import all_anomalies
from rastro.operators.cleaning import clean_readings, quality_report
from rastro.operators.movement import add_distance_from_previous
from rastro.operators.temporal import add_temporal_features, temporal_patterns
from rastro.session import scratch_path
from rastro.sources import sinks
from rastro.sources.locations import read_locations_csv


def daily_results(locations):
    """The four results as lazy DataFrames.

    Only the anomalies need the previous reading; the other three read the cleaned rows, so
    that Spark prunes their columns and plans no window for them.
    """
    cleaned = add_temporal_features(clean_readings(locations))
    return {
        "device_stats": device_metrics(cleaned),
        "network_analysis": network_distribution(cleaned),
        "temporal_patterns": temporal_patterns(cleaned),
        "anomalies": all_anomalies(add_distance_from_previous(cleaned)),
    }


def daily_pipeline(spark, source, output, text_source=None):
    """Run the daily analysis and write its four results as CSV; one summary row.

    ``source`` is a DataFrame or the path of CSV files. Text is parsed once and kept as
    parquet in the shared folder, because several results read it.
    """
    from_text = isinstance(source, str) if text_source is None else text_source
    locations = read_locations_csv(spark, source) if isinstance(source, str) else source
    if from_text:
        parsed = scratch_path(spark, "locations")
        locations.write.parquet(parsed)
        locations = spark.read.parquet(parsed)
    results = daily_results(locations)
    writers = {
        "device_stats": sinks.write_device_stats,
        "network_analysis": sinks.write_network_analysis,
        "temporal_patterns": sinks.write_temporal_patterns,
        "anomalies": sinks.write_anomalies,
    }
    written = {
        name: write(results[name], f"{output}/{name}") for name, write in writers.items()
    }
    total = quality_report(locations).filter(F.col("step") == "total")
    return total.select(
        F.col("initial_count").alias("initial_records"),
        F.col("valid_count").alias("clean_records"),
        F.col("discarded_count").alias("discarded_records"),
        F.col("discarded_percent").alias("discard_percent"),
        F.lit(written["device_stats"]).cast("bigint").alias("unique_devices"),
        F.lit(written["anomalies"]).cast("bigint").alias("anomalies"),
    )
