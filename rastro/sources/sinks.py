"""CSV results."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from rastro.session import observed


def write_csv(df, path, partition_cols=None, merge_small=False, single_file=False):
    """Write CSV files with a header, replacing what is there; returns the rows written.

    ``merge_small`` lets Spark join small partitions, so a small result becomes one file
    while a large one is still written by many tasks. ``single_file`` writes one file, in the order of
    the rows; it is for results whose size is bounded by their keys. The count comes with the write.
    """
    written = Observation()
    if single_file:
        df = df.coalesce(1)
    elif merge_small:
        df = df.hint("rebalance")
    counted = df.observe(
        written, F.count(F.lit(1)).alias("rows")
    )
    writer = counted.write.mode("overwrite").options(
        header=True,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    )
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.csv(str(path))
    return observed(written, "rows")


def write_device_stats(df, path):
    return write_csv(df, path, merge_small=True)


def write_network_analysis(df, path):
    """Rows arrive sorted by count and are written in that order; there is one per operator and network."""
    return write_csv(df, path, single_file=True)


def write_temporal_patterns(df, path):
    """At most 24 hours and 7 weekdays."""
    return write_csv(df, path, single_file=True)


def write_anomalies(df, path):
    return write_csv(df, path, partition_cols=["anomaly_type"])
