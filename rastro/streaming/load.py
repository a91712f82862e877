"""Warehouse loading as a stream of new files."""

from rastro.plans.load import load_batch, load_static_dimensions
from rastro.sources.locations import coerce_types
from rastro.sources.versions import changing, read_version


def load_stream_batch(spark, root, stream, number, readings, districts=None):
    """Load one batch of a stream, once: a batch that the stream has committed already is passed over.

    The number of the stream's last batch is part of the version that the batch makes, so rows and number are stored
    together. Returns the report, None for a batch that is passed over.
    """
    if number <= read_version(spark, root).streams.get(stream, -1):
        return None
    with changing(spark, root, "stream", f"{stream}#{number}") as change:
        report = load_batch(spark, root, readings, districts, change=change)
        change.streams[stream] = number
    return report


def stream_load_warehouse(
    spark, source, root, checkpoint, schema, districts=None, file_format="parquet", files=None, stream=None
):
    """Load every new file below ``source`` into the warehouse, then stop; can be resumed.

    Each batch is one change of the warehouse. A batch that was cut off has left nothing and is loaded again by the
    next run; one that was committed, but not noted in the checkpoint, is passed over. ``stream`` names the stream in
    the warehouse (default: the checkpoint's path). Repeated ids are ignored by comparison with the stored ids, whenever
    they arrive, so the stream keeps no state of its own. Returns the report of every batch.
    """
    stream = stream or str(checkpoint).rstrip("/")
    load_static_dimensions(spark, root, districts)
    reader = spark.readStream.schema(schema).format(file_format)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)

    reports = []

    def load(batch, number):
        report = load_stream_batch(batch.sparkSession, root, stream, number, coerce_types(batch), districts)
        if report is not None:
            reports.append({"batch": number, **report})

    query = (
        reader.load(str(source))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return reports
