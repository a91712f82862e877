"""Finding devices by model name."""

from pyspark.sql import functions as F

from rastro import schema as S
from rastro.operators.aggregates import sort_by_count


def _records():
    return F.count(F.lit(1)).alias("records")


def find_device_ids(locations, device_name):
    """Device ids of the name (exact) with their number of readings, largest first."""
    counted = locations.filter(F.col("device_name") == device_name).groupBy("device_id")
    return sort_by_count(counted.agg(_records()), "records", "device_id")


def device_id_examples(locations, device_name):
    """The first reading (by id) of each device id that has the name."""
    named = locations.filter(F.col("device_name") == device_name).groupBy("device_id")
    return named.agg(F.min("id").alias("id")).withColumn("device_name", F.lit(device_name))


def similar_device_names(locations, device_name, top=S.SIMILAR_NAMES):
    """Most frequent names that contain the first word of ``device_name``, in any case.

    One row per name and device id, so that a name used by very many devices is no problem.
    Names are empty if a reading has the exact name: the search is a fallback.
    """
    words = device_name.split()
    if not words:  # nothing is similar to a blank name
        locations, words = locations.limit(0), [""]
    word = words[0]
    pattern = "%" + word.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
    exact = locations.filter(F.col("device_name") == device_name).select(F.lit(1)).limit(1)
    pairs = (
        locations.filter(F.col("device_name").ilike(pattern))
        .filter(~exact.exists())
        .groupBy("device_name", "device_id")
        .agg(_records())
    )
    names = pairs.groupBy("device_name").agg(F.sum("records").alias("name_records"))
    best = sort_by_count(names, "name_records", "device_name").limit(top)
    return pairs.join(best, "device_name").select(
        "device_name", "name_records", "device_id", "records"
    )


def device_name_variations(locations, device_id):
    """Names a device id was seen with, most frequent first."""
    named = locations.filter(
        (F.col("device_id") == device_id) & F.col("device_name").isNotNull()
    ).groupBy("device_name")
    return sort_by_count(named.agg(_records()), "records", "device_name")
