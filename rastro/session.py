"""Session defaults and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Rows that a task should prepare at most; a task with fewer than the smaller number is left as it is.
ROWS_PER_TASK, FEW_ROWS = 500_000, 50_000


def build_session(app_name="rastro", master=None, **conf):
    """Session with the settings the package is designed for.

    Shuffle partitions are left to adaptive execution: start from a count sized for
    the cluster (``spark.sql.shuffle.partitions``) and let Spark merge small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # the preparation of a reading is a long projection; beyond this size the JVM would
        # not compile its generated method
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark):
    """Folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="rastro-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark, label):
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/rastro/{label}-{uuid.uuid4().hex}"


def observed(observation, name):
    """An observed count, after the action that it belongs to."""
    return observation.get[name]


def spread(rows):
    """The rows over all cores if few tasks hold most of them, else as they are; for work that costs more than a shuffle.

    A file of one row group is read by one task, however large it is and into however many partitions it is split. So the
    rows of each task are counted, which reads no column of columnar files.
    """
    counted = rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    total, largest = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // ROWS_PER_TASK))
    if largest <= FEW_ROWS or largest * tasks <= 2 * total:
        return rows
    return rows.repartition(tasks)
