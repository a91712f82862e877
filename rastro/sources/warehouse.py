"""The warehouse: tables of parquet segments, all switched together by versions (``versions.py``).

The fact table is split by tiempo_id (the day), so date filters prune folders. Beside the nine tables lie

* ``id_ranges``: the source ids that the fact table holds, as runs of consecutive ids within buckets. What a batch
  has to be compared with is this table alone, whichever ids it brings;
* ``rollup_diario`` and ``rollup_dispositivos``: sums of the facts, and the devices behind them (``plans/rollup.py``);
* ``load_errors``: readings that were left out or stored without a measure, with the reason.

Every function that writes is a change of its own, or part of the ``change`` that it is given.
"""

import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from rastro import schema as S
from rastro.plans.rollup import KEYS, SUMS, daily_rollup, device_rollup
from rastro.plans.star import Star
from rastro.session import observed
from rastro.sources.versions import Version, changing, read_version

FACT = "fact_mediciones"
FACT_PARTITION = "tiempo_id"
ID_RANGES, LOAD_ERRORS = "id_ranges", "load_errors"
ROLLUPS = {"rollup_diario": S.ROLLUP_DIARIO, "rollup_dispositivos": S.ROLLUP_DISPOSITIVOS}
#: Tables of some dozen rows, written as one file without a shuffle.
SMALL_TABLES = ("dim_hora", "dim_operador", "dim_red", "dim_calidad", "dim_zonas")
#: Dimensions that grow with the facts.
LARGE_DIMENSIONS = ("dim_ubicacion", "dim_dispositivo")
#: Ids whose upper bits are equal share a bucket of this many bits.
BUCKET_BITS = 15

SCHEMAS = {**S.TABLES, **ROLLUPS, ID_RANGES: S.ID_RANGES, LOAD_ERRORS: S.LOAD_ERRORS}


def create_warehouse(spark, root):
    """Make the first version, without rows, if there is none."""
    if read_version(spark, root).number == 0:
        with changing(spark, root, "create"):
            pass


def _read(spark, root, name, version):
    schema = SCHEMAS[name]
    paths = version.paths(root, name)
    if not paths:
        return spark.createDataFrame([], schema)
    base = f"{str(root).rstrip('/')}/{name}"
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def read_warehouse_table(spark, root, name, version=None):
    """A table as of the newest version, or of the one with that number."""
    return _read(spark, root, name, read_version(spark, root, version))


def read_star(spark, root, version=None):
    """All nine tables and the rollups as of one version."""
    known = read_version(spark, root, version)
    return Star(**{name: _read(spark, root, name, known) for name in (*S.TABLES, *ROLLUPS)})


def execute_query(spark, root, sql, params=None):
    """Run SQL in which {name} stands for a warehouse table, e.g. {fact_mediciones}.

    ``params`` are values for the named markers in it, such as :zone.
    """
    return spark.sql(sql, args=params, **read_star(spark, root).tables())


def execute_scalar(spark, root, sql, params=None):
    """First value of the first row of a query, None without rows."""
    row = execute_query(spark, root, sql, params).first()
    return row[0] if row else None


# --- what is new -----------------------------------------------------------------------


def new_members(new, existing, key):
    """Rows of ``new`` whose natural key the table does not hold yet."""
    return new.join(existing.select(*key), list(key), "left_anti")


def existing_dates(dim_tiempo, dates):
    """Rows of the date dimension for the given dates (a frame with ``fecha``)."""
    return dim_tiempo.join(dates, "fecha", "left_semi")


def with_source_id(facts):
    """Facts that have a source id; without one, two readings could not be told apart."""
    return facts.filter(F.col("source_id").isNotNull())


def one_per_source_id(facts):
    """One row per source id: the smallest of its copies, so that a rerun keeps the same."""
    rest = [name for name in facts.columns if name != "source_id"]
    smallest = facts.groupBy("source_id").agg(F.min(F.struct(*rest)).alias("kept"))
    return smallest.select("source_id", "kept.*").select(*facts.columns)


def id_bucket(column):
    return F.shiftright(column, BUCKET_BITS)


def id_runs(ids):
    """(bucket, low, high): distinct ``source_id`` values as runs of consecutive ids, none across buckets."""
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("source_id"))
    within = F.col("source_id").bitwiseAND((1 << BUCKET_BITS) - 1)
    runs = ids.select("bucket", "source_id", (within - place).alias("run"))
    ends = runs.groupBy("bucket", "run").agg(F.min("source_id").alias("low"), F.max("source_id").alias("high"))
    return ends.select("bucket", "low", "high")


def classified_ids(facts, ranges=None):
    """One row per source id: its bucket, how often it occurs (``n``), and whether ``ranges`` holds it (``stored``).

    Ids and runs of a bucket are put in one order. An id is held if a run that begins at or before it reaches it, so each
    is looked at once, however many runs its bucket has; a bucket has at most 2^15 ids and as many runs.
    """
    counted = facts.groupBy("source_id").agg(F.count(F.lit(1)).alias("n")).withColumn("bucket", id_bucket("source_id"))
    if ranges is None:
        return counted.select("source_id", "bucket", "n", F.lit(False).alias("stored"))
    places = counted.select("source_id", "bucket", "n", F.lit(None).cast("bigint").alias("high"))
    runs = ranges.select(F.col("low").alias("source_id"), "bucket", F.lit(None).cast("bigint").alias("n"), "high")
    # a run comes before the id that it begins with
    order = Window.partitionBy("bucket").orderBy("source_id", F.col("high").desc_nulls_last())
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    reached = places.unionByName(runs).withColumn("reach", reach).where(F.col("n").isNotNull())
    stored = F.coalesce(F.col("reach") >= F.col("source_id"), F.lit(False))
    return reached.select("source_id", "bucket", "n", stored.alias("stored"))


def upserted(old, new, key):
    """All new rows, and the old ones whose key is not among them."""
    return new.unionByName(new_members(old, new, key))


def renamed_zones(zones, names):
    """Zones with ``nombre`` taken from ``names`` (zona_id, nombre) where it is given."""
    given = names.select("zona_id", F.col("nombre").alias("_nombre"))
    return zones.join(given, "zona_id", "left").select(
        *[
            F.coalesce("_nombre", "nombre").alias("nombre") if name == "nombre" else F.col(name)
            for name in zones.columns
        ]
    )


@contextmanager
def staged_path(spark, root, label):
    """A fresh path below the warehouse, removed if the work on it succeeds.

    Loads that run at the same time do not share it; after a failure it stays for inspection.
    """
    path = f"{str(root).rstrip('/')}/_staged_{label}_{uuid.uuid4().hex}"
    yield path
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


# --- writes ------------------------------------------------------------------------------


def together(spark, *writes):
    """Run writes of one change at the same time, so small ones do not wait for each other; their results in order.

    An error of one is raised when all have ended. Scheduler pool and job group of the caller hold for all.
    """
    inheriting = inheritable_thread_target(spark)
    if not callable(inheriting):
        # threads of Python are not those of the JVM here, there is nothing to hand on
        def inheriting(write):
            return write

    with ThreadPoolExecutor(len(writes)) as pool:
        running = [pool.submit(inheriting(write)) for write in writes]
    return [write.result() for write in running]


def _part_of(spark, root, kind, change):
    """The given change, whose owner commits it, or a new one."""
    return nullcontext(change) if change is not None else changing(spark, root, kind)


def _written(change, name, rows):
    """Write rows as a new segment of a table and return how many; Spark sizes the files, also those of very large days."""
    by_day = [FACT_PARTITION] if name == FACT else []
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name]])
    written = Observation()
    if name in SMALL_TABLES:
        typed = typed.coalesce(1)
    else:
        typed = typed.hint("rebalance", *[F.col(key) for key in by_day])
    # above the shuffle: tasks that write are counted once, also if a task before them runs again
    typed = typed.observe(written, F.count(F.lit(1)).alias("rows"))
    segment, path = change.new_segment(name)
    typed.write.partitionBy(*by_day).parquet(path)
    count = observed(written, "rows")
    if count:
        change.add(name, segment)
    return count


def read_changed(change, name):
    """A table as the change will leave it."""
    return _read(change.spark, change.root, name, change.version())


def insert_rows(change, name, rows):
    """Add rows to a table that has no key; returns how many."""
    return _written(change, name, rows)


def rebuild_table(change, name, rows):
    """Replace a table by rows, one per key, which may come from it; returns how many."""
    change.clear(name)
    return _written(change, name, rows)


def insert_ignore_dimension(spark, root, name, rows, change=None):
    """Append the members whose natural key is new; returns how many."""
    with _part_of(spark, root, f"insert {name}", change) as change:
        existing = read_changed(change, name)
        return _written(change, name, new_members(rows, existing, S.NATURAL_KEYS[name]))


def tables_that_lack(change, tables):
    """Names of those small tables that lack a natural key of the rows given for them; one job for all."""
    empty = {name for name in tables if not change.tables.get(name)}
    filled = tables.keys() - empty
    if not filled:
        return empty

    def keys(name, rows):
        key = F.struct(*S.NATURAL_KEYS[name])
        return rows.select(F.lit(name).alias("name"), F.to_json(key).alias("key"))

    wanted = _stacked(keys(name, tables[name]) for name in filled)
    present = _stacked(keys(name, read_changed(change, name)) for name in filled)
    missing = wanted.join(present, ["name", "key"], "left_anti").select("name").distinct()
    return empty | {row["name"] for row in missing.collect()}


def store_facts(spark, root, facts, change, anew=False):
    """Add facts whose source id is new, one per id; with ``anew`` they replace those stored.

    Returns counts of rows: ``inserted``, ``already_present`` (their id is stored) and ``repeated_in_batch`` (further
    copies of an id that is not). Ids are counted in one aggregation, and the table of ids decides what is new; no fact is
    read. Whole rows are shuffled only if their id is repeated.
    """
    facts = with_source_id(facts)
    if anew:
        for name in (FACT, ID_RANGES):
            change.clear(name)
    ranges = read_changed(change, ID_RANGES) if change.tables.get(ID_RANGES) else None
    with staged_path(spark, root, "ids") as staged:
        classified_ids(facts, ranges).write.parquet(staged)
        ids = spark.read.schema("source_id bigint, bucket bigint, n bigint, stored boolean").parquet(staged)
        stored, new = F.col("stored"), ~F.col("stored")
        low, high, n_new, n_stored, n_repeated = ids.agg(
            F.min(F.when(new, F.col("source_id"))),
            F.max(F.when(new, F.col("source_id"))),
            F.count_if(new),
            F.coalesce(F.sum(F.when(stored, F.col("n"))), F.lit(0)),
            F.coalesce(F.sum(F.when(new, F.col("n") - 1)), F.lit(0)),
        ).first()
        counts = {"inserted": 0, "already_present": n_stored, "repeated_in_batch": n_repeated}
        if not n_new:
            return counts
        if n_stored:
            facts = facts.join(ids.where(stored).select("source_id"), "source_id", "left_anti").select(*facts.columns)
        if n_repeated:
            several = ids.where(new & (F.col("n") > 1)).select("source_id")
            once = facts.join(several, "source_id", "left_anti").select(*facts.columns)
            copies = facts.join(several, "source_id", "left_semi").select(*facts.columns)
            facts = once.unionByName(one_per_source_id(copies))
        counts["inserted"], _ = together(
            spark,
            lambda: _written(change, FACT, facts),
            lambda: _written(change, ID_RANGES, id_runs(ids.where(new))),
        )
    known = [x for x in (change.entry["low_id"], change.entry["high_id"], low, high) if x is not None]
    change.entry["low_id"], change.entry["high_id"] = min(known), max(known)
    return counts


def store_rollups(change, anew=False):
    """Add the rollups of the facts that the change has inserted; its dimensions are written before."""
    if anew:
        for name in ROLLUPS:
            change.clear(name)
    old = set() if anew else set(change.base.tables.get(FACT, []))
    added = [segment for segment in change.tables.get(FACT, []) if segment not in old]
    if added:
        inserted = _read(change.spark, change.root, FACT, Version(tables={FACT: added}))
        together(
            change.spark,
            lambda: _written(change, "rollup_diario", daily_rollup(inserted, read_changed(change, "dim_ubicacion"))),
            lambda: _written(change, "rollup_dispositivos", device_rollup(inserted)),
        )


def append_facts(spark, root, facts, change=None):
    """Append facts whose source id is new; returns how many. Facts without one are left out.

    The facts are written once and read back, so their ids and rows come from one run of whatever computes them.
    """
    with _part_of(spark, root, "append facts", change) as change, staged_path(spark, root, "facts") as staged:
        facts.write.parquet(staged)
        inserted = store_facts(spark, root, spark.read.schema(facts.schema).parquet(staged), change)["inserted"]
        store_rollups(change)
        return inserted


def last_stored_id(spark, root):
    """The largest source id in the fact table, 0 if it is empty; reads the table of ids."""
    ranges = read_warehouse_table(spark, root, ID_RANGES)
    return ranges.agg(F.coalesce(F.max("high"), F.lit(0))).first()[0]


def upsert_zones(spark, root, zones, change=None):
    """Insert zones; a zone that exists is overwritten. The old rows stay visible until the commit."""
    with _part_of(spark, root, "upsert zones", change) as change:
        old = read_changed(change, "dim_zonas")
        typed = zones.select(*[F.col(f.name).cast(f.dataType) for f in S.DIM_ZONAS])
        if not typed.subtract(old).isEmpty():
            rebuild_table(change, "dim_zonas", upserted(old, zones, ["zona_id"]))


def update_zone_names(spark, root, names, change=None):
    """Rename the zones given in ``names`` (zona_id, nombre)."""
    with _part_of(spark, root, "rename zones", change) as change:
        old = read_changed(change, "dim_zonas")
        rebuild_table(change, "dim_zonas", renamed_zones(old, names))


def compact_table(spark, root, name):
    """Write the segments of a table as one; returns how many rows it has."""
    with changing(spark, root, f"compact {name}") as change:
        rows = _read(spark, root, name, change.base)
        if name == "rollup_diario":
            rows = rows.groupBy(*KEYS).agg(*[F.sum(column).alias(column) for column in SUMS])
        if name == "rollup_dispositivos":
            rows = rows.distinct()
        return rebuild_table(change, name, rows)


# --- checks --------------------------------------------------------------------------------


def _stacked(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def warehouse_counts(star):
    """(table_name, row_count) of every table."""
    return _stacked(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in star.tables().items()
    )


def integrity_report(star):
    """(constraint_name, violations): key values that repeat, facts whose key is missing.

    Facts are counted per key first, so a key with many facts joins as a single row.
    """
    tables = star.tables()

    def violations(label, df, count):
        return df.agg(F.coalesce(count, F.lit(0)).cast("bigint").alias("violations")).select(
            F.lit(label).alias("constraint_name"), "violations"
        )

    checks = []
    for name, df in tables.items():
        primary = df.columns[0]
        for key in dict.fromkeys([(primary,), S.NATURAL_KEYS[name]]):
            present = df.dropna(subset=list(key))
            repeated = present.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            checks.append(violations(f"unique {name}({', '.join(key)})", repeated, F.count("*")))
    small = {key: dim for key, dim in S.FOREIGN_KEYS.items() if dim not in LARGE_DIMENSIONS}
    for key, dim in S.FOREIGN_KEYS.items():
        if key not in small:
            used = star.fact_mediciones.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            orphans = used.filter(F.col(key).isNotNull()).join(tables[dim], key, "left_anti")
            checks.append(violations(f"fact_mediciones({key}) in {dim}", orphans, F.sum("n")))
    return _stacked([*checks, _small_key_violations(star, small)])


def _small_key_violations(star, keys):
    """Facts whose small keys are missing: one pass over the facts for all of them."""
    tables = star.tables()

    def label(key, dim):
        return F.lit(f"fact_mediciones({key}) in {dim}").alias("constraint_name")

    pairs = F.array(
        *[F.struct(label(k, dim), F.col(k).cast("bigint").alias("member")) for k, dim in keys.items()]
    )
    used = (
        star.fact_mediciones.select(F.explode(pairs).alias("pair"))
        .groupBy("pair.constraint_name", "pair.member")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = _stacked(
        tables[dim].select(label(key, dim), F.col(key).cast("bigint").alias("member"))
        for key, dim in keys.items()
    )
    orphans = used.filter("member IS NOT NULL").join(known, ["constraint_name", "member"], "left_anti")
    found = orphans.groupBy("constraint_name").agg(F.sum("n").alias("violations"))
    # a line for each constraint, also without violations
    names = known.select("constraint_name").distinct()
    return names.join(found, "constraint_name", "left").select(
        "constraint_name", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")
    )
