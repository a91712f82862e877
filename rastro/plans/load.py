"""Loading the warehouse, in full or by increments. A load is one change: it is seen whole or not at all."""

import time
from functools import partial, reduce

from pyspark.sql import Observation
from pyspark.sql import functions as F

from rastro.functions.calendar import event_time
from rastro.plans import star as P
from rastro.session import observed, spread
from rastro.sources import warehouse as W
from rastro.sources.locations import above_cursor
from rastro.sources.versions import changing

#: What a load counts, in the order of its report.
COUNTS = (
    "records_read",
    "invalid_ids",
    "invalid_timestamps",
    "invalid_measures",
    "already_present",
    "repeated_in_batch",
    "records_inserted",
    "new_dates",
    "new_locations",
    "new_devices",
)
REPORT = (
    "late_ids bigint, "
    + ", ".join(f"{name} bigint" for name in COUNTS)
    + ", prepare_seconds double, write_seconds double, setup_seconds double"
)
NO_ID, NO_TIME, MEASURE = "no id", "no readable time", "measure out of range"


def load_static_dimensions(spark, root, districts=None, anew=False, change=None):
    """Insert missing fixed members; zones are overwritten from the districts.

    With ``anew`` the five tables are replaced.
    """
    if change is None:
        with changing(spark, root, "fixed dimensions") as change:
            load_static_dimensions(spark, root, districts, anew, change)
        return
    fixed = {
        "dim_hora": P.dim_hour(spark),
        "dim_operador": P.dim_operator(spark),
        "dim_red": P.dim_network(spark),
        "dim_calidad": P.dim_quality(spark),
    }
    zones = P.dim_zone(spark, districts)
    if anew:
        writes = [partial(W.rebuild_table, change, name, rows) for name, rows in {**fixed, "dim_zonas": zones}.items()]
    else:
        lacking = W.tables_that_lack(change, fixed)
        writes = [partial(W.insert_ignore_dimension, spark, root, name, fixed[name], change) for name in lacking]
        writes.append(partial(W.upsert_zones, spark, root, zones, change))
    W.together(spark, *writes)


def load_batch(spark, root, readings, districts=None, anew=False, change=None, batch=None):
    """Add readings to the warehouse, ignoring source ids it holds; returns the report.

    Readings without an id cannot be told apart and are left out; so are readings without a time. A
    measure that its column cannot hold is stored as null. All of them are kept in ``load_errors``, with the reason. Every
    count is measured: ``records_read`` is the sum of ``invalid_ids``, ``invalid_timestamps``, ``already_present``,
    ``repeated_in_batch`` and ``records_inserted``.

    The prepared batch is written once and read back, so dimensions and facts are made from
    the same rows even if the source grows meanwhile, and the geometry is computed once. Tables and the ledger entry
    become visible together. With ``anew`` the batch replaces what is there.
    """
    if change is None:
        with changing(spark, root, "reload" if anew else "load", batch) as change:
            return load_batch(spark, root, readings, districts, anew, change)
    begun = time.perf_counter()
    with W.staged_path(spark, root, "measurements") as staged:
        report = _stage(spark, root, readings, districts, staged, change, anew)
        prepared_at = time.perf_counter()
        report |= _write(spark, root, spark.read.parquet(staged), change, anew)
    change.entry["counts"] = {name: report[name] for name in COUNTS}
    return change.entry["counts"] | {
        "prepare_seconds": round(prepared_at - begun, 3),
        "write_seconds": round(time.perf_counter() - prepared_at, 3),
    }


def _stage(spark, root, readings, districts, staged, change, anew):
    """Write the prepared batch to ``staged``, and what is wrong with readings to the change; returns what was seen."""
    seen, kept = Observation(), Observation()
    no_id, no_time = F.col("id").isNull(), event_time(readings).isNull()
    # preparing a reading costs more than dealing it; counted behind that, so tasks that run again count once
    watched = spread(readings).observe(
        seen,
        F.count(F.lit(1)).alias("read"),
        F.count_if(no_id).alias("ids"),
        F.count_if(~no_id & no_time).alias("times"),
    ).filter(~no_id)
    zones = W.read_changed(change, "dim_zonas")
    prepared = P.prepare_measurements(watched, districts, zones)
    prepared.observe(kept, F.count_if(P.unstorable()).alias("measures")).write.parquet(staged)
    read, ids, times = (observed(seen, name) for name in ("read", "ids", "times"))
    measures = observed(kept, "measures")
    if anew:
        change.clear(W.LOAD_ERRORS)
    errors = []
    if ids or times:
        reason = F.when(no_id, NO_ID).otherwise(NO_TIME)
        errors.append(readings.where(no_id | no_time).select(
            F.col("id").alias("source_id"), reason.alias("reason"), F.to_json(F.struct(*readings.columns)).alias("reading")
        ))
    if measures:
        taken = spark.read.parquet(staged).where(P.unstorable())
        errors.append(taken.select(
            "source_id", F.lit(MEASURE).alias("reason"), F.to_json(F.struct(*taken.columns)).alias("reading")
        ))
    if errors:
        rows = reduce(lambda a, b: a.unionByName(b), errors)
        W.insert_rows(change, W.LOAD_ERRORS, rows.withColumn("batch", F.lit(change.entry["batch"])))
    return {"records_read": read, "invalid_ids": ids, "invalid_timestamps": times, "invalid_measures": measures}


def _write(spark, root, prepared, change, anew):
    """Write dimensions and facts; returns how many rows were new."""
    members = {
        "dim_tiempo": P.dim_date(prepared),
        "dim_ubicacion": P.dim_location(prepared),
        "dim_dispositivo": P.dim_device(prepared),
    }
    if anew:
        writes = [partial(W.rebuild_table, change, name, rows) for name, rows in members.items()]
    else:
        writes = [partial(W.insert_ignore_dimension, spark, root, name, rows, change) for name, rows in members.items()]
    *written, stored = W.together(spark, *writes, partial(W.store_facts, spark, root, P.build_fact(prepared), change, anew))
    W.store_rollups(change, anew)
    counts = dict(zip(members, written))
    return {
        "records_inserted": stored["inserted"],
        "already_present": stored["already_present"],
        "repeated_in_batch": stored["repeated_in_batch"],
        "new_dates": counts["dim_tiempo"],
        "new_locations": counts["dim_ubicacion"],
        "new_devices": counts["dim_dispositivo"],
    }


def load_warehouse(spark, root, locations, districts=None, full_reload=False, take_late=False, batch=None):
    """Load what is new (ids above the largest one loaded), or everything; one report row.

    ``late_ids`` are readings that an incremental load passes over, because their id is not above the
    largest one loaded. They are counted from the id column alone and are not part of ``records_read``. With
    ``take_late`` nothing is passed over: every reading whose id is not stored yet is loaded. ``batch`` names the load in the
    ledger.
    """
    begun, late = time.perf_counter(), 0
    with changing(spark, root, "reload" if full_reload else "load", batch) as change:
        if not full_reload and not take_late:
            cursor = W.last_stored_id(spark, root)
            late = locations.filter(F.col("id") <= cursor).count()
            locations = above_cursor(locations, cursor)
        load_static_dimensions(spark, root, districts, full_reload, change)
        setup = round(time.perf_counter() - begun, 3)
        if not full_reload and locations.isEmpty():
            change.entry["counts"] = dict.fromkeys(COUNTS, 0)
            report = change.entry["counts"] | {"prepare_seconds": 0.0, "write_seconds": 0.0}
        else:
            report = load_batch(spark, root, locations, districts, full_reload, change)
    values = (late, *report.values(), setup)
    return spark.createDataFrame([values], REPORT)
