"""Changes of the warehouse: whole or not at all, the ledger, recovery, the table of stored ids."""

import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.base import districts
from rastro import schema as S
from rastro import session
from rastro.plans import load as load_module
from rastro.plans import star as P
from rastro.plans.load import load_batch, load_warehouse
from rastro.session import scratch_path
from rastro.sources import versions as V
from rastro.sources import warehouse as W
from rastro.sources.locations import coerce_types, read_locations_csv
from rastro.streaming.load import stream_load_warehouse


def _reading(i, **changes):
    row = {
        "id": i, "device_name": "p", "latitude": -17.8, "longitude": -63.22, "altitude": 100.0, "speed": 5.0,
        "battery": 50, "signal": -60, "sim_operator": "tigo", "network_type": "4G",
        "timestamp": datetime(2024, 1, 1, 1) + timedelta(days=abs(i or 0) % 20), "device_id": f"d{(i or 0) % 3}",
    }
    return tuple({**row, **changes}.values())


@pytest.fixture
def frame(spark):
    def make(*ids, **changes):
        return spark.createDataFrame([_reading(i, **changes) for i in ids], S.LOCATIONS).coalesce(1)

    return make


def _ids(spark, root):
    return sorted(r["source_id"] for r in W.read_warehouse_table(spark, root, W.FACT).select("source_id").collect())


def _state(spark, root):
    """All tables as sorted rows."""
    return {name: sorted(map(tuple, df.collect()), key=repr) for name, df in W.read_star(spark, root).tables().items()}


class Broken(Exception):
    pass


@pytest.fixture
def broken_table(monkeypatch):
    """Writing that table raises after its rows were written."""

    def breaks(table):
        written = W._written

        def fail(change, name, rows):
            count = written(change, name, rows)
            if name == table:
                raise Broken(table)
            return count

        monkeypatch.setattr(W, "_written", fail)

    return breaks


# --- exact ids -----------------------------------------------------------------------------

BIG = 2**53


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("9007199254740993", BIG + 1), ("1234567890123456789", 1234567890123456789), ("9223372036854775807", 2**63 - 1),
        ("-9223372036854775808", -(2**63)), ("9223372036854775808", None), ("7.0", 7), ("7.", 7), ("-7.000", -7), ("1e3", 1000),
        ("9007199254740993.0", BIG + 1), ("1.5e1", 15), ("7.5", None), ("7.0000000000001", None), ("9007199254740993.5", None),
        (" 8 ", 8), ("+9", 9), ("", None), ("x", None), ("NaN", None), ("Infinity", None), ("1e40", None), (None, None),
    ],
)
def test_whole_numbers_from_text_are_exact(spark, text, number):
    df = spark.createDataFrame([(text,)], "id string")
    assert coerce_types(df).first()["id"] == number


def test_whole_numbers_of_other_types(spark):
    rows = [(Decimal("9007199254740993"), 3.0, 5), (Decimal("7.5"), 3.5, 6), (Decimal("12345678901234567890"), float("nan"), None)]
    df = spark.createDataFrame(rows, "id decimal(21,1), battery double, signal long")
    assert [tuple(r) for r in coerce_types(df).collect()] == [(BIG + 1, 3, 5), (None, None, 6), (None, None, None)]
    assert dict(coerce_types(df).dtypes) == {"id": "bigint", "battery": "int", "signal": "int"}


def test_a_load_keeps_two_neighbours_above_double_precision(spark, frame):
    path, root = scratch_path(spark, "big"), scratch_path(spark, "big-dw")
    frame(BIG, BIG + 1).write.csv(path, header=True)
    report = load_warehouse(spark, root, read_locations_csv(spark, path), districts(spark)).first()
    assert (report["records_inserted"], report["already_present"], report["repeated_in_batch"]) == (2, 0, 0)
    assert _ids(spark, root) == [BIG, BIG + 1] and W.last_stored_id(spark, root) == BIG + 1
    later = load_warehouse(spark, root, frame(BIG + 1, BIG + 2), districts(spark)).first()
    assert (later["late_ids"], later["records_inserted"]) == (1, 1)


# --- whole or not at all -------------------------------------------------------------------


@pytest.mark.parametrize("table", ["dim_hora", W.FACT])
def test_a_failing_reload_leaves_the_old_warehouse(spark, frame, broken_table, table):
    root = scratch_path(spark, "reload")
    load_warehouse(spark, root, frame(1, 2, 3), districts(spark))
    before = _state(spark, root)
    broken_table(table)
    with pytest.raises(Broken):
        load_warehouse(spark, root, frame(7, 8), districts(spark), full_reload=True)
    assert _state(spark, root) == before


@pytest.mark.parametrize("table", ["rollup_diario"])
def test_a_failing_load_leaves_nothing_and_can_run_again(spark, frame, broken_table, monkeypatch, table):
    root = scratch_path(spark, "again")
    load_warehouse(spark, root, frame(1, 2), districts(spark))
    before = _state(spark, root)
    with monkeypatch.context():
        broken_table(table)
        with pytest.raises(Broken):
            load_warehouse(spark, root, frame(3, 4), districts(spark))
    assert _state(spark, root) == before
    monkeypatch.undo()
    assert load_warehouse(spark, root, frame(3, 4), districts(spark)).first()["records_inserted"] == 2
    assert _ids(spark, root) == [1, 2, 3, 4]


def test_two_reloads_at_once_leave_one_of_the_two(spark, frame, monkeypatch):
    root = scratch_path(spark, "two")
    load_warehouse(spark, root, frame(1), districts(spark))
    store, inner = W.store_facts, []

    def store_while_another_reloads(*args):
        counts = store(*args)
        if not inner:
            inner.append(True)
            load_warehouse(spark, root, frame(20, 21, latitude=1.0), districts(spark), full_reload=True)
        return counts

    monkeypatch.setattr(W, "store_facts", store_while_another_reloads)
    load_warehouse(spark, root, frame(10, 11, 12), districts(spark), full_reload=True)
    assert _ids(spark, root) == [10, 11, 12]
    assert {r["violations"] for r in W.integrity_report(W.read_star(spark, root)).collect()} == {0}
    # the other one is whole too, one version earlier
    number = V.read_version(spark, root).number
    assert W.read_star(spark, root, number - 1).fact_mediciones.count() == 2


def test_a_load_that_another_change_overtakes_fails_whole(spark, frame, monkeypatch):
    root = scratch_path(spark, "overtaken")
    load_warehouse(spark, root, frame(1), districts(spark))
    store, inner = W.store_facts, []

    def store_while_another_loads(*args):
        if not inner:
            inner.append(True)
            load_warehouse(spark, root, frame(2), districts(spark))
        return store(*args)

    monkeypatch.setattr(W, "store_facts", store_while_another_loads)
    with pytest.raises(V.ConcurrentChange):
        load_warehouse(spark, root, frame(2, 3), districts(spark))
    assert _ids(spark, root) == [1, 2]
    assert load_warehouse(spark, root, frame(2, 3), districts(spark)).first()["records_inserted"] == 1
    assert _ids(spark, root) == [1, 2, 3]


def test_zones_stay_if_rewriting_them_fails(spark, broken_table, monkeypatch):
    root = scratch_path(spark, "zones")
    W.upsert_zones(spark, root, P.dim_zone(spark))
    before = sorted(map(tuple, W.read_warehouse_table(spark, root, "dim_zonas").collect()))
    broken_table("dim_zonas")
    names = spark.createDataFrame([(5, "Cinco")], "zona_id int, nombre string")
    for write in (lambda: W.upsert_zones(spark, root, P.dim_zone(spark, districts(spark))), lambda: W.update_zone_names(spark, root, names)):
        with pytest.raises(Broken):
            write()
        assert sorted(map(tuple, W.read_warehouse_table(spark, root, "dim_zonas").collect())) == before
    monkeypatch.undo()
    W.update_zone_names(spark, root, names)
    assert {r["zona_id"]: r["nombre"] for r in W.read_warehouse_table(spark, root, "dim_zonas").collect()}[5] == "Cinco"


def test_readers_keep_their_version(spark, frame):
    root = scratch_path(spark, "snapshot")
    load_warehouse(spark, root, frame(1, 2), districts(spark))
    star = W.read_star(spark, root)
    load_warehouse(spark, root, frame(9), districts(spark), full_reload=True)
    assert star.fact_mediciones.count() == 2 and W.read_star(spark, root).fact_mediciones.count() == 1


def test_a_version_is_created_once(spark):
    folder = V._Folder(spark, scratch_path(spark, "create"))
    assert folder.create("versions/1.json", "one") and not folder.create("versions/1.json", "two")
    assert folder.read("versions/1.json") == "one" and folder.names("versions") == ["1.json"]


# --- ledger and recovery ---------------------------------------------------------------------


def test_ledger_has_counts_ranges_and_failures(spark, frame, broken_table, monkeypatch):
    root = scratch_path(spark, "ledger")
    rows = [_reading(5), _reading(5), _reading(6), _reading(None), _reading(7, timestamp=None), _reading(8, battery=None)]
    load_warehouse(spark, root, spark.createDataFrame(rows, S.LOCATIONS), districts(spark), batch="first")
    load_warehouse(spark, root, frame(5, 9, 9, 9), districts(spark), take_late=True, batch="second")
    broken_table(W.FACT)
    with pytest.raises(Broken):
        load_warehouse(spark, root, frame(10), districts(spark), batch="third")
    monkeypatch.undo()
    ledger = {r["batch"]: r for r in V.read_ledger(spark, root).collect()}
    first, second, third = ledger["first"], ledger["second"], ledger["third"]
    assert (first["state"], second["state"], third["state"]) == ("committed", "committed", "failed")
    assert (first["low_id"], first["high_id"], second["low_id"], second["high_id"]) == (5, 8, 9, 9)
    counts = {name: n for name, n in first["counts"].items() if n}
    assert counts == {
        "records_read": 6, "invalid_ids": 1, "invalid_timestamps": 1, "repeated_in_batch": 1, "records_inserted": 3,
        "new_dates": 3, "new_locations": 1, "new_devices": 2,
    }
    assert (second["counts"]["already_present"], second["counts"]["repeated_in_batch"], second["counts"]["records_inserted"]) == (1, 2, 1)
    assert third["version"] is None and "Broken" in third["error"] and second["version"] == first["version"] + 1
    assert all(r["began"] <= r["ended"] for r in ledger.values())


def test_load_errors_name_reason_and_reading(spark):
    root = scratch_path(spark, "errors")
    rows = [_reading(None, device_name="lost"), _reading(2, timestamp=None), _reading(3, signal=2_000_000_000), _reading(4)]
    report = load_warehouse(spark, root, spark.createDataFrame(rows, S.LOCATIONS), districts(spark), batch="b").first()
    assert (report["invalid_ids"], report["invalid_timestamps"], report["invalid_measures"], report["records_inserted"]) == (1, 1, 1, 2)
    errors = {r["reason"]: r for r in W.read_warehouse_table(spark, root, W.LOAD_ERRORS).collect()}
    assert {reason: r["source_id"] for reason, r in errors.items()} == {
        load_module.NO_ID: None, load_module.NO_TIME: 2, load_module.MEASURE: 3,
    }
    assert json.loads(errors[load_module.NO_ID]["reading"])["device_name"] == "lost"
    assert {r["batch"] for r in errors.values()} == {"b"}


def test_failed_changes_are_cleaned_and_old_versions_expire(spark, frame, broken_table, monkeypatch):
    root = scratch_path(spark, "clean")
    load_warehouse(spark, root, frame(1, 2), districts(spark))
    folder = V._Folder(spark, root)
    good = set(V._segments(folder))
    broken_table(W.FACT)
    with pytest.raises(Broken):
        load_warehouse(spark, root, frame(3), districts(spark))
    monkeypatch.undo()
    # one that is in work, and one whose driver died long ago
    working, dead = V.Change(spark, root, "load"), V.Change(spark, root, "load")
    dead.entry["began"] = "2020-01-01T00:00:00+00:00"
    for change in (working, dead):
        folder.write(f"attempts/{change.id}.json", json.dumps({"entry": change.entry}))
        W._written(change, "dim_hora", P.dim_hour(spark))
    assert len(set(V._segments(folder)) - good) > 2
    cleaned = V.clean_failed(spark, root)
    assert dead.id in cleaned and working.id not in cleaned and len(cleaned) == 2
    rest = set(V._segments(folder)) - good
    assert [name for name, _ in rest] == ["dim_hora"] and working.id in next(iter(rest))[1]
    assert V.clean_failed(spark, root) == []
    states = {r["change"]: r["state"] for r in V.read_ledger(spark, root).collect()}
    assert states[dead.id] == "cleaned" and states[working.id] == "started"
    load_warehouse(spark, root, frame(4), districts(spark), full_reload=True)
    assert V.expire_versions(spark, root, keep=2) == 0
    assert V.expire_versions(spark, root, keep=1) > 0
    assert _ids(spark, root) == [4] and rest <= set(V._segments(folder))


def test_compacting_keeps_the_rows(spark, frame):
    root = scratch_path(spark, "compact")
    for i in (1, 2, 3):
        load_warehouse(spark, root, frame(i), districts(spark))
    before = _state(spark, root)
    assert len(V.read_version(spark, root).tables[W.FACT]) == 3
    assert W.compact_table(spark, root, W.FACT) == 3
    assert len(V.read_version(spark, root).tables[W.FACT]) == 1 and _state(spark, root) == before


def test_a_load_with_nothing_new_writes_no_segment(spark, frame):
    root = scratch_path(spark, "nothing")
    load_warehouse(spark, root, frame(1, 2), districts(spark))
    folder = V._Folder(spark, root)
    before = set(V._segments(folder))
    report = load_warehouse(spark, root, frame(1, 2), districts(spark)).first()
    assert (report["late_ids"], report["records_read"], report["records_inserted"]) == (2, 0, 0)
    assert set(V._segments(folder)) == before
    assert V.read_ledger(spark, root).where("state = 'committed'").count() == 2


# --- the table of stored ids -------------------------------------------------------------------


def _runs(ids):
    runs = []
    for i in sorted(set(ids)):
        if runs and runs[-1][2] == i - 1 and runs[-1][0] == i >> W.BUCKET_BITS:
            runs[-1][2] = i
        else:
            runs.append([i >> W.BUCKET_BITS, i, i])
    return sorted(map(tuple, runs))


def test_runs_of_ids(spark):
    ids = [-(2**63), -32769, -32768, -1, 0, 1, 2, 5, 7, 8, 32766, 32767, 32768, 32769, 2**53, 2**53 + 1, 2**63 - 1]
    frame = spark.createDataFrame([(i,) for i in ids], "source_id long").withColumn("bucket", W.id_bucket("source_id"))
    assert sorted(map(tuple, W.id_runs(frame).collect())) == _runs(ids)


def test_ids_are_classified_against_the_runs(spark):
    stored = [1, 2, 3, 10, 32767, 32768, 2**53 + 1]
    ranges = spark.createDataFrame(_runs(stored), S.ID_RANGES)
    batch = [3, 3, 4, 10, 32768, 2**53, 2**53 + 1, 5, 5, 5, -1]
    facts = spark.createDataFrame([(i,) for i in batch], "source_id long")
    found = {r["source_id"]: (r["n"], r["stored"]) for r in W.classified_ids(facts, ranges).collect()}
    assert found == {i: (batch.count(i), i in stored) for i in set(batch)}


def test_many_runs_of_a_bucket_are_passed_once(spark):
    """Every other id is stored, so the only bucket has 2^14 runs: ids are not compared with each of them."""
    every = 1 << W.BUCKET_BITS
    runs = spark.range(0, every, 2).selectExpr("0L AS bucket", "id AS low", "id AS high")
    facts = spark.range(0, every + 4).selectExpr("id AS source_id")
    ids = W.classified_ids(facts, runs)
    assert "Join" not in ids._jdf.queryExecution().executedPlan().toString()
    wrong = ids.where("stored <> (source_id % 2 = 0 AND bucket = 0) OR n <> 1 OR bucket <> shiftright(source_id, 15)")
    assert wrong.isEmpty() and ids.count() == every + 4


def test_any_order_of_loads_stores_each_id_once(spark, frame):
    root = scratch_path(spark, "orders")
    batches = [(100, 101, 102), (5, 101, 200), (6, 5, 5, 300), (103, 7, 99, 100)]
    for batch in batches:
        load_warehouse(spark, root, frame(*batch), districts(spark), take_late=True)
    wanted = sorted({i for batch in batches for i in batch})
    assert _ids(spark, root) == wanted
    ranges = W.read_warehouse_table(spark, root, W.ID_RANGES).collect()
    assert sorted(i for r in ranges for i in range(r["low"], r["high"] + 1)) == wanted


def test_new_facts_are_found_without_reading_facts(spark, frame, monkeypatch):
    """Ids are aggregated once, compared with the table of ids, and no scan of the fact table is planned."""
    root = scratch_path(spark, "plan")
    load_warehouse(spark, root, frame(*range(1, 50)), districts(spark))
    plans, seen = [], W.classified_ids

    def classified(facts, ranges):
        ids = seen(facts, ranges)
        plans.append(ids._jdf.queryExecution().executedPlan().toString())
        return ids

    monkeypatch.setattr(W, "classified_ids", classified)
    load_batch(spark, root, frame(7, 60, 61), districts(spark))
    (text,) = plans
    # a plan shows an exchange of the ids, and a broadcast of the runs
    assert W.FACT not in text and W.ID_RANGES in text
    assert text.count("Exchange hashpartitioning(source_id") == 1 and "CartesianProduct" not in text and "NestedLoop" not in text
    assert _ids(spark, root) == [*range(1, 50), 60, 61]


def test_appended_facts_are_computed_once(spark, frame):
    """Stored and repeated ids among them: rows are split several ways, but from one run of what makes them."""
    root, runs = scratch_path(spark, "once"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    facts = P.build_fact(P.prepare_measurements(frame(*range(1, 31), *range(20, 31)), districts(spark)))
    facts = facts.withColumn("fecha_carga", F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz"))
    assert W.append_facts(spark, root, facts.where("source_id < 10")) == 9
    assert W.append_facts(spark, root, facts.mapInArrow(counted, facts.schema)) == 21
    assert runs.value == 41 and _ids(spark, root) == [*range(1, 31)]


# --- readings that one task reads -------------------------------------------------------------


def test_readings_of_one_row_group_are_prepared_by_all_cores(spark, frame, monkeypatch):
    """A file of one row group comes from one task, into however many partitions it is split."""
    path, root = scratch_path(spark, "one-group"), scratch_path(spark, "one-group-dw")
    n = session.FEW_ROWS + 10
    many = frame(1).drop("id").crossJoin(spark.range(1, n + 1)).select(*S.LOCATIONS.names)
    many.coalesce(1).write.parquet(path)
    readings, staged = spark.read.parquet(path), []
    write = load_module._write

    def look(spark, root, prepared, change, anew):
        staged.append(prepared.groupBy(F.spark_partition_id()).count().toDF("task", "n").agg(F.max("n")).first()[0])
        staged.append(len(prepared.inputFiles()))
        return write(spark, root, prepared, change, anew)

    monkeypatch.setattr(load_module, "_write", look)
    report = load_warehouse(spark, root, readings, districts(spark)).first()
    assert (report["records_read"], report["records_inserted"]) == (n, n)
    largest, files = staged
    assert files >= spark.sparkContext.defaultParallelism and largest < n / 2


def test_few_or_even_readings_stay_where_they_are(spark):
    assert session.spread(spark.range(0, session.FEW_ROWS, 1, 1)).rdd.getNumPartitions() == 1
    assert session.spread(spark.range(0, 10 * session.FEW_ROWS, 1, 8)).rdd.getNumPartitions() == 8
    one = spark.range(0, 2 * session.FEW_ROWS, 1, 1)
    dealt = session.spread(one)
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and dealt.exceptAll(one).isEmpty()


# --- stream ----------------------------------------------------------------------------------


def test_a_stream_that_dies_between_dimensions_and_facts(spark, frame, broken_table, monkeypatch):
    folder = scratch_path(spark, "stream-dies")
    run = lambda: stream_load_warehouse(spark, f"{folder}/in", f"{folder}/dw", f"{folder}/cp", S.LOCATIONS, districts(spark))
    frame(1, 2, latitude=1.0).write.parquet(f"{folder}/in")
    broken_table(W.FACT)
    with pytest.raises(Exception, match="Broken"):
        run()
    star = W.read_star(spark, f"{folder}/dw")
    assert star.fact_mediciones.isEmpty() and star.dim_ubicacion.isEmpty()
    monkeypatch.undo()
    (report,) = run()
    assert (report["batch"], report["records_inserted"], report["new_locations"]) == (0, 2, 1)
    assert run() == [] and _ids(spark, f"{folder}/dw") == [1, 2]


def test_a_committed_batch_that_is_replayed_is_passed_over(spark, frame, monkeypatch):
    from rastro.streaming import load as stream_module

    folder = scratch_path(spark, "replay")
    run = lambda: stream_load_warehouse(spark, f"{folder}/in", f"{folder}/dw", f"{folder}/cp", S.LOCATIONS, districts(spark))
    frame(1, 2).write.parquet(f"{folder}/in")
    once = stream_module.load_stream_batch

    def dies_after_the_commit(*args):
        once(*args)
        raise Broken("after the commit")

    monkeypatch.setattr(stream_module, "load_stream_batch", dies_after_the_commit)
    with pytest.raises(Exception, match="after the commit"):
        run()
    monkeypatch.undo()
    number = V.read_version(spark, f"{folder}/dw").number
    assert run() == []
    ledger = V.read_ledger(spark, f"{folder}/dw").where("kind = 'stream'").collect()
    assert [r["version"] for r in ledger] == [number] and _ids(spark, f"{folder}/dw") == [1, 2]
    frame(3).write.mode("append").parquet(f"{folder}/in")
    (report,) = run()
    assert (report["batch"], report["records_inserted"]) == (1, 1) and _ids(spark, f"{folder}/dw") == [1, 2, 3]
