"""Readers and writers, shown by what they read back."""

from pyspark.sql import functions as F

from checks.aggregates import METRICS_SQL, NETWORK_SQL, PATTERNS_SQL
from checks.base import cleaned, districts, locations, query, rounded, star, warehouse_root
from checks.movement import ANOMALIES_SQL
from rastro import schema as S
from rastro.operators.aggregates import device_metrics, network_distribution
from rastro.operators.anomalies import all_anomalies
from rastro.operators.movement import add_distance_from_previous
from rastro.operators.temporal import add_temporal_features, temporal_patterns
from rastro.plans.daily import daily_pipeline, daily_results
from rastro.plans.load import load_batch, load_static_dimensions, load_warehouse
from rastro.plans.star import build_fact, dim_date, dim_zone, prepare_measurements
from rastro.session import scratch_path, spread
from rastro.sources import locations as L
from rastro.sources import sinks
from rastro.sources import warehouse as W
from rastro.sources.versions import read_ledger
from rastro.streaming.load import stream_load_warehouse

_COLUMNS = ", ".join(S.REQUIRED_COLUMNS)
_ALL = f"SELECT {_COLUMNS} FROM locations"


def _required(spark, sf_dir):
    return locations(spark, sf_dir).select(*S.REQUIRED_COLUMNS)


def _read_csv(spark, schema, path):
    return spark.read.schema(schema).csv(path, header=True, nullValue="\u0000")


@query("read_locations_csv", _ALL)
def read_locations_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    sinks.write_csv(_required(spark, sf_dir), path)
    return L.read_locations_csv(spark, path)


@query("validate_schema", f"SELECT count(*) AS records, {len(S.REQUIRED_COLUMNS)} AS required FROM locations")
def validate_schema(spark, sf_dir):
    df = L.validate_schema(locations(spark, sf_dir))
    known = set(S.REQUIRED_COLUMNS) & set(df.columns)
    return df.agg(F.count(F.lit(1)).alias("records"), F.lit(len(known)).alias("required"))


@query("read_locations_table", _ALL)
def read_locations_table(spark, sf_dir):
    path = scratch_path(spark, "table")
    locations(spark, sf_dir).write.parquet(path)
    return L.read_locations_table(spark, path, "parquet").select(*S.REQUIRED_COLUMNS)


@query("locations_schema", _ALL)
def locations_schema(spark, sf_dir):
    path = scratch_path(spark, "json")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    _required(spark, sf_dir).write.option("timestampNTZFormat", micros).json(path)
    return spark.read.schema(L.locations_schema()).json(path)


@query(
    "coerce_types",
    """SELECT id, CASE WHEN id % 4 = 0 THEN NULL ELSE latitude END AS latitude, longitude, altitude, speed,
 CASE WHEN id % 6 = 0 THEN NULL ELSE battery END AS battery, signal,
 CASE WHEN id % 5 = 0 THEN NULL ELSE timestamp END AS timestamp FROM locations""",
)
def coerce_types(spark, sf_dir):
    """Readings turned to text, some of it unreadable, and back."""
    texts = locations(spark, sf_dir).select(
        "id",
        F.when(F.col("id") % 4 == 0, "north").otherwise(F.col("latitude").cast("string")).alias("latitude"),
        *[F.col(c).cast("string").alias(c) for c in ("longitude", "altitude", "speed", "signal")],
        F.when(F.col("id") % 6 == 0, "full").otherwise(F.col("battery").cast("string")).alias("battery"),
        F.when(F.col("id") % 5 == 0, "today")
        .otherwise(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("timestamp"),
    )
    return L.coerce_types(texts)


_HALF = "TIMESTAMP '2024-01-16 00:00:00'"
_EARLY = f"(SELECT max(source_id) FROM prepared WHERE ts < {_HALF})"


def _early_fact(spark, sf_dir):
    early = locations(spark, sf_dir).filter(F.coalesce("timestamp", "created_at") < "2024-01-16")
    return build_fact(prepare_measurements(early, districts(spark)))


@query("read_incremental", f"{_ALL} WHERE id > {_EARLY}")
def read_incremental(spark, sf_dir):
    """Readings after the last one of a fact table that holds the first half of the month."""
    return L.read_incremental(_required(spark, sf_dir), _early_fact(spark, sf_dir))


@query(
    "table_profile",
    """SELECT 'locations' AS table_name, string_agg(column_name, ',' ORDER BY column_index) AS columns,
 count(*) AS column_count, (SELECT count(*) FROM locations) AS total_records, TRUE AS sample_is_a_row
 FROM (SELECT unnest(columns) AS column_name, unnest(range(13)) AS column_index FROM
 (SELECT ['id','device_name','latitude','longitude','altitude','speed','battery','signal','sim_operator','network_type',
 'timestamp','created_at','device_id'] AS columns))""",
)
def table_profile(spark, sf_dir):
    """The columns in order; the sample is one of the rows, whichever."""
    rows = locations(spark, sf_dir)
    profile = L.table_profile(rows)
    sample = F.from_json("sample_record", "id bigint")["id"]
    known = profile.withColumn("id", sample).join(rows.select("id"), "id", "left_semi")
    return known.select(
        "table_name",
        F.array_join("columns", ",").alias("columns"),
        F.col("column_count").cast("bigint").alias("column_count"),
        "total_records",
        F.lit(True).alias("sample_is_a_row"),
    )


_FACT_COLUMNS = ", ".join(
    name for name in S.FACT_MEDICIONES.names if name != "fecha_carga"
)


def _fact_shown(fact):
    return rounded(fact.drop("fecha_carga"), senal_dbm=2, velocidad=2)


@query("read_warehouse_table", f"SELECT {_FACT_COLUMNS} FROM fact")
def read_warehouse_table(spark, sf_dir):
    """All columns but the time of loading."""
    return _fact_shown(
        W.read_warehouse_table(spark, warehouse_root(spark, sf_dir), "fact_mediciones")
    )


@query(
    "execute_query",
    "SELECT zona_id, count(*) AS n, (SELECT count(*) FROM fact) AS total FROM fact GROUP BY zona_id",
)
def execute_query(spark, sf_dir):
    root = warehouse_root(spark, sf_dir)
    total = W.execute_scalar(spark, root, "SELECT count(*) FROM {fact_mediciones}")
    sql = "SELECT zona_id, count(*) AS n FROM {fact_mediciones} GROUP BY zona_id"
    return W.execute_query(spark, root, sql).withColumn("total", F.lit(total).cast("bigint"))


@query("write_csv", _ALL)
def write_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    shown = _required(spark, sf_dir)
    sinks.write_csv(shown, path, partition_cols=["network_type"])
    return _read_csv(spark, shown.schema, path).select(*shown.columns)


@query("write_device_stats", METRICS_SQL)
def write_device_stats(spark, sf_dir):
    path = scratch_path(spark, "stats")
    stats = device_metrics(cleaned(spark, sf_dir))
    sinks.write_device_stats(stats, path)
    read = _read_csv(spark, stats.schema, path)
    return rounded(read, avg_battery=6, avg_signal=6, avg_speed=6, activity_window_hours=6)


@query("write_network_analysis", NETWORK_SQL)
def write_network_analysis(spark, sf_dir):
    path = scratch_path(spark, "network")
    shown = network_distribution(cleaned(spark, sf_dir))
    sinks.write_network_analysis(shown, path)
    return rounded(_read_csv(spark, shown.schema, path), percentage=6)


@query(
    "write_temporal_patterns",
    """SELECT 'hourly' AS pattern_type, CAST(hour AS VARCHAR) AS dimension, count(*) AS record_count
 FROM features GROUP BY hour UNION ALL
 SELECT 'weekday', CAST(day_of_week AS VARCHAR) || '-' || weekday_name, count(*)
 FROM features GROUP BY day_of_week, weekday_name""",
)
def write_temporal_patterns(spark, sf_dir):
    path = scratch_path(spark, "patterns")
    shown = temporal_patterns(add_temporal_features(cleaned(spark, sf_dir)))
    sinks.write_temporal_patterns(shown, path)
    return _read_csv(spark, shown.schema, path)


@query("write_anomalies", ANOMALIES_SQL)
def write_anomalies(spark, sf_dir):
    path = scratch_path(spark, "anomalies")
    found = all_anomalies(add_distance_from_previous(cleaned(spark, sf_dir)))
    sinks.write_anomalies(found, path)
    # the folder names hold the type; the files have the other columns in order
    read = _read_csv(spark, found.schema, path).select(*found.columns)
    return rounded(read, distance_km=6, time_diff_hours=6)


@query(
    "daily_outputs",
    f"""SELECT 'device_stats' AS result, * FROM ({METRICS_SQL})
 UNION ALL BY NAME SELECT 'network_analysis' AS result, * FROM ({NETWORK_SQL})
 UNION ALL BY NAME SELECT 'temporal_patterns' AS result, * FROM ({PATTERNS_SQL})
 UNION ALL BY NAME SELECT 'anomalies' AS result, * FROM ({ANOMALIES_SQL})""",
)
def daily_outputs(spark, sf_dir):
    """The rows of the four outputs of the daily run, read back from its files."""
    out = scratch_path(spark, "daily-outputs")
    readings = locations(spark, sf_dir)
    daily_pipeline(spark, readings, out)
    rows = None
    for name, expected in daily_results(readings).items():
        read = _read_csv(spark, expected.schema, f"{out}/{name}").select(*expected.columns)
        part = read.withColumn("result", F.lit(name))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rounded(
        rows,
        avg_battery=6,
        avg_signal=6,
        avg_speed=6,
        activity_window_hours=6,
        percentage=6,
        distance_km=6,
        time_diff_hours=6,
    )


# --- warehouse writes ------------------------------------------------------------------


def _new_warehouse(spark, label):
    root = scratch_path(spark, label)
    W.create_warehouse(spark, root)
    return root


@query("append_facts", f"SELECT {_FACT_COLUMNS} FROM fact")
def append_facts(spark, sf_dir):
    """Half of the facts, then all of them twice: each is kept once."""
    root = _new_warehouse(spark, "append")
    known, readings = districts(spark), spread(locations(spark, sf_dir))
    early = readings.filter(F.coalesce("timestamp", "created_at") < "2024-01-16")
    whole = build_fact(prepare_measurements(readings, known))
    W.append_facts(spark, root, build_fact(prepare_measurements(early, known)))
    W.append_facts(spark, root, whole.unionAll(whole))
    return _fact_shown(W.read_warehouse_table(spark, root, "fact_mediciones"))


def _busy_zones(spark, sf_dir, top):
    """One zone per network type, centred on its readings."""
    grouped = cleaned(spark, sf_dir).filter(F.col("network_type").isNotNull()).groupBy("network_type")
    means = grouped.agg(F.min("latitude").alias("lat"), F.min("longitude").alias("lon"))
    number = F.length("network_type").cast("int") * 10 + F.ascii("network_type") % 10
    return means.select(
        number.cast("int").alias("zona_id"),
        F.concat(F.lit(top), F.col("network_type")).alias("nombre"),
        F.col("lat").cast("decimal(10,7)").alias("latitud_centro"),
        F.col("lon").cast("decimal(10,7)").alias("longitud_centro"),
        F.lit(1).cast("decimal(5,2)").alias("radio_km"),
    )


_NET_ZONES = """SELECT CAST(length(network_type) * 10 + ascii(network_type) % 10 AS INT) AS zona_id,
 network_type AS nombre, min(latitude) AS latitud_centro, min(longitude) AS longitud_centro, 1::DOUBLE AS radio_km
 FROM cleaned WHERE network_type IS NOT NULL GROUP BY network_type"""


def _zones_shown(zones):
    return rounded(zones, latitud_centro=7, longitud_centro=7, radio_km=2)


@query(
    "upsert_zones",
    f"""SELECT * FROM ({_NET_ZONES}) UNION ALL
 SELECT zid, nombre, zlat, zlon, radius FROM built_in_zones WHERE zid NOT IN (SELECT zona_id FROM ({_NET_ZONES}))""",
)
def upsert_zones(spark, sf_dir):
    root = _new_warehouse(spark, "zones")
    W.upsert_zones(spark, root, dim_zone(spark))
    W.upsert_zones(spark, root, _busy_zones(spark, sf_dir, "old "))
    W.upsert_zones(spark, root, _busy_zones(spark, sf_dir, ""))
    return _zones_shown(W.read_warehouse_table(spark, root, "dim_zonas"))


@query(
    "update_zone_names",
    f"""SELECT zid AS zona_id, coalesce(z.nombre, b.nombre) AS nombre, zlat AS latitud_centro, zlon AS longitud_centro,
 radius AS radio_km FROM built_in_zones AS b LEFT JOIN (SELECT n AS zid, 'Distrito ' || n || ' (' || c || ')' AS nombre
 FROM (SELECT zona_id AS n, count(*) AS c FROM prepared GROUP BY zona_id)) AS z USING (zid)""",
)
def update_zone_names(spark, sf_dir):
    """Name each zone after its number of measurements."""
    root = _new_warehouse(spark, "names")
    W.upsert_zones(spark, root, dim_zone(spark))
    measured = prepare_measurements(locations(spark, sf_dir), districts(spark))
    names = measured.groupBy("zona_id").agg(F.count(F.lit(1)).alias("n"))
    label = F.format_string("Distrito %d (%d)", F.col("zona_id"), F.col("n"))
    W.update_zone_names(spark, root, names.select("zona_id", label.alias("nombre")))
    return _zones_shown(W.read_warehouse_table(spark, root, "dim_zonas"))


@query("insert_ignore_dimension", "SELECT * FROM dim_tiempo")
def insert_ignore_dimension(spark, sf_dir):
    """The dates of the early readings, then all dates twice."""
    root = _new_warehouse(spark, "dates")
    early = locations(spark, sf_dir).filter(F.coalesce("timestamp", "created_at") < "2024-01-16")
    all_dates = dim_date(prepare_measurements(locations(spark, sf_dir)))
    for rows in (dim_date(prepare_measurements(early)), all_dates, all_dates):
        W.insert_ignore_dimension(spark, root, "dim_tiempo", rows)
    return W.read_warehouse_table(spark, root, "dim_tiempo")


@query(
    "new_members",
    f"SELECT * FROM dim_tiempo WHERE fecha >= CAST({_HALF} AS DATE)",
)
def new_members(spark, sf_dir):
    dates = star(spark, sf_dir).dim_tiempo
    return W.new_members(dates, dates.filter(F.col("fecha") < "2024-01-16"), ["fecha"])


@query(
    "existing_dates",
    "SELECT * FROM dim_tiempo WHERE fecha IN (SELECT CAST(timestamp AS DATE) FROM locations WHERE battery < 1)",
)
def existing_dates(spark, sf_dir):
    low = locations(spark, sf_dir).filter(F.col("battery") < 1)
    dates = low.select(F.to_date("timestamp").alias("fecha"))
    return W.existing_dates(star(spark, sf_dir).dim_tiempo, dates)


@query("full_reload", f"SELECT {_FACT_COLUMNS} FROM fact")
def full_reload(spark, sf_dir):
    """Load the early readings, then start over with all of them."""
    root = scratch_path(spark, "reload")
    everything = locations(spark, sf_dir)
    early = everything.filter(F.coalesce("timestamp", "created_at") < "2024-01-16")
    load_warehouse(spark, root, early, districts(spark))
    load_warehouse(spark, root, everything, districts(spark), full_reload=True)
    return _fact_shown(W.read_warehouse_table(spark, root, "fact_mediciones"))


@query(
    "load_warehouse",
    """SELECT 0::BIGINT AS late_ids, (SELECT count(*) FROM locations) AS records_read, 0::BIGINT AS invalid_ids,
 (SELECT count(*) FROM locations) - (SELECT count(*) FROM timed) AS invalid_timestamps,
 0::BIGINT AS invalid_measures, 0::BIGINT AS already_present, 0::BIGINT AS repeated_in_batch,
 (SELECT count(*) FROM timed) AS records_inserted, (SELECT count(*) FROM dim_tiempo) AS new_dates,
 (SELECT count(*) FROM dim_ubicacion) AS new_locations, (SELECT count(*) FROM dim_dispositivo) AS new_devices""",
)
def load(spark, sf_dir):
    root = scratch_path(spark, "load")
    report = load_warehouse(
        spark, root, locations(spark, sf_dir), districts(spark), full_reload=True
    )
    return report.drop("prepare_seconds", "write_seconds", "setup_seconds")


@query("load_in_slices", f"SELECT {_FACT_COLUMNS} FROM fact")
def load_in_slices(spark, sf_dir):
    """Overlapping batches and a repeat give the facts of a single load."""
    root = _new_warehouse(spark, "slices")
    known = districts(spark)
    load_static_dimensions(spark, root, known)
    everything = locations(spark, sf_dir)
    time = F.coalesce("timestamp", "created_at")
    for part in (
        everything.filter((time < "2024-01-12") | time.isNull()),
        everything.filter(time > "2024-01-10"),
        everything,
    ):
        load_batch(spark, root, part, known)
    return _fact_shown(W.read_warehouse_table(spark, root, "fact_mediciones"))


# --- exact ids, ledger, errors -------------------------------------------------------------

_BIG = 2**53 + 1


@query("coerce_types_large_ids", f"SELECT id + {_BIG} AS id, battery FROM locations")
def coerce_large_ids(spark, sf_dir):
    """Ids beyond a double's precision, as digits, with a zero fraction, with an exponent, and as decimals."""
    large = locations(spark, sf_dir).select(
        (F.col("id") + _BIG).alias("id"), F.concat(F.col("battery").cast("string"), F.lit(".00")).alias("battery")
    )
    digits = F.col("id").cast("string")
    kind = F.col("id") % 3
    text = F.when(kind == 0, digits).when(kind == 1, F.concat(digits, F.lit(".0"))).otherwise(F.concat(digits, F.lit("e0")))
    as_text = large.where(F.col("id") % 2 == 0).withColumn("id", text)
    as_decimal = large.where(F.col("id") % 2 == 1).withColumn("id", F.col("id").cast("decimal(38,3)"))
    return L.coerce_types(as_text).unionByName(L.coerce_types(as_decimal))


@query("load_large_ids", f"SELECT source_id + {_BIG} AS source_id, tiempo_id, bateria FROM fact")
def load_large_ids(spark, sf_dir):
    """Every other reading, then all of them, from CSV files; neighbours beyond a double's precision stay two."""
    root, path = scratch_path(spark, "large"), scratch_path(spark, "large-csv")
    time = F.coalesce("timestamp", "created_at")
    large = locations(spark, sf_dir).withColumns({"id": F.col("id") + _BIG, "timestamp": time})
    sinks.write_csv(spread(large.select(*S.REQUIRED_COLUMNS)), path)
    readings = L.read_locations_csv(spark, path)
    load_warehouse(spark, root, readings.where(F.col("id") % 2 == 0), districts(spark))
    load_warehouse(spark, root, readings, districts(spark), take_late=True)
    return W.read_warehouse_table(spark, root, "fact_mediciones").select("source_id", "tiempo_id", "bateria")


@query(
    "read_ledger",
    """SELECT 'later' AS batch, 'committed' AS state, count_if(later)::BIGINT AS records_inserted, 0::BIGINT AS already_present,
 0::BIGINT AS repeated_in_batch, 0::BIGINT AS invalid_timestamps, min(id) FILTER (later) AS low_id, max(id) FILTER (later) AS high_id FROM (SELECT *, ts >= CAST('2024-01-16' AS TIMESTAMP) AS later FROM timed)
 UNION ALL SELECT 'all', 'committed', count_if(NOT later)::BIGINT, (count_if(later) + count_if(later AND id < 100))::BIGINT,
 count_if(NOT later AND id < 100)::BIGINT,
 (SELECT (count(*) + count_if(id < 100))::BIGINT FROM locations WHERE coalesce(timestamp, created_at) IS NULL),
 min(id) FILTER (NOT later), max(id) FILTER (NOT later) FROM (SELECT *, ts >= CAST('2024-01-16' AS TIMESTAMP) AS later FROM timed)""",
)
def ledger(spark, sf_dir):
    """What two loads counted: the later readings, then all of them with the first hundred ids twice."""
    root = scratch_path(spark, "ledger")
    everything = locations(spark, sf_dir)
    later = everything.filter(F.coalesce("timestamp", "created_at") >= "2024-01-16")
    load_warehouse(spark, root, later, districts(spark), take_late=True, batch="later")
    repeated = everything.unionByName(everything.filter("id < 100"))
    load_warehouse(spark, root, repeated, districts(spark), take_late=True, batch="all")
    names = ("records_inserted", "already_present", "repeated_in_batch", "invalid_timestamps")
    counts = [F.col("counts")[name].alias(name) for name in names]
    return read_ledger(spark, root).select("batch", "state", *counts, "low_id", "high_id")


@query(
    "load_errors",
    "SELECT id AS source_id, 'no readable time' AS reason, device_id FROM locations WHERE coalesce(timestamp, created_at) IS NULL",
)
def load_errors(spark, sf_dir):
    """Readings that the load left out, read back from their JSON."""
    rows = W.read_warehouse_table(spark, warehouse_root(spark, sf_dir), W.LOAD_ERRORS)
    device = F.from_json("reading", "device_id string")["device_id"]
    return rows.select("source_id", "reason", device.alias("device_id"))


@query(
    "stored_id_runs",
    """SELECT source_id >> 15 AS bucket, min(source_id) AS low, max(source_id) AS high
 FROM (SELECT source_id, source_id - row_number() OVER (PARTITION BY source_id >> 15 ORDER BY source_id) AS run FROM fact)
 GROUP BY source_id >> 15, run""",
)
def stored_id_runs(spark, sf_dir):
    """The table of stored ids, which a load compares its ids with."""
    return W.read_warehouse_table(spark, warehouse_root(spark, sf_dir), W.ID_RANGES)


@query("stream_load_warehouse", f"SELECT {_FACT_COLUMNS} FROM fact")
def stream_load(spark, sf_dir):
    """Files that arrive in two portions with common rows; the second run resumes."""
    folder = scratch_path(spark, "stream")
    everything = locations(spark, sf_dir)
    time = F.coalesce("timestamp", "created_at")
    for part in (everything.filter(time < "2024-01-20"), everything.filter(time > "2024-01-10")):
        part.write.mode("append").parquet(f"{folder}/in")
        stream_load_warehouse(
            spark, f"{folder}/in", f"{folder}/dw", f"{folder}/cp", part.schema, districts(spark)
        )
    return _fact_shown(W.read_warehouse_table(spark, f"{folder}/dw", "fact_mediciones"))


@query(
    "daily_results",
    """SELECT 'device_stats' AS result, count(DISTINCT device_id) AS n FROM cleaned
 UNION ALL SELECT 'network_analysis', count(*) FROM (SELECT DISTINCT sim_operator, network_type FROM cleaned)
 UNION ALL SELECT 'temporal_patterns', (SELECT count(DISTINCT hour) + count(DISTINCT day_of_week) FROM features)
 UNION ALL SELECT 'anomalies', (SELECT count(*) FROM cleaned WHERE speed > 200) + (SELECT count(*) FROM cleaned WHERE battery < 10)
  + (SELECT count(*) FROM moves WHERE time_diff_hours > 0 AND distance_km > 500)""",
)
def daily_counts(spark, sf_dir):
    rows = None
    for name, df in daily_results(locations(spark, sf_dir)).items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("result"), "n")
        rows = part if rows is None else rows.unionByName(part)
    return rows
