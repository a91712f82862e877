"""Column helpers on edge cases."""

import hashlib
import math
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rastro.functions import calendar as C
from rastro.functions import keys as K
from rastro.functions import measures as M
from rastro.functions import text as X


def values(spark, inputs, schema, build):
    """The helper's result for each input row, in order."""
    rows = [(i, *(row if isinstance(row, tuple) else (row,))) for i, row in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"n int, {schema}")
    columns = [F.col(name) for name in df.columns[1:]]
    return [r["v"] for r in df.select("n", build(*columns).alias("v")).orderBy("n").collect()]


def test_normalize_operator(spark):
    raw = [None, "", " Entel S.A Bolivia ", "TIGO", " viva\t", "NULL", "ACME", "+18VACUNATE"]
    expected = ["Desconocido", "Desconocido", "ENTEL", "Tigo", "Viva", "Desconocido", "Desconocido", "ENTEL"]
    assert values(spark, raw, "s string", X.normalize_operator) == expected


def test_normalize_network_takes_the_first_mark(spark):
    raw = [None, "", "5g nr", "lte/5G", "LTE", "4g", "hspa+", "wcdma", "edge", "gsm", "wifi"]
    expected = ["Desconocida", "Desconocida", "5G", "5G", "4G LTE", "4G LTE", "3G", "3G", "2G", "2G", "Desconocida"]
    assert values(spark, raw, "s string", X.normalize_network) == expected


def test_sanitize_string(spark):
    raw = [None, "  ", " a  b\t\nc ", "a\x01b", "\x02", "\x01 a"]
    assert values(spark, raw, "s string", X.sanitize_string) == [None, None, "a b c", "ab", None, " a"]


def test_truncate_string(spark):
    raw = [None, "  abcdef ", "abc"]
    assert values(spark, raw, "s string", lambda c: X.truncate_string(c, 4)) == [None, "abcd", "abc"]
    assert values(spark, raw, "s string", lambda c: X.was_truncated(c, 4)) == [False, True, False]


def test_device_identifier(spark):
    rows = [
        (" d1 ", "Phone", 1),
        ("d1", None, 1),
        ("d1", "", 1),
        (" NULL ", " Phone ", 1),
        ("none", None, 7),
        (None, "  ", 7),
        ("", None, 8),
    ]
    found = values(spark, rows, "d string, n2 string, i long", X.device_identifier)

    def number(i):
        return f"UNKNOWN_{int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 100000}"

    assert [tuple(v) for v in found] == [
        ("d1", "Phone"),
        ("d1", "Device_d1"),
        ("d1", "Device_d1"),
        ("NAME_Phone", "Phone"),
        (number(7), "Dispositivo Desconocido"),
        (number(7), "Dispositivo Desconocido"),
        (number(8), "Dispositivo Desconocido"),
    ]


def test_device_hash_and_key(spark):
    rows = [("Dev-1", "Unknown"), ("é", "M 2 ")]
    found = values(spark, rows, "d string, m string", X.device_hash)
    expected = [hashlib.md5(f"{d}_{m}".lower().strip().encode()).hexdigest()[:16] for d, m in rows]
    assert found == expected
    numbers = values(spark, ["0000000000000001", "ffffffffffffffff", "8000000000000000"], "h string", K.device_key)
    assert numbers == [1, -1, -(2**63)]


def test_format_district_id(spark):
    assert values(spark, ["a.b.7", "7", "x."], "s string", X.format_district_id) == ["Distrito 7", "7", "Distrito "]


def test_labels(spark):
    assert values(spark, [0, 7, 23], "h int", X.hour_label) == ["00:00", "07:00", "23:00"]
    assert values(spark, [(2, "Monday")], "d int, s string", X.weekday_dimension) == ["2-Monday"]


def test_speed_kmh(spark):
    raw = [None, -1.0, 0.0, 10.0, 55.5, 55.6, 1000.0, float("nan")]
    assert values(spark, raw, "s double", M.speed_kmh) == [0.0, 0.0, 0.0, 36.0, 199.8, 200.0, 200.0, 0.0]
    assert values(spark, ["x", "10"], "s string", M.speed_kmh) == [0.0, 36.0]


def test_classify_signal(spark):
    raw = [None, -50, -70, -71, -85, -86, -100, -101, -110, -111]
    expected = ["Sin Senal", "Excelente", "Excelente", "Buena", "Buena", "Regular", "Regular", "Debil", "Debil", "Sin Senal"]
    assert values(spark, raw, "s int", M.classify_signal) == expected


def test_signal_band(spark):
    raw = [None, -60, -70, -89, -90]
    assert values(spark, raw, "s int", M.signal_band) == ["poor", "good", "medium", "medium", "poor"]


def test_clamp_coordinates(spark):
    rows = [(None, None), (95.0, 200.0), (-95.0, -181.0), (1.5, 2.5), (float("nan"), 0.0)]
    found = [tuple(v) for v in values(spark, rows, "a double, b double", M.clamp_coordinates)]
    assert found == [(-17.7833, -63.1822), (90.0, 180.0), (-90.0, -180.0), (1.5, 2.5), (-17.7833, 0.0)]
    found = [tuple(v) for v in values(spark, [("x", "7")], "a string, b string", M.clamp_coordinates)]
    assert found == [(-17.7833, 7.0)]


def test_validate_numeric(spark):
    build = lambda c: M.validate_numeric(c, -500, 10000, 0)
    assert values(spark, ["5", None, "x", "-501", "10000"], "s string", build) == [5.0, 0.0, 0.0, 0.0, 10000.0]


def test_cell_key_cuts_toward_zero(spark):
    rows = [(-17.78339, -63.18229), (0.00019, -0.00019), (None, 200.0)]
    found = values(spark, rows, "a double, b double", M.cell_key)
    assert found == ["-177833_-631822", "1_-1", "-177833_1800000"]


def test_classify_anomaly_first_rule_wins(spark):
    rows = [(121.0, 5, -120), (120.0, 5, -120), (1.0, 10, -101), (1.0, None, -100), (None, None, None)]
    found = values(spark, rows, "v double, b int, s int", M.classify_anomaly)
    assert found == ["Velocidad Alta", "Bateria Critica", "Senal Debil", "Normal", "Normal"]


def test_haversine_properties(spark):
    rng = random.Random(7)
    rows = [tuple(rng.uniform(-limit, limit) for limit in (90, 180, 90, 180)) for _ in range(300)]
    rows += [(10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0)]
    schema = "a double, b double, c double, d double"
    there = values(spark, rows, schema, M.haversine_km)
    back = values(spark, [(c, d, a, b) for a, b, c, d in rows], schema, M.haversine_km)
    half_round = math.pi * 6371.0
    assert all(0 <= km <= half_round + 1e-9 for km in there)
    assert there == pytest.approx(back)
    assert there[-3] == 0 and there[-2] == pytest.approx(half_round) == there[-1]


def test_calendar(spark):
    hours = values(spark, [None, -1, 0, 5, 6, 11, 12, 17, 18, 23, 24], "h int", C.day_period)
    night, none = "Madrugada", "Desconocido"
    assert hours == [none, none, night, night, "Mañana", "Mañana", "Tarde", "Tarde", "Noche", "Noche", none]
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 12, 29),)], "d date")
    rows = [tuple(r) for r in df.select(*C.calendar_attributes(F.col("d"))).collect()]
    assert rows == [
        (2024, 1, 1, 0, "Lunes", "Enero", 1, False),
        (2024, 12, 29, 6, "Domingo", "Diciembre", 4, True),
    ]


def test_hours_between_drops_fractions(spark):
    rows = [(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 1, 0, 0, 100000))]
    assert values(spark, rows, "a timestamp_ntz, b timestamp_ntz", C.hours_between) == [1.0]


def test_event_time_parses_text(spark):
    rows = [
        ("2024-01-01T10:00:00", "2024-02-02 00:00:00"),
        (None, "2024-02-02T01:02:03.5+00:00"),
        ("bad", "2024-02-02"),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "timestamp string, created_at string")
    found = [str(r[0]) for r in df.select(C.event_time(df).cast("string")).collect()]
    assert found == ["2024-01-01 10:00:00", "2024-02-02 01:02:03.5", "None", "None"]


def test_location_key_is_reversible(spark):
    rng = random.Random(3)
    rows = [(round(rng.uniform(-90, 90), 7), round(rng.uniform(-180, 180), 7)) for _ in range(500)]
    rows += [(90.0, 180.0), (-90.0, -180.0), (-90.0, 180.0), (90.0, -180.0), (0.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    keyed = df.select("a", "b", K.location_key(F.col("a"), F.col("b")).alias("k"))
    lat, lon = K.location_from_key(F.col("k"))
    found = keyed.select("a", "b", "k", lat.cast("double"), lon.cast("double")).collect()
    assert all((r[0], r[1]) == (r[3], r[4]) for r in found)
    assert len({r["k"] for r in found}) == len(set(rows))
