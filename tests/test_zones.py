"""Districts: reader, containment, nearest, grid."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from checks.base import DISTRICT_RINGS, districts
from rastro import schema as S
from rastro.operators import zones as Z
from rastro.session import scratch_path
from rastro.sources.districts import read_districts_geojson


def _geojson(spark, features, wrap=True):
    """Write a GeoJSON document where Spark can read it."""
    path = scratch_path(spark, "geojson")
    text = json.dumps({"type": "FeatureCollection", "features": features} if wrap else features)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]


def _polygon(*rings):
    return {"type": "Polygon", "coordinates": list(rings)}


def test_reader_polygon_with_hole(spark):
    path = _geojson(spark, [{"id": "demo.1", "properties": {}, "geometry": _polygon(SQUARE, HOLE)}])
    row = read_districts_geojson(spark, path).first()
    assert (row["zona_id"], row["distrito_id"], row["nombre"], row["tipo"]) == (1, "demo.1", "Distrito 1", "DISTRITO")
    assert len(row["rings"]) == 2 and tuple(row["rings"][1][2]) == (3.0, 3.0)


def test_reader_keys(spark):
    shape = _polygon(SQUARE)
    features = [
        {"properties": {"id": 5, "NOMBRE": "", "name": "b", "DISTRITO": "c", "TIPO": "t"}, "geometry": shape},
        {"properties": {"distrito_id": "x", "NOMBRE": "n", "name": "b", "type": "u", "TIPO": "t"}, "geometry": shape},
        {"properties": {"OBJECTID": 9, "nombre": "m", "NOMBRE": "n", "tipo": "v"}, "geometry": shape},
        {"properties": {"DISTRITO": "c"}, "geometry": shape},
        {"id": 6, "properties": None, "geometry": shape},
    ]
    rows = read_districts_geojson(spark, _geojson(spark, features)).orderBy("zona_id").collect()
    found = [(r["zona_id"], r["distrito_id"], r["nombre"], r["tipo"]) for r in rows]
    assert found == [
        (1, "5", "b", "t"), (2, "x", "n", "u"), (3, "9", "m", "v"), (4, "4", "c", "DISTRITO"), (5, "6", "6", "DISTRITO"),
    ]


def test_reader_repeated_id_replaces_in_place(spark):
    features = [
        {"id": "a", "properties": {"nombre": "old"}, "geometry": _polygon(SQUARE)},
        {"id": "b", "properties": {"nombre": "b"}, "geometry": _polygon(SQUARE)},
        {"id": "a", "properties": {"nombre": "new"}, "geometry": _polygon(HOLE)},
    ]
    rows = read_districts_geojson(spark, _geojson(spark, features)).orderBy("zona_id").collect()
    assert [(r["zona_id"], r["distrito_id"], r["nombre"]) for r in rows] == [(1, "a", "new"), (2, "b", "b")]


def test_reader_multipolygon_keeps_first_outer_ring(spark):
    other = [[10, 10], [11, 10], [11, 11], [10, 10]]
    geometry = {"type": "MultiPolygon", "coordinates": [[SQUARE, HOLE], [other]]}
    path = _geojson(spark, [{"id": "m", "properties": {}, "geometry": geometry}])
    row = read_districts_geojson(spark, path).first()
    assert [[tuple(p) for p in ring] for ring in row["rings"]] == [[tuple(map(float, p)) for p in SQUARE]]


def test_reader_refuses_other_documents(spark):
    with pytest.raises(ValueError):
        read_districts_geojson(spark, _geojson(spark, {"type": "Topology"}, wrap=False))


# --- geometry ------------------------------------------------------------------------------


def _segments(rings):
    for ring in rings:
        closed = ring if ring[0] == ring[-1] else [*ring, ring[0]]
        yield from zip(closed, closed[1:])


def _distance(x, y, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = max(0.0, min(1.0, ((x - a[0]) * dx + (y - a[1]) * dy) / (dx * dx + dy * dy)))
    return math.hypot(x - (a[0] + t * dx), y - (a[1] + t * dy))


def _classify(x, y, shapes):
    """Brute force: first strictly containing district, else the nearest."""
    best = None
    for zid, _, rings in shapes:
        segments = list(_segments(rings))
        distance = min(_distance(x, y, a, b) for a, b in segments)
        crossings = sum(
            (a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0]
            for a, b in segments
        )
        inside = crossings % 2 == 1 and distance > 1e-9
        rank = (0, 0.0, zid) if inside else (1, round(distance, 9), zid)
        best = rank if best is None else min(best, rank)
    return best[2], best[0] == 0


def _points(shapes, n, seed=5):
    rng = random.Random(seed)
    corners = [p for _, _, rings in shapes for ring in rings for p in ring]
    xs, ys = [p[0] for p in corners], [p[1] for p in corners]
    w, h = max(xs) - min(xs), max(ys) - min(ys)
    points = [(rng.uniform(min(xs) - 2 * w, max(xs) + 2 * w), rng.uniform(min(ys) - 2 * h, max(ys) + 2 * h)) for _ in range(n)]
    points += [(rng.uniform(min(xs), max(xs)), rng.uniform(min(ys), max(ys))) for _ in range(n)]
    points += corners
    points += [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for _, _, rings in shapes for a, b in _segments(rings)]
    points += [(0.0, 90.0), (180.0, -90.0)]
    return points


def _random_shapes(seed, count=6):
    """Overlapping star-shaped polygons, some with a hole."""
    rng = random.Random(seed)
    shapes = []
    for zid in range(1, count + 1):
        cx, cy = rng.uniform(0, 3), rng.uniform(0, 3)
        n = rng.randint(4, 12)
        angles = [2 * math.pi * (k + rng.uniform(0, 0.5)) / n for k in range(n)]
        ring = [(cx + rng.uniform(0.3, 1) * math.cos(a), cy + rng.uniform(0.3, 1) * math.sin(a)) for a in angles]
        rings = [ring + ring[:1] if rng.random() < 0.5 else ring]
        if rng.random() < 0.4:
            rings.append([(cx - 0.05, cy - 0.05), (cx + 0.05, cy - 0.05), (cx, cy + 0.05), (cx - 0.05, cy - 0.05)])
        shapes.append((zid, f"z{zid}", rings))
    return shapes


def _frame(spark, shapes):
    rows = [(zid, str(zid), name, "DISTRITO", rings, {}) for zid, name, rings in shapes]
    return spark.createDataFrame(rows, S.DISTRICTS)


@pytest.mark.parametrize("shapes", [DISTRICT_RINGS, _random_shapes(1), _random_shapes(2), _random_shapes(3, 1)])
def test_classify_agrees_with_brute_force(spark, shapes, monkeypatch):
    points = _points(shapes, 250)
    df = spark.createDataFrame(
        [(i, y, x) for i, (x, y) in enumerate(points)], "id int, latitude double, longitude double"
    )
    known = _frame(spark, shapes)
    expected = {i: _classify(x, y, shapes) for i, (x, y) in enumerate(points)}

    def found(frame):
        return {r["id"]: r["zona_id"] for r in frame.select("id", "zona_id").collect()}

    zones = {i: zone for i, (zone, _) in expected.items()}
    assert found(Z.classify_point(df, known, grid=False)) == zones
    assert found(Z.classify_point(df, known)) == zones
    inside = {i: zone if within else None for i, (zone, within) in expected.items()}
    assert found(Z.point_in_district(df, known)) == inside
    # geometry cut into several constants gives the same
    monkeypatch.setattr(Z, "EDGES_PER_CONSTANT", 5)
    assert found(Z.classify_point(df, known)) == zones


def test_points_without_coordinates_get_no_district(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None)], "latitude double, longitude double")
    assert [r["zona_id"] for r in Z.classify_point(df, districts(spark)).collect()] == [None, None]


def test_assign_falls_back_to_zone_centres(spark):
    df = spark.createDataFrame([(-17.8, -63.22), (-17.87, -63.15)], "latitude double, longitude double")
    zones = Z.district_centers(districts(spark)).filter(F.col("nombre") != "Sur")
    placed = [r["zona_id"] for r in Z.assign_district_zone(df, districts(spark), zones).collect()]
    # the second point lies in 'Sur', which the zone table lacks: nearest remaining centre
    assert placed == [1, 4]
    built_in = [r["zona_id"] for r in Z.assign_district_zone(df).collect()]
    assert built_in == [12, 6]


def test_zone_within_radius_defaults_to_one(spark):
    df = spark.createDataFrame([(-17.51, -63.17), (10.0, 10.0), (None, 1.0)], "latitude double, longitude double")
    assert [r["zona_id"] for r in Z.zone_within_radius(df).collect()] == [19, 1, 1]


def test_lookup_and_bounds(spark):
    known = districts(spark)
    assert Z.district_by_name(known, "dISTRITO 1").first()["zona_id"] == 1
    assert Z.district_by_id(known, "demo.3").first()["nombre"] == "Sur"
    assert [r["zona_id"] for r in Z.all_districts(known).collect()] == [1, 2, 3, 4]
    box = Z.district_bounds(known).first()
    assert (box["min_lon"], box["max_lat"], box["zoom"]) == (-63.25, -17.7, 12)
    wide = _frame(spark, _random_shapes(1))
    assert Z.district_bounds(wide).first()["zoom"] == 11


def test_reference_points_get_a_district(spark):
    points = [(-17.7833, -63.1822), (-17.7650, -63.1950), (-17.8200, -63.1400)]
    df = spark.createDataFrame(points, "latitude double, longitude double")
    assert all(r["zona_id"] for r in Z.classify_point(df, districts(spark)).collect())


def test_districts_without_a_polygon_are_named(spark):
    features = [
        {"id": "a", "properties": {"nombre": "good"}, "geometry": _polygon(SQUARE)},
        {"id": "b", "properties": {"nombre": "a point"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"id": "c", "properties": {"nombre": "nothing"}, "geometry": None},
    ]
    found = read_districts_geojson(spark, _geojson(spark, features))
    with pytest.raises(ValueError, match="a point, nothing"):
        Z.assign_district_zone(spark.createDataFrame([(0.0, 0.0)], "latitude double, longitude double"), found)


def test_no_districts_and_no_area(spark):
    points = spark.createDataFrame([(2.0, 2.0), (None, 1.0)], "latitude double, longitude double")
    none = districts(spark).limit(0)
    assert [r["zona_id"] for r in Z.classify_point(points, none).collect()] == [None, None]
    dot = [[2, 2], [2, 2], [2, 2], [2, 2]]
    flat = read_districts_geojson(spark, _geojson(spark, [{"id": "p", "properties": {}, "geometry": _polygon(dot)}]))
    assert Z.classify_point(points, flat).count() == 2
    assert [r["zona_id"] for r in Z.point_in_district(points, flat).collect()] == [None, None]


def test_grid_candidates_give_the_exact_district(spark):
    """Inside, near and far points: the grid's districts against all districts."""
    rng = random.Random(11)
    data = [(rng.uniform(-18.2, -17.4), rng.uniform(-63.6, -62.8)) for _ in range(3000)] + [(None, -63.0), (50.0, 9.0)]
    points = spark.createDataFrame(data, "latitude double, longitude double")
    known = districts(spark)
    shapes = Z.Shapes.of(known)
    found = Z.nearest_district(Z.point_in_district(points, known, name="inside"), known, name="near")
    exact = found.withColumns(
        {"i": F.expr(shapes.containing("longitude", "latitude")), "n": F.expr(shapes.nearest("longitude", "latitude"))}
    )
    assert exact.filter("NOT (inside <=> i) OR NOT (near <=> n)").isEmpty()


def _boxes(seed, n):
    """Boxes of all sizes, some of them repeated, some without width."""
    rng = random.Random(seed)
    found = []
    for _ in range(n):
        x, y = rng.choice([rng.uniform(0, 10), float(rng.randint(0, 10))]), rng.uniform(0, 5)
        w, h = rng.choice([0.0, 0.01, 1.0, 6.0]), rng.choice([0.01, 2.0, 4.0])
        found.append((x, y, x + w, y + h))
    return found + found[:5]


@pytest.mark.parametrize("broadcast_bytes", [Z.BROADCAST_BYTES, 0])
def test_boxes_agree_with_brute_force(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(Z, "BROADCAST_BYTES", broadcast_bytes)
    boxes = _boxes(4, 40)
    rings = [(i, f"b{i}", [[(a, b), (c, b), (c, d), (a, d), (a, b)]]) for i, (a, b, c, d) in enumerate(boxes, 1)]
    rng = random.Random(9)
    points = [(rng.uniform(-1, 18), rng.uniform(-1, 10)) for _ in range(1500)]
    points += [(box[i], box[j]) for box in boxes for i in (0, 2) for j in (1, 3)]
    points += [(boxes[3][0], boxes[3][1])] * 800 + [(None, 1.0), (1.0, None), (float("nan"), 2.0), (float("inf"), 2.0)]
    df = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(points)], "id int, latitude double, longitude double")
    found = {r["id"]: r["zona_id"] for r in Z.district_bbox_match(df, _frame(spark, rings)).select("id", "zona_id").collect()}

    def first(x, y):
        if x is None or y is None:
            return None
        return next((i for i, (a, b, c, d) in enumerate(boxes, 1) if a <= x <= c and b <= y <= d), None)

    assert found == {i: first(x, y) for i, (x, y) in enumerate(points)}


def test_no_boxes(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "latitude double, longitude double")
    assert Z.district_bbox_match(df, districts(spark).limit(0)).first()["zona_id"] is None


@pytest.mark.parametrize("few", [0, 10_000])
def test_nearest_centre_agrees_with_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(Z, "FEW_ZONES", few)
    rng = random.Random(6)
    # many on a lattice, so that points between them have ties
    centers = [(i, float(rng.randint(0, 12)), float(rng.randint(0, 12))) for i in range(200, 320)]
    centers += [(i, rng.uniform(0, 12), rng.uniform(0, 12)) for i in range(1, 60)]
    zones = spark.createDataFrame(
        [(i, f"z{i}", y, x, 1.0) for i, y, x in centers],
        "zona_id int, nombre string, latitud_centro double, longitud_centro double, radio_km double",
    )
    points = [(rng.uniform(-30, 40), rng.uniform(-30, 40)) for _ in range(400)]
    points += [(rng.randint(0, 24) / 2, rng.randint(0, 24) / 2) for _ in range(600)] + [(1e6, -1e6)]
    df = spark.createDataFrame([(i, y, x) for i, (y, x) in enumerate(points)], "id int, latitude double, longitude double")
    found = {r["id"]: r["zona_id"] for r in Z.zone_nearest_center(df, zones=zones).collect()}
    wanted = {
        i: min((math.sqrt((y - b) ** 2 + (x - a) ** 2), zid) for zid, b, a in centers)[1] for i, (y, x) in enumerate(points)
    }
    assert found == wanted


def test_zones_and_edges_are_counted_before_they_are_collected(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, 1.0)], "latitude double, longitude double")
    monkeypatch.setattr(Z, "MAX_ZONES", 3)
    with pytest.raises(ValueError, match="more than 3 zones"):
        Z.zone_nearest_center(df, zones=Z.district_centers(districts(spark)))
    monkeypatch.setattr(Z, "MAX_EDGES", 5)
    monkeypatch.setattr(Z.F, "to_json", None)
    with pytest.raises(ValueError, match="district edges"):
        Z.classify_point(df, districts(spark))
