"""Zones and districts of every reading."""

from pyspark.sql import functions as F

from checks.base import cleaned, districts, locations, place_sql, prepared, query, rounded
from rastro.operators import zones as Z
from rastro.operators.cleaning import clean_coordinates
from rastro.session import scratch_path
from rastro.sources.districts import read_districts_geojson


def _valid(spark, sf_dir):
    return clean_coordinates(locations(spark, sf_dir)).select("id", "latitude", "longitude")


_VALID = (
    "SELECT id, latitude AS lat, longitude AS lon FROM locations"
    " WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"
)
_POINTS = f"SELECT DISTINCT lat, lon FROM ({_VALID})"


@query(
    "zone_within_radius",
    """SELECT id, coalesce(zid, 1) AS zona_id FROM locations LEFT JOIN (
  SELECT id, arg_min(zid, (d, zid)) AS zid FROM (
   SELECT id, zid, radius, sqrt((latitude - zlat) * (latitude - zlat) + (longitude - zlon) * (longitude - zlon)) AS d
   FROM locations CROSS JOIN built_in_zones) WHERE d <= radius * 0.01::DOUBLE GROUP BY id) USING (id)""",
)
def zone_within_radius(spark, sf_dir):
    return Z.zone_within_radius(locations(spark, sf_dir)).select("id", "zona_id")


@query(
    "zone_nearest_center",
    f"""SELECT id, arg_min(zid, (d, zid)) AS zona_id FROM (
 SELECT id, zid, sqrt((lat - zlat) * (lat - zlat) + (lon - zlon) * (lon - zlon)) AS d
 FROM ({_VALID}) CROSS JOIN built_in_zones) GROUP BY id""",
)
def zone_nearest_center(spark, sf_dir):
    return Z.zone_nearest_center(_valid(spark, sf_dir)).select("id", "zona_id")


@query(
    "point_in_district",
    f"SELECT id, CASE WHEN inside = 1 THEN zid END AS zona_id FROM ({_VALID})"
    f" JOIN ({place_sql(_POINTS)}) USING (lat, lon)",
)
def point_in_district(spark, sf_dir):
    return Z.point_in_district(_valid(spark, sf_dir), districts(spark)).select("id", "zona_id")


@query(
    "nearest_district",
    f"""SELECT id, zid AS zona_id FROM ({_VALID}) JOIN (
 SELECT lat, lon, arg_min(zid, (d, zid)) AS zid FROM (
  SELECT lat, lon, zid, round(min(sqrt((lon-(x1+t*(x2-x1)))*(lon-(x1+t*(x2-x1)))+(lat-(y1+t*(y2-y1)))*(lat-(y1+t*(y2-y1))))), 9) AS d FROM (
   SELECT lat, lon, zid, x1, y1, x2, y2,
    greatest(0::DOUBLE, least(1::DOUBLE, ((lon-x1)*(x2-x1)+(lat-y1)*(y2-y1))/((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)))) AS t
   FROM ({_POINTS}) CROSS JOIN edges) GROUP BY lat, lon, zid) GROUP BY lat, lon) USING (lat, lon)""",
)
def nearest_district(spark, sf_dir):
    return Z.nearest_district(_valid(spark, sf_dir), districts(spark)).select("id", "zona_id")


@query(
    "assign_district_zone",
    f"SELECT id, zid AS zona_id FROM ({_VALID}) JOIN ({place_sql(_POINTS)}) USING (lat, lon)",
)
def assign_district_zone(spark, sf_dir):
    zones = Z.district_centers(districts(spark))
    placed = Z.assign_district_zone(_valid(spark, sf_dir), districts(spark), zones)
    return placed.select("id", "zona_id")


@query(
    "district_bbox_match",
    f"SELECT id, min(zid) AS zona_id FROM ({_VALID}) LEFT JOIN boxes"
    " ON lon BETWEEN minx AND maxx AND lat BETWEEN miny AND maxy GROUP BY id",
)
def district_bbox_match(spark, sf_dir):
    return Z.district_bbox_match(_valid(spark, sf_dir), districts(spark)).select("id", "zona_id")


def _counted(spark, sf_dir):
    return prepared(spark, sf_dir).groupBy("zona_id").agg(F.count(F.lit(1)).alias("mediciones"))


@query(
    "district_lookup",
    """SELECT label, zid AS zona_id, nombre, (SELECT count(*) FROM prepared WHERE zona_id = zid) AS mediciones
 FROM (SELECT 'id' AS label, 2 AS zid, 'Norte' AS nombre UNION ALL SELECT 'name', 3, 'Sur'
 UNION ALL SELECT DISTINCT 'all', zid, nombre FROM edges)""",
)
def district_lookup(spark, sf_dir):
    known = districts(spark)
    found = {
        "id": Z.district_by_id(known, "demo.2"),
        "name": Z.district_by_name(known, "SUR"),
        "all": Z.all_districts(known),
    }
    rows = None
    for label, frame in found.items():
        part = frame.select(F.lit(label).alias("label"), "zona_id", "nombre")
        rows = part if rows is None else rows.unionByName(part)
    return rows.join(_counted(spark, sf_dir), "zona_id", "left").na.fill(0, ["mediciones"])


@query(
    "district_bounds",
    """SELECT *, (SELECT count(*) FROM cleaned WHERE latitude BETWEEN min_lat AND max_lat AND longitude BETWEEN min_lon AND max_lon) AS readings_inside FROM (
 SELECT min(minx) AS min_lon, min(miny) AS min_lat, max(maxx) AS max_lon, max(maxy) AS max_lat,
 round((min(miny) + max(maxy)) / 2, 9) AS center_lat, round((min(minx) + max(maxx)) / 2, 9) AS center_lon,
 CASE WHEN max(maxy) - min(miny) < 0.2 AND max(maxx) - min(minx) < 0.2 THEN 12 ELSE 11 END AS zoom FROM boxes)""",
)
def district_bounds(spark, sf_dir):
    box = Z.district_bounds(districts(spark))
    inside = F.col("latitude").between(F.col("min_lat"), F.col("max_lat")) & F.col(
        "longitude"
    ).between(F.col("min_lon"), F.col("max_lon"))
    limits = ("min_lat", "max_lat", "min_lon", "max_lon")
    bounded = cleaned(spark, sf_dir).withColumns(
        {name: box.select(name).scalar() for name in limits}
    )
    readings = bounded.filter(inside).agg(F.count(F.lit(1)).alias("n")).scalar()
    return rounded(box, center_lat=9, center_lon=9).withColumn("readings_inside", readings)


@query(
    "district_centers",
    """SELECT zid AS zona_id, nombre, round((miny + maxy) / 2, 9) AS latitud_centro,
 round((minx + maxx) / 2, 9) AS longitud_centro, 5::DOUBLE AS radio_km,
 (SELECT count(*) FROM prepared WHERE zona_id = zid) AS mediciones FROM boxes""",
)
def district_centers(spark, sf_dir):
    centers = rounded(Z.district_centers(districts(spark)), latitud_centro=9, longitud_centro=9)
    counted = centers.join(_counted(spark, sf_dir), "zona_id", "left")
    return counted.na.fill(0, ["mediciones"])


@query(
    "read_districts_geojson",
    """SELECT CAST(row_number() OVER (ORDER BY network_type) AS INT) AS zona_id, 'net.' || network_type AS distrito_id,
 network_type AS nombre, 'DISTRITO' AS tipo, n AS readings, 1 AS rings, 5 AS corners, minx, miny, maxx, maxy FROM (
 SELECT network_type, count(*) AS n, min(longitude) AS minx, min(latitude) AS miny, max(longitude) AS maxx, max(latitude) AS maxy
 FROM cleaned WHERE network_type IS NOT NULL GROUP BY network_type)""",
)
def geojson(spark, sf_dir):
    """Write the area of each network type as GeoJSON, then read it."""
    areas = (
        cleaned(spark, sf_dir)
        .filter(F.col("network_type").isNotNull())
        .groupBy("network_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("longitude").alias("minx"),
            F.min("latitude").alias("miny"),
            F.max("longitude").alias("maxx"),
            F.max("latitude").alias("maxy"),
        )
    )
    corners = [("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny")]
    ring = F.array(*[F.array(F.col(x), F.col(y)) for x, y in corners])
    feature = F.struct(
        F.concat(F.lit("net."), F.col("network_type")).alias("id"),
        F.struct(
            F.col("network_type").alias("nombre"), F.col("n").cast("string").alias("readings")
        ).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
    )
    path = scratch_path(spark, "districts")
    areas.agg(F.array_sort(F.collect_list(feature)).alias("features")).select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")
    ).write.text(path)
    read = read_districts_geojson(spark, path)
    shapes = Z.district_shapes(read).drop("nombre", "edges")
    described = read.select(
        "zona_id",
        "distrito_id",
        "nombre",
        "tipo",
        F.col("properties")["readings"].cast("bigint").alias("readings"),
        F.size("rings").alias("rings"),
        F.size(F.get("rings", F.lit(0))).alias("corners"),
    )
    return described.join(shapes, "zona_id")
