"""District polygons from GeoJSON."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastro.functions.text import format_district_id

# Coordinates nest differently per geometry type, so they are read as text first.
_FILE = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField(
                            "properties", T.MapType(T.StringType(), T.StringType())
                        ),
                        T.StructField(
                            "geometry",
                            T.StructType(
                                [
                                    T.StructField("type", T.StringType()),
                                    T.StructField("coordinates", T.StringType()),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)
# Fixed property names, first match wins.
_ID_KEYS = ("id", "distrito_id", "OBJECTID")
_NAME_KEYS = ("nombre", "NOMBRE", "name", "DISTRITO")
_TYPE_KEYS = ("tipo", "type", "TIPO")
_DEFAULT_TYPE = "DISTRITO"


def _first_filled(*columns):
    return F.coalesce(*[F.nullif(column, F.lit("")) for column in columns])


def read_districts_geojson(spark, path):
    """Districts of a FeatureCollection, in file order.

    Columns: zona_id (position from 1), distrito_id, nombre, tipo, rings (outer ring first,
    then holes), properties. Of a MultiPolygon only the first polygon's outer ring is kept.
    A later feature with the id of an earlier one replaces it in its place.
    """
    document = spark.read.schema(_FILE).option("multiLine", True).json(str(path))
    if not document.filter(F.col("features").isNull()).isEmpty():
        raise ValueError(f"not a GeoJSON FeatureCollection: {path}")

    properties = F.coalesce(F.col("f.properties"), F.create_map().cast("map<string,string>"))
    coordinates = F.col("f.geometry.coordinates")
    polygon = F.from_json(coordinates, "array<array<array<double>>>")
    first_of_many = F.get(
        F.get(F.from_json(coordinates, "array<array<array<array<double>>>>"), F.lit(0)), F.lit(0)
    )
    raw_rings = F.when(
        F.col("f.geometry.type") == "MultiPolygon", F.array(first_of_many)
    ).otherwise(polygon)
    rings = F.transform(
        raw_rings,
        lambda ring: F.transform(
            ring,
            lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")),
        ),
    )

    def named(keys):
        return [F.col("properties")[key] for key in keys]

    features = (
        document.select(F.posexplode("features").alias("position", "f"))
        .select("position", F.col("f.id").alias("feature_id"), properties.alias("properties"), rings.alias("rings"))
        .withColumn(
            "distrito_id",
            _first_filled(
                F.col("feature_id"), *named(_ID_KEYS), (F.col("position") + 1).cast("string")
            ),
        )
        .withColumn(
            "nombre", _first_filled(*named(_NAME_KEYS), format_district_id(F.col("distrito_id")))
        )
        .withColumn("tipo", _first_filled(*named(_TYPE_KEYS), F.lit(_DEFAULT_TYPE)))
    )
    same_id = Window.partitionBy("distrito_id")
    kept = features.withColumns(
        {
            "place": F.min("position").over(same_id),
            "last": F.max("position").over(same_id),
        }
    ).filter(F.col("position") == F.col("last"))
    # the features of one file: a list small enough to number in one task
    return kept.select(
        F.row_number().over(Window.orderBy("place")).alias("zona_id"),
        "distrito_id",
        "nombre",
        "tipo",
        "rings",
        "properties",
    )
