"""Star schema: dimensions, fact, checks and views."""

from pyspark.sql import functions as F

from checks.base import districts, prepared, query, rounded, star
from rastro import schema as S
from rastro.plans import star as P
from rastro.plans import views as V
from rastro.sources import warehouse as W

_PREPARED = (
    "source_id, ts, fecha, hora, operador, red, calidad, senal, velocidad_kmh, bateria, latitud,"
    " longitud, altitud, zona_id, device_identifier, device_display_name, device_model, device_hash"
)


@query("prepare_measurements", f"SELECT {_PREPARED} FROM prepared")
def prepare(spark, sf_dir):
    return rounded(prepared(spark, sf_dir), latitud=7, longitud=7)


def _used(name, dim, key, natural):
    """Register a fixed dimension together with how many measurements use each member."""

    @query(
        name,
        f"SELECT {dim}.*, (SELECT count(*) FROM fact WHERE fact.{key} = {dim}.{key}) AS mediciones FROM {dim}",
    )
    def run(spark, sf_dir):
        members = natural(spark)
        fact = P.build_fact(prepared(spark, sf_dir))
        used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("mediciones"))
        joined = members.join(used, key, "left").select(*members.columns, "mediciones")
        return joined.na.fill(0, ["mediciones"])


_used("dim_hour", "dim_hora", "hora_id", P.dim_hour)
_used("dim_operator", "dim_operador", "operador_id", P.dim_operator)
_used("dim_network", "dim_red", "red_id", P.dim_network)
_used("dim_quality", "dim_calidad", "calidad_id", P.dim_quality)
_used(
    "dim_zone",
    "dim_zonas",
    "zona_id",
    lambda spark: rounded(
        P.dim_zone(spark, districts(spark)), latitud_centro=7, longitud_centro=7, radio_km=2
    ),
)


@query("dim_date", "SELECT * FROM dim_tiempo")
def dim_date(spark, sf_dir):
    return P.dim_date(prepared(spark, sf_dir))


@query("dim_location", "SELECT * FROM dim_ubicacion")
def dim_location(spark, sf_dir):
    return rounded(P.dim_location(prepared(spark, sf_dir)), latitud=7, longitud=7, altitud=2)


@query("dim_device", "SELECT * FROM dim_dispositivo")
def dim_device(spark, sf_dir):
    return P.dim_device(prepared(spark, sf_dir))


@query(
    "distinct_dimension_members",
    """SELECT DISTINCT 'date' AS kind, fecha FROM prepared
 UNION ALL BY NAME SELECT DISTINCT 'location' AS kind, latitud, longitud, altitud, zona_id FROM prepared
 UNION ALL BY NAME SELECT DISTINCT 'device' AS kind, device_hash, device_display_name, device_model FROM prepared""",
)
def distinct_members(spark, sf_dir):
    """The members of the three kinds, each with its own columns."""
    rows = prepared(spark, sf_dir)
    frames = {
        "date": P.distinct_dates(rows),
        "location": rounded(P.distinct_locations(rows), latitud=7, longitud=7),
        "device": P.distinct_devices(rows),
    }
    members = [df.withColumn("kind", F.lit(kind)) for kind, df in frames.items()]
    first, *rest = members
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


_FACT = "SELECT * FROM fact"


def _shown(fact):
    return rounded(fact.drop("fecha_carga"), senal_dbm=2, velocidad=2)


@query("build_fact", _FACT)
def build_fact(spark, sf_dir):
    return _shown(P.build_fact(prepared(spark, sf_dir)))


@query("fact_lookup", _FACT)
def fact_lookup(spark, sf_dir):
    tables = star(spark, sf_dir)
    return _shown(P.fact_lookup(prepared(spark, sf_dir), tables))


@query(
    "warehouse_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM "
        + ("fact" if name == "fact_mediciones" else name)
        for name in S.TABLES
    ),
)
def warehouse_counts(spark, sf_dir):
    return W.warehouse_counts(star(spark, sf_dir))


def _constraints():
    names = []
    for name, schema in S.TABLES.items():
        for key in dict.fromkeys([(schema.names[0],), S.NATURAL_KEYS[name]]):
            names.append((f"unique {name}({', '.join(key)})", name, key))
    return names


_TABLE = {name: "fact" if name == "fact_mediciones" else name for name in S.TABLES}
_INTEGRITY = " UNION ALL ".join(
    [
        f"SELECT '{label}' AS constraint_name, count(*) AS violations FROM"
        f" (SELECT 1 FROM {_TABLE[name]} GROUP BY {', '.join(key)} HAVING count(*) > 1)"
        for label, name, key in _constraints()
    ]
    + [
        f"SELECT 'fact_mediciones({key}) in {dim}', count(*) FROM fact WHERE {key} NOT IN (SELECT {key} FROM {dim})"
        for key, dim in S.FOREIGN_KEYS.items()
    ]
)


@query("integrity_report", _INTEGRITY)
def integrity_report(spark, sf_dir):
    return W.integrity_report(star(spark, sf_dir))


# --- views -------------------------------------------------------------------------------


@query(
    "operator_zone_summary",
    """SELECT o.nombre AS operador, z.nombre AS zona, count(*) AS mediciones, round(avg(senal_dbm), 4) AS senal_promedio,
 round(avg(velocidad), 4) AS velocidad_promedio, round(avg(bateria), 4) AS bateria_promedio
 FROM fact JOIN dim_operador AS o USING (operador_id) JOIN dim_zonas AS z USING (zona_id) GROUP BY o.nombre, z.nombre""",
)
def operator_zone_summary(spark, sf_dir):
    view = V.operator_zone_summary(star(spark, sf_dir))
    return rounded(view, senal_promedio=4, velocidad_promedio=4, bateria_promedio=4)


@query(
    "temporal_summary",
    """SELECT fecha, hora, periodo, count(*) AS mediciones, round(avg(senal_dbm), 4) AS senal_promedio
 FROM fact JOIN dim_tiempo USING (tiempo_id) JOIN dim_hora USING (hora_id) GROUP BY fecha, hora, periodo""",
)
def temporal_summary(spark, sf_dir):
    return rounded(V.temporal_summary(star(spark, sf_dir)), senal_promedio=4)


@query(
    "quality_summary",
    """SELECT nivel AS calidad, nombre AS operador, count(*) AS mediciones
 FROM fact JOIN dim_calidad USING (calidad_id) JOIN dim_operador USING (operador_id) GROUP BY nivel, nombre""",
)
def quality_summary(spark, sf_dir):
    return V.quality_summary(star(spark, sf_dir))


@query(
    "map_view",
    """SELECT u.latitud, u.longitud, o.nombre AS operador, tipo_red AS red, nivel AS calidad, z.nombre AS zona,
 senal_dbm, velocidad, bateria, timestamp_original
 FROM fact JOIN dim_ubicacion AS u USING (ubicacion_id) JOIN dim_operador AS o USING (operador_id)
 JOIN dim_red USING (red_id) JOIN dim_calidad USING (calidad_id) JOIN dim_zonas AS z ON fact.zona_id = z.zona_id""",
)
def map_view(spark, sf_dir):
    view = V.map_view(star(spark, sf_dir))
    return rounded(view, latitud=7, longitud=7, senal_dbm=2, velocidad=2)


@query(
    "global_kpis",
    """SELECT count(*) AS total_mediciones, count(DISTINCT dispositivo_id) AS dispositivos_unicos,
 round(avg(senal_dbm), 4) AS senal_promedio, round(avg(velocidad), 4) AS velocidad_promedio,
 round(avg(bateria), 4) AS bateria_promedio, min(timestamp_original) AS primera_medicion,
 max(timestamp_original) AS ultima_medicion FROM fact""",
)
def global_kpis(spark, sf_dir):
    view = V.global_kpis(star(spark, sf_dir))
    return rounded(view, senal_promedio=4, velocidad_promedio=4, bateria_promedio=4)


@query(
    "create_views",
    """SELECT 'v_mapa' AS view_name, CAST(operador_id AS VARCHAR) AS member, count(*) AS mediciones FROM fact GROUP BY operador_id
 UNION ALL SELECT 'v_calidad', nivel || '/' || nombre, count(*) FROM fact JOIN dim_calidad USING (calidad_id)
  JOIN dim_operador USING (operador_id) GROUP BY nivel, nombre
 UNION ALL SELECT 'v_temporal', periodo || '/' || hora, count(*) FROM fact JOIN dim_hora USING (hora_id) GROUP BY periodo, hora
 UNION ALL SELECT 'v_operador_zona', o.nombre || '/' || z.nombre, count(*) FROM fact JOIN dim_operador AS o USING (operador_id)
  JOIN dim_zonas AS z ON fact.zona_id = z.zona_id GROUP BY o.nombre, z.nombre
 UNION ALL SELECT 'v_kpis', 'all', count(*) FROM fact""",
)
def create_views(spark, sf_dir):
    """Measurements per member of each view, by SQL over the views."""
    V.create_views(star(spark, sf_dir))
    star(spark, sf_dir).dim_operador.createOrReplaceTempView("operators_of_the_check")
    return spark.sql(
        """SELECT 'v_mapa' AS view_name, CAST(operador_id AS STRING) AS member, count(*) AS mediciones
 FROM v_mapa JOIN operators_of_the_check ON operador = nombre GROUP BY operador_id
 UNION ALL SELECT 'v_calidad', calidad || '/' || operador, mediciones FROM v_calidad
 UNION ALL SELECT 'v_temporal', periodo || '/' || hora, sum(mediciones) FROM v_temporal GROUP BY periodo, hora
 UNION ALL SELECT 'v_operador_zona', operador || '/' || zona, mediciones FROM v_operador_zona
 UNION ALL SELECT 'v_kpis', 'all', total_mediciones FROM v_kpis"""
    )
