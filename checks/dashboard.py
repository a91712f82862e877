"""The dashboard's queries, each without and with a filter."""

from pyspark.sql import functions as F

from checks.base import query, rounded, star
from rastro.operators.cleaning import moving_only
from rastro.plans import dashboard as D

FILTERS = D.Filters(
    operators=("ENTEL", "Tigo"),
    zones=("Norte", "Este", "Sur"),
    hora_min=6,
    hora_max=20,
    bateria_min=5,
    bateria_max=95,
    velocidad_min=10,
    velocidad_max=150,
)
_WIDE = """FROM fact LEFT JOIN dim_ubicacion AS u USING (ubicacion_id) LEFT JOIN dim_operador AS o USING (operador_id)
 LEFT JOIN dim_zonas AS z ON fact.zona_id = z.zona_id LEFT JOIN dim_hora AS h USING (hora_id)
 LEFT JOIN dim_tiempo AS t USING (tiempo_id) LEFT JOIN dim_red USING (red_id)
 LEFT JOIN dim_calidad USING (calidad_id) LEFT JOIN dim_dispositivo AS d USING (dispositivo_id) WHERE 1 = 1"""
_FILTERED = """ AND o.nombre IN ('ENTEL', 'Tigo') AND z.nombre IN ('Norte', 'Este', 'Sur') AND h.hora BETWEEN 6 AND 20
 AND bateria BETWEEN 5 AND 95 AND velocidad BETWEEN 10 AND 150"""


def _both(name, sql, build, **digits):
    """Register ``name`` and ``name_filtered``; {FROM} is the joined and filtered star."""
    for suffix, filters, where in (("", D.NO_FILTERS, ""), ("_filtered", FILTERS, _FILTERED)):

        @query(name + suffix, sql.replace("{FROM}", _WIDE + where))
        def run(spark, sf_dir, filters=filters):
            return rounded(build(star(spark, sf_dir), filters), **digits)


_both(
    "filter_measurements",
    "SELECT source_id, operador_id, fact.zona_id, hora_id, bateria, velocidad {FROM}",
    lambda tables, filters: D.filter_measurements(tables, filters).select(
        "source_id", "operador_id", "zona_id", "hora_id", "bateria", "velocidad"
    ),
    velocidad=2,
)
_both(
    "kpis",
    """SELECT count(*) AS total_mediciones, count(DISTINCT dispositivo_id) AS dispositivos_unicos,
 coalesce(round(avg(bateria), 1), 0) AS bateria_promedio, coalesce(round(avg(senal_dbm), 0), 0) AS senal_promedio,
 coalesce(round(avg(velocidad), 1), 0) AS velocidad_promedio,
 coalesce(round(avg(coalesce(altitud, 0)), 0), 0) AS altitud_promedio {FROM}""",
    D.kpis,
)
_both(
    "operator_distribution",
    "SELECT o.nombre AS operador, count(*) AS count {FROM} GROUP BY o.nombre",
    D.operator_distribution,
)
_both(
    "zone_distribution",
    "SELECT z.nombre AS zona, count(*) AS count {FROM} GROUP BY z.nombre ORDER BY count(*) DESC, z.nombre LIMIT 15",
    D.zone_distribution,
)
_both(
    "speed_altitude",
    """SELECT velocidad AS velocidad_kmh, altitud, o.nombre AS operador {FROM} AND velocidad > 0
 ORDER BY source_id LIMIT 5000""",
    D.speed_altitude,
    velocidad_kmh=2,
    altitud=2,
)
_both(
    "hourly_pattern",
    "SELECT h.hora, count(*) AS count {FROM} GROUP BY h.hora",
    D.hourly_pattern,
)
_both(
    "quality_by_operator",
    "SELECT nivel AS calidad, o.nombre AS operador, count(*) AS count {FROM} GROUP BY nivel, o.nombre",
    D.quality_by_operator,
)
_both(
    "hour_day_counts",
    "SELECT h.hora, nombre_dia, dia_semana, count(*) AS count {FROM} GROUP BY h.hora, nombre_dia, dia_semana",
    D.hour_day_counts,
)
_both(
    "activity_heatmap",
    "SELECT nombre_dia, "
    + ", ".join(f'count(*) FILTER (h.hora = {hour}) AS "{hour}"' for hour in range(24))
    + " {FROM} GROUP BY nombre_dia",
    D.activity_heatmap,
)
_both(
    "map_points",
    """SELECT latitud, longitud, o.nombre AS operador_nombre, nombre_dispositivo AS dispositivo_nombre,
 bateria AS medida_bateria, senal_dbm AS medida_senal, velocidad AS velocidad_kmh, timestamp_original,
 z.nombre AS zona_nombre, tipo_red AS red_tipo {FROM} ORDER BY timestamp_original DESC, source_id LIMIT 10000""",
    D.map_points,
    latitud=7,
    longitud=7,
    medida_senal=2,
    velocidad_kmh=2,
)
_both(
    "flagged_measurements",
    """SELECT medicion_id, fecha, h.hora, o.nombre AS operador, nombre_dispositivo AS dispositivo, velocidad, bateria,
 senal_dbm, CASE WHEN velocidad > 120 THEN 'Velocidad Alta' WHEN bateria < 10 THEN 'Bateria Critica'
 WHEN senal_dbm < -100 THEN 'Senal Debil' ELSE 'Normal' END AS tipo_anomalia
 {FROM} AND (velocidad > 120 OR bateria < 10 OR senal_dbm < -100) ORDER BY fecha DESC, h.hora DESC, source_id LIMIT 100""",
    D.flagged_measurements,
    velocidad=2,
    senal_dbm=2,
)


@query(
    "filter_options",
    """SELECT kind, nombre, CASE WHEN kind = 'operator' THEN (SELECT count(*) {FROM} AND o.nombre = n.nombre)
 ELSE (SELECT count(*) {FROM} AND z.nombre = n.nombre) END AS mediciones FROM (
 SELECT 'operator' AS kind, nombre FROM dim_operador UNION SELECT 'zone', nombre FROM dim_zonas) AS n""".replace(
        "{FROM}", _WIDE
    ),
)
def filter_options(spark, sf_dir):
    """The options, with the measurements behind each."""
    tables = star(spark, sf_dir)
    by_operator = D.operator_distribution(tables).select(
        F.lit("operator").alias("kind"), F.col("operador").alias("nombre"), "count"
    )
    by_zone = D.zone_counts(tables).select(
        F.lit("zone").alias("kind"), F.col("zona").alias("nombre"), "count"
    )
    counted = by_operator.unionByName(by_zone).withColumnRenamed("count", "mediciones")
    options = D.filter_options(tables).join(counted, ["kind", "nombre"], "left")
    return options.na.fill(0, ["mediciones"])


@query(
    "moving_only",
    "SELECT source_id, velocidad FROM fact WHERE velocidad > 0",
)
def moving(spark, sf_dir):
    rows = moving_only(star(spark, sf_dir).fact_mediciones)
    return rounded(rows.select("source_id", "velocidad"), velocidad=2)


@query(
    "optional_dimension_join",
    "SELECT source_id, o.nombre AS operador, z.nombre AS zona, nombre_dispositivo {FROM}".replace(
        "{FROM}", _WIDE
    ),
)
def optional_join(spark, sf_dir):
    tables = star(spark, sf_dir)
    operators = tables.dim_operador.select("operador_id", F.col("nombre").alias("operador"))
    zones = tables.dim_zonas.select("zona_id", F.col("nombre").alias("zona"))
    devices = tables.dim_dispositivo.select("dispositivo_id", "nombre_dispositivo")
    return (
        tables.fact_mediciones.join(operators, "operador_id", "left")
        .join(zones, "zona_id", "left")
        .join(devices, "dispositivo_id", "left")
        .select("source_id", "operador", "zona", "nombre_dispositivo")
    )


@query(
    "top_zones",
    "SELECT z.nombre AS zona, count(*) AS count {FROM} GROUP BY z.nombre ORDER BY count(*) DESC, z.nombre LIMIT 2".replace(
        "{FROM}", _WIDE
    ),
)
def top_zones(spark, sf_dir):
    return D.zone_distribution(star(spark, sf_dir), top=2)


@query(
    "latest_points",
    "SELECT latitud, longitud, timestamp_original FROM fact JOIN dim_ubicacion USING (ubicacion_id)"
    " ORDER BY timestamp_original DESC, source_id LIMIT 500",
)
def latest_points(spark, sf_dir):
    newest = D.map_points(star(spark, sf_dir), points=500)
    return rounded(newest, latitud=7, longitud=7).select("latitud", "longitud", "timestamp_original")


@query(
    "sample_limit",
    "SELECT velocidad AS velocidad_kmh, altitud FROM fact JOIN dim_ubicacion USING (ubicacion_id)"
    " WHERE velocidad > 0 ORDER BY source_id LIMIT 50",
)
def sample_limit(spark, sf_dir):
    first = D.speed_altitude(star(spark, sf_dir), points=50).drop("operador")
    return rounded(first, velocidad_kmh=2, altitud=2)
