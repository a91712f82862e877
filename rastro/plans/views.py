"""The five summary views over the warehouse."""

from pyspark.sql import functions as F

from rastro.functions.keys import location_from_key


def _mean(name):
    return F.avg(F.col(name).cast("double"))


def operator_zone_summary(star):
    """Count and mean signal, speed and battery per operator and zone."""
    return (
        star.fact_mediciones.join(star.dim_operador, "operador_id")
        .join(star.dim_zonas.withColumnRenamed("nombre", "zona"), "zona_id")
        .groupBy(F.col("nombre").alias("operador"), "zona")
        .agg(
            F.count(F.lit(1)).alias("mediciones"),
            _mean("senal_dbm").alias("senal_promedio"),
            _mean("velocidad").alias("velocidad_promedio"),
            _mean("bateria").alias("bateria_promedio"),
        )
    )


def temporal_summary(star):
    """Count and mean signal per date, hour and period."""
    return (
        star.fact_mediciones.join(star.dim_tiempo, "tiempo_id")
        .join(star.dim_hora, "hora_id")
        .groupBy("fecha", "hora", "periodo")
        .agg(F.count(F.lit(1)).alias("mediciones"), _mean("senal_dbm").alias("senal_promedio"))
    )


def quality_summary(star):
    """Count per quality level and operator."""
    return (
        star.fact_mediciones.join(star.dim_calidad, "calidad_id")
        .join(star.dim_operador, "operador_id")
        .groupBy(F.col("nivel").alias("calidad"), F.col("nombre").alias("operador"))
        .agg(F.count(F.lit(1)).alias("mediciones"))
    )


def map_view(star):
    """Every measurement with its place and names.

    Coordinates are read out of the location key, so the large fact and location tables
    need not be joined; the other dimensions are small.
    """
    lat, lon = location_from_key(F.col("ubicacion_id"))
    return (
        star.fact_mediciones.filter(F.col("ubicacion_id").isNotNull())
        .join(star.dim_operador.select("operador_id", F.col("nombre").alias("operador")), "operador_id")
        .join(star.dim_red.select("red_id", F.col("tipo_red").alias("red")), "red_id")
        .join(star.dim_calidad.select("calidad_id", F.col("nivel").alias("calidad")), "calidad_id")
        .join(star.dim_zonas.select("zona_id", F.col("nombre").alias("zona")), "zona_id")
        .select(
            lat.alias("latitud"),
            lon.alias("longitud"),
            "operador",
            "red",
            "calidad",
            "zona",
            "senal_dbm",
            "velocidad",
            "bateria",
            "timestamp_original",
        )
    )


def global_kpis(star):
    """One row: counts, means, first and last time."""
    return star.fact_mediciones.agg(
        F.count(F.lit(1)).alias("total_mediciones"),
        F.count_distinct("dispositivo_id").alias("dispositivos_unicos"),
        _mean("senal_dbm").alias("senal_promedio"),
        _mean("velocidad").alias("velocidad_promedio"),
        _mean("bateria").alias("bateria_promedio"),
        F.min("timestamp_original").alias("primera_medicion"),
        F.max("timestamp_original").alias("ultima_medicion"),
    )


VIEWS = {
    "v_operador_zona": operator_zone_summary,
    "v_temporal": temporal_summary,
    "v_calidad": quality_summary,
    "v_mapa": map_view,
    "v_kpis": global_kpis,
}


def create_views(star):
    """Register the five views in the session."""
    for name, build in VIEWS.items():
        build(star).createOrReplaceTempView(name)
