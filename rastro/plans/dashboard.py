"""The dashboard's queries over the warehouse.

All take an optional filter. Counts are taken per key before names are joined, and top-k
queries pick their rows from the fact table before joining: every key of a fact row exists in
its dimension (``integrity_report``), so the result is the same and the join stays small.

A warehouse keeps rollups of its facts. Unless the filter has a range of battery or speed, which the rollups do not tell apart,
counts and means come from them, and so does the choice of the newest days; facts are read for single measurements only.
"""

from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from rastro import schema as S
from rastro.functions.keys import location_from_key
from rastro.functions.measures import classify_anomaly
from rastro.operators.aggregates import sort_by_count
from rastro.operators.cleaning import moving_only
from rastro.plans.rollup import is_flagged, is_placed


@dataclass(frozen=True)
class Filters:
    """Restrictions on measurements; a range counts only if both ends are given."""

    operators: tuple = ()
    zones: tuple = ()
    hora_min: int | None = None
    hora_max: int | None = None
    bateria_min: float | None = None
    bateria_max: float | None = None
    velocidad_min: float | None = None
    velocidad_max: float | None = None


NO_FILTERS = Filters()


def _range(column, low, high):
    return None if low is None or high is None else F.col(column).between(low, high)


def filter_measurements(star, filters=NO_FILTERS):
    """Fact rows that pass the filter; hours are compared by value, not by key."""
    rows = star.fact_mediciones
    for condition in (
        _range("bateria", filters.bateria_min, filters.bateria_max),
        _range("velocidad", filters.velocidad_min, filters.velocidad_max),
    ):
        if condition is not None:
            rows = rows.filter(condition)
    return _of_members(rows, star, filters)


def _of_members(rows, star, filters):
    """Rows whose hour, operator and zone pass the filter."""
    hours = _range("hora", filters.hora_min, filters.hora_max)
    if hours is not None:
        rows = rows.join(star.dim_hora.filter(hours), "hora_id", "left_semi")
    if filters.operators:
        chosen = star.dim_operador.filter(F.col("nombre").isin(list(filters.operators)))
        rows = rows.join(chosen, "operador_id", "left_semi")
    if filters.zones:
        chosen = star.dim_zonas.filter(F.col("nombre").isin(list(filters.zones)))
        rows = rows.join(chosen, "zona_id", "left_semi")
    return rows


def _rollup(star, filters, table="rollup_diario"):
    """Rows of a rollup that pass the filter; None if facts are needed."""
    rows = getattr(star, table)
    ranges = (
        _range("bateria", filters.bateria_min, filters.bateria_max),
        _range("velocidad", filters.velocidad_min, filters.velocidad_max),
    )
    if rows is None or any(condition is not None for condition in ranges):
        return None
    return _of_members(rows, star, filters)


def _counts(star, filters, *keys):
    """Measurements per key, from the rollup if it can tell."""
    rows = _rollup(star, filters)
    if rows is None:
        return filter_measurements(star, filters).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"))


def _operators(star):
    return star.dim_operador.select("operador_id", F.col("nombre").alias("operador"))


def _zones(star):
    return star.dim_zonas.select("zona_id", F.col("nombre").alias("zona"))


def _rounded_mean(column, digits):
    mean = F.avg(F.col(column).cast("double"))
    return F.coalesce(F.round(mean, digits), F.lit(0.0))


def kpis(star, filters=NO_FILTERS):
    """One row of counts and rounded means; zeros if no measurement passes."""
    rows = _rollup(star, filters)
    if rows is None:
        return _kpis_of_facts(star, filters)

    def mean(name, digits, count=None):
        total, n = F.sum(f"{name}_sum").cast("double"), F.sum(count or f"{name}_n")
        return F.coalesce(F.round(F.try_divide(total, n), digits), F.lit(0.0)).alias(f"{name}_mean")

    devices = _rollup(star, filters, "rollup_dispositivos").agg(F.count_distinct("dispositivo_id"))
    return rows.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_mediciones"),
        mean("bateria", 1),
        mean("senal_dbm", 0),
        mean("velocidad", 1),
        mean("altitud", 0, "n"),
    ).select(
        "total_mediciones",
        devices.scalar().alias("dispositivos_unicos"),
        F.col("bateria_mean").alias("bateria_promedio"),
        F.col("senal_dbm_mean").alias("senal_promedio"),
        F.col("velocidad_mean").alias("velocidad_promedio"),
        F.col("altitud_mean").alias("altitud_promedio"),
    )


def _kpis_of_facts(star, filters):
    """The mean altitude needs the location table. Measurements are counted per location
    first, so a busy place joins as one row.
    """
    rows = filter_measurements(star, filters)
    figures = rows.agg(
        F.count(F.lit(1)).alias("total_mediciones"),
        F.count_distinct("dispositivo_id").alias("dispositivos_unicos"),
        _rounded_mean("bateria", 1).alias("bateria_promedio"),
        _rounded_mean("senal_dbm", 0).alias("senal_promedio"),
        _rounded_mean("velocidad", 1).alias("velocidad_promedio"),
    )
    height = F.coalesce(F.col("altitud").cast("double"), F.lit(0.0))
    per_place = rows.groupBy("ubicacion_id").agg(F.count(F.lit(1)).alias("n"))
    mean_altitude = (
        per_place.join(star.dim_ubicacion.select("ubicacion_id", "altitud"), "ubicacion_id", "left")
        .agg(F.try_divide(F.sum(height * F.col("n")), F.sum("n")).alias("mean"))
    )
    return figures.withColumn(
        "altitud_promedio", F.coalesce(F.round(mean_altitude.scalar(), 0), F.lit(0.0))
    )


def operator_distribution(star, filters=NO_FILTERS):
    """Measurements per operator, largest first."""
    counted = _counts(star, filters, "operador_id")
    named = counted.join(_operators(star), "operador_id").groupBy("operador")
    return sort_by_count(named.agg(F.sum("n").alias("count")), "count", "operador")


def zone_counts(star, filters=NO_FILTERS):
    """Measurements of every zone that has any."""
    counted = _counts(star, filters, "zona_id")
    return counted.join(_zones(star), "zona_id").groupBy("zona").agg(F.sum("n").alias("count"))


def zone_distribution(star, filters=NO_FILTERS, top=S.TOP_ZONES):
    """The zones with most measurements."""
    return sort_by_count(zone_counts(star, filters), "count", "zona").limit(top)


def hourly_pattern(star, filters=NO_FILTERS):
    """Measurements per hour, by hour."""
    counted = _counts(star, filters, "hora_id")
    return (
        counted.join(star.dim_hora, "hora_id")
        .select("hora", F.col("n").alias("count"))
        .orderBy("hora")
    )


def quality_by_operator(star, filters=NO_FILTERS):
    """Measurements per quality level and operator, largest first."""
    counted = _counts(star, filters, "calidad_id", "operador_id")
    named = (
        counted.join(star.dim_calidad, "calidad_id")
        .join(_operators(star), "operador_id")
        .groupBy(F.col("nivel").alias("calidad"), "operador")
    )
    return sort_by_count(named.agg(F.sum("n").alias("count")), "count", "calidad", "operador")


def speed_altitude(star, filters=NO_FILTERS, points=S.SCATTER_POINTS):
    """Speed, altitude and operator of moving measurements, the first by source id."""
    chosen = (
        moving_only(filter_measurements(star, filters))
        .filter(F.col("ubicacion_id").isNotNull() & F.col("operador_id").isNotNull())
        .orderBy("source_id")
        .limit(points)
    )
    return (
        chosen.join(star.dim_ubicacion, "ubicacion_id")
        .join(_operators(star), "operador_id")
        .orderBy("source_id")
        .select(F.col("velocidad").alias("velocidad_kmh"), "altitud", "operador")
    )


def hour_day_counts(star, filters=NO_FILTERS):
    """Measurements per hour and weekday."""
    counted = _counts(star, filters, "tiempo_id", "hora_id")
    return (
        counted.join(star.dim_hora, "hora_id")
        .join(star.dim_tiempo, "tiempo_id")
        .groupBy("hora", "nombre_dia", "dia_semana")
        .agg(F.sum("n").alias("count"))
        .orderBy("dia_semana", "hora")
    )


def activity_heatmap(star, filters=NO_FILTERS):
    """Weekdays (Monday first) by hours 0-23; 0 where nothing was measured."""
    return (
        hour_day_counts(star, filters)
        .groupBy("nombre_dia", "dia_semana")
        .pivot("hora", list(range(24)))
        .agg(F.sum("count"))
        .na.fill(0)
        .orderBy("dia_semana")
        .drop("dia_semana")
    )


def _of_newest_days(rows, enough, star, filters, counted):
    """The rows of the newest days that together hold ``enough`` rows, or all.

    The rows per day are the sum of ``counted`` in the rollup, or else counted from few columns; what is read of the
    facts after that are those days' folders.
    """
    kept = _rollup(star, filters)
    if kept is None:
        per_day = rows.groupBy("tiempo_id").agg(F.count(F.lit(1)).alias("n"))
    else:
        per_day = kept.groupBy("tiempo_id").agg(F.sum(counted).alias("n")).filter("n > 0")
    # one row per day
    newer = Window.orderBy(F.col("tiempo_id").desc()).rowsBetween(Window.unboundedPreceding, -1)
    before = per_day.withColumn("before", F.coalesce(F.sum("n").over(newer), F.lit(0)))
    oldest = before.filter(F.col("before") < enough).agg(F.min("tiempo_id")).scalar()
    return rows.filter(F.col("tiempo_id") >= oldest)


def map_points(star, filters=NO_FILTERS, points=S.MAP_POINTS):
    """The newest measurements with place and names."""
    newest = [F.col("timestamp_original").desc_nulls_first(), F.col("source_id")]
    placed = filter_measurements(star, filters).filter(is_placed())
    chosen = _of_newest_days(placed, points, star, filters, "n_placed").orderBy(*newest).limit(points)
    devices = star.dim_dispositivo.select("dispositivo_id", "nombre_dispositivo")
    # the key holds the coordinates; the location table, as large as the facts, is not needed
    latitude, longitude = location_from_key(F.col("ubicacion_id"))
    return (
        chosen.withColumns({"latitud": latitude, "longitud": longitude})
        .join(_operators(star), "operador_id")
        .join(star.dim_red.select("red_id", "tipo_red"), "red_id", "left")
        .join(devices, "dispositivo_id", "left")
        .join(_zones(star), "zona_id", "left")
        .orderBy(*newest)
        .select(
            "latitud",
            "longitud",
            F.col("operador").alias("operador_nombre"),
            F.col("nombre_dispositivo").alias("dispositivo_nombre"),
            F.col("bateria").alias("medida_bateria"),
            F.col("senal_dbm").alias("medida_senal"),
            F.col("velocidad").alias("velocidad_kmh"),
            "timestamp_original",
            F.col("zona").alias("zona_nombre"),
            F.col("tipo_red").alias("red_tipo"),
        )
    )


def flagged_measurements(star, filters=NO_FILTERS, rows=S.FLAGGED_ROWS):
    """The newest fast, empty-battery or weak-signal measurements, with a label.

    Day and hour keys sort like the day and the hour.
    """
    newest = [F.col("tiempo_id").desc(), F.col("hora_id").desc(), F.col("source_id")]
    measures = (F.col("velocidad"), F.col("bateria"), F.col("senal_dbm"))
    flagged = filter_measurements(star, filters).filter(is_flagged())
    chosen = _of_newest_days(flagged, rows, star, filters, "n_flagged").orderBy(*newest).limit(rows)
    devices = star.dim_dispositivo.select(
        "dispositivo_id", F.col("nombre_dispositivo").alias("dispositivo")
    )
    return (
        chosen.join(star.dim_tiempo.select("tiempo_id", "fecha"), "tiempo_id")
        .join(star.dim_hora.select("hora_id", "hora"), "hora_id")
        .join(_operators(star), "operador_id")
        .join(devices, "dispositivo_id", "left")
        .orderBy(*newest)
        .select(
            "medicion_id",
            "fecha",
            "hora",
            "operador",
            "dispositivo",
            *measures,
            classify_anomaly(*measures).alias("tipo_anomalia"),
        )
    )


def filter_options(star):
    """(kind, nombre): names to choose operators and zones from, sorted."""
    operators = star.dim_operador.select(F.lit("operator").alias("kind"), "nombre")
    zones = star.dim_zonas.select(F.lit("zone").alias("kind"), "nombre")
    return operators.unionByName(zones).distinct().orderBy("kind", "nombre")
