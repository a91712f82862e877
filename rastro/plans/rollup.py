"""Rollups kept beside the facts: what the dashboard's counts, means and choice of days need, without reading facts.

Every load adds the rollup of the facts that it inserts, in the same change, so both always agree. Rows of different loads with
the same key are summed by whoever reads them; all sums are exact.
"""

from pyspark.sql import functions as F

from rastro import schema as S

KEYS = ("tiempo_id", "hora_id", "operador_id", "calidad_id", "zona_id")
DEVICE_KEYS = ("dispositivo_id", "hora_id", "operador_id", "zona_id")
SUMS = tuple(name for name in S.ROLLUP_DIARIO.names if name not in KEYS)


def is_placed():
    """Measurements that the map shows."""
    return F.col("ubicacion_id").isNotNull() & F.col("operador_id").isNotNull()


def is_flagged():
    """Fast, empty-battery or weak-signal measurements that have all the keys they are listed with."""
    flagged = (
        (F.col("velocidad") > S.FLAG_SPEED_KMH)
        | (F.col("bateria") < S.FLAG_BATTERY)
        | (F.col("senal_dbm") < S.FLAG_SIGNAL_DBM)
    )
    keys = [F.col(name).isNotNull() for name in ("tiempo_id", "hora_id", "operador_id")]
    return flagged & keys[0] & keys[1] & keys[2]


def daily_rollup(facts, locations):
    """Counts and sums of facts per day, hour, operator, quality and zone.

    The altitude of a measurement is that of its location. Facts are summed per location first, so a place with many
    measurements joins as few rows.
    """
    per_place = facts.groupBy(*KEYS, "ubicacion_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_placed()).alias("n_placed"),
        F.count_if(is_flagged()).alias("n_flagged"),
        *[F.sum(name).alias(f"{name}_sum") for name in ("bateria", "senal_dbm", "velocidad")],
        *[F.count(name).alias(f"{name}_n") for name in ("bateria", "senal_dbm", "velocidad")],
    )
    known = locations.select(F.col("ubicacion_id").alias("_place"), "altitud")
    height = F.coalesce("altitud", F.lit(0).cast("decimal(10,2)")) * F.col("n")
    placed = per_place.join(known, F.col("ubicacion_id") == F.col("_place"), "left")
    placed = placed.withColumn("altitud_sum", height.cast("decimal(38,2)"))
    return placed.groupBy(*KEYS).agg(*[F.sum(name).alias(name) for name in SUMS])


def device_rollup(facts):
    """The devices seen in each hour of the day, by operator and zone."""
    return facts.select(*DEVICE_KEYS).distinct()
