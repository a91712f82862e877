"""Surrogate keys computed from the natural key.

Each key is a one-to-one function of its natural key, so tasks assign equal keys without
talking to each other, a repeated load finds the same keys, and the fact table needs no
lookup join. Nothing is hashed down, so nothing can collide.
"""

from pyspark.sql import functions as F

from rastro import schema as S

_STEPS_PER_DEGREE = 10_000_000  # coordinates are kept to seven decimals
_LAT_OFFSET = 90 * _STEPS_PER_DEGREE
_LON_OFFSET = 180 * _STEPS_PER_DEGREE
_LON_SPAN = 2 * _LON_OFFSET + 1


def date_key(date):
    """2024-01-31 becomes 20240131."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def hour_key(hour):
    return hour + 1


def location_key(lat, lon):
    """Both decimal(10,7) coordinates in one long."""
    y = (lat.cast("decimal(10,7)") * _STEPS_PER_DEGREE).cast("bigint") + _LAT_OFFSET
    x = (lon.cast("decimal(10,7)") * _STEPS_PER_DEGREE).cast("bigint") + _LON_OFFSET
    return y * F.lit(_LON_SPAN) + x


def location_from_key(key):
    """The (lat, lon) decimal(10,7) columns that ``location_key`` was made of."""
    y = F.call_function("div", key, F.lit(_LON_SPAN)) - _LAT_OFFSET
    x = key % F.lit(_LON_SPAN) - _LON_OFFSET

    def degrees(steps):
        return (steps.cast("decimal(12,0)") / F.lit(_STEPS_PER_DEGREE)).cast("decimal(10,7)")

    return degrees(y), degrees(x)


def device_key(device_hash):
    """The 16 hexadecimal digits read as a signed long."""
    return F.conv(device_hash, 16, -10).cast("bigint")


def static_key(name, members, default):
    """Id of a fixed dimension member by name; anything else is the default member."""
    ids = {member[1]: member[0] for member in members}
    lookup = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    return F.coalesce(lookup[name], F.lit(ids[default]))


def operator_key(name):
    return static_key(name, S.OPERATORS, S.UNKNOWN_OPERATOR)


def network_key(kind):
    return static_key(kind, S.NETWORKS, S.UNKNOWN_NETWORK)


def quality_key(level):
    return static_key(level, S.QUALITIES, S.NO_SIGNAL)
