"""Text helpers."""

from pyspark.sql import functions as F

from rastro import schema as S

# The characters of Unicode that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(col):
    """Remove white space of any kind from both ends."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def normalize_operator(name):
    """Operator family of a free-text operator name; unknown and null are 'Desconocido'."""
    names = F.create_map(*[F.lit(x) for pair in S.OPERATOR_NAMES.items() for x in pair])
    return F.coalesce(names[strip(F.lower(name))], F.lit(S.UNKNOWN_OPERATOR))


def normalize_network(kind):
    """Network family of a free-text network type; unknown and null are 'Desconocida'."""
    text = F.upper(kind)
    result = F.lit(S.UNKNOWN_NETWORK)
    for family, marks in reversed(S.NETWORK_MARKS):
        found = F.lit(False)
        for mark in marks:
            found = found | text.contains(mark)
        result = F.when(found, F.lit(family)).otherwise(result)
    return result


def sanitize_string(col):
    """Collapse white space, drop control characters; an empty result is null."""
    spaced = strip(F.regexp_replace(col, f"[{WHITE_SPACE}]+", " "))
    return F.nullif(F.regexp_replace(spaced, r"[\x00-\x1f]", ""), F.lit(""))


def truncate_string(col, length):
    """Strip and cut to ``length`` characters; null stays null."""
    return F.substring(strip(col), 1, length)


def was_truncated(col, length):
    """Whether ``truncate_string`` would lose characters."""
    return F.coalesce(F.length(strip(col)) > length, F.lit(False))


def device_identifier(device_id, device_name, record_id):
    """Struct (identifier, display): the device id, else its name, else a stable number.

    Blank, 'none' and 'null' ids count as missing.
    """
    clean_id = strip(device_id)
    has_id = F.coalesce(~F.lower(clean_id).isin("", "none", "null"), F.lit(False))
    clean_name = strip(device_name)
    has_name = F.coalesce(clean_name != "", F.lit(False))
    digest = F.substring(F.md5(record_id.cast("string").cast("binary")), 1, 8)
    number = F.conv(digest, 16, 10).cast("bigint") % 100000
    identifier = (
        F.when(has_id, clean_id)
        .when(has_name, F.concat(F.lit("NAME_"), clean_name))
        .otherwise(F.concat(F.lit("UNKNOWN_"), number.cast("string")))
    )
    display = (
        F.when(
            has_id,
            F.coalesce(F.nullif(device_name, F.lit("")), F.concat(F.lit("Device_"), clean_id)),
        )
        .when(has_name, clean_name)
        .otherwise(F.lit(S.UNKNOWN_DEVICE))
    )
    return F.struct(identifier.alias("identifier"), display.alias("display"))


def device_hash(identifier, model):
    """First 16 hexadecimal digits of the MD5 of 'identifier_model' in lower case."""
    text = strip(F.lower(F.concat(identifier, F.lit("_"), model)))
    return F.substring(F.md5(text.cast("binary")), 1, 16)


def format_district_id(district_id):
    """'a.b.7' becomes 'Distrito 7'; an id without a dot stays as it is."""
    last = F.element_at(F.split(district_id, "[.]"), -1)
    return F.when(district_id.contains("."), F.concat(F.lit("Distrito "), last)).otherwise(
        district_id
    )


def hour_label(hour):
    """7 becomes '07:00'."""
    return F.format_string("%02d:00", hour)


def weekday_dimension(number, name):
    """'2-Monday'."""
    return F.concat(number.cast("string"), F.lit("-"), name)
