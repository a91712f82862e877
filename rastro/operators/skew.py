"""Joins with a large table whose keys are used very unevenly, without help from adaptive execution."""

from functools import reduce

from pyspark.sql import functions as F

#: Pieces that the rows of all busy keys are cut into, per shuffle partition: enough for hashing to spread them evenly.
PIECES = 16


def salted_left_join(rows, table, keys, by):
    """``rows`` with the columns of ``table``, which has one row per value of ``keys``; unmatched rows stay.

    A key is busy if it has more than half of an even share of a shuffle partition. There are at most two such keys per
    partition, whatever the data, so they are broadcast. Rows of a busy key are dealt over as many pieces as its
    share asks for, by the hash of ``by``, and its row of the table is repeated for each piece. Rows without a key are dealt
    as well; they match nothing.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taken = {*rows.columns, *table.columns}
    salt, pieces = (next(n for n in (f"_{name}{i}" for i in range(len(taken) + 1)) if n not in taken) for name in ("salt", "pieces"))
    known = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    counted = rows.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias(pieces))
    total = counted.agg(F.sum(pieces)).scalar()
    busy = counted.where(F.col(pieces) * 2 * partitions > total).withColumn(
        pieces, F.ceil(F.col(pieces) * PIECES * partitions / total)
    )
    mark = F.xxhash64(*by)
    several = F.when(~known, F.pmod(mark, F.lit(PIECES * partitions))).when(
        F.col(pieces).isNotNull(), F.pmod(mark, F.col(pieces))
    )
    dealt = rows.join(F.broadcast(busy), keys, "left").withColumn(salt, F.coalesce(several, F.lit(0))).drop(pieces)
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(pieces), F.lit(1)) - 1)
    repeated = table.join(F.broadcast(busy), keys, "left").withColumn(salt, F.explode(copies)).drop(pieces)
    return dealt.join(repeated, [*keys, salt], "left").drop(salt)
