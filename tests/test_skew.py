"""Salted joins: the same rows as a plain join, evenly dealt."""

from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from rastro.operators.skew import salted_left_join


@pytest.fixture
def plain_joins(spark):
    """No help from adaptive execution, nothing broadcast by size."""
    before = {key: spark.conf.get(key) for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_half_of_the_rows_with_one_key_are_dealt_evenly(spark, plain_joins):
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 3000)
    rows = spark.range(40_000).select("id", key.alias("a"), (F.col("id") % 1).alias("b"))
    table = spark.range(2_500).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"), (F.col("id") * 2).alias("twice"))
    joined = salted_left_join(rows, table, ["a", "b"], ["id"])
    assert set(joined.columns) == {"id", "a", "b", "twice"}
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * median(sizes)
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    plain = rows.join(table, ["a", "b"], "left").select(*joined.columns)
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, plain.collect()))


def test_nothing_to_join(spark):
    rows, table = spark.range(3).selectExpr("id", "id AS _salt0"), spark.createDataFrame([], "id long, x long")
    assert sorted(map(tuple, salted_left_join(rows, table, ["id"], ["id"]).collect())) == [(i, i, None) for i in range(3)]
    assert salted_left_join(rows.limit(0), spark.range(2).selectExpr("id", "id AS x"), ["id"], ["id"]).count() == 0
