"""The salted join returns exactly the plain join, hot keys included."""

from pyspark.sql import functions as F

from snapdiff.operators.skew import hot_keys, salted_join


def test_salted_join_equals_plain_join(spark):
    left = spark.range(0, 3000).select(F.col("id").alias("a"), F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(0, 2000).select(F.col("id").alias("b"), F.when(F.col("id") < 900, 0).otherwise(F.col("id") % 70).alias("k"))
    assert hot_keys(left, right, ["k"], pairs_per_task=10_000).count() >= 1
    got = salted_join(left, right, ["k"], ["a"], ["b"], pairs_per_task=10_000)
    plain = left.join(right, "k")
    assert got.count() == plain.count()
    assert got.exceptAll(plain.select(*got.columns)).count() == 0
