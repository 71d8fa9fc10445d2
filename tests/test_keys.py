"""Surrogate keys: dense 1..n in name order, independent of partitioning."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from deskmetrics.operators.star import dense_keys


def names_frame(spark, n_per_role=300):
    rows = [(role, f"{role}-{(i * 7919) % 1000:04d}") for role in ("a", "b", "c")
            for i in range(n_per_role)]
    return spark.createDataFrame(rows, "role string, name string").distinct()


def reference_keys(pairs):
    w = Window.partitionBy("role").orderBy("name")
    return pairs.withColumn("key", F.row_number().over(w).cast("long"))


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_dense_keys_stable_over_partitioning(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        pairs = names_frame(spark)
        got = dense_keys(pairs)
        want = reference_keys(pairs)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        per_role = got.groupBy("role").agg(F.min("key"), F.max("key"), F.count("*")).collect()
        assert all(r[1] == 1 and r[2] == r[3] for r in per_role)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_dense_keys_empty(spark):
    empty = spark.createDataFrame([], "role string, name string")
    assert dense_keys(empty).count() == 0
