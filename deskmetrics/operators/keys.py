"""Lasting surrogate keys (K1): an append-only registry of names.

A registry is a folder of batches; a batch holds names that no earlier batch
has, with keys that go on after the largest key of their role, dense and by
name within the batch.  A key once given never changes, so rows stored with
keys stay right when new names arrive.  A batch is written under its own
number and depends on earlier batches only, so writing it again after a
failure gives the same folder.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .star import dense_keys

SCHEMA = "role string, name string, key bigint"


def read(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """(role, name, key) of all batches, or of those numbered below ``before``."""
    try:
        rows = spark.read.schema(f"{SCHEMA}, batch bigint").parquet(path)
    except AnalysisException:      # no batch yet
        rows = spark.createDataFrame([], f"{SCHEMA}, batch bigint")
    return (rows if before is None else rows.filter(F.col("batch") < before)).drop("batch")


def extend(names: DataFrame, path: str, batch: int) -> DataFrame:
    """Registers the (role, name) pairs that are new as batch ``batch`` and
    returns the registry up to it."""
    spark = names.sparkSession
    known = read(spark, path, before=batch)
    new = names.join(known, ["role", "name"], "left_anti")
    ends = known.groupBy("role").agg(F.max("key").alias("_end"))       # one row per role
    keyed = (dense_keys(new).join(F.broadcast(ends), "role", "left")
             .select("role", "name", (F.col("key") + F.coalesce("_end", F.lit(0))).alias("key")))
    keyed.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return read(spark, path, before=batch + 1)
