"""Column rules: stamp parsing, text standardisation, SLA verdict."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import ts
from deskmetrics.functions.columns import (
    hours_between,
    parse_timestamp,
    priority_flag,
    standardize_category,
    standardize_priority,
    standardize_project,
    target_met,
)


@pytest.mark.parametrize("text, expected", [
    ("2016-03-24 15:35:53+00:00", "2016-03-24 15:35:53"),
    ("2018-08-14 15:42:12.564000", "2018-08-14 15:42:12"),
    ("2018-08-14 15:42:12", "2018-08-14 15:42:12"),
    ("2018-08-14 15:42:12.564000+00:00", "2018-08-14 15:42:12"),
    ("2018-08-14 15:42:12+02:00", None),
    ("2018-08-14T15:42:12Z", None),
    (" 2018-08-14 15:42:12", None),
    ("", None),
    ("junk", None),
    (None, None),
])
def test_parse_timestamp(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    got = df.select(parse_timestamp("s").cast("timestamp_ntz").alias("t")).first().t
    assert got == (ts(expected) if expected else None)


def test_bad_numbers_become_null(spark):
    from deskmetrics.sources.scan import cast_to_schema
    from pyspark.sql.types import LongType, IntegerType, StructField, StructType
    schema = StructType([StructField("a", LongType()), StructField("b", IntegerType())])
    df = spark.createDataFrame([("abc", "3.0"), ("12345678901234", " 7 ")], "a string, b string")
    rows = cast_to_schema(df, schema).collect()
    assert (rows[0].a, rows[0].b) == (None, 3)
    assert (rows[1].a, rows[1].b) == (12345678901234, 7)


def test_standardize_text(spark):
    df = spark.createDataFrame(
        [(" economy anodized STEEL ", " HIGH ", "  united states "), (None, "blocker", None)],
        "t string, p string, j string")
    rows = df.select(standardize_category("t").alias("c"), standardize_priority("p").alias("p"),
                     standardize_project("j").alias("j"),
                     priority_flag(standardize_priority("p")).alias("f")).collect()
    assert tuple(rows[0]) == ("Economy Anodized Steel", "High", "UNITED STATES", None)
    assert tuple(rows[1]) == ("Uncategorized", "Blocker", None, "UNRECOGNIZED_PRIORITY")


@pytest.mark.parametrize("priority, start, end, expected", [
    ("High", "2020-01-01 00:00:00", "2020-01-02 00:00:00", True),    # exactly 24 h
    ("High", "2020-01-01 00:00:00", "2020-01-02 00:00:01", False),   # one second over
    ("Critical", "2020-01-01 00:00:00", "2020-01-01 04:00:00", True),
    ("Low", "2020-01-01 00:00:00", None, None),                      # unresolved
    ("Blocker", "2020-01-01 00:00:00", "2020-01-01 01:00:00", None),  # no target
    (None, "2020-01-01 00:00:00", "2020-01-01 01:00:00", None),
])
def test_target_met(spark, priority, start, end, expected):
    df = spark.createDataFrame([(priority, start, end)], "p string, s string, e string")
    df = df.select("p", F.col("s").cast("timestamp").alias("s"), F.col("e").cast("timestamp").alias("e"))
    row = df.select(hours_between("s", "e").alias("h"), "p").select(
        "h", target_met("h", "p").alias("m")).first()
    assert row.m == expected
    if end == "2020-01-02 00:00:01":
        assert row.h == pytest.approx(24 + 1 / 3600)
