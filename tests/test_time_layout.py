"""The time-clustered stored fact, footer maxima and point lookups."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from deskmetrics.operators import star
from deskmetrics.plans import model, pipeline, reports, stored
from deskmetrics.session import scratch
from deskmetrics.sources import sinks

MONTHS = 24


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def plan(df):
    return df._jdf.queryExecution().toString()


def scanned_rows(df):
    """Rows that the file scans of an executed plan handed on."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if "AdaptiveSparkPlan" in name:
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("FileSourceScan"):
            return node.metrics().apply("numOutputRows").value()
        children = node.children()
        return sum(walk(children.apply(i)) for i in range(children.size()))
    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


@pytest.fixture(scope="module")
def fact(spark):
    """60,000 tickets over 24 months in no order of time, a fifth unresolved."""
    start = F.timestamp_seconds(F.lit(1_600_000_000) + F.pmod(F.xxhash64("id"), F.lit(MONTHS * 30 * 86400)))
    hours = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(200))
    done = F.when(F.col("id") % 5 > 0, start + F.make_dt_interval(F.lit(0), hours.cast("int")))
    return spark.range(60_000).select(
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10**9)) * 2).alias("ticket_id"),
        F.lit(1).cast("long").alias("customer_id"), (F.col("id") % 9).alias("agent_id"),
        F.lit(1).cast("long").alias("project_id"), F.lit("Bug").alias("category"),
        F.when(F.col("id") % 7 > 0, F.element_at(F.array(*map(F.lit, ("High", "Low", ""))), (F.col("id") % 3 + 1).cast("int")))
        .alias("priority"),
        start.alias("start_time"), done.alias("resolution_time"),
        F.when(F.col("id") % 5 > 0, hours).cast("decimal(10,2)").alias("resolution_duration_hours"),
        F.lit("Open").alias("status"), F.lit(True).alias("resolution_target_met"))


@pytest.fixture(scope="module")
def folder(spark, fact):
    path = scratch(spark, "clustered")
    sinks.curate(star.with_seconds(fact), f"{path}/fact_tickets", **pipeline.FACT_LAYOUT, row_group_bytes=8 << 10)
    return path


@pytest.fixture(scope="module")
def opened(spark, folder):
    schema = stored.SCHEMAS["fact_tickets"]
    return stored.Star({"fact_tickets": sinks.read_parquet(spark, f"{folder}/fact_tickets", schema=schema)}, folder)


def bounds(folder, column):
    """(least, greatest) of every row group of the stored fact."""
    out = []
    for f in glob.glob(f"{local(folder)}/fact_tickets/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            out.append((s.min, s.max))
    return out


def test_same_rows(fact, opened):
    cols = [c for c in fact.columns if c != "priority"]
    a, b = fact.select(*cols, F.nullif("priority", F.lit("")).alias("priority")), opened.fact.select(*cols, "priority")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_month_is_few_row_groups(fact, folder, opened):
    last = fact.agg(F.max("resolution_time")).first()[0].timestamp()
    seconds = bounds(folder, "resolution_second")
    begin, end = last - 62 * 86400, last - 28 * 86400
    near = [1 for lo, hi in seconds if hi >= begin and lo < end]
    assert len(seconds) >= 100 and len(near) < len(seconds) / 4
    names = opened.fact.withColumn("assignee", F.col("agent_id").cast("string"))
    report = reports.top_agents_last_month(names, last=opened.last("resolution"))
    assert report.collect() == reports.top_agents_last_month(
        fact.withColumn("assignee", F.col("agent_id").cast("string"))).collect()
    assert 0 < scanned_rows(report) < fact.count() / 4


def test_point_lookup_skips_row_groups(opened, fact):
    held = fact.orderBy(F.xxhash64("ticket_id")).first().ticket_id
    n = fact.count()
    assert scanned_rows(opened.fact.filter(F.col("ticket_id") == held)) < n / 10
    # between held ids, but held by none (all are even)
    assert scanned_rows(opened.fact.filter(F.col("ticket_id") == held + 1)) < n / 10


def test_ends_come_from_footers(opened, fact):
    assert "PushedAggregation: [MAX(start_second), MAX(resolution_second)]" in plan(opened.ends).replace("\n", " ")
    want = fact.agg(F.max("start_time"), F.max("resolution_time")).first()
    assert tuple(opened.ends.first()) == tuple(want)


@pytest.mark.parametrize("name", ["top_agents_last_month", "zero_compliance_categories"])
def test_reports_use_the_footers(spark, name):
    from deskmetrics.plans.catalog import QUERIES
    assert "PushedAggregation: [MAX(" in plan(QUERIES[name](spark, SMOKE_DIR))


def test_ends_without_any_resolution(spark, fact):
    path = scratch(spark, "unresolved")
    none = fact.withColumn("resolution_time", F.lit(None).cast("timestamp"))
    sinks.curate(star.with_seconds(none), f"{path}/fact_tickets", **pipeline.FACT_LAYOUT)
    ends = stored.Star({"fact_tickets": none}, path).ends.first()
    assert ends.last_resolution is None and ends.last_start is not None


def test_star_ends_equal_the_fact(spark):
    s = stored.for_tables(spark, SMOKE_DIR)
    want = model.from_tables(spark, SMOKE_DIR).fact.agg(F.max("start_time"), F.max("resolution_time")).first()
    assert tuple(s.ends.first()) == tuple(want)
