"""Policies as data, merged summaries, the quarantine and header discovery."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import ISSUE_COLS, SMOKE_DIR, issue, ts
from deskmetrics.operators import quality, quarantine, sketches, sla
from deskmetrics.plans import catalog, model, stored
from deskmetrics.schemas import ISSUES_SCHEMA
from deskmetrics.session import scratch
from deskmetrics.sources import scan


@pytest.fixture(scope="module")
def star(spark):
    return stored.for_tables(spark, SMOKE_DIR)


# --- policies ----------------------------------------------------------------

TICKETS = [(1, "High", "2024-01-01 00:00:00", 20.0), (2, "High", "2024-06-01 00:00:00", 20.0),
           (3, "High", None, 20.0), (4, "Low", "2024-06-01 00:00:00", 20.0), (5, None, "2024-01-01 00:00:00", 1.0),
           (6, "High", "2024-05-31 23:59:59", None), (7, "High", "2030-01-01 00:00:00", 5.0), (7, "High", "2030-01-01 00:00:00", 5.0)]
POLICIES = [("High", 24.0, None, None), ("High", 12.0, ts("2024-06-01 00:00:00"), ts("2029-01-01 00:00:00")),
            ("High", 12.0, ts("2024-06-01 00:00:00"), ts("2029-01-01 00:00:00")), (None, 1.0, None, None),
            ("Never", 1.0, ts("2050-01-01 00:00:00"), None)]


def judged(spark, tickets, policies):
    fact = spark.createDataFrame([(i, p, ts(s) if s else None, h) for i, p, s, h in tickets],
                                 "ticket_id long, priority string, start_time timestamp, resolution_duration_hours double")
    rows = sla.with_targets(fact, spark.createDataFrame(policies, sla.SCHEMA)).collect()
    return sorted((r.ticket_id, r.threshold_hours, r.resolution_target_met) for r in rows)


def test_targets_follow_their_dates(spark):
    assert judged(spark, TICKETS, POLICIES) == [
        (1, 24.0, True), (2, 12.0, False), (3, 24.0, True), (4, None, None), (5, None, None), (6, 24.0, None),
        (7, None, None), (7, None, None)]
    assert judged(spark, TICKETS, []) == sorted((i, None, None) for i, *_ in TICKETS)
    assert judged(spark, [], POLICIES) == []


def test_one_version_equals_the_constant_targets(spark):
    fact = model.from_tables(spark, SMOKE_DIR).fact
    got = sla.with_targets(fact, sla.constant_policies(spark)).select("ticket_id", "resolution_target_met")
    want = fact.select("ticket_id", "resolution_target_met")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_policies_join_on_a_key(spark):
    fact = model.from_tables(spark, SMOKE_DIR).fact
    plan = sla.with_targets(fact, sla.constant_policies(spark))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# --- heavy hitters -----------------------------------------------------------

def skewed(spark, n=20_000):
    """A few heavy values, many rare ones, NULLs."""
    i = F.col("id")
    return spark.range(n).select(F.when(i % 11 == 0, F.lit(None)).when(i % 3 == 0, F.concat(F.lit("hot"), i % 5))
                                 .otherwise(F.concat(F.lit("rare"), F.xxhash64("id"))).alias("v"), "id").repartition(5)


def exact(df, n):
    return df.filter("v is not null").groupBy("v").agg(F.count("*").alias("rows")) \
        .orderBy(F.desc("rows"), "v").limit(n).collect()


def test_top_n_by_summary_is_exact_and_counts_candidates_only(spark):
    df = skewed(spark)
    assert sketches.top_n_by_summary(df, "v", 5, tracked=64).collect() == exact(df, 5)
    known = sketches.heavy_candidates(df, "v", 64).first()
    assert len(known.candidates) <= 64 < df.select("v").distinct().count()
    bound = 3.5 * known.rows / 128
    assert all(r.v in known.candidates for r in df.groupBy("v").count().filter(F.col("count") > bound).collect() if r.v)


def test_flat_data_is_counted_whole(spark):
    df = spark.range(5000).select(F.concat(F.lit("v"), F.col("id") % 2500).alias("v"))
    assert sketches.top_n_by_summary(df, "v", 7, tracked=16).collect() == exact(df, 7)
    assert sketches.top_n_by_summary(df, "v", 5000, tracked=16).count() == 2500
    assert sketches.top_n_by_summary(df.limit(0), "v", 7).collect() == []
    assert sketches.top_n_by_summary(df.select(F.lit(None).cast("string").alias("v")), "v", 7).collect() == []


# --- quantiles, distinct counts ------------------------------------------------

def test_merged_quantiles_keep_the_rank_error(spark):
    df = spark.range(60_000).select((F.pmod(F.xxhash64("id"), F.lit(10**6)) / 7.0).alias("x"), (F.col("id") % 24).alias("month"),
                                    F.lit("a").alias("g")).repartition(9)
    stored_sketches = sketches.quantile_sketches(df, F.col("x"), "g", "month")
    values = sorted(r.x for r in df.collect())
    for r in sketches.merged_quantiles(stored_sketches, (0.01, 0.25, 0.5, 0.9, 0.99), "g").collect():
        rank = sum(v <= r.value for v in values) / len(values)
        assert r.n == 60_000 and abs(rank - r.probability) <= sketches.RANK_ERROR


def test_merged_distinct_counts_keep_the_error(spark):
    df = spark.range(50_000).select((F.col("id") % 30_000).alias("a"), (F.col("id") % 17).alias("b"), (F.col("id") % 4).alias("run"))
    runs = sketches.distinct_sketches(df, {"many": "a", "few": "b"}, "run")
    got = {r.metric: r.estimate for r in sketches.merged_distinct(runs, "metric").collect()}
    assert got["few"] == 17 and abs(got["many"] / 30_000 - 1) <= sketches.DISTINCT_ERROR


def test_runs_leave_mergeable_sketches(spark, star):
    rows = spark.read.parquet(f"{star.folder}/run_sketches")
    got = {r.metric: r.estimate for r in sketches.merged_distinct(rows.unionAll(rows), "metric").collect()}
    assert set(got) == set(star.dimensions)
    for t, dim in star.dimensions.items():
        assert abs(got[t] / dim.count() - 1) <= sketches.DISTINCT_ERROR


# --- quarantine ----------------------------------------------------------------

def test_every_violation_appears_once_per_reason(spark, star):
    dirty = catalog._dirty(star.fact)
    bad_dim = star.tables["dim_agents"].unionAll(spark.createDataFrame(
        [(1, "again"), (9001, "n" * 121), (None, "no key"), (9002, None)], "agent_id long, agent_name string"))
    dims = star.dimensions | {"dim_agents": bad_dim}
    found = quarantine.star_rows(dirty, dims)
    assert found.count() == found.select("table_name", "column_name", "reason", "key", "row").distinct().count() \
        + dirty.count() - dirty.distinct().count()      # planted copies are equal rows
    counts = {(r.table_name, r.column_name, r.reason): r.violations for r in quarantine.as_counts(found).collect()}
    checks = {}
    for reason, rows in (("duplicate", quality.check_unique(dirty, dims)), ("missing", quality.check_not_null(dirty, dims)),
                         ("no dimension row", quality.check_foreign_keys(dirty, dims))):
        checks |= {(r.table_name, r.column_name, reason): r.violations for r in rows.collect() if r.violations}
    lengths = {("fact_tickets", "category", "too long"): dirty.filter(F.length("category") > 60).count(),
               ("dim_agents", "agent_name", "too long"): 1}
    assert {k: v for k, v in counts.items() if k[2] not in ("too long", "out of range")} == checks
    assert {k: v for k, v in counts.items() if k[2] == "too long"} == lengths and len(checks) >= 5


def test_a_clean_star_has_no_rows(star):
    assert quarantine.star_rows(star.fact, star.dimensions).isEmpty()


def test_hours_out_of_range(spark):
    fact = spark.createDataFrame([(1, 1e9), (2, 5.0), (3, None)], "ticket_id long, resolution_duration_hours double") \
        .select("*", *[F.lit(None).cast("string").alias(c) for c in ("category", "priority", "status")])
    rows = quarantine.fact_rows(fact, {}).collect()
    assert [(r.column_name, r.reason, r.key) for r in rows] == [("resolution_duration_hours", "out of range", "1")]


# --- headers -------------------------------------------------------------------

def csv_folder(spark, scratch_dir, files):
    import os
    folder = scratch(spark, "csv")
    local = folder[len("file:"):] if folder.startswith("file:") else folder
    os.makedirs(local)
    for name, text in files.items():
        with open(f"{local}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    return folder


def line(values):
    return ",".join("" if v is None else v for v in values)


def test_malformed_lines_are_kept_with_their_text(spark, scratch_dir):
    good = [issue(i, "2024-01-01 10:00:00") for i in range(3)]
    header = ",".join(ISSUE_COLS)
    short, long = line(good[0])[:-3], line(good[1]) + ",extra"
    folder = csv_folder(spark, scratch_dir, {"a.csv": "\n".join([header, line(good[0]), short]),
                                             "b c.csv": "\n".join([header + ",more", line(good[2]) + ",x", long, long + ",y"])})
    rows = scan.read_csv_text(spark, folder, ISSUES_SCHEMA, corrupt="_line")
    bad = quarantine.malformed_rows(rows, "issues", "id", "_line").collect()
    assert sorted(r.row for r in bad) == sorted([short, long + ",y"]) and {r.reason for r in bad} == {"malformed"}
    assert [r._line is None for r in rows.select("id", "_line").collect()].count(True) == 3


def test_headers_of_many_files_are_found_by_one_job(spark, scratch_dir):
    header = ",".join(ISSUE_COLS)
    files = {f"f{i:04}.csv": "\n".join([header if i % 7 else ",".join(reversed(ISSUE_COLS)),
                                        *[line(issue(i, "2024-01-01 10:00:00") if i % 7 else issue(i, "x")[::-1])] * 3])
             for i in range(600)}
    folder = csv_folder(spark, scratch_dir, files | {"empty.csv": ""})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        groups = scan._headers(spark, folder)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(map(len, groups.values())) == [86, 514]
    assert len(tracker.getJobIdsForGroup("headers")) <= 2      # listing and the first lines
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(1 << 50)
    assert scan.read_issues_csv(spark, folder).select("id").distinct().count() == 600


def test_a_header_task_reads_the_first_lines_only(spark, scratch_dir):
    header = ",".join(ISSUE_COLS)
    big = "\n".join([header, *[line(issue(i, "2024-01-01 10:00:00")) for i in range(60_000)]])
    folder = csv_folder(spark, scratch_dir, {"big.csv": big})
    t = dt.datetime.now()
    assert list(scan._headers(spark, folder)) == [tuple(ISSUE_COLS)]
    assert (dt.datetime.now() - t).total_seconds() < 5
