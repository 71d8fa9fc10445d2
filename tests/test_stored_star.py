"""Reports, tiles and checks on the stored star."""

from __future__ import annotations

import os
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from deskmetrics.plans import dashboard, extras, model, pipeline, reports, stored
from deskmetrics.operators import marts
from deskmetrics.session import scratch, staged


@pytest.fixture(scope="module")
def star(spark):
    return stored.for_tables(spark, SMOKE_DIR)


@pytest.fixture(scope="module")
def in_flight(spark):
    return staged(model.from_tables(spark, SMOKE_DIR).fact, scratch(spark, "fact"))


REPORTS = {"sla_by_priority": (), "top_agents_last_month": ("assignee",), "avg_resolution_by_project": ("project",),
           "agent_rank_by_speed": ("assignee",), "heavy_reporters": ("reporter",), "running_resolved_total": (),
           "zero_compliance_categories": (), "zero_compliance_categories_anti": (),
           "resolution_stats_by_priority": (), "status_distribution": (),
           "fastest_agent_per_project": ("assignee", "project")}
TILES = {"kpi_overall_compliance": (), "top_category": (), "kpi_total_tickets": (), "tickets_by_status": (),
         "tickets_by_priority": (), "tickets_by_category": (), "tickets_per_month": (), "avg_hours_by_priority": (),
         "target_met_split": (), "top_projects": ("project",), "compliance_by_priority_all": (),
         "monthly_compliance_trend": (), "top_agents_by_tickets": ("assignee",),
         "top_n_by_count_tiles": ("project",), "top_agents_avg_hours": ("assignee",), "category_month_heatmap": (),
         "category_month_heatmap_wide": ()}


@pytest.mark.parametrize("name", REPORTS)
def test_reports_equal_the_in_flight_form(star, in_flight, name):
    report = getattr(reports, name)
    assert report(stored.with_names(star, *REPORTS[name])).collect() == report(in_flight).collect()


@pytest.mark.parametrize("name", TILES)
def test_tiles_equal_the_in_flight_form(star, in_flight, name):
    tile = getattr(dashboard, name)
    a = tile(dashboard.display_frame(stored.with_names(star, *TILES[name]))).collect()
    b = tile(dashboard.display_frame(in_flight)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


ORDERS = {"sla_by_priority": lambda r: (r.priority is None, r.priority or ""),
          "top_agents_last_month": lambda r: (-r.tickets_resolved, r.agent_name),
          "avg_resolution_by_project": lambda r: (r.avg_resolution_hours, r.project_name),
          "agent_rank_by_speed": lambda r: (r.rank_by_speed, r.agent_name),
          "heavy_reporters": lambda r: (-r.ticket_count, r.reporter_name),
          "running_resolved_total": lambda r: r.month, "zero_compliance_categories": lambda r: r.category,
          "resolution_stats_by_priority": lambda r: r.avg_resolution_hours,
          "status_distribution": lambda r: (-r.ticket_count, r.status),
          "fastest_agent_per_project": lambda r: (r.project_name, r.agent_name)}


@pytest.mark.parametrize("name", ORDERS)
def test_reports_come_in_their_order(star, name):
    rows = getattr(reports, name)(stored.with_names(star, *REPORTS[name])).collect()
    assert rows == sorted(rows, key=ORDERS[name])


def test_month_tiles_come_in_month_order(star):
    d = dashboard.display_frame(star.fact)
    for tile in (dashboard.tickets_per_month, dashboard.monthly_compliance_trend):
        months = [r.ym for r in tile(d).collect()]
        assert months == sorted(months) and len(months) == 20


def test_views_hold_all_rows(spark, star):
    stored.create_views(star)
    assert spark.table("view_avg_resolution_by_project").count() == \
        stored.with_names(star, "project").filter("project is not null and resolution_duration_hours is not null") \
        .select("project").distinct().count()
    assert spark.table("view_status_distribution").agg(F.sum("ticket_count")).first()[0] == \
        star.fact.filter("status is not null").count()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_filters_reach_the_scan(star):
    for report, column in ((reports.top_agents_last_month, "resolution_time"),
                           (reports.zero_compliance_categories, "start_time")):
        df = report(stored.with_names(star, "assignee"))
        plan = _plan(df)
        filters = [part for part in plan.split("DataFilters: ")[1:] if f"{column}" in part.split("]")[0]]
        assert any(">=" in f.split("Format:")[0] for f in filters), plan


def test_agents_never_meet_in_one_task(in_flight):
    """Only aggregates of a fixed or slowly growing size go through one task."""
    ranked = _plan(marts.agent_rank_by_volume(in_flight))
    spread = _plan(extras.agent_workload_spread(in_flight))
    for plan in (ranked, spread):
        for part in plan.split("Exchange SinglePartition")[1:]:
            assert "agent_name" not in part.split("Scan")[0] and "assignee" not in part.split("Scan")[0]


def test_a_new_file_is_seen(spark, scratch_dir):
    """Doubling the orders between two calls doubles the tickets read."""
    from deskmetrics.plans.catalog import QUERIES
    folder = f"{scratch_dir}/tables-{uuid.uuid4().hex[:8]}"
    for t in ("orders", "lineitem", "customer", "supplier", "nation", "part"):
        os.makedirs(f"{folder}/{t}.parquet")
        shutil.copyfile(f"{SMOKE_DIR}/{t}.parquet", f"{folder}/{t}.parquet/part-0.parquet")
    read = lambda: {r.source: r.rows for r in QUERIES["input_counts"](spark, folder).collect()}["issues"]
    tiles = lambda: QUERIES["kpi_total_tickets"](spark, folder).collect()[0][0]
    before, shown = read(), tiles()
    more = spark.read.parquet(f"{SMOKE_DIR}/orders.parquet").withColumn("o_orderkey", F.col("o_orderkey") + 10**7)
    more.coalesce(1).write.mode("append").parquet(f"{folder}/orders.parquet")
    assert read() > 1.9 * before and tiles() > 1.9 * shown


def test_means_do_not_depend_on_partitioning(spark, in_flight):
    """Fractions of hours in any layout give the same bits."""
    seen = set()
    for n in (1, 7, 200):
        rows = in_flight.repartition(n)
        d = dashboard.display_frame(rows)
        seen.add(str([sorted(map(str, df.collect())) for df in (
            dashboard.avg_hours_by_priority(d), dashboard.top_agents_avg_hours(d), marts.agent_volume(rows),
            marts.category_trends_with_hours(rows), extras.agent_monthly_hours(rows))]))
    assert len(seen) == 1
    assert in_flight.filter("resolution_duration_hours <> floor(resolution_duration_hours)").count() > 500


def test_dimensions_grow_with_the_tables(spark, star):
    assert star.tables["dim_customers"].count() > 90       # more than the 10 heavy reporters
    assert star.tables["dim_agents"].count() > 7


def test_counters_equal_the_query(spark, star):
    from deskmetrics.operators import quality
    m = model.from_tables(spark, SMOKE_DIR)
    counted = {r.metric: r.value for r in quality.quality_counts(m.parsed, m.changes, m.fact).collect()}
    assert counted == {r.metric: r.value for r in star.tables["run_metrics"].collect()}


def test_a_curated_folder_opens(spark, scratch_dir, star):
    out = f"{scratch_dir}/curated-{uuid.uuid4().hex[:8]}"
    m = model.from_tables(spark, SMOKE_DIR)
    pipeline.run(spark, m.issues, m.changes, out)
    opened = stored.open_star(spark, out)
    for name, table in star.tables.items():
        assert opened.tables[name].schema == table.schema
        assert opened.tables[name].exceptAll(table).count() == 0 == table.exceptAll(opened.tables[name]).count()


def test_staged_fact_is_removed(spark, scratch_dir):
    issues, changes = (model.from_tables(spark, SMOKE_DIR).issues, model.from_tables(spark, SMOKE_DIR).changes)
    before = {p for p in os.listdir(scratch_dir) if p.startswith("fact-")}
    pipeline.run(spark, issues, changes, f"{scratch_dir}/curated-{uuid.uuid4().hex[:8]}")
    assert {p for p in os.listdir(scratch_dir) if p.startswith("fact-")} == before
