"""Marts, reports and dashboard tiles on hand-made facts, plus invariants on
the driver's sf0.001 tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from deskmetrics.operators import marts
from deskmetrics.plans import dashboard, model, reports
from deskmetrics.schemas import FACT_COLUMNS

FACT_DDL = ("ticket_id long, reporter string, assignee string, project string, category string, "
            "priority string, start_time timestamp, resolution_time timestamp, "
            "resolution_duration_hours double, status string, resolution_target_met boolean, "
            "priority_flag string, issue_contr_count int, processing_steps int, wf_total_time long")


def fact_of(spark, rows):
    """rows: dicts with any subset of the fact columns."""
    full = [tuple(r.get(c) for c in FACT_COLUMNS) for r in rows]
    return spark.createDataFrame(full, FACT_DDL)


def d(y, m, day=1):
    return dt.datetime(y, m, day)


def test_month_over_month_uses_previous_present_month(spark):
    rows = ([{"ticket_id": i, "category": "Bug", "start_time": d(2020, 1, 2)} for i in range(2)]
            + [{"ticket_id": 10 + i, "category": "Bug", "start_time": d(2020, 3, 2)} for i in range(3)])
    got = {r.month.month: r.volume_change_pct
           for r in marts.category_trends(fact_of(spark, rows)).collect()}
    assert got == {1: None, 3: 50.0}


def test_compliance_null_only_in_resolution_mart(spark):
    rows = [{"ticket_id": 1, "priority": "Blocker", "start_time": d(2020, 1, 1),
             "resolution_time": d(2020, 1, 2), "resolution_duration_hours": 24.0,
             "resolution_target_met": None}]
    f = fact_of(spark, rows)
    assert marts.resolution_performance(f).first().compliance_rate is None
    r1 = reports.sla_by_priority(f).first()
    assert (r1.total_tickets, r1.met_target, r1.compliance_rate_pct) == (1, 0, 0.0)


def test_rank_ties_kept_and_mode_smallest(spark):
    rows = [
        {"ticket_id": 1, "project": "P", "assignee": "x", "resolution_duration_hours": 5.0,
         "category": "a", "resolution_time": d(2020, 1, 2), "start_time": d(2020, 1, 1)},
        {"ticket_id": 2, "project": "P", "assignee": "y", "resolution_duration_hours": 5.0,
         "category": "a", "resolution_time": d(2020, 1, 2), "start_time": d(2020, 1, 1)},
        {"ticket_id": 3, "project": "P", "assignee": "z", "resolution_duration_hours": 9.0,
         "category": "b", "resolution_time": d(2020, 1, 2), "start_time": d(2020, 1, 1)},
        {"ticket_id": 4, "category": "b", "start_time": d(2020, 1, 1)},
    ] + [{"ticket_id": 10 + i, "category": None, "start_time": d(2020, 1, 1)} for i in range(3)]
    f = fact_of(spark, rows)
    fastest = sorted((r.project_name, r.agent_name) for r in reports.fastest_agent_per_project(f).collect())
    assert fastest == [("P", "x"), ("P", "y")]
    ranks = {r.agent_name: r.rank_by_speed for r in reports.agent_rank_by_speed(f).collect()}
    assert ranks == {"x": 1, "y": 1, "z": 3}
    assert dashboard.top_category(dashboard.display_frame(f)).first().top_category == "a"


def test_heatmap_wide_and_long_agree(spark):
    m = model.from_tables(spark, SMOKE_DIR)
    disp = dashboard.display_frame(m.fact)
    wide = dashboard.category_month_heatmap_wide(disp)
    months = [c for c in wide.columns if c != "category"]
    assert 0 < len(months) <= 12
    long_from_wide = wide.unpivot("category", months, "ym", "ticket_count")
    long = dashboard.category_month_heatmap(disp)
    assert long.exceptAll(long_from_wide).count() == 0
    assert long_from_wide.exceptAll(long).count() == 0


@pytest.fixture(scope="module")
def smoke(spark):
    return model.from_tables(spark, SMOKE_DIR)


def test_r7_forms_agree(smoke):
    a = reports.zero_compliance_categories(smoke.fact)
    b = reports.zero_compliance_categories_anti(smoke.fact)
    assert sorted(a.collect()) == sorted(b.collect())


def test_window_form_equals_aggregate_form(smoke):
    """Literal row_number form of the latest-change rule == the aggregate."""
    from pyspark.sql import Window
    from deskmetrics.operators.state import latest_change_per_field
    ch = smoke.changes_parsed
    w = Window.partitionBy("issueid", "field").orderBy(
        F.col("created").desc_nulls_last(), F.col("id").desc_nulls_last(),
        F.col("value").desc_nulls_last(), F.col("change_group_id").desc_nulls_last())
    literal = (ch.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
               .select("issueid", "field", "id", "value", "created", "change_group_id"))
    agg = latest_change_per_field(ch)
    assert literal.exceptAll(agg).count() == 0 and agg.exceptAll(literal).count() == 0


def test_dedup_first_equals_dedup_last(smoke):
    """Joining the state before or after de-duplication gives the same fact."""
    from deskmetrics.operators import clean, fact, state
    late = fact.fact_tickets(clean.dedup_tickets(state.attach_state(smoke.valid, smoke.state)))
    assert late.exceptAll(smoke.fact).count() == 0 and smoke.fact.exceptAll(late).count() == 0


def test_marts_reconcile_with_fact(smoke):
    f = smoke.fact
    resolved = f.filter("resolution_time is not null").count()
    assert marts.agent_volume(f).agg(F.sum("tickets_resolved")).first()[0] == resolved
    assert marts.resolution_performance(f).agg(F.sum("tickets_resolved")).first()[0] == resolved
    assert marts.category_monthly_volume(f).agg(F.sum("ticket_volume")).first()[0] == f.count()
    assert f.select("ticket_id").distinct().count() == f.count()


def test_sf001_counts_match_the_fixture_notes(spark):
    """Figures recorded for the sf0.01 ticket view in FIXTURES.md."""
    from conftest import CHECK_DIR
    from deskmetrics.operators import clean
    m = model.from_tables(spark, CHECK_DIR)
    assert clean.invalid_resolution_counts(m.parsed).first().invalid_rows == 310
    assert m.fact.count() == 14741
    assert m.fact.filter("resolution_time is null").count() == 5141
    groups = (m.fact.filter("reporter is not null")
              .groupBy("reporter", F.date_trunc("month", "start_time")).count()
              .filter("count > 5").count())
    assert groups == 218
    r1 = {r.priority: (r.total_tickets, r.met_target) for r in reports.sla_by_priority(m.fact).collect()}
    assert r1 == {"Critical": (1906, 8), "High": (1938, 97), "Medium": (1915, 555),
                  "Low": (1898, 1536), "Blocker": (919, 0), None: (1024, 0)}


@pytest.mark.parametrize("last, counted_month", [
    (dt.datetime(2021, 3, 31, 23, 0), 2),   # month-end: Mar 31 - 1 month clamps into February
    (dt.datetime(2021, 1, 15, 8, 0), 12),   # year boundary: December of the year before
])
def test_top_agents_last_month_window(spark, last, counted_month):
    prev = dt.datetime(last.year - (1 if counted_month == 12 else 0), counted_month, 10)
    rows = [
        {"ticket_id": 1, "assignee": "a", "start_time": prev, "resolution_time": prev},
        {"ticket_id": 2, "assignee": "a", "start_time": prev, "resolution_time": prev},
        {"ticket_id": 3, "assignee": "b", "start_time": prev, "resolution_time": prev},
        # same month as the last resolution: not counted
        {"ticket_id": 4, "assignee": "b", "start_time": last, "resolution_time": last},
        # the last resolution belongs to an unassigned ticket: still sets the window
        {"ticket_id": 5, "assignee": None, "start_time": last, "resolution_time": last},
    ]
    got = [(r.agent_name, r.tickets_resolved)
           for r in reports.top_agents_last_month(fact_of(spark, rows)).collect()]
    assert got == [("a", 2), ("b", 1)]


def test_zero_compliance_window_edges(spark):
    end = dt.datetime(2021, 6, 30, 12, 0)
    edge = end - dt.timedelta(days=30)               # inclusive bound
    rows = [
        {"ticket_id": 1, "category": "Met", "start_time": end, "resolution_target_met": True},
        {"ticket_id": 2, "category": "Edge", "start_time": edge, "resolution_target_met": False},
        {"ticket_id": 3, "category": "Unjudged", "start_time": end, "resolution_target_met": None},
        # met, but just outside the window: does not rescue the category
        {"ticket_id": 4, "category": "Unjudged", "start_time": edge - dt.timedelta(seconds=1),
         "resolution_target_met": True},
        # only outside the window: not reported at all
        {"ticket_id": 5, "category": "Old", "start_time": edge - dt.timedelta(days=1),
         "resolution_target_met": False},
    ]
    f = fact_of(spark, rows)
    got = sorted(r.category for r in reports.zero_compliance_categories(f).collect())
    assert got == ["Edge", "Unjudged"]
    assert got == sorted(r.category for r in reports.zero_compliance_categories_anti(f).collect())


def test_fastest_growing_categories_uses_each_latest_month(spark):
    from deskmetrics.plans import extras
    rows = []
    for cat, counts in {"A": (2, 4), "B": (4, 2), "C": (3, None)}.items():
        for month, n in zip((1, 2), counts):
            for i in range(n or 0):
                rows.append({"ticket_id": len(rows), "category": cat, "start_time": d(2021, month, 3)})
    got = [(r.category, r.volume_change_pct)
           for r in extras.fastest_growing_categories(fact_of(spark, rows)).collect()]
    assert got == [("A", 100.0), ("B", -50.0)]


def test_dim_date_covers_starts_and_resolutions(spark):
    from deskmetrics.plans import extras
    rows = [{"ticket_id": 1, "start_time": dt.datetime(2020, 2, 27, 9), "resolution_time": None},
            {"ticket_id": 2, "start_time": dt.datetime(2020, 2, 28, 9),
             "resolution_time": dt.datetime(2020, 3, 2, 1)}]
    got = extras.dim_date(fact_of(spark, rows)).orderBy("date").collect()
    assert [r.date_key for r in got] == [20200227, 20200228, 20200229, 20200301, 20200302]
    leap = got[2]
    assert (leap.year, leap.quarter, leap.month, leap.day, leap.day_of_week) == (2020, 1, 2, 29, 7)
    assert str(got[3].month_start) == "2020-03-01"


def test_workload_bands_use_exact_quartiles(spark):
    from deskmetrics.plans import extras
    loads = {"a": 1, "b": 2, "c": 3, "d": 4, "e": 100}
    rows = [{"ticket_id": i, "assignee": agent, "start_time": d(2021, 1, 1)}
            for i, (agent, n) in enumerate((a, n) for a, n in loads.items() for _ in range(n))]
    rows = [dict(r, ticket_id=i) for i, r in enumerate(rows)]
    got = {r.agent_name: (r.tickets, r.p25_tickets, r.p75_tickets, r.workload_band)
           for r in extras.agent_workload_spread(fact_of(spark, rows)).collect()}
    assert got == {"a": (1, 2.0, 4.0, "under"), "b": (2, 2.0, 4.0, "normal"),
                   "c": (3, 2.0, 4.0, "normal"), "d": (4, 2.0, 4.0, "normal"),
                   "e": (100, 2.0, 4.0, "over")}


def test_running_total_and_status_shares(spark):
    rows = ([{"ticket_id": i, "resolution_time": d(2021, 1, 5), "status": "Closed"} for i in range(3)]
            + [{"ticket_id": 10 + i, "resolution_time": d(2021, 4, 5), "status": "Open"} for i in range(1)]
            + [{"ticket_id": 20, "resolution_time": None, "status": None}])
    f = fact_of(spark, rows)
    got = [(r.month.month, r.monthly_resolved, r.running_total)
           for r in reports.running_resolved_total(f).orderBy("month").collect()]
    assert got == [(1, 3, 3), (4, 1, 4)]
    shares = {r.status: (r.ticket_count, r.percentage) for r in reports.status_distribution(f).collect()}
    assert shares == {"Closed": (3, 75.0), "Open": (1, 25.0)}


def test_tiles_drop_null_keys_and_empty_means(spark):
    rows = [{"ticket_id": 1, "priority": "High", "resolution_duration_hours": 10.0, "start_time": d(2021, 1, 1)},
            {"ticket_id": 2, "priority": "High", "resolution_duration_hours": 20.0, "start_time": d(2021, 2, 1)},
            {"ticket_id": 3, "priority": "Low", "resolution_duration_hours": None, "start_time": d(2021, 3, 1)},
            {"ticket_id": 4, "priority": None, "resolution_duration_hours": 99.0, "start_time": None}]
    disp = dashboard.display_frame(fact_of(spark, rows))
    assert [(r.priority, r.avg_hours) for r in dashboard.avg_hours_by_priority(disp).collect()] == [
        ("High", 15.0)]
    assert [(r.ym, r.tickets) for r in dashboard.tickets_per_month(disp, n=2).collect()] == [
        ("2021-02", 1), ("2021-03", 1)]
    assert {r.priority: r.tickets for r in dashboard.tickets_by_priority(disp).collect()} == {
        "High": 2, "Low": 1}


def test_category_trend_carries_mean_hours(spark):
    rows = [{"ticket_id": 1, "category": "Bug", "start_time": d(2021, 1, 2), "resolution_duration_hours": 1.0},
            {"ticket_id": 2, "category": "Bug", "start_time": d(2021, 1, 3), "resolution_duration_hours": 2.0},
            {"ticket_id": 3, "category": "Bug", "start_time": d(2021, 2, 3), "resolution_duration_hours": None}]
    got = {r.month.month: (r.ticket_volume, r.avg_resolution_hours, r.volume_change_pct)
           for r in marts.category_trends_with_hours(fact_of(spark, rows)).collect()}
    assert got == {1: (2, 1.5, None), 2: (1, None, -50.0)}
