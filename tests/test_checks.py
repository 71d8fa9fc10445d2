"""The data-quality checks find planted violations (and report zeros
otherwise)."""

from __future__ import annotations

from deskmetrics.operators import quality

WFACT = ("ticket_id long, customer_id long, agent_id long, project_id long, "
         "category string, resolution_duration_hours double")


def as_dict(df):
    return {(r.table_name, r.column_name): r.violations for r in df.collect()}


def frames(spark):
    wfact = spark.createDataFrame([
        (1, 1, 1, 1, "Bug", 1.0),
        (1, 1, 1, 1, "Bug", 2.0),          # duplicate ticket id
        (2, None, 9, 1, "x" * 61, 1e9),    # orphan agent key, long category, huge hours
        (None, 1, None, 1, "Bug", None),   # NULL ticket id
    ], WFACT)
    dims = {
        "dim_customers": spark.createDataFrame([(1, "r1")], "customer_id long, reporter_name string"),
        "dim_agents": spark.createDataFrame([(1, "a1"), (2, "a1"), (3, None)],
                                            "agent_id long, agent_name string"),
        "dim_projects": spark.createDataFrame([(1, "p" * 121)], "project_id long, project_name string"),
    }
    return wfact, dims


def test_unique_not_null_and_foreign_keys(spark):
    wfact, dims = frames(spark)
    uniq = as_dict(quality.check_unique(wfact, dims))
    assert uniq[("fact_tickets", "ticket_id")] == 1
    assert uniq[("dim_agents", "agent_name")] == 1
    assert uniq[("dim_customers", "customer_id")] == 0
    nulls = as_dict(quality.check_not_null(wfact, dims))
    assert nulls[("fact_tickets", "ticket_id")] == 1
    assert nulls[("dim_agents", "agent_name")] == 1
    fks = as_dict(quality.check_foreign_keys(wfact, dims))
    assert fks == {("fact_tickets", "customer_id"): 0, ("fact_tickets", "agent_id"): 1,
                   ("fact_tickets", "project_id"): 0}


def test_bounds(spark):
    wfact, dims = frames(spark)
    fact = wfact.selectExpr("category", "'High' as priority", "'Open' as status",
                            "resolution_duration_hours")
    perf = spark.createDataFrame([(100.0,), (1000.0,)], "compliance_rate double")
    trends = spark.createDataFrame([(12345.0,)], "volume_change_pct double")
    agents = spark.createDataFrame([(5.0,)], "avg_resolution_duration_hours double")
    got = as_dict(quality.check_bounds(fact, dims, perf, trends, agents))
    assert got[("fact_tickets", "category")] == 1
    assert got[("fact_tickets", "resolution_duration_hours")] == 1
    assert got[("dim_projects", "project_name")] == 1
    assert got[("resolution_performance", "compliance_rate")] == 1
    assert got[("category_trends", "volume_change_pct")] == 0   # fits DECIMAL(12,2)
    assert got[("agent_performance", "avg_resolution_duration_hours")] == 0
