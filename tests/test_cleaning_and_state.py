"""Hand-made edge rows for the cleaning chain and the current state."""

from __future__ import annotations

from conftest import change, issue, raw_frames, ts
from deskmetrics.operators import clean
from deskmetrics.plans.model import from_scans
from deskmetrics.sources.scan import scan_changes, scan_issues


def model_of(spark, issues, changes=()):
    raw_i, raw_c = raw_frames(spark, list(issues), list(changes))
    return from_scans(scan_issues(raw_i), scan_changes(raw_c))


def test_invalid_resolution_rule(spark):
    m = model_of(spark, [
        issue(1, "2020-01-02 00:00:00", "2020-01-01 00:00:00"),  # resolved before created
        issue(2, None, "2020-01-01 00:00:00"),                   # resolved, no creation stamp
        issue(3, "2020-01-01 00:00:00", "2020-01-01 00:00:00"),  # resolved at creation
        issue(4, "2020-01-01 00:00:00", None),                   # unresolved
    ])
    counts = clean.invalid_resolution_counts(m.parsed).first()
    assert (counts.invalid_rows, counts.resolved_without_created) == (1, 1)
    assert sorted(r.id for r in m.valid.collect()) == [3, 4]
    fact = {r.ticket_id: r for r in m.fact.collect()}
    assert fact[3].resolution_duration_hours == 0.0
    assert fact[4].resolution_duration_hours is None and fact[4].resolution_target_met is None


def test_dedup_rules(spark):
    m = model_of(spark, [
        # duplicate: earliest created kept
        issue(1, "2020-01-02 00:00:00", reporter="late"),
        issue(1, "2020-01-01 00:00:00", reporter="early"),
        # duplicate whose earliest copy is invalid: the later copy survives
        issue(2, "2020-01-01 00:00:00", "2019-12-31 00:00:00", reporter="invalid"),
        issue(2, "2020-01-05 00:00:00", reporter="valid"),
        # duplicate, one created stamp NULL (both unresolved): NULL copy wins
        issue(3, "2020-01-01 00:00:00", reporter="stamped"),
        issue(3, None, reporter="unstamped"),
    ])
    got = {r.ticket_id: r.reporter for r in m.fact.collect()}
    assert got == {1: "early", 2: "valid", 3: "unstamped"}


def test_state_rules(spark):
    m = model_of(spark, [
        issue(1, "2020-01-01 00:00:00", assignee="csv_agent", status="Open"),
        issue(2, "2020-01-01 00:00:00", assignee="csv_agent", status="Open"),
        issue(3, "2020-01-01 00:00:00", assignee="csv_agent", status="Open"),
    ], [
        # two log rows in one second (fractions are cut): the larger id wins
        change(7, 1, "assignee", "agent_seven", "2020-02-01 10:00:00.900000"),
        change(9, 1, "assignee", "agent_nine", "2020-02-01 10:00:00.100000"),
        change(5, 1, "status", "Resolved", "2020-02-02 00:00:00+00:00"),
        # latest assignee value NULL: falls back to the ticket's own assignee
        change(1, 2, "assignee", "someone", "2020-02-01 00:00:00"),
        change(2, 2, "assignee", None, "2020-02-03 00:00:00"),
    ])
    fact = {r.ticket_id: r for r in m.fact.collect()}
    assert fact[1].assignee == "agent_nine" and fact[1].status == "Resolved"
    assert fact[2].assignee == "csv_agent"
    assert fact[3].status is None  # no status history: NULL, not the CSV value
    state = {r.issueid: r for r in m.state.collect()}
    assert state[1].last_assigned_at.replace(tzinfo=None) == ts("2020-02-01 10:00:00")
    assert state[2].current_assignee is None


def test_unknown_and_null_priority(spark):
    m = model_of(spark, [
        issue(1, "2020-01-01 00:00:00", "2020-01-01 01:00:00", priority=" blocker "),
        issue(2, "2020-01-01 00:00:00", "2020-01-01 01:00:00", priority=None),
    ])
    fact = {r.ticket_id: r for r in m.fact.collect()}
    assert (fact[1].priority, fact[1].priority_flag, fact[1].resolution_target_met) == (
        "Blocker", "UNRECOGNIZED_PRIORITY", None)
    assert (fact[2].priority, fact[2].priority_flag, fact[2].resolution_target_met) == (
        None, None, None)


def test_empty_inputs_keep_schemas(spark):
    from deskmetrics.operators import marts
    from deskmetrics.plans import reports
    m = model_of(spark, [])
    assert m.fact.count() == 0
    assert len(m.fact.columns) == 15
    assert reports.sla_by_priority(m.fact).count() == 0
    assert marts.category_trends(m.fact).count() == 0
    from deskmetrics.operators import quality
    counts = {r.metric: r.value for r in quality.quality_counts(m.parsed, m.changes, m.fact).collect()}
    assert len(counts) == 8 and set(counts.values()) == {0}
