"""The chain from raw extracts to the ticket fact, as lazy DataFrames.

Order of work (each step is a plain DataFrame operator):

    scan -> parse stamps -> drop invalid resolutions -> de-duplicate
         -> LEFT JOIN current state (rebuilt from the change log) -> fact

De-duplication runs before the state join (the reference joins first): the
state side has at most one row per ticket and the pick only looks at ticket
columns, so the result is the same, and both sides then arrive hash
partitioned on the ticket id, so the join needs no further shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators import clean, fact, quality, state
from ..session import prepare
from ..sources import fixture, scan


@dataclass(frozen=True)
class TicketModel:
    issues: DataFrame          # typed scan, stamps still text
    changes: DataFrame         # typed scan, stamps still text
    parsed: DataFrame          # tickets with parsed stamps
    changes_parsed: DataFrame  # change log with parsed stamps
    valid: DataFrame           # invalid resolutions removed
    deduped: DataFrame         # one row per ticket id
    state: DataFrame           # current assignee / status per ticket
    fact: DataFrame            # 15-column ticket fact


def from_scans(issues: DataFrame, changes: DataFrame, counters: Observation | None = None) -> TicketModel:
    """``counters`` collects the counts of the parsed tickets in the next action."""
    parsed = clean.parse_issue_stamps(issues)
    if counters is not None:
        parsed = parsed.observe(counters, *[c.alias(name) for name, c in quality.ticket_counters().items()])
    changes_parsed = clean.parse_change_stamps(changes)
    valid = clean.valid_issues(parsed)
    deduped = clean.dedup_tickets(valid)
    current = state.current_state(changes_parsed)
    facts = fact.fact_tickets(state.attach_state(deduped, current))
    return TicketModel(issues, changes, parsed, changes_parsed, valid, deduped, current, facts)


def from_tables(spark: SparkSession, sf_dir: str) -> TicketModel:
    """Tickets derived from the driver's tables (see ``sources.fixture``)."""
    prepare(spark)
    return from_scans(scan.scan_issues(fixture.raw_issues(spark, sf_dir)),
                      scan.scan_changes(fixture.raw_changes(spark, sf_dir)))


def from_csv(spark: SparkSession, issues_path: str, changes_path: str) -> TicketModel:
    """Tickets from the two CSV extracts, as the reference reads them."""
    prepare(spark)
    return from_scans(scan.read_issues_csv(spark, issues_path),
                      scan.read_changes_csv(spark, changes_path))
