"""The ticket fact (P5-P13): the cleaned, de-duplicated tickets with their
current state, standardized text, resolution hours and SLA verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    hours_between,
    priority_flag,
    standardize_category,
    standardize_priority,
    standardize_project,
    target_met,
)


def fact_tickets(tickets_with_state: DataFrame, *extra: str) -> DataFrame:
    """15 columns; tickets without status history keep a NULL status, the
    assignee falls back to the ticket's own value.  ``extra`` columns are
    passed through."""
    priority = standardize_priority("issue_priority")
    hours = hours_between("issue_created", "issue_resolution_date")
    staged = tickets_with_state.select(
        F.col("id").alias("ticket_id"),
        F.col("issue_reporter").alias("reporter"),
        F.coalesce("current_assignee", "issue_assignee").alias("assignee"),
        standardize_project("issue_proj").alias("project"),
        standardize_category("issue_type").alias("category"),
        priority.alias("priority"),
        F.col("issue_created").alias("start_time"),
        F.col("issue_resolution_date").alias("resolution_time"),
        hours.alias("resolution_duration_hours"),
        F.col("current_status").alias("status"),
        "issue_contr_count", "processing_steps", "wf_total_time", *extra,
    )
    return staged.select(
        "ticket_id", "reporter", "assignee", "project", "category", "priority",
        "start_time", "resolution_time", "resolution_duration_hours", "status",
        target_met("resolution_duration_hours", "priority").alias("resolution_target_met"),
        priority_flag("priority").alias("priority_flag"),
        "issue_contr_count", "processing_steps", "wf_total_time", *extra,
    )
