"""Ticket cleaning: stamp parsing, the invalid-resolution rule, de-duplication
(P1-P4, W3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import parse_timestamp
from ..schemas import ISSUE_TIMESTAMP_COLUMNS


def parse_issue_stamps(issues: DataFrame) -> DataFrame:
    """The three stamp columns of the tickets, parsed in one projection."""
    return issues.withColumns({c: parse_timestamp(c) for c in ISSUE_TIMESTAMP_COLUMNS})


def parse_change_stamps(changes: DataFrame) -> DataFrame:
    return changes.withColumn("created", parse_timestamp("created"))


def _resolved_before_created():
    res, created = F.col("issue_resolution_date"), F.col("issue_created")
    return res.isNotNull() & (res < created)


def invalid_resolution_counts(parsed: DataFrame) -> DataFrame:
    """One row: tickets resolved before they were created, and resolved
    tickets without a creation stamp (dropped by the filter too, but not part
    of the first number)."""
    res, created = F.col("issue_resolution_date"), F.col("issue_created")
    return parsed.agg(
        F.count_if(_resolved_before_created()).alias("invalid_rows"),
        F.count_if(res.isNotNull() & created.isNull()).alias("resolved_without_created"),
    )


def valid_issues(parsed: DataFrame) -> DataFrame:
    """Keep unresolved tickets and tickets resolved at or after creation."""
    res, created = F.col("issue_resolution_date"), F.col("issue_created")
    return parsed.filter(res.isNull() | (res >= created))


def row_hash(valid: DataFrame) -> Column:
    """The last part of the order of picks: a hash of the whole row."""
    return F.xxhash64(*valid.columns)


def pick_order(valid: DataFrame, created: str = "issue_created", hashed: str | None = None) -> list[Column]:
    """The order of a ticket's rows; the first one is picked."""
    return [F.col(created).asc_nulls_first(), F.col("last_change_date").desc_nulls_last(),
            (F.col(hashed) if hashed else row_hash(valid)).asc()]


def dedup_tickets(valid: DataFrame, by: tuple[str, ...] = ("id",), created: str = "issue_created",
                  hashed: str | None = None) -> DataFrame:
    """One row per ticket id: the earliest ``issue_created`` (a NULL stamp
    sorts first), then the latest ``last_change_date``, then a hash of the
    whole row, so the pick does not depend on partitioning.

    Planned as a per-id top-1 (``WindowGroupLimit`` partial before the
    shuffle, final after), so a hot id is cut down map-side.  Rows that were
    derived from tickets name their columns: ``by`` (the id, and what the rows
    are partitioned by), ``created`` and the ``hashed`` ticket row.
    """
    order = Window.partitionBy(*by).orderBy(*pick_order(valid, created, hashed))
    return (valid.withColumn("_rn", F.row_number().over(order))
            .filter(F.col("_rn") == 1).drop("_rn"))
