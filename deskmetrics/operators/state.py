"""Current ticket state rebuilt from the change log.

"Latest" is the greatest ``(created, id, value)``: stamps are cut to whole
seconds before ordering, so ties on ``created`` are common and need the log
row id (and value, since ids repeat in some extracts) to be total.

Both operators are aggregations, not windows: partial aggregation map-side
keeps a ticket with a huge history from landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE_FIELDS = ("assignee", "status")


def _order_key(*carried: str):
    return F.struct("created", "id", "value", *carried)


def latest_change_per_field(changes: DataFrame, by: tuple[str, ...] = ("issueid",)) -> DataFrame:
    """The newest log row per (ticket, field), all its columns.  ``by`` names
    the ticket id and what the rows are partitioned by."""
    rest = [c for c in changes.columns if c not in (*by, "field", "created", "id", "value")]
    last = _order_key(*rest)
    return (changes.groupBy(*by, "field")
            .agg(F.max(last).alias("_last"))
            .select(*by, "field",
                    *[F.col(f"_last.{c}").alias(c) for c in ("id", "value", "created", *rest)]))


def current_state(changes: DataFrame, by: tuple[str, ...] = ("issueid",), carried: tuple[str, ...] = ()) -> DataFrame:
    """Latest assignee (with its stamp) and latest status per ticket, in one
    pass and one shuffle instead of a window, two filters and two joins.

    A cleared assignee (NULL value) stays NULL here; the fact falls back to
    the ticket's own assignee later.  ``carried`` columns are those of the
    latest assignee's row.
    """
    field = F.col("field")
    return (changes.filter(field.isin(*STATE_FIELDS))
            .groupBy(*by)
            .agg(F.max(F.when(field == "assignee", _order_key(*carried))).alias("_a"),
                 F.max(F.when(field == "status", _order_key())).alias("_s"))
            .select(*by,
                    F.col("_a.value").alias("current_assignee"),
                    F.col("_a.created").alias("last_assigned_at"),
                    F.col("_s.value").alias("current_status"),
                    *[F.col(f"_a.{c}").alias(c) for c in carried]))


def attach_state(tickets: DataFrame, state: DataFrame, ticket_id: str = "id", within: tuple[str, ...] = ()) -> DataFrame:
    """Tickets LEFT JOIN their current state (at most one row per ticket).
    ``within`` names columns of both sides that follow from the id."""
    same = tickets[ticket_id] == state["issueid"]
    for c in within:
        same = (tickets[c] == state[c]) & same
    return tickets.join(state, same, "left").drop(state["issueid"], *[state[c] for c in within])
