"""The ten reports (R1-R10), written against the ticket fact: the in-flight
one, or the stored star with the names each report needs (``stored``).

Reports read the hours as the warehouse stores them (DECIMAL(10,2)).  The
inner joins of the SQL originals (fact -> dimension on key -> name) are left
joins and "name is not NULL", which Spark turns into inner joins.

Top-N lists order by a full key (value, then name) so the cut is stable, and
every report returns its rows in the order of the original.  The data's last
stamp is a scalar subquery; compared with a stored column it becomes a range
filter that prunes row groups.  Ranks are taken after aggregation and, where
only the first N are wanted, after a distributed top-N.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import month_start, round2
from ..operators.star import hours_at_rest

HOURS = "resolution_duration_hours"


def at_rest(fact: DataFrame) -> DataFrame:
    """The fact with hours as stored (idempotent on stored data)."""
    return fact.withColumn(HOURS, hours_at_rest(F.col(HOURS)))


def exact_mean(c: str) -> Column:
    """Mean of a DECIMAL column without the intermediate rounding of avg()."""
    return F.try_divide(F.sum(c), F.count(c))


def mean_2dp(c: str) -> Column:
    return F.round(exact_mean(c), 2).cast("double")


def sla_by_priority(fact: DataFrame) -> DataFrame:
    """Over resolved tickets, per priority: count, met count, met %."""
    met = F.sum(F.when(F.col("resolution_target_met") == F.lit(True), 1).otherwise(0))
    total = F.count(F.lit(1))
    return (fact.filter(F.col("resolution_time").isNotNull())
            .groupBy("priority")
            .agg(total.alias("total_tickets"),
                 met.alias("met_target"),
                 round2(F.lit(100.0) * met / F.nullif(total, F.lit(0))).alias("compliance_rate_pct"))
            .orderBy(F.col("priority").asc_nulls_last()))


def top_agents_last_month(fact: DataFrame, n: int = 5, last: DataFrame | None = None) -> DataFrame:
    """R2: agents with most tickets resolved in the calendar month before
    the month of the data's last resolution (the last over all tickets).

    ``last`` is that stamp, one row; the stored star has it from file
    footers.  Without it, it is computed from the fact.  Both bounds are
    scalars of their own: only a bare scalar reaches the Parquet scan."""
    last = (fact.agg(F.max("resolution_time")) if last is None else last).toDF("last")
    begin = last.select(F.date_trunc("month", F.col("last") - F.make_ym_interval(F.lit(0), F.lit(1)))).scalar()
    end = last.select(F.date_trunc("month", "last")).scalar()
    return (fact.filter((F.col("resolution_time") >= begin)
                        & (F.col("resolution_time") < end)
                        & F.col("assignee").isNotNull())
            .groupBy(F.col("assignee").alias("agent_name"))
            .agg(F.count("ticket_id").alias("tickets_resolved"))
            .orderBy(F.col("tickets_resolved").desc(), "agent_name")
            .limit(n))


def avg_resolution_by_project(fact: DataFrame, n: int | None = 20) -> DataFrame:
    """Per project, resolved count and mean hours; fastest first.  All
    projects (the view) with ``n`` None."""
    f = at_rest(fact)
    rows = (f.filter(F.col(HOURS).isNotNull() & F.col("project").isNotNull())
            .groupBy(F.col("project").alias("project_name"))
            .agg(F.count("ticket_id").alias("total_tickets"),
                 mean_2dp(HOURS).alias("avg_resolution_hours"))
            .orderBy("avg_resolution_hours", "project_name"))
    return rows if n is None else rows.limit(n)


def agent_rank_by_speed(fact: DataFrame, n: int = 20) -> DataFrame:
    """Agents ranked by mean hours (RANK on the unrounded mean).

    The first n by (mean, name) are taken with a distributed top-N; every
    agent with a smaller mean is among them, so ranking those n rows gives
    the global rank."""
    f = at_rest(fact)
    top = (f.filter(F.col(HOURS).isNotNull() & F.col("assignee").isNotNull())
           .groupBy(F.col("assignee").alias("agent_name"))
           .agg(exact_mean(HOURS).alias("_mean"))
           .orderBy("_mean", "agent_name")
           .limit(n))
    return (top.withColumn("rank_by_speed", F.rank().over(Window.orderBy("_mean")))
            .select("agent_name", F.round("_mean", 2).cast("double").alias("avg_resolution_hours"),
                    "rank_by_speed"))


def heavy_reporters(fact: DataFrame, n: int = 20, more_than: int = 5) -> DataFrame:
    """Reporters with more than ``more_than`` tickets in one start month."""
    return (fact.filter(F.col("reporter").isNotNull())
            .groupBy(F.col("reporter").alias("reporter_name"),
                     month_start("start_time").alias("ticket_month"))
            .agg(F.count(F.lit(1)).alias("ticket_count"))
            .filter(F.col("ticket_count") > more_than)
            .orderBy(F.col("ticket_count").desc(), "reporter_name",
                     F.col("ticket_month").asc_nulls_first())
            .limit(n))


def running_resolved_total(fact: DataFrame) -> DataFrame:
    """Resolved tickets per resolution month and their running total
    (the window runs over months, not tickets)."""
    monthly = (fact.filter(F.col("resolution_time").isNotNull())
               .groupBy(month_start("resolution_time").alias("month"))
               .agg(F.count(F.lit(1)).alias("monthly_resolved")))
    upto = Window.orderBy("month").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.withColumn("running_total", F.sum("monthly_resolved").over(upto)).orderBy("month")


def _recent(fact: DataFrame, days: int, last: DataFrame | None) -> DataFrame:
    """Tickets with a category started in the data's last ``days`` days."""
    last = (fact.agg(F.max("start_time")) if last is None else last).toDF("last")
    begin = last.select(F.col("last") - F.make_dt_interval(F.lit(days))).scalar()
    return fact.filter((F.col("start_time") >= begin) & F.col("category").isNotNull())


def zero_compliance_categories(fact: DataFrame, days: int = 30, last: DataFrame | None = None) -> DataFrame:
    """Categories with tickets started in the data's last ``days`` days
    but none of them met (the NOT IN as one grouped pass over the recent
    tickets; their range filter reaches the scan of a stored fact).  ``last``
    is the data's last start, one row (see R2)."""
    met = F.max(F.when(F.col("resolution_target_met") == F.lit(True), 1))
    return (_recent(fact, days, last)
            .groupBy("category").agg(met.alias("_met"))
            .filter(F.col("_met").isNull())
            .select("category").orderBy("category"))


def zero_compliance_categories_anti(fact: DataFrame, days: int = 30,
                                    last: DataFrame | None = None) -> DataFrame:
    """R7 in its original shape (anti-join), kept as a cross-check."""
    recent = _recent(fact, days, last)
    met = recent.filter(F.col("resolution_target_met") == F.lit(True)).select("category").distinct()
    return recent.select("category").distinct().join(met, "category", "left_anti").orderBy("category")


def resolution_stats_by_priority(fact: DataFrame) -> DataFrame:
    """Mean / min / max hours and count per priority."""
    f = at_rest(fact)
    return (f.filter(F.col(HOURS).isNotNull())
            .groupBy("priority")
            .agg(mean_2dp(HOURS).alias("avg_resolution_hours"),
                 F.count(F.lit(1)).alias("total_tickets"),
                 F.min(HOURS).cast("double").alias("min_hours"),
                 F.max(HOURS).cast("double").alias("max_hours"))
            .orderBy("avg_resolution_hours", "priority"))


def status_distribution(fact: DataFrame) -> DataFrame:
    """Tickets per current status and their share of all tickets with a
    status.  The total is a window over the grouped rows (one per status,
    a handful), not over tickets."""
    counts = (fact.filter(F.col("status").isNotNull())
              .groupBy("status").agg(F.count(F.lit(1)).alias("ticket_count")))
    total = F.sum("ticket_count").over(Window.partitionBy())
    return counts.withColumn(
        "percentage", round2(F.lit(100.0) * F.col("ticket_count") / F.nullif(total, F.lit(0)))) \
        .orderBy(F.col("ticket_count").desc(), "status")


def fastest_agent_per_project(fact: DataFrame, n: int = 20) -> DataFrame:
    """Per project the agent(s) with the lowest mean hours (ties kept)."""
    f = at_rest(fact)
    pairs = (f.filter(F.col(HOURS).isNotNull() & F.col("assignee").isNotNull()
                      & F.col("project").isNotNull())
             .groupBy(F.col("project").alias("project_name"), F.col("assignee").alias("agent_name"))
             .agg(exact_mean(HOURS).alias("_mean")))
    best = F.rank().over(Window.partitionBy("project_name").orderBy("_mean"))
    return (pairs.withColumn("_rank", best).filter(F.col("_rank") == 1)
            .select("project_name", "agent_name",
                    F.round("_mean", 2).cast("double").alias("avg_resolution_hours"))
            .orderBy("project_name", "agent_name")
            .limit(n))
