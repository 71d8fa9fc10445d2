"""The three aggregate marts and their building blocks (G1-G3, W4, W5, R-D1).

Windows only ever run over already-aggregated rows (agents, volumes,
category-months), never over tickets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import mean_hours, month_start, round2
from ..session import scratch, staged


def _resolved(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("resolution_time").isNotNull())


def agent_volume(fact: DataFrame) -> DataFrame:
    """G1: per agent, resolved tickets and mean hours (2 places)."""
    return (_resolved(fact).groupBy("assignee")
            .agg(F.count("ticket_id").alias("tickets_resolved"),
                 round2(mean_hours("resolution_duration_hours")).alias("avg_resolution_duration_hours")))


def dense_rank_desc(df: DataFrame, value: str, rank_col: str) -> DataFrame:
    """Dense rank of ``value`` (largest first) over the whole frame.

    The frame (an aggregate, one row per agent) is saved once; its distinct
    values are ranked -- k distinct counts need at least k * (k - 1) / 2
    tickets, so they are far fewer than agents -- and joined back, so the
    agents never meet in one task."""
    saved = staged(df, scratch(df.sparkSession, "to-rank"))
    ranks = saved.select(F.col(value).alias("_value")).distinct().withColumn(
        rank_col, F.dense_rank().over(Window.orderBy(F.col("_value").desc())))
    return saved.join(ranks, saved[value].eqNullSafe(ranks["_value"])).drop("_value")


def agent_rank_by_volume(fact: DataFrame) -> DataFrame:
    """G1 + W4: the agent mart as computed before keys are attached."""
    return dense_rank_desc(agent_volume(fact), "tickets_resolved", "rank_by_volume")


def resolution_performance(fact: DataFrame) -> DataFrame:
    """Per priority and resolution month, resolved count and the share
    of met targets (NULL verdicts count in the denominator only; NULL when
    every verdict of the group is NULL)."""
    n = F.count("ticket_id")
    return (_resolved(fact)
            .groupBy("priority", month_start("resolution_time").alias("month"))
            .agg(n.alias("tickets_resolved"),
                 round2(F.lit(100.0) * F.sum(F.col("resolution_target_met").cast("int")) / n)
                 .alias("compliance_rate")))


def category_monthly_volume(fact: DataFrame) -> DataFrame:
    """Tickets per category and start month."""
    return (fact.groupBy("category", month_start("start_time").alias("month"))
            .agg(F.count("ticket_id").alias("ticket_volume")))


def with_month_over_month(monthly: DataFrame, volume: str = "ticket_volume") -> DataFrame:
    """% change against the previous *present* month of the category
    (gaps are not filled; a NULL month sorts first); NULL for the first month
    or when the previous volume is 0."""
    w = Window.partitionBy("category").orderBy(F.col("month").asc_nulls_first())
    prev = F.lag(volume).over(w)
    change = F.when(prev.isNotNull() & (prev > 0),
                    round2(F.lit(100.0) * (F.col(volume) - prev) / prev))
    return monthly.withColumn("volume_change_pct", change)


def category_trends(fact: DataFrame) -> DataFrame:
    return with_month_over_month(category_monthly_volume(fact))


def category_trends_with_hours(fact: DataFrame) -> DataFrame:
    """R-D1: the category trend with the mean resolution hours per month."""
    monthly = (fact.groupBy("category", month_start("start_time").alias("month"))
               .agg(F.count("ticket_id").alias("ticket_volume"),
                    round2(mean_hours("resolution_duration_hours")).alias("avg_resolution_hours")))
    return with_month_over_month(monthly)


def typed_agent_performance(agents: DataFrame) -> DataFrame:
    """The agent mart with the warehouse's types."""
    return agents.select("agent_id", F.col("tickets_resolved").cast("int").alias("tickets_resolved"),
                         F.col("avg_resolution_duration_hours").cast("decimal(10,2)")
                         .alias("avg_resolution_duration_hours"), "rank_by_volume")


def typed_resolution_performance(perf: DataFrame) -> DataFrame:
    return perf.select("priority", "month", F.col("tickets_resolved").cast("int").alias("tickets_resolved"),
                       F.col("compliance_rate").cast("decimal(5,2)").alias("compliance_rate"))


def typed_category_trends(trends: DataFrame) -> DataFrame:
    """Changes are kept as DECIMAL(12,2): a small category can grow by more
    than the declared DECIMAL(6,2) holds."""
    return trends.select("category", "month", F.col("ticket_volume").cast("int").alias("ticket_volume"),
                         F.col("volume_change_pct").cast("decimal(12,2)").alias("volume_change_pct"))
