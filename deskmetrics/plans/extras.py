"""Outputs the reference documents but does not code (R-D1 .. R-D4, R-D7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import mean_hours, month_start, round2
from ..session import scratch, staged
from ..operators.marts import category_trends


def dim_date(fact: DataFrame) -> DataFrame:
    """R-D2: one row per calendar day from the first ticket start to the
    last start or resolution.  The day list is a ``sequence`` of the two
    bounds (it grows with the time span, not with the ticket count)."""
    bounds = fact.agg(F.min(F.to_date("start_time")).alias("lo"),
                      F.max(F.to_date(F.coalesce("resolution_time", "start_time"))).alias("hi"))
    days = bounds.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    d = F.col("date")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.trunc(d, "month").alias("month_start"),
    )


def agent_monthly_hours(fact: DataFrame) -> DataFrame:
    """R-D3: mean resolution hours per agent and resolution month."""
    return (fact.filter(F.col("resolution_time").isNotNull() & F.col("assignee").isNotNull())
            .groupBy(F.col("assignee").alias("agent_name"),
                     month_start("resolution_time").alias("month"))
            .agg(F.count(F.lit(1)).alias("tickets_resolved"),
                 round2(mean_hours("resolution_duration_hours")).alias("avg_resolution_hours")))


def fastest_growing_categories(fact: DataFrame, n: int = 10) -> DataFrame:
    """R-D4: each category's change in its latest month; the n largest."""
    latest = (category_trends(fact)
              .groupBy("category")
              .agg(F.max(F.struct("month", "ticket_volume", "volume_change_pct")).alias("_l"))
              .select("category", F.col("_l.month").alias("month"),
                      F.col("_l.ticket_volume").alias("ticket_volume"),
                      F.col("_l.volume_change_pct").alias("volume_change_pct")))
    return (latest.filter(F.col("volume_change_pct").isNotNull())
            .orderBy(F.col("volume_change_pct").desc(), "category")
            .limit(n))


def agent_workload_spread(fact: DataFrame) -> DataFrame:
    """R-D7: tickets per agent against the quartiles of all agents' loads:
    'over' above the upper quartile, 'under' below the lower one.  The
    quartiles are exact percentiles over the per-agent counts."""
    loads = (fact.filter(F.col("assignee").isNotNull())
             .groupBy(F.col("assignee").alias("agent_name"))
             .agg(F.count(F.lit(1)).alias("tickets")))
    loads = staged(loads, scratch(fact.sparkSession, "loads"))
    # agents per load: partial counts, so the exact percentile sees one
    # weighted row per distinct load, and the saved loads get a scalar
    often = loads.groupBy("tickets").agg(F.count(F.lit(1)).alias("agents"))
    q = often.agg(F.percentile("tickets", [0.25, 0.75], F.col("agents")).alias("q")).scalar()
    loads = loads.withColumn("_q", q)
    p25, p75 = F.col("_q").getItem(0), F.col("_q").getItem(1)
    band = (F.when(F.col("tickets") > p75, F.lit("over"))
            .when(F.col("tickets") < p25, F.lit("under"))
            .otherwise(F.lit("normal")))
    return loads.select("agent_name", "tickets",
                        p25.alias("p25_tickets"), p75.alias("p75_tickets"),
                        band.alias("workload_band"))
