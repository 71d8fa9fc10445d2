"""Service targets as data (P10, P11): a table of policies with validity dates.

A policy row is (priority, hours, valid_from, valid_to): the target of tickets
of that priority that start at or after ``valid_from`` and before ``valid_to``
(NULL: open on that side; tickets without a start stamp only have policies
that are open at the front).  A policy ends at the latest when the next one of
its priority begins, so a ticket has one target at most.

The join is on (priority, month): each policy is listed once for every month
that it touches between the first and the last start of the tickets, and the
exact stamps are compared after the equality join.  A third of all tickets
under one priority are spread over its months, and AQE broadcasts the policies
if they are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import SLA_HOURS

SCHEMA = "priority string, hours double, valid_from timestamp, valid_to timestamp"
_NO_MONTH = "0001-01-01"      # the bucket of tickets without a start stamp


def constant_policies(spark: SparkSession) -> DataFrame:
    """The built-in targets as one version, always valid."""
    return spark.createDataFrame([(p, float(h), None, None) for p, h in SLA_HOURS.items()], SCHEMA)


def versions(policies: DataFrame) -> DataFrame:
    """Policies that do not overlap: each ends when the next one begins (of
    policies that begin together, the shorter target counts)."""
    order = Window.partitionBy("priority").orderBy(F.col("valid_from").asc_nulls_first())
    one = policies.filter("priority is not null").groupBy("priority", "valid_from").agg(
        F.min_by(F.struct("hours", "valid_to"), "hours").alias("p"))
    return one.select("priority", F.col("p.hours").alias("hours"), "valid_from",
                      F.least("p.valid_to", F.lead("valid_from").over(order)).alias("valid_to"))


def with_targets(fact: DataFrame, policies: DataFrame) -> DataFrame:
    """The fact with ``threshold_hours`` of the policy that holds for each
    ticket, and the verdict against it (NULL: no target or unresolved)."""
    span = fact.agg(F.min("start_time").alias("lo"), F.max("start_time").alias("hi"))
    begin, end = F.greatest("valid_from", "lo"), F.least("valid_to", "hi")
    months = F.when(begin <= end, F.sequence(F.trunc(begin, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH")))
    none = F.when(F.col("valid_from").isNull(), F.array(F.lit(_NO_MONTH).cast("date")))
    empty = F.array().cast("array<date>")
    listed = (versions(policies).withColumns({"lo": span.select("lo").scalar(), "hi": span.select("hi").scalar()})
              .select(F.col("priority").alias("_priority"), F.col("hours").alias("threshold_hours"), "valid_from", "valid_to",
                      F.explode(F.concat(F.coalesce(months, empty), F.coalesce(none, empty))).alias("_month")))
    month = F.coalesce(F.trunc("start_time", "month"), F.lit(_NO_MONTH).cast("date"))
    rows = fact.drop("threshold_hours", "resolution_target_met").withColumn("_at", month)
    holds = ((rows["priority"] == listed["_priority"]) & (rows["_at"] == listed["_month"])
             & (listed["valid_from"].isNull() | (rows["start_time"] >= listed["valid_from"]))
             & (listed["valid_to"].isNull() | rows["start_time"].isNull() | (rows["start_time"] < listed["valid_to"])))
    hours = F.col("resolution_duration_hours")
    return (rows.join(listed, holds, "left").drop("_at", "_priority", "_month", "valid_from", "valid_to")
            .withColumn("resolution_target_met",
                        F.when(hours.isNotNull() & F.col("threshold_hours").isNotNull(), hours <= F.col("threshold_hours"))))
