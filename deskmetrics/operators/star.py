"""Star schema: surrogate-key dimensions, keyed fact, warehouse typing
(K1, G4, J3, J4, P14).

Keys are dense ``1..n`` in name order, so they are a function of the data
alone (the same for any partitioning or re-run), and they are computed
without moving all names through one task:

1. one pass over the fact collects the distinct (role, name) pairs of all
   three dimensions (partial aggregation map-side);
2. the pairs are range-partitioned and sorted; each row's position inside
   its partition comes from ``monotonically_increasing_id`` (partition index
   in the high bits, row number in the low 33), taken once and written to the
   shared checkpoint folder so a lost executor cannot re-run it with another
   layout;
3. per (partition, role) counts -- at most 3 x partitions rows, a proven
   bound -- give each range its offset, broadcast back to the rows;
4. the keyed names are written once; the fact's lookups are plain joins, and
   AQE broadcasts them or splits hot names from measured sizes.

The result does not depend on where the range boundaries fell: ranges are
contiguous and ordered, so offset + position is the row's rank.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch, staged

# (role in the fact, key column, name column) of each dimension.
DIMENSIONS = {
    "customers": ("reporter", "customer_id", "reporter_name"),
    "agents": ("assignee", "agent_id", "agent_name"),
    "projects": ("project", "project_id", "project_name"),
}
_POS_BITS = 33


@dataclass(frozen=True)
class Dimensions:
    keyed: DataFrame  # role, name, key -- all dimensions in one frame

    def table(self, dim: str) -> DataFrame:
        role, key_col, name_col = DIMENSIONS[dim]
        return (self.keyed.filter(F.col("role") == role)
                .select(F.col("key").alias(key_col), F.col("name").alias(name_col)))


def distinct_names(fact: DataFrame, roles: list[str]) -> DataFrame:
    """Distinct non-NULL (role, name) pairs of the given fact columns."""
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("name"))
                                for r in roles]))
    return (fact.select(pairs.alias("p")).select("p.role", "p.name")
            .filter(F.col("name").isNotNull()).distinct())


def dense_keys(pairs: DataFrame) -> DataFrame:
    """(role, name) -> (role, name, key) with key = rank of name within role."""
    mid = F.monotonically_increasing_id()
    ranged = staged(
        pairs.repartitionByRange("role", "name").sortWithinPartitions("role", "name")
        .select("role", "name", F.shiftright(mid, _POS_BITS).alias("_part"),
                mid.bitwiseAND((1 << _POS_BITS) - 1).alias("_pos")),
        scratch(pairs.sparkSession, "names"))
    before = Window.partitionBy("role").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    ranges = (ranged.groupBy("_part", "role")
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
              .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    return (ranged.join(F.broadcast(ranges.drop("_n")), ["_part", "role"])
            .select("role", "name",
                    (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).cast("long").alias("key")))


def build_dimensions(fact: DataFrame, dims=tuple(DIMENSIONS)) -> Dimensions:
    """Key all requested dimensions from one pass over the fact; the keyed
    names are written once."""
    keyed = dense_keys(distinct_names(fact, [DIMENSIONS[d][0] for d in dims]))
    return Dimensions(staged(keyed, scratch(fact.sparkSession, "keys")))


def _lookup(dims: Dimensions, dim: str) -> DataFrame:
    """Name -> key for one dimension."""
    role, key_col, _ = DIMENSIONS[dim]
    return (dims.keyed.filter(F.col("role") == role)
            .select(F.col("name").alias(f"_{role}_name"), F.col("key").alias(key_col)))


def fact_with_keys(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """The fact LEFT JOIN each dimension on name (NULL name -> NULL key)."""
    out = fact
    for dim, (role, _, _) in DIMENSIONS.items():
        lk = _lookup(dims, dim)
        out = out.join(lk, out[role] == lk[f"_{role}_name"], "left").drop(f"_{role}_name")
    return out


def hours_at_rest(hours) -> F.Column:
    """Hours as the warehouse stores them, DECIMAL(10,2), rounded half up; a
    value out of range fails the job under ANSI mode, as the warehouse's load
    would (``check_bounds`` reports such values beforehand)."""
    return hours.cast("decimal(10,2)")


def warehouse_fact(keyed_fact: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The 11 stored fact columns with the warehouse's types (plus ``extra``
    columns passed through)."""
    return keyed_fact.select(
        "ticket_id", "customer_id", "agent_id", "project_id", "category", "priority",
        "start_time", "resolution_time",
        hours_at_rest(F.col("resolution_duration_hours")).alias("resolution_duration_hours"),
        "status", "resolution_target_met", *extra,
    )


#: Stands for NULL in the stored seconds, so that every row group has bounds.
NO_SECOND = -(1 << 63)
#: Epoch seconds of the two stamps, stored beside the warehouse's columns:
#: their maxima come from file footers, which have none for stamps.
SECONDS = {"start_second": "start_time", "resolution_second": "resolution_time"}


def with_seconds(wfact: DataFrame) -> DataFrame:
    """The fact with the seconds in front (footers are read by position)."""
    return wfact.select(*[F.coalesce(F.unix_seconds(c), F.lit(NO_SECOND)).alias(s) for s, c in SECONDS.items()], "*")


def last_stamp(second: str):
    """The last stamp of a stored seconds column, as an aggregate."""
    return F.timestamp_seconds(F.nullif(F.max(second), F.lit(NO_SECOND)))


def agent_performance(agent_ranked: DataFrame, dims: Dimensions) -> DataFrame:
    """Agent mart with the agent key instead of the name (NULL agent -> NULL key)."""
    lk = _lookup(dims, "agents")
    return (agent_ranked.join(lk, agent_ranked["assignee"] == lk["_assignee_name"], "left")
            .select("agent_id", "tickets_resolved", "avg_resolution_duration_hours",
                    "rank_by_volume"))
