"""Data-quality checks.

The warehouse enforced primary, unique, NOT NULL, foreign-key, length and
decimal-range constraints on load.  Here each check is a query returning
one row per checked column -- (table_name, column_name, violations) -- so a
clean run shows visible zeros instead of an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CATEGORY_MAX_LEN, NAME_MAX_LEN, PRIORITY_MAX_LEN, STATUS_MAX_LEN


def _rows(table: str, df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One aggregate pass over ``df``; one output row per named check."""
    agg = df.agg(*[c.alias(f"_c{i}") for i, c in enumerate(checks.values())])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"_c{i}").cast("long").alias("violations"))
        for i, name in enumerate(checks)]))
    return agg.select(F.lit(table).alias("table_name"), stacked.alias("r")).select(
        "table_name", "r.column_name", "r.violations")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_keys(df: DataFrame, col: str) -> DataFrame:
    """Number of values of ``col`` that occur more than once."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.count_if(F.col("_n") > 1).alias("_dups")))


def check_unique(wfact: DataFrame, dim_tables: dict[str, DataFrame]) -> DataFrame:
    """Primary keys and unique names."""
    out = [duplicate_keys(wfact, "ticket_id").select(
        F.lit("fact_tickets").alias("table_name"), F.lit("ticket_id").alias("column_name"),
        F.col("_dups").cast("long").alias("violations"))]
    for table, dim in dim_tables.items():
        for col in dim.columns:
            out.append(duplicate_keys(dim, col).select(
                F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
                F.col("_dups").cast("long").alias("violations")))
    return _union(out)


def check_not_null(wfact: DataFrame, dim_tables: dict[str, DataFrame]) -> DataFrame:
    """NOT NULL columns (one pass per table)."""
    out = [_rows("fact_tickets", wfact, {"ticket_id": F.count_if(F.col("ticket_id").isNull())})]
    for table, dim in dim_tables.items():
        out.append(_rows(table, dim, {c: F.count_if(F.col(c).isNull()) for c in dim.columns}))
    return _union(out)


def check_foreign_keys(wfact: DataFrame, dim_tables: dict[str, DataFrame]) -> DataFrame:
    """Fact keys without a dimension row (NULL keys are allowed).  One
    scan: the fact's keys are counted per (column, key) before they meet the
    dimensions' keys, so a hot key is one row."""
    keys = [dim.columns[0] for dim in dim_tables.values()]
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("column_name"), F.col(k).alias("key")) for k in keys]))
    used = (wfact.select(pairs.alias("p")).select("p.*").filter("key is not null")
            .groupBy("column_name", "key").agg(F.count(F.lit(1)).alias("_n")))
    known = reduce(DataFrame.unionAll, [
        dim.select(F.lit(k).alias("column_name"), F.col(k).alias("key")) for k, dim in zip(keys, dim_tables.values())])
    orphans = used.join(known, ["column_name", "key"], "left_anti").agg(*[
        F.coalesce(F.sum(F.when(F.col("column_name") == k, F.col("_n"))), F.lit(0)).alias(k) for k in keys])
    return _rows("fact_tickets", orphans, {k: F.max(k) for k in keys})


def _too_long(col: str, n: int) -> Column:
    return F.count_if(F.length(col) > n)


def _out_of_range(col: str, decimal_type: str) -> Column:
    return F.count_if(F.col(col).isNotNull() & F.col(col).try_cast(decimal_type).isNull())


def check_bounds(fact: DataFrame, dim_tables: dict[str, DataFrame],
                 resolution_perf: DataFrame, trends: DataFrame, agents: DataFrame) -> DataFrame:
    """C4: VARCHAR lengths and DECIMAL ranges of the stored tables (checked
    on the un-cast values, so an overflow is counted, not hidden)."""
    out = [_rows("fact_tickets", fact, {
        "category": _too_long("category", CATEGORY_MAX_LEN),
        "priority": _too_long("priority", PRIORITY_MAX_LEN),
        "status": _too_long("status", STATUS_MAX_LEN),
        "resolution_duration_hours": _out_of_range("resolution_duration_hours", "decimal(10,2)"),
    })]
    for table, dim in dim_tables.items():
        name = dim.columns[1]
        out.append(_rows(table, dim, {name: _too_long(name, NAME_MAX_LEN)}))
    out.append(_rows("agent_performance", agents, {
        "avg_resolution_duration_hours": _out_of_range("avg_resolution_duration_hours",
                                                       "decimal(10,2)")}))
    out.append(_rows("resolution_performance", resolution_perf, {
        "compliance_rate": _out_of_range("compliance_rate", "decimal(5,2)")}))
    out.append(_rows("category_trends", trends, {
        "volume_change_pct": _out_of_range("volume_change_pct", "decimal(12,2)")}))
    return _union(out)


def ticket_counters() -> dict[str, Column]:
    """What the reference logs about the parsed tickets, as aggregates."""
    res, created = F.col("issue_resolution_date"), F.col("issue_created")
    return {"rows_in": F.count(F.lit(1)),
            "invalid_resolution": F.count_if(res.isNotNull() & (res < created)),
            "resolved_without_created": F.count_if(res.isNotNull() & created.isNull())}


def quality_counts(parsed: DataFrame, changes: DataFrame, fact: DataFrame) -> DataFrame:
    """C5 as a query of its own: the same counters that the batch run gathers
    by ``Observation`` while it writes, as (metric, value) rows."""
    tickets = _rows("issues", parsed, ticket_counters())
    rows = [tickets, _rows("changes", changes, {"rows_in": F.count(F.lit(1))}),
            _rows("fact_tickets", fact, {"rows_after_dedup": F.count(F.lit(1))}),
            _rows("dimensions", fact, {d: F.count_distinct(r) for r, d in (
                ("reporter", "dim_customers"), ("assignee", "dim_agents"), ("project", "dim_projects"))})]
    return _union(rows).select(F.concat_ws(".", "table_name", "column_name").alias("metric"),
                               F.col("violations").alias("value"))
