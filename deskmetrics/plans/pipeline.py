"""The batch run: extract -> transform -> load (K4-K7).

One fact computation feeds every output: the fact is written once as Parquet
into the shared folder (lineage cut, pruned reads, survives executor loss),
the dimensions are keyed once from it, and each output is then one write.
Counters (C5, S6) are gathered by ``Observation`` during those passes.  The
Parquet writes run concurrently; the warehouse load empties all tables child
first and fills them parents first.  Every write is a full refresh, so a
re-run gives the same tables.  Every scratch folder of the run is removed at
its end, also when it fails.  Errors propagate to the caller.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import marts, sketches, star
from ..schemas import WAREHOUSE_FACT_COLUMNS
from ..session import prepare, scratch, staged, workspace
from ..sources import sinks
from ..sources.scan import counted
from .model import from_scans

CURATED_ORDER = ("dim_customers", "dim_agents", "dim_projects", "fact_tickets",
                 "agent_performance", "resolution_performance", "category_trends")
#: Names in the warehouse, where they differ: the marts have a schema of their own.
WAREHOUSE_NAMES = {"agent_performance": "analytics.agent_performance",
                   "resolution_performance": "analytics.resolution_performance",
                   "category_trends": "analytics.category_trends"}
#: The stored fact: by priority, clustered by the last stamp of a ticket.
FACT_LAYOUT = {"by": "priority", "stamps": ("resolution_time", "start_time"), "lookup": "ticket_id"}


@dataclass
class RunResult:
    tables: dict[str, DataFrame]
    metrics: dict[str, int]


def build_outputs(fact: DataFrame) -> dict[str, DataFrame]:
    """The seven curated tables, with the warehouse's types, over a staged fact."""
    dims = star.build_dimensions(fact)
    keyed = star.fact_with_keys(fact, dims)
    agents = star.agent_performance(marts.agent_rank_by_volume(fact), dims)
    return {
        "dim_customers": dims.table("customers"),
        "dim_agents": dims.table("agents"),
        "dim_projects": dims.table("projects"),
        "fact_tickets": star.warehouse_fact(keyed),
        "agent_performance": marts.typed_agent_performance(agents),
        "resolution_performance": marts.typed_resolution_performance(marts.resolution_performance(fact)),
        "category_trends": marts.typed_category_trends(marts.category_trends(fact)),
    }


def run(spark: SparkSession, issues: DataFrame, changes: DataFrame, out_dir: str,
        jdbc_url: str | None = None, jdbc_properties: dict[str, str] | None = None,
        jdbc_connections: int | None = None, warehouse_names: dict[str, str] | None = None,
        empty_statement: str = "DELETE FROM {table}") -> RunResult:
    """Full refresh of the curated Parquet zone (and the warehouse if a JDBC
    URL is given) from typed ticket and change-log scans.

    The warehouse load needs ``jdbc_connections``, how many writers the
    database bears; ``warehouse_names`` replaces ``WAREHOUSE_NAMES``."""
    if jdbc_url and not jdbc_connections:
        raise ValueError("a warehouse load needs jdbc_connections")
    prepare(spark)
    changes, obs_changes = counted(changes, "changes_in")
    obs_tickets, obs_fact = Observation("tickets"), Observation("fact")
    with workspace(spark):
        model = from_scans(issues, changes, obs_tickets)
        fact = staged(model.fact.observe(obs_fact, F.count(F.lit(1)).alias("rows")), scratch(spark, "fact"))
        tables = build_outputs(fact)
        out = out_dir.rstrip("/")

        def write(name: str) -> int:
            rows = Observation(name)
            seen = tables[name].observe(rows, F.count(F.lit(1)).alias("rows"))
            if name == "fact_tickets":
                sinks.curate(star.with_seconds(seen), f"{out}/{name}", **FACT_LAYOUT)
            else:
                sinks.curate(seen, f"{out}/{name}")
            return rows.get.get("rows", 0)

        # Parquet folders have no load order: the seven writes run as concurrent
        # jobs, so the small marts fill the cluster while the fact is written.
        with ThreadPoolExecutor(max_workers=len(CURATED_ORDER)) as pool:
            sizes = dict(zip(CURATED_ORDER, pool.map(write, CURATED_ORDER)))
    seen = obs_tickets.get
    metrics = {**{f"issues.{k}": seen.get(k, 0) for k in ("rows_in", "invalid_resolution", "resolved_without_created")},
               "changes.rows_in": obs_changes.get.get("rows", 0),
               "fact_tickets.rows_after_dedup": obs_fact.get.get("rows", 0),
               **{f"dimensions.{t}": sizes[t] for t in CURATED_ORDER if t.startswith("dim_")}}
    # written last: its marker says that the folder is whole
    sinks.curate(spark.createDataFrame(sorted(metrics.items()), "metric string, value bigint").coalesce(1),
                 f"{out}/run_metrics")
    # distinct sizes that later runs can be merged with
    sinks.curate(sketches.distinct_sketches(
        sinks.read_parquet(spark, f"{out}/fact_tickets", schema=tables["fact_tickets"].schema),
        {f"dim_{d}": key for d, (_, key, _) in star.DIMENSIONS.items()}), f"{out}/run_sketches")
    stored = {name: sinks.read_parquet(spark, f"{out}/{name}",
                                       list(WAREHOUSE_FACT_COLUMNS) if name == "fact_tickets" else None,
                                       schema=tables[name].schema)
              for name in CURATED_ORDER}
    if jdbc_url:
        sinks.refresh_warehouse(stored, jdbc_url, jdbc_connections,
                                WAREHOUSE_NAMES if warehouse_names is None else warehouse_names,
                                jdbc_properties, empty_statement)
    return RunResult(stored, metrics)


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of the written tables."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()])
