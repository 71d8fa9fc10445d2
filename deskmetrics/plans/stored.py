"""The stored star: reports, tiles and checks on the curated tables.

``open_star`` reads a curated folder; ``with_names`` joins the fact to the
dimensions a report needs, by key.  For the driver's tables, ``for_tables``
builds the star once per application and state of the input files: its folder
is named after the paths, sizes and change times of all input files, so a file
that is added or replaced leads to a new star.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.star import DIMENSIONS, SECONDS, last_stamp
from ..schemas import WAREHOUSE_FACT_COLUMNS
from ..session import checkpoint_dir, prepare
from ..sources import fixture, scan, sinks
from . import pipeline, reports

#: Types of the curated tables; declared, so that opening them starts no job.
SCHEMAS = {
    "dim_customers": "customer_id bigint, reporter_name string",
    "dim_agents": "agent_id bigint, agent_name string",
    "dim_projects": "project_id bigint, project_name string",
    "fact_tickets": "ticket_id bigint, customer_id bigint, agent_id bigint, project_id bigint, category string, "
                    "start_time timestamp, resolution_time timestamp, resolution_duration_hours decimal(10,2), "
                    "status string, resolution_target_met boolean, priority string",
    "agent_performance": "agent_id bigint, tickets_resolved int, avg_resolution_duration_hours decimal(10,2), "
                         "rank_by_volume int",
    "resolution_performance": "priority string, month timestamp, tickets_resolved int, compliance_rate decimal(5,2)",
    "category_trends": "category string, month timestamp, ticket_volume int, volume_change_pct decimal(12,2)",
    "run_metrics": "metric string, value bigint",
}
_INPUTS = ("orders", "lineitem", "customer", "supplier", "nation", "part")


@dataclass(frozen=True)
class Star:
    tables: dict[str, DataFrame]
    folder: str

    @property
    def fact(self) -> DataFrame:
        return self.tables["fact_tickets"]

    @property
    def dimensions(self) -> dict[str, DataFrame]:
        return {n: t for n, t in self.tables.items() if n.startswith("dim_")}

    @property
    def ends(self) -> DataFrame:
        """One row: the last start and the last resolution of all tickets,
        from the footers of the fact's files."""
        seconds = sinks.read_footers(self.fact.sparkSession, f"{self.folder}/fact_tickets",
                                     ", ".join(f"{s} bigint" for s in SECONDS))
        return seconds.agg(*[last_stamp(s).alias(f"last_{s.removesuffix('_second')}") for s in SECONDS])

    def last(self, what: str) -> DataFrame:
        """``start`` or ``resolution`` of ``ends``."""
        return self.ends.select(f"last_{what}")


def open_star(spark: SparkSession, folder: str) -> Star:
    """The curated tables in a folder."""
    read = {n: sinks.read_parquet(spark, f"{folder.rstrip('/')}/{n}", schema=s) for n, s in SCHEMAS.items()}
    return Star(read | {"fact_tickets": read["fact_tickets"].select(*WAREHOUSE_FACT_COLUMNS)}, folder.rstrip("/"))


def with_names(star: Star, *roles: str) -> DataFrame:
    """The fact LEFT JOIN the dimensions of ``roles`` (reporter, assignee,
    project) on their keys, each name in a column called like its role."""
    rows = star.fact
    for dim, (role, key, name) in DIMENSIONS.items():
        if role in roles:
            rows = rows.join(star.tables[f"dim_{dim}"].withColumnRenamed(name, role), key, "left")
    return rows


def create_views(star: Star) -> None:
    """The two named views of the reports, over all their rows."""
    reports.avg_resolution_by_project(with_names(star, "project"), n=None) \
        .createOrReplaceTempView("view_avg_resolution_by_project")
    reports.status_distribution(star.fact).createOrReplaceTempView("view_status_distribution")


def state_of(spark: SparkSession, sf_dir: str) -> str:
    """A digest of the input files' paths, sizes and change times."""
    conf, path_of = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    seen = []
    for table in _INPUTS:
        path = path_of(f"{sf_dir.rstrip('/')}/{table}.parquet")
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:16]


def build(spark: SparkSession, sf_dir: str, folder: str) -> Star:
    """The batch run over the driver's tables into ``folder``."""
    issues = scan.scan_issues(fixture.raw_issues(spark, sf_dir))
    changes = scan.scan_changes(fixture.raw_changes(spark, sf_dir))
    pipeline.run(spark, issues, changes, folder)
    return open_star(spark, folder)


def for_tables(spark: SparkSession, sf_dir: str) -> Star:
    """The star of the driver's tables as they are now."""
    prepare(spark)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/star-{spark.sparkContext.applicationId}-{state_of(spark, sf_dir)}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/run_metrics/_SUCCESS")
    if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return open_star(spark, folder)
    return build(spark, sf_dir, folder)
