"""Query catalog: one callable per operator / report, each
``(spark, sf_dir) -> DataFrame`` over the driver's tables (through the
ticket fixture of ``sources.fixture``)."""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..functions.columns import (
    hours_between,
    month_start,
    priority_flag,
    standardize_category,
    standardize_priority,
    standardize_project,
    sla_threshold,
)
from ..operators import clean, keys, marts, quality, quarantine, sketches, sla, star
from ..operators.state import latest_change_per_field
from ..schemas import CHANGES_SCHEMA, ISSUES_SCHEMA, WAREHOUSE_FACT_COLUMNS, as_text
from ..session import move, prepare, remove, scratch, settings, staged, sweep
from ..sources import fixture, scan, sinks
from ..streaming import current_state as streaming
from ..streaming import incremental_star as incremental
from . import dashboard, extras, model, pipeline, reports, stored

Query = Callable[[SparkSession, str], DataFrame]


def finalize(df: DataFrame) -> DataFrame:
    """Output stamps as ``timestamp_ntz`` (wall-clock, no zone).

    Always returns a new DataFrame."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def _q(fn: Callable[[model.TicketModel], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finalize(fn(model.from_tables(spark, sf_dir)))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _on_fact(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return _q(lambda m: fn(m.fact))


def _on_star(fn: Callable[[stored.Star], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finalize(fn(stored.for_tables(spark, sf_dir)))
    return run


def _table(name: str) -> Query:
    return _on_star(lambda star: star.tables[name])


def _report(fn: Callable[[DataFrame], DataFrame], *roles: str) -> Query:
    """A report on the stored fact with the names it needs."""
    return _on_star(lambda star: fn(stored.with_names(star, *roles)))


def _tile(fn: Callable[[DataFrame], DataFrame], *roles: str) -> Query:
    return _on_star(lambda star: fn(dashboard.display_frame(stored.with_names(star, *roles))))


def _view(name: str) -> Query:
    def read(star: stored.Star) -> DataFrame:
        stored.create_views(star)
        return star.fact.sparkSession.table(name)
    return _on_star(read)


# --- sources ---------------------------------------------------------------

def _input_counts(m):
    return scan.input_counts(m.issues, m.changes)


def _shuffled(raw: DataFrame) -> DataFrame:
    """The extract's columns in another order, with an extra one in front."""
    return raw.select(F.lit("x").alias("export_note"), *sorted(raw.columns, reverse=True))


def _scan_issues_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 through real CSV files whose columns stand in another order, with
    one more column: taken by header name."""
    prepare(spark)
    path = scratch(spark, "issues-csv")
    scan.write_csv_text(_shuffled(fixture.raw_issues(spark, sf_dir)), path)
    return scan.read_issues_csv(spark, path)


def _scan_changes_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = scratch(spark, "changes-csv")
    scan.write_csv_text(_shuffled(fixture.raw_changes(spark, sf_dir)), path)
    return scan.read_changes_csv(spark, path)


# --- projections -----------------------------------------------------------

def _parse_timestamps(m):
    return m.parsed.select("id", "issue_created", "issue_resolution_date", "last_change_date")


def _invalid_resolution_count(m):
    return clean.invalid_resolution_counts(m.parsed)


def _valid_issues(m):
    return m.valid


def _dedup_tickets(m):
    return m.deduped


def _resolution_hours(m):
    return m.deduped.select(F.col("id").alias("ticket_id"),
                            hours_between("issue_created", "issue_resolution_date")
                            .alias("resolution_duration_hours"))


def _standardize_category(m):
    return m.deduped.select(F.col("id").alias("ticket_id"),
                            standardize_category("issue_type").alias("category"))


def _standardize_priority(m):
    return m.deduped.select(F.col("id").alias("ticket_id"),
                            standardize_priority("issue_priority").alias("priority"))


def _priority_flag(m):
    p = standardize_priority("issue_priority")
    return m.deduped.select(F.col("id").alias("ticket_id"), p.alias("priority"),
                            priority_flag(p).alias("priority_flag"))


def _standardize_project(m):
    return m.deduped.select(F.col("id").alias("ticket_id"),
                            standardize_project("issue_proj").alias("project"))


def _sla_target_met(m):
    return m.fact.select("ticket_id", "priority", "resolution_duration_hours",
                         sla_threshold("priority").alias("threshold_hours"),
                         "resolution_target_met")


# --- state / joins ---------------------------------------------------------

def _latest_change_per_field(m):
    return latest_change_per_field(m.changes_parsed)


def _current_state(m):
    return m.state


def _ticket_current_state(m):
    return (m.deduped.join(m.state, m.deduped["id"] == m.state["issueid"], "left")
            .select(F.col("id").alias("ticket_id"), "current_assignee", "last_assigned_at",
                    "current_status"))


# --- star schema -----------------------------------------------------------

def _keyed(m) -> DataFrame:
    fact = staged(m.fact, scratch(m.fact.sparkSession, "fact"))
    return star.fact_with_keys(fact, star.build_dimensions(fact))


def _fact_with_keys(m):
    return _keyed(m).select("ticket_id", "reporter", "customer_id", "assignee", "agent_id",
                            "project", "project_id")


def _dashboard_base(star_: stored.Star) -> DataFrame:
    return dashboard.dashboard_base_stored(star_.fact, star_.tables["dim_projects"], star_.tables["dim_agents"])


def _preview(star_: stored.Star) -> DataFrame:
    return dashboard.preview(_dashboard_base(star_))


def _dim_category(m):
    names = (m.fact.select(F.lit("category").alias("role"), F.col("category").alias("name"))
             .filter(F.col("name").isNotNull()).distinct())
    return star.dense_keys(names).select(F.col("key").alias("category_id"),
                                         F.col("name").alias("category_name"))


def _dim_priority(m):
    names = (m.fact.select(F.lit("priority").alias("role"), F.col("priority").alias("name"))
             .filter(F.col("name").isNotNull()).distinct())
    return star.dense_keys(names).select(F.col("key").alias("priority_id"),
                                         F.col("name").alias("priority_name"))


# --- checks ----------------------------------------------------------------

def _checks(check: Callable[[DataFrame, dict[str, DataFrame]], DataFrame]) -> Query:
    return _on_star(lambda star_: check(star_.fact, star_.dimensions))


def _check_bounds(m) -> DataFrame:
    """C4 on the values before the warehouse's types are applied."""
    fact = staged(m.fact, scratch(m.fact.sparkSession, "fact"))
    dims = star.build_dimensions(fact)
    return quality.check_bounds(fact, {f"dim_{d}": dims.table(d) for d in star.DIMENSIONS},
                                marts.resolution_performance(fact), marts.category_trends(fact),
                                marts.agent_volume(fact))


# --- sinks / pipeline / stream ---------------------------------------------

def _parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the fact written partitioned by priority and read back."""
    path = scratch(spark, "fact-parquet")
    sinks.curate(stored.for_tables(spark, sf_dir).fact, path, **pipeline.FACT_LAYOUT)
    return finalize(sinks.read_parquet(spark, path, list(WAREHOUSE_FACT_COLUMNS)))


def _run_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4-K7: the whole batch run into a fresh curated folder."""
    prepare(spark)
    star_ = stored.build(spark, sf_dir, scratch(spark, "curated"))
    return pipeline.table_sizes({n: star_.tables[n] for n in pipeline.CURATED_ORDER})


STREAM_BATCHES = 4


def _stream_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-D5: the change log lands with the partitions it has and is folded
    into the current state in a few micro-batches, each over many files."""
    prepare(spark)
    landing = scratch(spark, "change-log")
    fixture.raw_changes(spark, sf_dir).write.parquet(landing)
    files = len(spark.read.schema(as_text(CHANGES_SCHEMA)).parquet(landing).inputFiles())
    return finalize(streaming.run_available(
        spark, landing, as_text(CHANGES_SCHEMA), "parquet", max_files_per_trigger=-(-files // STREAM_BATCHES),
        transform=lambda raw: clean.parse_change_stamps(scan.scan_changes(raw))))


def _stream_latest_per_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` read as a file stream and folded into the latest value per
    (user, event type) with ``availableNow``."""
    prepare(spark)
    schema = fixture.read_table(spark, sf_dir, "events").schema
    state = streaming.run_available(spark, sf_dir, schema, "parquet",
                                    transform=streaming.events_as_changes,
                                    operator=streaming.stream_latest_per_field,
                                    glob="events.parquet", keys=("issueid", "field"))
    return finalize(state)


WAVES = 4


def land_waves(spark: SparkSession, sf_dir: str) -> str:
    """The raw extracts dealt out to ``WAVES`` folders each, by a hash of the
    row's key and stamp: copies of a ticket and its changes arrive apart."""
    folder = scratch(spark, "waves")
    for kind, raw, stamp in (("issues", fixture.raw_issues(spark, sf_dir), "issue_created"),
                             ("changes", fixture.raw_changes(spark, sf_dir), "created")):
        wave = F.pmod(F.xxhash64("id", stamp), F.lit(WAVES)).alias("wave")
        # a writer for each wave instead of a sort of all rows by wave (with as
        # many writers as the setting says, Spark sorts what is left)
        with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(WAVES + 1)}):
            raw.select("*", wave).write.option("compression", "zstd").partitionBy("wave").parquet(f"{folder}/{kind}")
        sweep(spark)
    return folder


def incremental_base(spark: SparkSession, sf_dir: str) -> str:
    """The incremental star after all waves, one run of the stream a wave;
    kept for the application and the state of the input files.  A wave lands
    by a rename, so its rows are written once; what a wave leaves behind
    (shuffle files, versions that it has replaced) goes before the next."""
    prepare(spark)
    name = f"star-{spark.sparkContext.applicationId}-{stored.state_of(spark, sf_dir)}"
    base = streaming.stream_base(spark, name)
    if incremental.versions(spark, base)[1] < WAVES - 1:
        waves = land_waves(spark, sf_dir)
        landing = f"{base}/landing"
        for wave in range(WAVES):
            for kind in ("issues", "changes"):
                move(spark, f"{waves}/{kind}/wave={wave}", f"{landing}/{kind}/wave={wave}")
            incremental.run_available(spark, f"{landing}/issues", f"{landing}/changes", name)
            incremental.vacuum(spark, base)
            sweep(spark)
        remove(spark, waves)
    return base


def _incremental(fn: Callable[[stored.Star], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = incremental_base(spark, sf_dir)
        return finalize(fn(stored.Star(incremental.open_star(spark, base), base)))
    return run


def _named_fact(star_: stored.Star) -> DataFrame:
    """The fact with names for keys."""
    rows = stored.with_names(star_, "reporter", "assignee", "project")
    keys = [key for _, key, _ in star.DIMENSIONS.values()]
    return rows.drop(*keys)


def _dimension_names(star_: stored.Star) -> DataFrame:
    """(dimension, name) of every dimension row."""
    return reduce(DataFrame.unionAll, [
        star_.tables[f"dim_{d}"].select(F.lit(d).alias("dimension"), F.col(name).alias("name"))
        for d, (_, _, name) in star.DIMENSIONS.items()])


def _registry_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the names of the even tickets are registered first, then those of
    all tickets; keys of the first batch stay."""
    prepare(spark)
    rows = stored.with_names(stored.for_tables(spark, sf_dir), "reporter", "assignee", "project")
    roles = [role for role, _, _ in star.DIMENSIONS.values()]
    path = scratch(spark, "registry")
    keys.extend(star.distinct_names(rows.filter("ticket_id % 2 = 0"), roles), path, 0)
    return keys.extend(star.distinct_names(rows, roles), path, 1)


def _sla_by_policy(m) -> DataFrame:
    """P10 / P11 with targets as data: the built-in ones, halved from 1995 on
    for two priorities."""
    spark = m.fact.sparkSession
    since = dt.datetime(1995, 1, 1, tzinfo=dt.timezone.utc)
    later = spark.createDataFrame([("High", 12.0, since, None), ("Low", 84.0, since, None)], sla.SCHEMA)
    return sla.with_targets(m.fact, sla.constant_policies(spark).unionByName(later)).select(
        "ticket_id", "priority", "resolution_duration_hours", "threshold_hours", "resolution_target_met")


def _top_reporters_by_summary(star_: stored.Star) -> DataFrame:
    """O3 over a wide column: candidates from a merged summary, exact counts."""
    top = sketches.top_n_by_summary(stored.with_names(star_, "reporter"), "reporter", 10)
    return top.select(F.col("reporter").alias("reporter_name"), F.col("rows").alias("tickets"))


QUANTILES = (0.25, 0.5, 0.9)


def _quantiles_by_span(star_: stored.Star) -> DataFrame:
    """R-D7 by stored monthly sketches: quantiles of the hours per priority
    over the last twelve resolution months, and whether the share of hours
    below and up to each value is as near to the probability as stated."""
    spark = star_.fact.sparkSession
    month = month_start("resolution_time").alias("month")
    monthly = staged(sketches.quantile_sketches(star_.fact, F.col(reports.HOURS), "priority", month),
                     scratch(spark, "hours-sketches"))
    last = star_.last("resolution").toDF("last")
    begin = last.select(F.date_trunc("month", "last") - F.make_ym_interval(F.lit(0), F.lit(11))).scalar()
    found = sketches.merged_quantiles(monthly.filter(F.col("month") >= begin), QUANTILES, "priority")
    hours = star_.fact.filter((F.col("resolution_time") >= begin) & F.col(reports.HOURS).isNotNull()) \
        .groupBy(F.col("priority").alias("p"), F.col(reports.HOURS).cast("double").alias("h")).agg(F.count(F.lit(1)).alias("c"))
    share = lambda hit: F.sum(F.when(hit, F.col("c")).otherwise(0)) / F.sum("c")
    p = F.col("probability")
    return (found.join(hours, F.col("priority").eqNullSafe(F.col("p"))).groupBy("priority", "probability")
            .agg(F.max("n").alias("tickets"), share(F.col("h") < F.col("value")).alias("below"),
                 share(F.col("h") <= F.col("value")).alias("upto"))
            .select("priority", "probability", "tickets",
                    ((F.col("below") <= p + sketches.RANK_ERROR) & (F.col("upto") >= p - sketches.RANK_ERROR))
                    .alias("within_bound")))


def _distinct_over_runs(star_: stored.Star) -> DataFrame:
    """C5 over runs: one sketch per dimension and run (a third of the tickets
    each), merged, against the exact number of names in the fact."""
    columns = {f"dim_{d}": key for d, (_, key, _) in star.DIMENSIONS.items()}
    runs = staged(sketches.distinct_sketches(star_.fact.withColumn("run", F.col("ticket_id") % 3), columns, "run"),
                  scratch(star_.fact.sparkSession, "name-sketches"))
    exact = reduce(DataFrame.unionAll, [
        star_.tables[t].agg(F.count(F.lit(1)).alias("names")).select(F.lit(t).alias("metric"), "names") for t in columns])
    error = F.abs(F.col("estimate") / F.col("names") - 1)
    return exact.join(sketches.merged_distinct(runs, "metric"), "metric").select(
        "metric", "names", (error <= sketches.DISTINCT_ERROR).alias("within_bound"))


def _dirty(fact: DataFrame) -> DataFrame:
    """The fact with planted violations: ids twice, over-long categories, keys
    of no customer, missing ids."""
    i = F.col("ticket_id")
    twice = F.explode(F.array_repeat(F.lit(1), F.when(i % 101 == 0, 2).otherwise(1))).alias("_n")
    return fact.select("*", twice).drop("_n").withColumns({
        "category": F.when(i % 103 == 0, F.repeat(F.lit("x"), F.lit(70))).otherwise(F.col("category")),
        "customer_id": F.when(i % 107 == 0, F.lit(-5).cast("long")).otherwise(F.col("customer_id")),
        "ticket_id": F.when(i % 109 != 0, i)})


def _quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1-C4 with the rows: planted violations of the stored fact, and lines
    of a CSV extract that lack a field or have one too many."""
    star_ = stored.for_tables(spark, sf_dir)
    found = quarantine.star_rows(_dirty(star_.fact), star_.dimensions)
    raw = fixture.raw_issues(spark, sf_dir)
    path = scratch(spark, "issues-csv")
    scan.write_csv_text(raw, path)
    fields = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in raw.columns[:-1]])
    line = F.when(F.col("id") % 113 == 0, fields).otherwise(F.concat(fields, F.lit(",1,2")))
    # every file must begin with the header; repeated ones are whole rows
    raw.filter("id % 113 = 0 or id % 127 = 0").select(F.concat(F.lit(",".join(raw.columns) + "\n"), line)) \
        .write.mode("append").text(path)
    lines = scan.read_csv_text(spark, path, as_text(ISSUES_SCHEMA), corrupt="_line")
    return found.unionByName(quarantine.malformed_rows(lines, "issues", "id", "_line")).drop("row")


QUERIES: dict[str, Query] = {
    # sources
    "scan_issues": _q(lambda m: m.issues),
    "scan_changes": _q(lambda m: m.changes),
    "scan_issues_csv": _scan_issues_csv,
    "scan_changes_csv": _scan_changes_csv,
    "input_counts": _q(_input_counts),
    "dashboard_base": _on_star(_dashboard_base),
    "preview": _on_star(_preview),
    # projections and filters
    "parse_timestamps": _q(_parse_timestamps),
    "invalid_resolution_count": _q(_invalid_resolution_count),
    "valid_issues": _q(_valid_issues),
    "resolution_hours": _q(_resolution_hours),
    "standardize_category": _q(_standardize_category),
    "standardize_priority": _q(_standardize_priority),
    "priority_flag": _q(_priority_flag),
    "standardize_project": _q(_standardize_project),
    "sla_target_met": _q(_sla_target_met),
    "sla_by_policy": _q(_sla_by_policy),
    "fact_tickets": _on_fact(lambda f: f),
    "warehouse_fact": _table("fact_tickets"),
    # state, de-dup, joins
    "latest_change_per_field": _q(_latest_change_per_field),
    "current_state": _q(_current_state),
    "dedup_tickets": _q(_dedup_tickets),
    "ticket_current_state": _q(_ticket_current_state),
    "fact_with_keys": _q(_fact_with_keys),
    "registry_keys": _registry_keys,
    # star schema
    "dim_customers": _table("dim_customers"),
    "dim_agents": _table("dim_agents"),
    "dim_projects": _table("dim_projects"),
    # marts
    "agent_volume": _on_fact(marts.agent_volume),
    "agent_rank_by_volume": _on_fact(marts.agent_rank_by_volume),
    "agent_performance": _table("agent_performance"),
    "resolution_performance": _table("resolution_performance"),
    "category_monthly_volume": _on_fact(marts.category_monthly_volume),
    "category_trends": _table("category_trends"),
    # reports
    "sla_by_priority": _report(reports.sla_by_priority),
    "data_end_stamps": _on_star(lambda s: s.ends),
    "top_agents_last_month": _on_star(lambda s: reports.top_agents_last_month(
        stored.with_names(s, "assignee"), last=s.last("resolution"))),
    "avg_resolution_by_project": _report(reports.avg_resolution_by_project, "project"),
    "view_avg_resolution_by_project": _view("view_avg_resolution_by_project"),
    "view_status_distribution": _view("view_status_distribution"),
    "agent_rank_by_speed": _report(reports.agent_rank_by_speed, "assignee"),
    "heavy_reporters": _report(reports.heavy_reporters, "reporter"),
    "running_resolved_total": _report(reports.running_resolved_total),
    "zero_compliance_categories": _on_star(lambda s: reports.zero_compliance_categories(s.fact, last=s.last("start"))),
    "zero_compliance_categories_anti": _on_star(
        lambda s: reports.zero_compliance_categories_anti(s.fact, last=s.last("start"))),
    "resolution_stats_by_priority": _report(reports.resolution_stats_by_priority),
    "status_distribution": _report(reports.status_distribution),
    "fastest_agent_per_project": _report(reports.fastest_agent_per_project, "assignee", "project"),
    # dashboard data sets
    "kpi_overall_compliance": _tile(dashboard.kpi_overall_compliance),
    "top_category": _tile(dashboard.top_category),
    "kpi_total_tickets": _tile(dashboard.kpi_total_tickets),
    "tickets_by_status": _tile(dashboard.tickets_by_status),
    "tickets_by_priority": _tile(dashboard.tickets_by_priority),
    "tickets_by_category": _tile(dashboard.tickets_by_category),
    "tickets_per_month": _tile(dashboard.tickets_per_month),
    "avg_hours_by_priority": _tile(dashboard.avg_hours_by_priority),
    "target_met_split": _tile(dashboard.target_met_split),
    "top_projects": _tile(dashboard.top_projects, "project"),
    "compliance_by_priority_all": _tile(dashboard.compliance_by_priority_all),
    "monthly_compliance_trend": _tile(dashboard.monthly_compliance_trend),
    "top_agents_by_tickets": _tile(dashboard.top_agents_by_tickets, "assignee"),
    "top_reporters_by_summary": _on_star(_top_reporters_by_summary),
    "top_n_by_count": _tile(dashboard.top_n_by_count_tiles, "project"),
    "top_agents_avg_hours": _tile(dashboard.top_agents_avg_hours, "assignee"),
    "category_month_heatmap": _tile(dashboard.category_month_heatmap),
    # checks
    "check_unique": _checks(quality.check_unique),
    "check_not_null": _checks(quality.check_not_null),
    "check_foreign_keys": _checks(quality.check_foreign_keys),
    "check_bounds": _q(_check_bounds),
    "quality_counts": _table("run_metrics"),
    "quarantined_rows": _quarantined_rows,
    "distinct_over_runs": _on_star(_distinct_over_runs),
    # documented extras
    "category_trends_with_hours": _on_fact(marts.category_trends_with_hours),
    "dim_date": _on_fact(extras.dim_date),
    "dim_category": _q(_dim_category),
    "dim_priority": _q(_dim_priority),
    "agent_monthly_hours": _on_fact(extras.agent_monthly_hours),
    "fastest_growing_categories": _on_fact(extras.fastest_growing_categories),
    "agent_workload_spread": _on_fact(extras.agent_workload_spread),
    "quantiles_by_span": _on_star(_quantiles_by_span),
    "stream_current_state": _stream_current_state,
    "stream_latest_per_field": _stream_latest_per_field,
    "incremental_star": _incremental(_named_fact),
    "incremental_dimensions": _incremental(_dimension_names),
    "incremental_agent_performance": _incremental(lambda s: s.tables["agent_performance"].join(
        s.tables["dim_agents"], "agent_id", "left").drop("agent_id")),
    "incremental_resolution_performance": _incremental(lambda s: s.tables["resolution_performance"]),
    "incremental_category_trends": _incremental(lambda s: s.tables["category_trends"]),
    # sinks and the whole run
    "parquet_roundtrip": _parquet_roundtrip,
    "run_pipeline": _run_pipeline,
}
