"""The whole run, incrementally (R-D5): new ticket and change-log files keep
the star up to date, at a cost that goes with the new files.

One Structured Streaming query reads both landing folders (``availableNow``);
each micro-batch is an epoch.  Stored per ticket are what later files may still
need: the winning ticket row (as a fact row without a state, with keys for
names, and what orders the picks) and the newest change per field.  Both are
picks by a total order, so (stored picks + new rows) gives the same picks as
all rows ever seen, in any order of arrival.

Tables are split by ranges of ticket ids (``width`` ids a bucket; ids are
handed out in time, so new files touch the last buckets).  An epoch rewrites
touched buckets only, each as a new version ``epoch=n/bucket=b``.  Readers
take, of every bucket, the newest version that a commit names.  The marts are
sums of signed deltas: the fact rows that the epoch changes, old ones counted
-1 and new ones +1.  Names get lasting keys from a registry
(``operators.keys``) when they arrive, also those that no fact row shows in the
end.

An epoch reads versions, deltas and keys of earlier epochs only and writes
under its own number, and its commit is written last, so an epoch that is
replayed after a failure gives the same files, whatever part of it was there.

The driver holds one number per (table, bucket) -- what a file listing has --
and no rows.  ``vacuum`` removes versions that a newer one has replaced.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import month_start, round2
from ..operators import clean, fact, keys, marts, star, state
from ..schemas import CHANGES_SCHEMA, ISSUES_SCHEMA, WAREHOUSE_FACT_COLUMNS, as_text
from ..session import persisting, prepare, remove, workspace
from ..sources import scan
from .current_state import stream_base

#: Ticket ids per bucket.
WIDTH = 1 << 20
#: Slices per bucket: all rows of a slice of ids are in one task, so a version has at most as many files.
SLICES = 16
VERSIONED = ("tickets", "latest", "fact")
SCHEMAS = {
    "tickets": "ticket_id bigint, customer_id bigint, agent_id bigint, project_id bigint, category string, "
               "priority string, start_time timestamp, resolution_time timestamp, resolution_duration_hours double, "
               "resolution_target_met boolean, last_change_date timestamp, row_hash bigint",
    "latest": "issueid bigint, field string, id bigint, value string, created timestamp, value_key bigint",
    "fact": "ticket_id bigint, customer_id bigint, agent_id bigint, project_id bigint, category string, "
            "priority string, start_time timestamp, resolution_time timestamp, resolution_duration_hours double, "
            "status string, resolution_target_met boolean",
}
TICKETS, LATEST, FACT = (tuple(f.split()[0] for f in SCHEMAS[t].split(", ")) for t in VERSIONED)
#: Rows that are partitioned by slice are so for a join on (slice, id) too, and
#: a task with a few buckets has a writer open for each instead of a sort.
EPOCH_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false",
              "spark.sql.maxConcurrentOutputFileWriters": "16"}
_SUMS = ("n", "seconds", "timed", "met", "judged")
Versions = dict[str, dict[int, int]]      # table -> bucket -> epoch


def bucket_of(ticket_id: str, width: int) -> Column:
    """The bucket of a ticket id; NULL ids have one of their own."""
    return F.coalesce(F.expr(f"{ticket_id} div {width}"), F.lit(-1)).cast("long").alias("bucket")


def slice_of(ticket_id: str, width: int) -> Column:
    """The slice of a ticket id, by which an epoch's rows are partitioned."""
    return F.coalesce(F.expr(f"{ticket_id} div {max(1, width // SLICES)}"), F.lit(-1)).cast("long").alias("slice")


# --- versions --------------------------------------------------------------

def _commits(spark: SparkSession, base: str) -> DataFrame:
    schema = "table string, bucket bigint, epoch bigint"
    try:
        return spark.read.schema(schema).parquet(f"{base}/commits")
    except AnalysisException:      # no epoch yet
        return spark.createDataFrame([], schema)


def versions(spark: SparkSession, base: str, before: int | None = None) -> tuple[Versions, int]:
    """Newest committed version of every bucket (of epochs below ``before``)
    and the last committed epoch (-1: none)."""
    rows = _commits(spark, base)
    if before is not None:
        rows = rows.filter(F.col("epoch") < before)
    out: Versions = {t: {} for t in VERSIONED}
    last = -1
    for r in rows.groupBy("table", "bucket").agg(F.max("epoch").alias("epoch")).collect():
        last = max(last, r.epoch)
        if r.table in out:
            out[r.table][r.bucket] = r.epoch
    return out, last


def _read(spark: SparkSession, base: str, table: str, held: dict[int, int]) -> DataFrame:
    """The rows of these bucket versions."""
    if not held:
        return spark.createDataFrame([], SCHEMAS[table])
    paths = [f"{base}/{table}/epoch={e}/bucket={b}" for b, e in sorted(held.items())]
    return spark.read.schema(SCHEMAS[table]).parquet(*paths)


def _write(rows: DataFrame, base: str, table: str, ticket_id: str, buckets: set[int], width: int, epoch: int) -> None:
    """New versions of these buckets; ``rows`` are partitioned by slice.  An
    epoch has a folder of its own: Spark drops what it persists of a folder
    that is written to, and rows of earlier epochs are still in use."""
    names = [f.split()[0] for f in SCHEMAS[table].split(", ")]
    (rows.select(*names, bucket_of(ticket_id, width)).filter(F.col("bucket").isin(*buckets))
     .write.mode("overwrite").option("compression", "zstd").partitionBy("bucket")
     .parquet(f"{base}/{table}/epoch={epoch}"))


def _commit(spark: SparkSession, base: str, epoch: int, done: list[tuple[str, int]]) -> None:
    """Makes an epoch's versions, deltas and keys count."""
    spark.createDataFrame(done, "table string, bucket bigint").coalesce(1) \
        .write.mode("overwrite").parquet(f"{base}/commits/epoch={epoch}")


def vacuum(spark: SparkSession, base: str) -> int:
    """Removes versions that a newer committed one has replaced; returns how many."""
    now, last = versions(spark, base)
    gone = [(r.table, r.bucket, r.epoch) for r in _commits(spark, base).filter(F.col("table").isin(*VERSIONED)).collect()
            if r.epoch < now[r.table][r.bucket]]
    for table, bucket, epoch in gone:
        remove(spark, f"{base}/{table}/epoch={epoch}/bucket={bucket}")
    return len(gone)


# --- one epoch -------------------------------------------------------------

def signed_deltas(rows: DataFrame) -> dict[str, DataFrame]:
    """The marts' sums over fact rows with a column ``sign`` (+1 or -1)."""
    sign = F.col("sign")
    total = lambda c: F.sum(sign * c).alias
    done = rows.filter(F.col("resolution_time").isNotNull())
    hours, met = F.col("resolution_duration_hours"), F.col("resolution_target_met")
    role = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(k).alias("key"))
                               for r, k, _ in star.DIMENSIONS.values()]))
    out = {
        "agents": done.groupBy("agent_id").agg(
            F.sum(sign).alias("n"), total(F.coalesce(F.round(hours * 3600).cast("long"), F.lit(0)))("seconds"),
            total(hours.isNotNull().cast("int"))("timed")),
        "resolution": done.groupBy("priority", month_start("resolution_time").alias("month")).agg(
            F.sum(sign).alias("n"), total(F.coalesce(met, F.lit(False)).cast("int"))("met"),
            total(met.isNotNull().cast("int"))("judged")),
        "category": rows.groupBy("category", month_start("start_time").alias("month")).agg(F.sum(sign).alias("n")),
        "names": rows.select("sign", role.alias("r")).filter("r.key is not null")
        .groupBy(F.col("r.role").alias("role"), F.col("r.key").alias("key")).agg(F.sum(sign).alias("n")),
    }
    changed = lambda df: reduce(Column.__or__, [F.col(c) != 0 for c in df.columns if c in _SUMS])
    return {name: df.filter(changed(df)) for name, df in out.items()}


def _buckets(rows: DataFrame, ticket_id: str, width: int) -> set[int]:
    return {r.bucket for r in rows.select(bucket_of(ticket_id, width)).distinct().collect()}


def _keyed(issues: DataFrame, changes: DataFrame, registry: str, epoch: int) -> tuple[DataFrame, DataFrame]:
    """New tickets as fact rows without a state, and new changes, both with
    keys for names; new names are registered."""
    none = F.lit(None).cast("string")
    rows = fact.fact_tickets(issues.withColumns({"current_assignee": none, "current_status": none})
                             .select("*", clean.row_hash(issues).alias("row_hash")), "last_change_date", "row_hash")
    assigned = changes.filter(F.col("field") == "assignee")
    names = star.distinct_names(rows, [r for r, *_ in star.DIMENSIONS.values()]).unionAll(
        star.distinct_names(assigned.select(F.col("value").alias("assignee")), ["assignee"])).distinct()
    dims = star.Dimensions(keys.extend(names, registry, epoch))
    agents = dims.table("agents")
    by_key = assigned.join(agents, assigned["value"] == agents["agent_name"], "left") \
        .withColumnRenamed("agent_id", "value_key")
    others = changes.filter(~F.col("field").eqNullSafe("assignee")).withColumn("value_key", F.lit(None).cast("long"))
    return (star.fact_with_keys(rows, dims).select(*TICKETS),
            by_key.select(*LATEST).unionAll(others.select(*LATEST)))


def _with_state(tickets: DataFrame, changes: DataFrame) -> DataFrame:
    """Fact rows with their state, and the slice they are in."""
    now = state.current_state(changes, ("slice", "issueid"), ("value_key",))
    return state.attach_state(tickets, now, "ticket_id", ("slice",)).withColumns({
        "agent_id": F.coalesce("value_key", "agent_id"), "status": F.col("current_status")}).select("slice", *FACT)


def apply_epoch(spark: SparkSession, base: str, raw_issues: DataFrame, raw_changes: DataFrame, epoch: int,
                width: int = WIDTH) -> None:
    """Folds raw text rows into the star as epoch ``epoch``.

    Stored and new rows meet in one exchange each of tickets and of changes,
    by slices of ids, and are sorted there once; picks, joins and all three
    tables' new versions follow from it without another.  ``spark`` should let
    a join on (slice, id) use that (``EPOCH_CONF``); the result does not depend
    on it."""
    with workspace(spark), persisting() as keep:
        issues = keep(clean.valid_issues(clean.parse_issue_stamps(scan.scan_issues(raw_issues))))
        changes = keep(clean.parse_change_stamps(scan.scan_changes(raw_changes))
                       .filter(F.col("field").isin(*state.STATE_FIELDS) & F.col("issueid").isNotNull()))
        before, _ = versions(spark, base, before=epoch)
        in_issues, in_changes = _buckets(issues, "id", width), _buckets(changes, "issueid", width)
        touched = in_issues | in_changes
        parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

        def meet(table: str, ticket_id: str, new: DataFrame, order: list) -> DataFrame:
            held = {b: e for b, e in before[table].items() if b in touched}
            rows = _read(spark, base, table, held).withColumn("held", F.lit(True)) \
                .unionByName(new.withColumn("held", F.lit(False)))
            return keep(rows.withColumn("slice", slice_of(ticket_id, width)).repartition(parts, "slice")
                        .sortWithinPartitions("slice", ticket_id, *order))

        new_tickets, new_changes = _keyed(issues, changes, f"{base}/registry", epoch)
        tickets = meet("tickets", "ticket_id", new_tickets, clean.pick_order(new_tickets, "start_time", "row_hash"))
        log = meet("latest", "issueid", new_changes, ["field"])
        picked = clean.dedup_tickets(tickets.drop("held"), ("slice", "ticket_id"), "start_time", "row_hash")
        newest = state.latest_change_per_field(log.drop("held"), ("slice", "issueid"))
        # a ticket that no new row names has the same fact row as before
        now = _with_state(picked, newest).select("slice", "ticket_id", F.struct(*FACT).alias("now"))
        then = _with_state(tickets.filter("held"), log.filter("held")) \
            .select(F.col("slice").alias("_slice"), F.col("ticket_id").alias("_id"), F.struct(*FACT).alias("then"))
        same = (now["slice"] == then["_slice"]) & now["ticket_id"].eqNullSafe(then["_id"])
        # flat columns, which the storage packs, and an old row only where it differs
        changed, was = ~F.col("now").eqNullSafe(F.col("then")), {c: f"then_{c}" for c in FACT}
        rows = keep(now.join(then, same, "left").select(
            "now.*", changed.alias("changed"), (changed & F.col("then").isNotNull()).alias("replaced"),
            *[F.when(changed, F.col(f"then.{c}")).alias(w) for c, w in was.items()]))
        in_fact = in_issues | {b for b in before["tickets"] if b in touched}
        jobs = [(picked, base, "tickets", "ticket_id", in_issues), (newest, base, "latest", "issueid", in_changes),
                (rows.select(*FACT), base, "fact", "ticket_id", in_fact)]
        with ThreadPoolExecutor(len(jobs)) as pool:
            list(pool.map(lambda job: _write(*job, width, epoch), [j for j in jobs if j[-1]]))

        new = F.struct(F.lit(1).cast("long").alias("sign"), *FACT)
        old = F.struct(F.lit(-1).cast("long").alias("sign"), *[F.col(w).alias(c) for c, w in was.items()])
        signed = F.when(F.col("replaced"), F.array(new, old)).otherwise(F.array(new))
        deltas = signed_deltas(rows.filter("changed").select(F.explode(signed).alias("s")).select("s.*"))
        with ThreadPoolExecutor(len(deltas)) as pool:
            list(pool.map(lambda name: deltas[name].write.mode("overwrite")
                          .parquet(f"{base}/deltas/{name}/epoch={epoch}"), deltas))
        done = [("tickets", b) for b in in_issues] + [("latest", b) for b in in_changes] + \
            [("fact", b) for b in in_fact] + [("run", -1)]
        _commit(spark, base, epoch, done)


# --- the stream ------------------------------------------------------------

def _stream(spark: SparkSession, issues_dir: str, changes_dir: str, fmt: str, options: dict[str, str]) -> DataFrame:
    """Both landing folders as one stream of (issue, change), one of them NULL."""
    kinds = {"issue": as_text(ISSUES_SCHEMA), "change": as_text(CHANGES_SCHEMA)}

    def one(kind: str, schema: StructType, path: str) -> DataFrame:
        rows = spark.readStream.schema(schema).options(**options).format(fmt).load(path)
        return rows.select(*[(F.struct(*schema.names) if k == kind else F.lit(None).cast(s)).alias(k)
                             for k, s in kinds.items()])
    return one("issue", kinds["issue"], issues_dir).unionByName(one("change", kinds["change"], changes_dir))


def run_available(spark: SparkSession, issues_dir: str, changes_dir: str, name: str, fmt: str = "parquet",
                  options: dict[str, str] | None = None, width: int = WIDTH) -> str:
    """Folds all files not seen yet into the star ``name`` and returns its
    folder.  Call it when files have landed; a call after a failure resumes
    from the checkpoint.  ``options`` go to both readers (for example
    maxFilesPerTrigger, header)."""
    prepare(spark)
    base = stream_base(spark, name)

    def epoch_of(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession        # the stream's own
        for name, value in EPOCH_CONF.items():
            session.conf.set(name, value)
        apply_epoch(session, base, batch.filter("issue is not null").select("issue.*"),
                    batch.filter("change is not null").select("change.*"), epoch, width)

    query = (_stream(spark, issues_dir, changes_dir, fmt, options or {}).writeStream.foreachBatch(epoch_of)
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return base


# --- reading ---------------------------------------------------------------

def _sums(spark: SparkSession, base: str, mart: str, schema: str, last: int) -> DataFrame:
    """The mart's groups that have tickets, with their sums over all epochs."""
    rows = spark.read.schema(f"{schema}, epoch bigint").parquet(f"{base}/deltas/{mart}").filter(F.col("epoch") <= last)
    by = [c for c in rows.columns if c not in (*_SUMS, "epoch")]
    sums = rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in rows.columns if c in _SUMS])
    return sums.filter(F.col("n") > 0)


def open_star(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The seven tables as of the last committed epoch; keys are the
    registry's."""
    held, last = versions(spark, base)
    if last < 0:
        raise ValueError(f"no epoch in {base}")
    names = keys.read(spark, f"{base}/registry", before=last + 1) \
        .join(_sums(spark, base, "names", "role string, key bigint, n bigint", last).drop("n"), ["role", "key"], "left_semi")
    dims = star.Dimensions(names)
    agents = _sums(spark, base, "agents", "agent_id bigint, n bigint, seconds bigint, timed bigint", last)
    mean = F.try_divide(F.col("seconds").cast("double"), F.col("timed") * F.lit(3600.0))
    agents = agents.select("agent_id", F.col("n").alias("tickets_resolved"),
                           round2(mean).alias("avg_resolution_duration_hours"))
    done = _sums(spark, base, "resolution", "priority string, month timestamp, n bigint, met bigint, judged bigint", last)
    rate = round2(F.lit(100.0) * F.when(F.col("judged") > 0, F.col("met")) / F.col("n"))
    monthly = _sums(spark, base, "category", "category string, month timestamp, n bigint", last)
    return {
        **{f"dim_{d}": dims.table(d) for d in star.DIMENSIONS},
        "fact_tickets": star.warehouse_fact(_read(spark, base, "fact", held["fact"])).select(*WAREHOUSE_FACT_COLUMNS),
        "agent_performance": marts.typed_agent_performance(
            marts.dense_rank_desc(agents, "tickets_resolved", "rank_by_volume")),
        "resolution_performance": marts.typed_resolution_performance(
            done.select("priority", "month", F.col("n").alias("tickets_resolved"), rate.alias("compliance_rate"))),
        "category_trends": marts.typed_category_trends(
            marts.with_month_over_month(monthly.withColumnRenamed("n", "ticket_volume"))),
    }
