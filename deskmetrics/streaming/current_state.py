"""Incremental current state (R-D5): new change-log files are picked up as
they land and the latest assignee / status per ticket is kept up to date.

The state is one row per ticket, not an event-time window, so no watermark
can retire it; "latest" is decided by the log's own stamp and id, not by
arrival, so late or out-of-order files are handled by the ordering itself.
``row_number`` is not allowed on streams; the aggregate form (max of the
ordering struct) is, and equals the batch operator.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.clean import parse_change_stamps
from ..operators.state import current_state, latest_change_per_field
from ..session import checkpoint_dir, default_parallelism


STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_current_state(changes: DataFrame) -> DataFrame:
    """Streaming (or batch) ticket change log -> latest assignee / status."""
    return current_state(changes)


def stream_latest_per_field(changes: DataFrame) -> DataFrame:
    """Streaming (or batch) log of any fields -> latest value per (key, field)."""
    return latest_change_per_field(changes)


def run_available(spark: SparkSession, source_dir: str, schema: StructType, fmt: str = "parquet",
                  transform=None, name: str | None = None,
                  max_files_per_trigger: int | None = None,
                  operator=stream_current_state, glob: str | None = None,
                  keys: tuple[str, ...] = ("issueid",),
                  state_partitions: int | None = None,
                  state_store: str | None = ROCKSDB_STATE_STORE) -> DataFrame:
    """Process every file in ``source_dir`` now (``availableNow``), in
    micro-batches, and return the resulting state.

    Update mode: each micro-batch emits only the keys whose state changed and
    ``foreachBatch`` writes them to their own ``epoch=N`` folder (overwrite, so
    a replayed epoch is idempotent).  The current state is the newest epoch's
    row per key -- an aggregate, so readers never need the whole state in one
    place.  The query checkpoint lives under the session's checkpoint folder,
    so a restart resumes where it stopped.  ``transform`` maps the raw stream
    to the change-log shape (id, issueid, field, value, created).

    The state is split into ``state_partitions`` partitions, fixed for the
    life of the checkpoint (default: the cluster's parallelism), and kept in
    RocksDB on the executors' disks rather than in their heap: it holds one
    row per key for ever (no watermark can retire it).  Both session
    settings are only changed while the query starts (the query keeps its
    own copy).  The update folders grow with the epochs; ``compact`` folds
    them into a snapshot that readers start from.  A second call with the
    same ``name`` resumes the same query (same checkpoint, same folders).
    """
    name = name or f"current_state_{uuid.uuid4().hex[:8]}"
    base = stream_base(spark, name)
    out_path = f"{base}/updates"
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.load(source_dir)
    changes = transform(raw) if transform else parse_change_stamps(raw)
    state = operator(changes)

    def publish(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")

    partitions = state_partitions or default_parallelism(spark)
    settings = {"spark.sql.shuffle.partitions": str(partitions)}
    if state_store:
        settings[STATE_STORE_CONF] = state_store
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        q = (state.writeStream
             .outputMode("update")
             .foreachBatch(publish)
             .option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True)
             .start())
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    q.awaitTermination()
    return current_table(spark, base, state.schema, keys)


def stream_base(spark: SparkSession, name: str) -> str:
    """Folder of a named stream: checkpoint, updates, snapshots."""
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def _published(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField("epoch", LongType())])


def _last_snapshot(spark: SparkSession, base: str) -> int | None:
    try:
        return spark.read.schema("upto long").parquet(f"{base}/compactions") \
            .agg(F.max("upto")).first()[0]
    except AnalysisException:  # never compacted
        return None


def current_table(spark: SparkSession, base: str, schema: StructType,
                  keys: tuple[str, ...]) -> DataFrame:
    """The current state: the newest row per key over the latest snapshot
    and the update epochs after it (older epochs are pruned by partition)."""
    published = _published(schema)
    try:
        updates = spark.read.schema(published).parquet(f"{base}/updates")
    except AnalysisException:  # no micro-batch produced output
        updates = spark.createDataFrame([], published)
    upto = _last_snapshot(spark, base)
    if upto is not None:
        snapshot = (spark.read.schema(schema).parquet(f"{base}/snapshots/upto={upto}")
                    .withColumn("epoch", F.lit(upto).cast("long")))
        updates = updates.filter(F.col("epoch") > upto).unionByName(snapshot)
    return latest_per_key(updates, list(keys))


def compact(spark: SparkSession, base: str, schema: StructType, keys: tuple[str, ...]) -> int | None:
    """Fold every published epoch into a new snapshot folder and record it;
    readers then skip the folded epochs.  The snapshot never shares a folder
    with an epoch, so a replayed micro-batch cannot overwrite it; folded
    epoch folders can be removed by the storage's retention rules."""
    published = _published(schema)
    try:
        last = spark.read.schema(published).parquet(f"{base}/updates").agg(F.max("epoch")).first()[0]
    except AnalysisException:
        return None
    if last is None or last == _last_snapshot(spark, base):
        return last
    state = current_table(spark, base, schema, keys)
    state.write.mode("overwrite").parquet(f"{base}/snapshots/upto={last}")
    spark.createDataFrame([(int(last),)], "upto long").write.mode("append").parquet(f"{base}/compactions")
    return last


def latest_per_key(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Newest published row per key across epochs."""
    values = [c for c in updates.columns if c not in keys and c != "epoch"]
    return (updates.groupBy(*keys)
            .agg(F.max(F.struct(F.col("epoch").cast("long").alias("_e"), *values)).alias("_l"))
            .select(*keys, *[F.col(f"_l.{c}").alias(c) for c in values]))


def events_as_changes(events: DataFrame) -> DataFrame:
    """The ``events`` table read as a change log: user -> ticket, event type
    -> field, value -> new value, ts -> stamp cut to whole seconds."""
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("issueid"),
        F.col("event_type").alias("field"),
        F.col("value").cast("string").alias("value"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("created"),
    )
