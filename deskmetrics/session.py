"""Session helpers.

``prepare`` pins the settings every query relies on (UTC session zone, a
checkpoint directory) on a session someone else built.  ``local_session`` is
for tests and the bench only.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Scratch folders of the innermost open ``workspace``.
_FOLDERS: ContextVar[list[str] | None] = ContextVar("folders", default=None)


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None on Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by whoever launches the job (a shared,
    fault-tolerant file system).  Only a local-mode session without it gets a
    scratch folder of its own.
    """
    sc = _context(spark)
    current = (sc.getCheckpointDir() if sc is not None else None) or \
        spark.conf.get(CHECKPOINT_CONF, None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="deskmetrics-ckpt-")
    sc.setCheckpointDir(path)
    spark.conf.set(CHECKPOINT_CONF, path)
    return path


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared checkpoint folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"
    folders = _FOLDERS.get()
    if folders is not None:
        folders.append(path)
    return path


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Removes every ``scratch`` folder handed out inside, also on errors."""
    folders: list[str] = []
    token = _FOLDERS.set(folders)
    try:
        yield
    finally:
        _FOLDERS.reset(token)
        for path in folders:
            remove(spark, path)


def staged(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once as Parquet and read back: cuts lineage like a
    checkpoint, but later reads prune columns and push filters down."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a folder; one that is at its new place already stays."""
    sc = _context(spark)
    source, target = (sc._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    fs = source.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(target):
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"{path} was not moved to {to}")


@contextmanager
def persisting() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Hands out a function that persists frames for the time of the block."""
    frames: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        frames.append(df.persist())
        return df
    try:
        yield keep
    finally:
        for df in reversed(frames):
            df.unpersist()


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of the block."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sweep(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of steps that are done:
    it does so when the driver collects its garbage, which a driver with
    little to do puts off while the files fill the executors' disks."""
    gc.collect()
    sc = _context(spark)
    if sc is not None:
        sc._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder this package wrote."""
    sc = _context(spark)
    if sc is None:
        return
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC and make sure checkpoints have a home.

    Ticket stamps carry no zone; UTC keeps month boundaries and hour
    differences free of daylight-saving shifts.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # stamps as 64-bit microseconds: the default form has no bounds in the
    # footers, so no range filter could skip a row group
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    # lets a maximum of stored seconds come from Parquet footers (V2 scans only)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    checkpoint_dir(spark)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  scratch: str | None = None) -> SparkSession:
    """A local-mode session with the settings used by tests and the bench."""
    scratch = scratch or tempfile.mkdtemp(prefix="deskmetrics-run-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("deskmetrics")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small test inputs with CPU-heavy rows: let AQE keep more, smaller
        # partitions than its 1 MB default floor (no effect at real sizes)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.driver.memory", os.environ.get("DESKMETRICS_DRIVER_MEMORY", "8g"))
        .config("spark.local.dir", os.path.join(scratch, "local"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.extraJavaOptions",
                f"-Dderby.system.home={os.path.join(scratch, 'derby')}")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # spark.checkpoint.dir comes from the environment's defaults when set;
    # prepare() gives an unset local session a scratch folder
    return prepare(spark)
