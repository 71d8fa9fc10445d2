"""Session, scratch-folder and row-identity helpers of the subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, default_parallelism, sweep  # noqa: F401

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are runs of anything but ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
#: Words are runs of ASCII letters, digits and all non-ASCII characters.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no frame has such a column."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def every(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever their names hold."""
    return [df[f"`{c}`"] for c in df.columns]


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names (in any case)."""
    gone = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in gone])


def undotted(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with names that ``mapInArrow`` can address (none with a dot or a
    backtick), and the map back to its own names."""
    back = {fresh(f"_c{i}", df): c for i, c in enumerate(df.columns) if "." in c or "`" in c}
    own = {c: safe for safe, c in back.items()}
    return df.toDF(*[own.get(c, c) for c in df.columns]), back


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, what: str, plain: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage,
    keeps column pruning, survives lost executors.  ``plain`` is for values
    that repeat little, such as hashes: they are written without a dictionary."""
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.option("parquet.enable.dictionary", not plain).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(*frames: DataFrame) -> None:
    """Delete the files of staged frames that are no longer needed."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only.  ``translate`` looks every character up, so texts
    of ASCII alone take ``lower``, which is the same there."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def held_out(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a NULL id counts as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))
                   .cast("binary")) % F.lit(modulus)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session, at least one per core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")),
               default_parallelism(spark))


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """A mapInArrow function from a batch function."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return run
