"""Scans of the two raw extracts.

Text columns are cast with ``try_cast`` so a bad number becomes NULL instead
of failing the job under ANSI mode.  Integral columns fall back to a cast via
double so ``'3.0'`` still reads as 3; the direct cast runs first so large ids
keep full precision.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..schemas import CHANGES_SCHEMA, ISSUES_SCHEMA


def _cast(col: Column, dtype) -> Column:
    if isinstance(dtype, (LongType, IntegerType)):
        return F.coalesce(col.try_cast(dtype), col.try_cast("double").try_cast(dtype))
    return col.try_cast(dtype)


def cast_to_schema(raw: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns from a text frame and cast them.

    Extra columns are ignored; a missing one fails analysis, like the
    reference's explicit projection.
    """
    return raw.select(*[_cast(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def scan_issues(raw: DataFrame) -> DataFrame:
    return cast_to_schema(raw, ISSUES_SCHEMA)


def scan_changes(raw: DataFrame) -> DataFrame:
    return cast_to_schema(raw, CHANGES_SCHEMA)


@contextmanager
def _whole_files(spark: SparkSession) -> Iterator[None]:
    """While open, a file scan has one task per file and hands rows to Python
    one at a time, so a task that stops early has read a few lines only."""
    settings = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50),
                "spark.sql.files.maxPartitionNum": None, "spark.sql.files.minPartitionNum": None,
                "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files by their header.  The first lines are read by one Spark job, a
    task per file, whatever store and compression they are in; the driver gets
    each different header and the files that have it."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    with _whole_files(spark):
        rows = (lines.mapInArrow(_first_row, "file string, value string")
                .groupBy("value").agg(F.sort_array(F.collect_list("file")).alias("files")).collect())
    found: dict[tuple[str, ...], list[str]] = {}
    for line, files in rows:
        if line and line.strip("\ufeff \t\r"):
            columns = next(csv.reader([line.lstrip("\ufeff").rstrip("\r")]))
            found.setdefault(tuple(c.strip() for c in columns), []).extend(unquote(f) for f in files)
    return found


def read_csv_text(spark: SparkSession, path: str, schema: StructType, corrupt: str | None = None) -> DataFrame:
    """The declared columns of header CSV files as text, taken by name.

    Column order may differ, also between the files of a folder: files are
    read in groups with the same header, each with the names of that header
    (everything text, no inference pass).  Extra columns are ignored; a
    column that a file lacks fails analysis.  ``corrupt`` names one more
    column with the whole line where a row has more or fewer fields than its
    header (see ``operators.quarantine``), NULL elsewhere.
    """
    names = [f.name for f in schema.fields]
    own = [corrupt] if corrupt else []
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    if corrupt:
        # a pruned scan counts the fields of the wanted columns only
        reader = reader.option("columnNameOfCorruptRecord", corrupt).option("columnPruning", "false")
    text = lambda columns: StructType([StructField(c, StringType()) for c in columns])
    groups = _headers(spark, path)
    if not groups:                       # no file, or empty ones
        return reader.schema(text([*names, *own])).csv(path)
    parts = [reader.schema(text([*header, *own])).csv(path if len(groups) == 1 else files).select(*names, *own)
             for header, files in sorted(groups.items())]
    return reduce(DataFrame.unionAll, parts)


def read_issues_csv(spark: SparkSession, path: str) -> DataFrame:
    return scan_issues(read_csv_text(spark, path, ISSUES_SCHEMA))


def read_changes_csv(spark: SparkSession, path: str) -> DataFrame:
    return scan_changes(read_csv_text(spark, path, CHANGES_SCHEMA))


def write_csv_text(df: DataFrame, path: str) -> None:
    """Write a text frame as header CSV (used to build raw extracts)."""
    (df.write.mode("overwrite").option("header", "true")
     # the writer trims blanks by default; the extracts keep theirs
     .option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false")
     .csv(path))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs next,
    so counting the input costs no extra pass over it."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def input_counts(issues: DataFrame, changes: DataFrame) -> DataFrame:
    """Row counts of both inputs as a two-row frame (source, rows)."""
    return (issues.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("issues").alias("source"), "rows")
            .unionByName(changes.agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit("changes").alias("source"), "rows")))
