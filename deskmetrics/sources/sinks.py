"""Sinks: curated Parquet zone and JDBC warehouse (K2, K3).

Both are full refreshes and safe to run twice.  Connection settings come from
the caller; nothing is hard-coded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import default_parallelism


#: Row groups of time-clustered tables: small enough that a month is some of
#: them, large enough for a scan.
ROW_GROUP_BYTES = 32 << 20


def curate(df: DataFrame, path: str, by: str | None = None, stamps: tuple[str, ...] = (),
           lookup: str | None = None, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Replace the Parquet table at ``path``.

    With ``by`` the table is partitioned on that column; the rows are
    rebalanced on it first, so each value gets a few files rather than one
    per input task, and AQE splits a large value over several tasks.  NULLs
    land in the default partition and read back as NULL.

    With ``stamps`` the rows are clustered by the first of them that is not
    NULL: rebalanced by value and
    month, so a file holds whole months (AQE splits a large month and merges
    small ones; no sampling pass), and sorted by it, so the bounds of
    a row group are narrow and range filters skip most of them.  ``lookup``
    names a key column that gets Parquet Bloom filters, for point lookups.
    """
    options = {}
    if lookup is not None:
        options |= {f"parquet.bloom.filter.enabled#{lookup}": "true",
                    "parquet.bloom.filter.adaptive.enabled": "true"}
    if by is None:
        rows = df
    elif not stamps:
        rows = df.hint("rebalance", by)
    else:
        options["parquet.block.size"] = str(row_group_bytes)
        stamp = F.coalesce(*stamps)
        rows = (df.withColumns({"_stamp": stamp, "_month": F.date_trunc("month", stamp)})
                .hint("rebalance", by, "_month").sortWithinPartitions(by, "_stamp").drop("_stamp", "_month"))
    rows.write.options(**options).parquet(path, mode="overwrite", partitionBy=by)


def read_footers(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table through the V2 reader, which answers MIN, MAX and COUNT
    of whole-number columns from the files' footers.  ``schema`` must begin
    with the files' first columns, in their order: Spark 4.1 looks footers up
    by position.  (Stamps, decimals and text have no usable bounds there, and
    a row group without any value is an error: write a stand-in for NULL.)"""
    conf = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "")
    try:
        return spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(conf, before)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None,
                 schema: StructType | None = None) -> DataFrame:
    """Read a curated table; partition columns move to the end on read, so
    the declared column order is restored when given.  A known schema spares
    the footer-inference job."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def append_jdbc(df: DataFrame, url: str, table: str, connections: int,
                properties: dict[str, str] | None = None, batch_size: int = 10000) -> None:
    """Append over JDBC with ``connections`` concurrent writers.

    The rows are dealt out to the writers by a shuffle, so the tasks before
    it keep their own number.  Each task commits its rows as one transaction,
    so a retried task does not leave half a partition behind on a
    transactional database."""
    (df.repartition(connections).write.format("jdbc")
     .options(url=url, dbtable=table, batchsize=str(batch_size), **(properties or {}))
     .mode("append").save())


def empty_tables(spark: SparkSession, url: str, tables: list[str], properties: dict[str, str] | None = None,
                 statement: str = "DELETE FROM {table}") -> None:
    """Run ``statement`` for every table, in one transaction.

    Name the tables child first.  The default respects foreign keys on any
    database; a faster form can be given, for example
    ``TRUNCATE TABLE {table} CASCADE`` on PostgreSQL."""
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        settings.setProperty(k, v)
    if "driver" in (properties or {}):
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        driver = loader.loadClass(properties["driver"]).newInstance()
        connection = driver.connect(url, settings)
    else:
        connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        run = connection.createStatement()
        for table in tables:
            run.executeUpdate(statement.format(table=table))
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def refresh_warehouse(tables: dict[str, DataFrame], url: str, connections: int,
                      names: dict[str, str] | None = None, properties: dict[str, str] | None = None,
                      empty_statement: str = "DELETE FROM {table}") -> None:
    """Full refresh of tables that exist with their keys: ``tables`` is in
    load order (parents first); all are emptied child first, then appended
    parents first.  ``names`` maps to the database's names."""
    target = {t: (names or {}).get(t, t) for t in tables}
    spark = next(iter(tables.values())).sparkSession
    empty_tables(spark, url, [target[t] for t in reversed(tables)], properties, empty_statement)
    for name, df in tables.items():
        append_jdbc(df, url, target[name], connections, properties)


def read_jdbc(spark: SparkSession, url: str, table: str,
              properties: dict[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Read a warehouse table; with a numeric partition column and its
    bounds the read is split into ``num_partitions`` parallel range queries
    instead of one connection reading everything."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
             .option("numPartitions", str(num_partitions or default_parallelism(spark))))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()
