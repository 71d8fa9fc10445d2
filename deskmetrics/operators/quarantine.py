"""The rows behind the checks (C1-C4): each violating row with its reasons.

One pass per table: every row gets an array of (column, reason), empty arrays
are dropped, the rest is exploded to one row per reason with the row as JSON.
Duplicates are found by a count per key (partial sums map-side, so a key with
a third of all rows is one row after it) and joined back; dimension keys are
plain joins, which AQE broadcasts or splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CATEGORY_MAX_LEN, NAME_MAX_LEN, PRIORITY_MAX_LEN, STATUS_MAX_LEN

SCHEMA = "table_name string, column_name string, reason string, key string, row string"
LENGTHS = {"category": CATEGORY_MAX_LEN, "priority": PRIORITY_MAX_LEN, "status": STATUS_MAX_LEN}
HOURS = "resolution_duration_hours"


def _listed(rows: DataFrame, table: str, key: str, columns: list[str], rules: list[tuple[str, str, Column]]) -> DataFrame:
    """One row per broken rule (column, reason, condition) of each row."""
    broken = F.array_compact(F.array(*[
        F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("reason")))
        for c, r, bad in rules]))
    return (rows.select(F.lit(table).alias("table_name"), F.explode(broken).alias("b"), F.col(key).cast("string").alias("key"),
                        F.to_json(F.struct(*columns)).alias("row"))
            .select("table_name", "b.column_name", "b.reason", "key", "row"))


def _marked(rows: DataFrame, column: str, flag: str) -> DataFrame:
    """``flag`` is true where another row has the same value."""
    often = (rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
             .filter("_n > 1").select(F.col(column).alias(f"_{column}"), F.lit(True).alias(flag)))
    return rows.join(often, rows[column] == often[f"_{column}"], "left").drop(f"_{column}")


def fact_rows(wfact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Violations of the fact: C1 duplicate ticket ids, C2 missing ones, C3
    keys without a dimension row, C4 texts and hours out of bounds."""
    columns = wfact.columns
    rows = _marked(wfact, "ticket_id", "_dup")
    rules = [("ticket_id", "duplicate", F.col("_dup")), ("ticket_id", "missing", F.col("ticket_id").isNull())]
    for dim in dims.values():
        key = dim.columns[0]
        known = dim.select(F.col(key).alias(f"_{key}"), F.lit(True).alias(f"_known_{key}")).distinct()
        rows = rows.join(known, rows[key] == known[f"_{key}"], "left").drop(f"_{key}")
        rules.append((key, "no dimension row", F.col(key).isNotNull() & F.col(f"_known_{key}").isNull()))
    rules += [(c, "too long", F.length(c) > n) for c, n in LENGTHS.items()]
    rules.append((HOURS, "out of range", F.col(HOURS).isNotNull() & F.col(HOURS).try_cast("decimal(10,2)").isNull()))
    return _listed(rows, "fact_tickets", "ticket_id", columns, rules)


def dimension_rows(table: str, dim: DataFrame) -> DataFrame:
    """Violations of a dimension (key, name)."""
    key, name = dim.columns
    rows = _marked(_marked(dim, key, "_dup_key"), name, "_dup_name")
    return _listed(rows, table, key, dim.columns, [
        (key, "duplicate", F.col("_dup_key")), (name, "duplicate", F.col("_dup_name")),
        (key, "missing", F.col(key).isNull()), (name, "missing", F.col(name).isNull()),
        (name, "too long", F.length(name) > NAME_MAX_LEN)])


def malformed_rows(scanned: DataFrame, table: str, key: str, corrupt: str) -> DataFrame:
    """Lines of a CSV scan (``scan.read_csv_text`` with ``corrupt``) that have
    more or fewer fields than their header."""
    return scanned.filter(F.col(corrupt).isNotNull()).select(
        F.lit(table).alias("table_name"), F.lit(None).cast("string").alias("column_name"),
        F.lit("malformed").alias("reason"), F.col(key).alias("key"), F.col(corrupt).alias("row"))


def star_rows(wfact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Violations of the fact and its dimensions."""
    return reduce(DataFrame.unionByName, [fact_rows(wfact, dims), *[dimension_rows(t, d) for t, d in dims.items()]])


def as_counts(found: DataFrame) -> DataFrame:
    """The counts that the four checks give: duplicates as values, all other
    violations as rows."""
    value = F.expr("get_json_object(row, concat('$.', column_name))")
    return (found.withColumn("value", value).groupBy("table_name", "column_name", "reason")
            .agg(F.count_distinct("value").alias("values"), F.count(F.lit(1)).alias("rows"))
            .select("table_name", "column_name", "reason",
                    F.when(F.col("reason") == "duplicate", F.col("values")).otherwise(F.col("rows")).alias("violations")))
