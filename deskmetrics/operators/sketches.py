"""Summaries that merge: heavy hitters (O3), quantiles (R-D7), distinct
counts (C5).

Each is a sketch of bounded size, built map-side and merged, so what is
shuffled does not grow with the number of different values.  Where a result
must be exact, the sketch only names candidates and a second pass counts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch, staged

# --- heavy hitters ---------------------------------------------------------

#: Values that a summary of heavy hitters tracks.
TRACKED = 4096


def untracked_bound(rows: Column, tracked: int = TRACKED) -> Column:
    """The most rows that a value can have which the summary does not name:
    3.5 / m of all rows, m the size of its table (a power of two)."""
    size = 1 << (-(-4 * tracked // 3) - 1).bit_length()
    return rows * 3.5 / size


def heavy_candidates(df: DataFrame, column: str, tracked: int = TRACKED) -> DataFrame:
    """One row: ``rows`` (not NULL) and ``candidates``, at most ``tracked``
    values, all with more than ``untracked_bound`` rows among them."""
    found = F.expr(f"approx_top_k(`{column}`, {tracked}, {tracked})")
    return df.filter(F.col(column).isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), found.alias("found")).select(
        "rows", F.transform("found", lambda x: x["item"]).alias("candidates"))


def _counted(df: DataFrame, column: str, n: int) -> DataFrame:
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.col("rows").desc(), column).limit(n))


def top_n_by_summary(df: DataFrame, column: str, n: int, tracked: int = TRACKED) -> DataFrame:
    """The n most frequent values with their exact counts, ties by value.

    The first pass merges one summary per task; the second counts only the
    candidates, so no other value is shuffled.  The list is exact if its last
    count is above what a value outside the summary can have; where it is not
    (flat data), all values are counted instead."""
    column_only = df.select(column).filter(F.col(column).isNotNull())
    known = staged(heavy_candidates(df, column, tracked), scratch(df.sparkSession, "heavy"))
    values = known.select(F.explode("candidates").alias(column))      # at most ``tracked`` rows
    top = staged(_counted(column_only.join(F.broadcast(values), column, "left_semi"), column, n),
                 scratch(df.sparkSession, "top"))
    proof = top.agg(F.count(F.lit(1)).alias("n"), F.min("rows").alias("least")).crossJoin(
        known.select("rows", F.size("candidates").alias("named"), untracked_bound(F.col("rows"), tracked).alias("bound"))).first()
    if proof["n"] == n and proof["least"] > proof["bound"] or not proof["rows"]:
        return top
    return _counted(column_only, column, n)


# --- quantiles -------------------------------------------------------------

#: Size of a quantile sketch, and the rank error that it keeps (twice the
#: 99 % error of one query, 2.296 / k ** 0.9021).
QUANTILE_K = 400
RANK_ERROR = 2 * 2.296 / QUANTILE_K**0.9021


def quantile_sketches(df: DataFrame, value: Column, *by: str | Column) -> DataFrame:
    """Per group, ``n`` values and their ``sketch`` (binary, to be stored)."""
    rows = df.select(*by, value.cast("double").alias("_v")).filter("_v is not null")
    names = [c for c in rows.columns if c != "_v"]
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"),
                                    F.kll_sketch_agg_double("_v", QUANTILE_K).alias("sketch"))


def merged_quantiles(sketches: DataFrame, probabilities: tuple[float, ...], *by: str) -> DataFrame:
    """Per group, probability and ``value`` over all the sketches given."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", QUANTILE_K).alias("sketch"))
    found = F.explode(F.array(*[F.struct(F.lit(p).alias("probability"),
                                         F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("value"))
                                for p in probabilities]))
    return merged.select(*by, "n", found.alias("q")).select(*by, "n", "q.*")


# --- distinct counts -------------------------------------------------------

#: 2 ** 12 registers: a standard error of 1.63 %; three of them are the bound.
LG_REGISTERS = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_REGISTERS / 2)


def distinct_sketches(df: DataFrame, columns: dict[str, str], *by: str) -> DataFrame:
    """(metric, sketch) per group: distinct values of each column, named."""
    pair = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).alias("value")) for m, c in columns.items()]))
    return df.select(*by, pair.alias("p")).select(*by, "p.*").groupBy(*by, "metric").agg(
        F.hll_sketch_agg("value", LG_REGISTERS).alias("sketch"))


def merged_distinct(sketches: DataFrame, *by: str) -> DataFrame:
    """Per group (for example metric), the estimated distinct values over all
    the sketches given."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
