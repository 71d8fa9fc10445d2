"""A set of values as a bit array of fixed size, to thin out rows before a
join.  The array is one value of a scalar subquery, so its size is bounded by
``n_bits`` whatever the data; values outside the set may pass, values in it
always do, so the join after it decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 26      # 8 MB


def size_for(values: int) -> int:
    """A power of two with about 32 bits for each value, up to ``MAX_BITS``."""
    n = 1 << 13
    while n < MAX_BITS and n < 32 * values:
        n *= 2
    return n


def bit_words(values: DataFrame, column: str, n_bits: int) -> Column:
    """The bit array of a column of longs (hashes), as a scalar."""
    slot = F.pmod(F.col(column), F.lit(n_bits).cast("long"))
    spark = values.sparkSession
    words = (values.filter(F.col(column).isNotNull())
             .groupBy(F.shiftright(slot, 6).alias("at"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                           F.pmod(F.col(column), F.lit(64)).cast("int"))).alias("bits")))
    # one row per word of the array, set or not: as many rows as the size says
    full = spark.range(n_bits // 64).withColumnRenamed("id", "at").join(words, "at", "left")
    return full.agg(F.transform(
        F.array_sort(F.collect_list(F.struct("at", F.coalesce("bits", F.lit(0)).alias("bits")))),
        lambda x: x["bits"]).alias("bits")).scalar()


def may_hold(bits: Column, value: Column, n_bits: int) -> Column:
    """Whether a long may be in the set."""
    word = F.get(bits, F.shiftright(F.pmod(value, F.lit(n_bits).cast("long")), 6).cast("int"))
    bit = F.call_function("shiftright", word, F.pmod(value, F.lit(64)).cast("int"))
    return bit.bitwiseAND(F.lit(1).cast("long")) == 1
