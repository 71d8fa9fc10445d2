"""Benchmark decontamination by a prefix-filtered set join, in DataFrame
operations only.

A window is ``window`` consecutive words of a benchmark item (the whole item
if it is shorter).  A document contains a window only if it contains all the
window's shingles, so any one of them is a necessary prefix, and the rarest is
the best:

1. One scan of the documents finds the places of shingles that occur in the
   benchmark.  A bit array that grows with the benchmark (up to 8 MB, 32 bits
   for each of 2 million shingles) lets others pass by chance only; each place
   keeps the few words around it, so no text is read or moved again.
2. A window's shingles are ordered by how often documents have them; the
   rarest is its prefix.  A window with a shingle that no document has is out.
3. Places join windows on the prefix; the place and the shingle's offset give
   the window's start, which must lie inside the text (positional and length
   bounds), and the words there must equal the window's (exact check).

Windows and items that repeat are handled once; a place joins only windows of
which it is the prefix, so a common passage costs its occurrences, not pairs.

Defined results: NULL and empty texts have no words and are clean; NULL and
empty items have no window; items without an id mark words but are not
listed; repeated items count once; repeated documents are reported alike; an
empty table of documents gives an empty result, an empty benchmark clean
documents; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bits
from .common import ITEM_WORD, ascii_lower, fresh, staged

WINDOW = 10
SHINGLE = 5


def words(text: str) -> Column:
    return F.coalesce(F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(ITEM_WORD), F.lit(0)),
                      F.array().cast("array<string>"))


def _span(first: Column, last: Column) -> Column:
    """first..last, empty if last < first."""
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, w) with the distinct windows of each item."""
    split = items.select(F.col(id_col).cast("string").alias("item_id"), words(text_col).alias("words")) \
        .withColumn("n", F.size("words")).filter("n > 0")
    length = F.least(F.lit(window), F.col("n"))
    return split.select("item_id", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("n") - length + 1), lambda i: F.slice("words", i, length))).alias("w")).distinct()


def _shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(w, size, offset, hash) of the shingles of distinct windows."""
    size = F.least(F.lit(shingle), F.size("w"))
    places = F.transform(F.sequence(F.lit(0), F.size("w") - size), lambda o: F.struct(
        o.alias("offset"), F.xxhash64(F.slice("w", o + 1, size)).alias("hash")))
    return windows.select("w").distinct().select("w", size.alias("size"), F.explode(places).alias("s")) \
        .select("w", "size", "s.offset", "s.hash")


def _places(docs: DataFrame, id_col: str, text_col: str, sizes: list[int], window: int, held: Column,
            n_bits: int) -> DataFrame:
    """(id, h, n_words, places): where shingles of the benchmark may stand."""
    split = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"),
                        words(text_col).alias("words")).withColumn("n_words", F.size("words"))

    def of_size(size: int) -> Column:
        return F.transform(_span(F.lit(1), F.col("n_words") - size + 1), lambda i: F.struct(
            i.alias("pos"), F.lit(size).alias("size"), F.xxhash64(F.slice("words", i, size)).alias("hash")))

    # a subquery may not be written inside a higher-order function, but the optimiser moves it there from
    # a column that is used once; so no row carries the bits
    hashed = split.select("*", F.concat(*[of_size(s) for s in sizes]).alias("hashed"), held.alias("held"))
    found = F.filter("hashed", lambda x: bits.may_hold(F.col("held"), x["hash"], n_bits))
    begin = lambda x: F.greatest(F.lit(1), x["pos"] - (F.lit(window) - x["size"]))
    return hashed.select("id", "h", "n_words", F.transform(found, lambda x: F.struct(
        x["pos"].alias("pos"), x["hash"].alias("hash"), begin(x).alias("begin"),
        F.slice("words", begin(x), x["pos"] + window - begin(x)).alias("around"))).alias("places"))


def _covered(spans: Column) -> Column:
    """Words inside the union of (start, stop) spans, stop exclusive."""
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], a["reach"]))).alias("n"),
        F.greatest(a["reach"], s["stop"]).alias("reach"))
    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")), step,
                       lambda a: a["n"].cast("long"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE) -> DataFrame:
    """(``id_col``, text_hash, n_words, n_hit, n_items, items, contaminated) for
    every row of ``docs``; ``items`` lists the ids as sorted strings and
    ``text_hash`` is xxhash64 of the text."""
    windows = staged(_windows(items, item_id_col, item_text_col, window), "windows")
    shingles = staged(_shingles(windows, shingle), "shingles")
    found = shingles.agg(F.count("*").alias("n"), F.sort_array(F.collect_set("size")).alias("sizes")).first()
    sizes = found.sizes or [min(shingle, window)]      # at most ``shingle`` values
    n_bits = bits.size_for(found.n)
    held = bits.bit_words(shingles, "hash", n_bits)
    docs_places = staged(_places(docs, id_col, text_col, sizes, window, held, n_bits), "places")
    place = docs_places.select("id", "h", "n_words", F.explode("places").alias("p")).select("id", "h", "n_words", "p.*")

    often = place.groupBy("hash").agg(F.count("*").alias("df"))
    rarest = (shingles.join(often, "hash", "left").groupBy("w")
              .agg(F.min(F.struct(F.col("df"), F.col("hash"), F.col("offset"))).alias("rarest"),
                   F.count("df").alias("there"), F.count("*").alias("all"))
              .filter(F.col("there") == F.col("all"))
              .select("w", "rarest.hash", "rarest.offset"))
    start, length = F.col("pos") - F.col("offset"), F.size("w")
    hits = (place.join(rarest, "hash")
            .filter((start >= 1) & (start + length - 1 <= F.col("n_words"))
                    & (F.slice("around", start - F.col("begin") + 1, length) == F.col("w")))
            .select("id", "h", F.struct(start.alias("start"), (start + length).alias("stop")).alias("span"), "w"))
    by_doc = hits.join(windows, "w").groupBy("id", "h").agg(
        F.collect_set("span").alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items"))
    hit = staged(by_doc.select("id", "h", _covered(F.col("spans")).alias("n_hit"), "items"), "hits")
    rows = docs_places.select("id", "h", "n_words")
    same = rows["id"].eqNullSafe(hit["id"]) & rows["h"].eqNullSafe(hit["h"])
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(hit, same, "left").select(
        rows["id"].alias(id_col), rows["h"].alias("text_hash"), F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("items"),
        (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, **columns) -> DataFrame:
    """``docs`` without the contaminated documents.  Only texts that a bit
    array lets through are moved to meet the exact list."""
    id_col, text_col, name = columns.get("id_col", "doc_id"), columns.get("text_col", "text"), fresh("_bad", docs)
    bad = staged(contamination(docs, items, **columns).filter("contaminated")
                 .select(F.xxhash64(id_col, "text_hash").alias(name)).distinct(), "contaminated")
    key = F.xxhash64(docs[id_col], F.xxhash64(docs[text_col]))
    n_bits = bits.size_for(bad.count())
    may = bits.may_hold(bits.bit_words(bad, name, n_bits), key, n_bits)
    return docs.filter(~may).unionAll(docs.filter(may).join(bad, key == bad[name], "left_anti"))
