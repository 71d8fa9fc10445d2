"""Line dedup by an exact set-similarity join, in DataFrame operations only.

A line is the set of its lower-cased words; a line is removed when an earlier
line (by document id, text hash, line number) has a Jaccard similarity of at
least ``num / den``, be that line removed itself or not.  Lines without a word
stay.

1. Equal lines become one class with its first place; every later place is
   removed without any comparison.
2. The lines are split once, and their distinct words kept as 64-bit hashes,
   which stand for the words from here on.  Words are ordered by rarity: a
   count sketch over the words of all lines gives each word a level (half
   powers of two), words of one level are ordered by hash.  The sketch grows
   with the text, a slot for SLOT_BYTES bytes, up to MAX_SLOTS (one byte
   each), so that a slot's noise stays a few words.  This is one global order,
   whatever the sketch's errors.
3. A set of n words has the prefix of its n - ceil(t n) + 1 rarest words; two
   linked sets share a prefix word.  Classes that share one are compared if
   the sizes, the places of the word in both orders, and a parity signature
   of 64 bits, 128 for more than SHORT words (every word flips one bit, so the
   bits that differ are at most the words that differ) allow the threshold.
4. Each class first meets a class of the smallest document id of its size
   range that shares one of three words of both prefixes: the least and the
   greatest by hash, and the most frequent.  Those with a similar earlier line are settled.  The others look
   for all classes within the bounds that may be earlier (by document id; a run
   of shared prefix words is one meeting, at its first word), are
   compared with the one whose signature is nearest, and only those that it
   does not settle with the rest, so a large group of near copies costs few
   comparisons each.
5. The lines that are compared are read again by their first place, and which
   is earlier and the Jaccard similarity of their word hashes are computed exactly.
   Of the texts, only those with such a line are split again.

Defined results: NULL and empty texts have no line with words; rows with the
same id and text are one document and lose the same lines; a NULL id sorts
first; the first of equal lines stays; an empty table gives an empty result;
other columns are ignored (``dedup`` keeps them).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bits
from .common import SPACE_WORD, ascii_lower, drop_staged, every, staged, sweep

SLOT_BYTES = 256
MIN_SLOTS, MAX_SLOTS = 1 << 12, 1 << 23
LEVEL_SHIFT = 57
SHORT = 64      # lines of more words have a signature of 128 bits
_PLACE = ("id", "h", "line_no")


def _spaced(text: Column) -> Column:
    """``text`` with spaces for the white space inside its lines, which is rarely anything else."""
    return F.when(text.rlike(r"[\x09\x0B-\x0D]"), F.translate(text, "\t\x0b\f\r", "    ")).otherwise(text)


def _split(text: Column) -> Column:
    """The lines of a text that went through ``_spaced``."""
    return F.split(text, "\n", -1)


def _has_word(line: Column) -> Column:
    return F.trim(line) != ""


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, line_no, line) of every line with a word, spaced."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.posexplode(
        _split(_spaced(text))).alias("line_no", "line")).filter(_has_word(F.col("line")))


def _word_hashes(line: Column) -> Column:
    """The distinct lower-cased words of a spaced line as 64-bit hashes."""
    return F.array_distinct(F.array_remove(F.transform(F.split(ascii_lower(line), " ", -1), lambda w: F.xxhash64(w)),
                                           F.xxhash64(F.lit(""))))


def slots_for(size: int) -> int:
    """A power of two with a slot for every SLOT_BYTES bytes of text, within the bounds."""
    return min(max(1 << (size // SLOT_BYTES).bit_length(), MIN_SLOTS), MAX_SLOTS)


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(place, lh, lc, hashes) of every line with a word: its distinct words'
    hashes; equal lines have equal (lh, lc)."""
    return _lines(docs, id_col, text_col).select(
        *_PLACE, F.xxhash64("line").alias("lh"), F.crc32(F.col("line").cast("binary")).alias("lc"),
        _word_hashes(F.col("line")).alias("hashes"))


def _levels(hashed: DataFrame, slots: int) -> Column:
    """The rarity level of each slot (half powers of two of the lines counted
    in it) as a scalar: an array of bytes, made from longs of eight levels."""
    slot = F.col("word").bitwiseAND(F.lit(slots - 1).cast("long")).cast("int")
    levels = (hashed.select(F.explode("hashes").alias("word")).groupBy(slot.alias("slot"))
              .agg(F.least(F.lit(62), F.floor(F.log2(F.count("*") + 1) * 2)).cast("long").alias("level")))
    eight = levels.groupBy(F.shiftright("slot", 3).cast("long").alias("at")).agg(F.sum(F.call_function(
        "shiftleft", F.col("level"), F.col("slot").bitwiseAND(7) * 8)).alias("packed"))
    # one row for eight slots, filled or not: as many rows as the size says
    full = hashed.sparkSession.range(slots // 8).withColumnRenamed("id", "at").join(eight, "at", "left")
    parts = F.array_sort(F.collect_list(F.struct("at", F.coalesce("packed", F.lit(0)).alias("packed"))))
    return full.agg(F.flatten(F.transform(parts, lambda x: F.array(*[
        F.shiftright(x["packed"], 8 * i).bitwiseAND(F.lit(127).cast("long")).cast("byte") for i in range(8)])))).scalar()


def _described(hashed: DataFrame, slots: int, num: int, den: int) -> DataFrame:
    """(place, lh, lc, n, sig, half, prefix) of every line; the prefix holds 31 bits
    of each word's rank, which are enough to meet: a chance meeting is one
    more comparison."""
    # a subquery may not be written inside a higher-order function, but the optimiser moves it there from
    # a column that is used once; so no row carries the levels
    levelled = hashed.withColumn("levels", _levels(hashed, slots))

    def rank(h: Column) -> Column:      # rare words first; the hash tells words apart
        return F.shiftleft(F.get("levels", h.bitwiseAND(F.lit(slots - 1).cast("long")).cast("int")).cast("long"),
                           LEVEL_SHIFT).bitwiseOR(F.shiftrightunsigned(h, 64 - LEVEL_SHIFT))

    # without nulls, longs are sorted as such
    ranks = F.transform("hashes", lambda h: F.coalesce(rank(h), F.lit(0).cast("long")))
    ranked = levelled.select(*_PLACE, "lh", "lc", F.sort_array(ranks).alias("ranks"))
    none, n = F.lit(0).cast("long"), F.size("ranks")

    def parity(ranks: Column) -> Column:
        return F.aggregate(ranks, none, lambda a, r: a.bitwiseXOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), r.bitwiseAND(F.lit(63).cast("long")).cast("int"))))
    # the other half of 128 bits is the exclusive or of both
    half = F.when(n > SHORT, parity(F.filter("ranks", lambda r: r.bitwiseAND(F.lit(64).cast("long")) != none)))
    prefix = F.slice("ranks", F.lit(1), (n - F.ceil(F.lit(num) * n / F.lit(den)) + 1).cast("int"))
    return ranked.select(*_PLACE, "lh", "lc", n.alias("n"), parity(F.col("ranks")).alias("sig"), half.alias("half"), F.transform(
        prefix, lambda r: r.bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int")).alias("prefix"))


_SETTLED = 1 << 62      # in ni: the class needs no more comparisons


def _tokens(classes: DataFrame) -> DataFrame:
    """(token, before, lid, id, ni, sig, half): a row for each prefix word; before is
    the prefix word before it (-1: none), ni packs the size, the word's place in
    the order and whether the class is settled."""
    n = F.col("n").cast("long")
    if "settled" in classes.columns:
        n += F.col("settled").cast("long") * F.lit(_SETTLED >> 32)
    return classes.select("lid", "id", n.alias("n"), "sig", "half", "prefix", F.posexplode("prefix").alias("i", "token")).select(
        "token", F.coalesce(F.get("prefix", F.col("i") - 1), F.lit(-1)).alias("before"), "lid", "id",
        F.shiftleft("n", 32).bitwiseOR(F.col("i").cast("long")).alias("ni"), "sig", "half")


def _size(ni: Column) -> Column:
    return F.shiftright(ni.bitwiseAND(F.lit(_SETTLED - 1)), 32)


def _bits_apart(sig: Column, half: Column, other_sig: Column, other_half: Column) -> Column:
    """The signature bits in which two lines differ: at most their differing
    words.  If one of them is short, it is those of 64 bits."""
    whole, part = sig.bitwiseXOR(other_sig), half.bitwiseXOR(other_half)
    return F.coalesce(F.bit_count(part) + F.bit_count(part.bitwiseXOR(whole)), F.bit_count(whole))


def _may_link(na: Column, nb: Column, apart: Column, num: int, den: int) -> Column:
    """The size and signature bounds; the bits ``apart`` are at most the words that differ."""
    return ((num + den) * apart <= (den - num) * (na + nb)) & (den * F.least(na, nb) >= num * F.greatest(na, nb))


def _meetings(tokens: DataFrame, num: int, den: int) -> DataFrame:
    """(lid, other, apart): open classes and those that may be earlier and
    similar, by the prefix words they share.  Two that share a word and the one
    before it have met there, so a run of shared words is one meeting."""
    a, b = tokens.alias("a"), tokens.alias("b")
    place = lambda s: F.col(f"{s}.ni").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    na, nb = _size(F.col("a.ni")), _size(F.col("b.ni"))
    apart = _bits_apart(*map(F.col, ("a.sig", "a.half", "b.sig", "b.half")))
    # lines of one id meet both ways, their places decide; said of both sides, so that they stay one exchange
    earlier = (F.col("b.id").isNull() | (F.col("b.id") <= F.col("a.id"))) & (F.col("a.lid") != F.col("b.lid"))
    is_open = F.when(earlier, F.col("a.ni") < F.lit(_SETTLED))
    met = (F.col("a.before") == F.col("b.before")) & (F.col("a.before") >= 0)
    left = (num + den) * F.least(na - place("a"), nb - place("b")) >= num * (na + nb)
    return a.join(b, (F.col("a.token") == F.col("b.token")) & is_open & left & ~met
                  & _may_link(na, nb, apart, num, den)) \
        .select(F.col("a.lid").alias("lid"), F.col("b.lid").alias("other"), apart.alias("apart"))


def _among(classes: DataFrame, lids: DataFrame) -> tuple[Column, int]:
    """Whether a class may be one of ``lids``, as a column, and how many there are."""
    count = lids.count()
    n_bits, key = bits.size_for(count), F.xxhash64("lid")
    return bits.may_hold(bits.bit_words(lids.select(key.alias("key")), "key", n_bits), key, n_bits), count


def _word_sets(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(lid, place, words) of the classes in (lid, other) pairs, read by their first places."""
    ids = staged(pairs.select("lid").unionAll(pairs.select(F.col("other").alias("lid"))).distinct(), "ids")
    among, count = _among(classes, ids)
    wanted = staged(classes.select("lid", *_PLACE).filter(among).join(ids, "lid"), "wanted")
    # one array for the documents and the lines: a text without a wanted line is not split
    n_bits = bits.size_for(2 * count)
    of_doc, of_line = F.xxhash64("id", "h"), F.xxhash64(*_PLACE)
    held = bits.bit_words(wanted.select(F.explode(F.array(of_doc, of_line)).alias("key")), "key", n_bits)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    near = (texts.withColumn("h", F.xxhash64("text")).filter(bits.may_hold(held, of_doc, n_bits))
            .select("id", "h", F.posexplode(_split(_spaced(F.col("text")))).alias("line_no", "line"))
            .filter(bits.may_hold(held, of_line, n_bits)).alias("l"))
    w = wanted.alias("w")
    same = (F.col("l.id").eqNullSafe(F.col("w.id")) & (F.col("l.h") == F.col("w.h"))
            & (F.col("l.line_no") == F.col("w.line_no")))
    words = staged(near.join(w, same).select(
        "lid", F.struct(*[F.col(f"w.{c}") for c in _PLACE]).alias("place"),
        _word_hashes(F.col("line")).alias("words"))
        .dropDuplicates(["lid"]), "words")
    drop_staged(ids, wanted)
    return words


def _similar(pairs: DataFrame, words: DataFrame, num: int, den: int) -> DataFrame:
    """The classes ``lid`` of (lid, other) pairs whose ``other`` is earlier and
    whose exact similarity reaches the threshold."""
    both = (pairs.join(words.select("lid", F.col("words").alias("wa"), F.col("place").alias("pa")), "lid")
            .join(words.select(F.col("lid").alias("other"), F.col("words").alias("wb"), F.col("place").alias("pb")), "other"))
    inter = F.size(F.array_intersect("wa", "wb"))
    return staged(both.filter((F.col("pb") < F.col("pa")) & ((num + den) * inter >= num * (F.size("wa") + F.size("wb"))))
                  .select("lid").distinct(), "similar")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 4,
                  den: int = 5) -> DataFrame:
    """(id, h, line_no) of every removed line; ``h`` is xxhash64 of the text."""
    slots = slots_for(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)
    hashed = staged(_hashed(docs, id_col, text_col), "hashes", plain=True)
    classes = staged(
        _described(hashed, slots, num, den).groupBy("lh", "lc")
        .agg(F.min(F.struct(*_PLACE, "n", "sig", "half", "prefix")).alias("first")).select("lh", "lc", "first.*")
        .withColumn("lid", F.monotonically_increasing_id()), "classes")
    places = staged(hashed.select(*_PLACE, "lh", "lc"), "places")
    drop_staged(hashed)
    sweep(docs.sparkSession)

    # step 4: the earliest class in each group of alike ones
    width = math.log(den / num) if num < den else 1.0
    span = F.floor(F.log(_size(F.col("ni"))) / width).cast("int")
    # least and greatest by hash: near copies choose alike, whatever differs before them in the order
    ends = classes.withColumn("prefix", F.array_distinct(F.array(
        F.array_min("prefix"), F.array_max("prefix"), F.element_at("prefix", -1))))
    grouped = _tokens(ends).withColumn("span", span)
    # any choice is right, as the words decide; of rows with one id, all four take the same one
    hub = grouped.groupBy("token", "span").agg(*[F.min_by(c, "id").alias(to) for c, to in (
        ("lid", "other"), ("ni", "other_ni"), ("sig", "other_sig"), ("half", "other_half"))], F.count("*").alias("held")).filter("held > 1").drop("held")
    apart = _bits_apart(*map(F.col, ("sig", "half", "other_sig", "other_half")))
    at_hub = staged(grouped.join(hub, ["token", "span"]).filter("other != lid").filter(
        _may_link(_size(F.col("ni")), _size(F.col("other_ni")), apart, num, den)).select("lid", "other").distinct(), "pairs")
    words = _word_sets(at_hub, classes, docs, id_col, text_col)
    settled = _similar(at_hub, words, num, den)
    drop_staged(words)
    sweep(docs.sparkSession)

    # only the few that may be settled are joined with those that are
    among, _ = _among(classes, settled)
    own = classes.select("lid", "id", "n", "sig", "half", "prefix")
    marked = own.filter(among).join(settled.withColumn("settled", F.lit(True)), "lid", "left") \
        .withColumn("settled", F.col("settled").isNotNull()).unionByName(own.filter(~among).withColumn("settled", F.lit(False)))
    rest = staged(_meetings(_tokens(marked), num, den).distinct()
                  .join(at_hub, ["lid", "other"], "left_anti"), "pairs")
    drop_staged(at_hub)
    sweep(docs.sparkSession)
    words = _word_sets(rest, classes, docs, id_col, text_col)
    nearest = rest.groupBy("lid").agg(F.min_by("other", F.struct("apart", "other")).alias("other"))
    by_nearest = _similar(nearest, words, num, den)
    open_pairs = rest.select("lid", "other").join(by_nearest, "lid", "left_anti") \
        .join(nearest, ["lid", "other"], "left_anti")
    late = settled.unionAll(by_nearest).unionAll(_similar(open_pairs, words, num, den)).distinct()
    drop_staged(words, rest)
    flagged = classes.select("lid", "lh", "lc", F.struct(*_PLACE).alias("first")).join(
        late.withColumn("late", F.lit(True)), "lid", "left").drop("lid")
    return places.join(flagged, ["lh", "lc"]).filter(
        F.col("late").isNotNull() | (F.struct(*_PLACE) != F.col("first"))).select(*_PLACE)


def by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 4,
                den: int = 5) -> DataFrame:
    """(``id_col``, text_hash, n_lines, n_removed, removed) for every row of
    ``docs``; ``removed`` lists line numbers, from 0."""
    # sets, as repeated rows give the same lines again
    of_doc = removed_lines(docs, id_col, text_col, num, den).groupBy("id", "h").agg(
        F.array_sort(F.collect_set("line_no")).alias("removed"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    n_lines = F.size(F.filter(F.split(text, "\n", -1), lambda line: line.rlike(SPACE_WORD)))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), n_lines.cast("long").alias("n_lines"))
    same = rows["id"].eqNullSafe(of_doc["id"]) & (rows["h"] == of_doc["h"])
    return rows.join(of_doc, same, "left").select(
        rows["id"].alias(id_col), rows["h"].alias("text_hash"), "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 4, den: int = 5) -> DataFrame:
    """``docs`` without the removed lines; texts that keep all lines stay as they are."""
    removed = removed_lines(docs, id_col, text_col, num, den).groupBy("id", "h").agg(
        F.collect_set("line_no").alias("gone"))
    own, gone = docs[text_col], removed["gone"]
    same = docs[id_col].eqNullSafe(removed["id"]) & (F.xxhash64(F.coalesce(own, F.lit(""))) == removed["h"])
    lines = F.filter(F.split(own, "\n", -1), lambda line, i: ~F.array_contains(gone, i))
    text = F.when(gone.isNull(), own).otherwise(F.array_join(lines, "\n"))
    return docs.join(removed, same, "left").select(
        *[text.alias(c) if c == text_col else col for c, col in zip(docs.columns, every(docs))])
