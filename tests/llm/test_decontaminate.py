from __future__ import annotations

import random

from pyspark.sql import functions as F

from deskmetrics.llm import bits, decontaminate, queries

from . import brute
from .conftest import SF


def _check(rows, texts, items):
    for r in rows:
        n, hit, found = brute.contamination(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.contaminated) == (n, hit, hit > 0), r
        assert r["items"] == sorted(map(str, found))


def test_query_matches_brute_force(spark, sf_texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    rows = queries.op3_decontaminate(spark, SF).collect()
    assert len(rows) == len(sf_texts)
    for r in rows:
        n, hit, found = brute.contamination(sf_texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0)
        assert r.items_sha256 == brute.sha(",".join(sorted(map(str, found))))


def test_no_python_on_the_main_path(spark):
    plan = queries.op3_decontaminate(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_bits_grow_with_the_benchmark_and_no_row_carries_them(spark):
    assert bits.size_for(10) == 1 << 13 and bits.size_for(1_000_000) == 1 << 25 and bits.size_for(10**9) == bits.MAX_BITS
    values = spark.range(200_000).select(F.xxhash64("id").alias("hash"))
    held = bits.bit_words(values, "hash", bits.size_for(200_000))
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(3000)))], "doc_id long, text string")
    places = decontaminate._places(docs, "doc_id", "text", [2, 5], 10, held, bits.size_for(200_000))
    plan = places._jdf.queryExecution().optimizedPlan().toString()
    assert "AS held" not in plan and plan.split("\n")[0].count("scalar-subquery") == 1
    found = places.select(F.size("places")).first()[0]
    assert 0 < found < 6000 * 0.06        # by chance only: 200,000 of 2^23 bits are set


def test_short_items_overlaps_and_frequent_words(spark):
    rnd = random.Random(2)
    word = lambda: rnd.choice("the of a in to x y z".split())
    items = {i: " ".join(word() for _ in range(rnd.choice((0, 1, 2, 4, 6, 9, 10, 11, 14)))) for i in range(25)}
    items |= {100: None, 101: "", 102: items[3], 103: "  !! ", 104: "Ünï, ÇÖDÉ x"}
    texts = {i: " ".join(word() + rnd.choice(["", ",", "!"]) for _ in range(rnd.randrange(0, 60))) for i in range(60)}
    texts |= {100: "prefix " + (items[20] or "q") + " -- " + (items[21] or "q"), 101: None, 102: "ünï çödé X"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    _check(decontaminate.contamination(docs, bench).collect(), texts, items)
    kept = {r.doc_id for r in decontaminate.clean(docs, bench).collect()}
    assert kept == {k for k, t in texts.items() if not brute.contamination(t, items)[1]}


def test_edge_rows(edge_docs, edge_rows, clashing_docs, no_docs):
    spark = edge_docs.sparkSession
    text = next(t for k, t, *_ in edge_rows if k == 11)
    bench = spark.createDataFrame([(1, text), (1, text), (None, "one two")], "item_id long, text string")
    rows = decontaminate.contamination(edge_docs, bench).collect()
    assert len(rows) == len(edge_rows)
    got = {r.doc_id: (r.n_hit, r["items"]) for r in rows}
    assert got[11] == (60, ["1"]) and got[8] == got[9] == (2, []) and got[4] == got[5] == (0, [])
    kept = decontaminate.clean(clashing_docs, bench)
    assert kept.columns == clashing_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(
        (k or 0) for k, *_ in edge_rows if k not in (8, 9, 11))
    assert decontaminate.contamination(no_docs, bench).collect() == [] == decontaminate.clean(no_docs, bench).collect()
    empty = bench.filter(F.lit(False))
    assert not any(r.contaminated for r in decontaminate.contamination(edge_docs, empty).collect())
