"""Property tests: stamp parsing over generated stamps, surrogate keys over
generated name sets, and a hot-key run checked against a plain-Python count."""

from __future__ import annotations

import collections
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskmetrics.functions.columns import parse_timestamp
from deskmetrics.operators import marts
from deskmetrics.operators.star import dense_keys

stamps = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2090, 12, 31))
suffixes = st.sampled_from(["", "+00:00", ".564000", ".1", ".123456+00:00"])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(stamps, suffixes), min_size=1, max_size=40))
def test_parse_accepts_the_three_formats(spark, rows):
    text = [(t.strftime("%Y-%m-%d %H:%M:%S") + s,) for t, s in rows]
    got = [r.t for r in spark.createDataFrame(text, "s string")
           .select(parse_timestamp("s").cast("timestamp_ntz").alias("t")).collect()]
    assert got == [t.replace(microsecond=0) for t, _ in rows]


names = st.text(alphabet="abcXYZ019 _-", min_size=1, max_size=6)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["reporter", "assignee"]), names), max_size=60))
def test_dense_keys_rank_names(spark, pairs):
    df = spark.createDataFrame(pairs or [("reporter", "x")], "role string, name string")
    if not pairs:
        df = df.limit(0)
    got = {(r.role, r.name): r.key for r in dense_keys(df.distinct()).collect()}
    want = {}
    for role in {p[0] for p in pairs}:
        # Spark orders strings by their UTF-8 bytes
        for i, name in enumerate(sorted({n for r, n in pairs if r == role},
                                        key=lambda s: s.encode()), start=1):
            want[(role, name)] = i
    assert got == want


def test_hot_agent_with_a_third_of_all_tickets(spark):
    """One agent holding a third of the rows: partial aggregation handles it
    and the counts equal a plain count."""
    rows = []
    for i in range(3000):
        agent = "hot" if i % 3 == 0 else f"a{i % 97}"
        rows.append((i, agent, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2), 24.0))
    fact = spark.createDataFrame(
        rows, "ticket_id long, assignee string, start_time timestamp, resolution_time timestamp, "
              "resolution_duration_hours double").repartition(16)
    got = {r.assignee: r.tickets_resolved for r in marts.agent_volume(fact).collect()}
    assert got == dict(collections.Counter(r[1] for r in rows))
    ranked = marts.agent_rank_by_volume(fact).filter(F.col("rank_by_volume") == 1).collect()
    assert [r.assignee for r in ranked] == ["hot"]
