"""The incremental star and the key registry."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import SMOKE_DIR, change, issue, raw_frames
from deskmetrics.operators import keys, star
from deskmetrics.plans import catalog, pipeline, stored
from deskmetrics.session import move, persisting, scratch, settings, workspace
from deskmetrics.sources import scan
from deskmetrics.streaming import incremental_star as inc

WIDTH = 500


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def named(tables):
    """The seven tables with names for keys, as sorted rows."""
    s = stored.Star(tables, "")
    out = {"fact_tickets": catalog._named_fact(s), "names": catalog._dimension_names(s),
           "agents": tables["agent_performance"].join(tables["dim_agents"], "agent_id", "left").drop("agent_id"),
           **{t: tables[t] for t in ("resolution_performance", "category_trends")}}
    return {n: sorted(map(str, df.select(*sorted(df.columns)).collect())) for n, df in out.items()}


def batch(spark, raw_issues, raw_changes):
    return pipeline.run(spark, scan.scan_issues(raw_issues), scan.scan_changes(raw_changes),
                        scratch(spark, "curated")).tables


def land(raw_issues, raw_changes, landing):
    raw_issues.write.mode("append").parquet(f"{landing}/issues")
    raw_changes.write.mode("append").parquet(f"{landing}/changes")


@pytest.fixture
def landing(spark):
    return scratch(spark, "landing")


def run(spark, landing, width=WIDTH):
    return inc.run_available(spark, f"{landing}/issues", f"{landing}/changes", landing.rpartition("/")[2], width=width)


def test_four_waves_equal_the_batch_run(spark, landing):
    waves = catalog.land_waves(spark, SMOKE_DIR)
    for wave in range(catalog.WAVES):
        land(spark.read.parquet(f"{waves}/issues/wave={wave}"), spark.read.parquet(f"{waves}/changes/wave={wave}"), landing)
        base = run(spark, landing)
    got = inc.open_star(spark, base)
    want = stored.for_tables(spark, SMOKE_DIR).tables
    assert named(got) == named(want)
    assert set(got) == set(pipeline.CURATED_ORDER)
    for t in pipeline.CURATED_ORDER:
        assert got[t].dtypes == want[t].dtypes or sorted(got[t].dtypes) == sorted(want[t].dtypes)
    held, last = inc.versions(spark, base)
    assert last == catalog.WAVES - 1 and len(held["fact"]) == 3
    # keys are lasting and dense, and every fact key is a dimension's
    for dim, (_, key, _) in star.DIMENSIONS.items():
        ids = {r[0] for r in got[f"dim_{dim}"].select(key).collect()}
        used = {r[0] for r in got["fact_tickets"].select(key).distinct().collect() if r[0] is not None}
        assert used == ids
    assert inc.vacuum(spark, base) > 0 and named(inc.open_star(spark, base)) == named(want)


FIRST = ([issue(1, "2024-01-01 10:00:00", "2024-01-01 12:00:00"), issue(600, "2024-01-02 10:00:00", priority="low"),
          issue(1200, "2024-02-02 10:00:00", "2024-02-03 10:00:00", assignee=None)],
         [change(1, 1, "assignee", "bob", "2024-01-01 11:00:00"), change(2, 600, "status", "Open", "2024-01-02 11:00:00")])
SECOND = ([issue(1, "2023-12-31 10:00:00", "2024-01-01 12:00:00", proj="moved"),      # an earlier copy wins
           issue(2, "2024-03-01 10:00:00", "2024-02-01 10:00:00")],                   # invalid
          [change(3, 1, "assignee", "eve", "2024-01-01 10:30:00"),                    # older than bob's
           change(4, 1, "status", "Done", "2024-01-01 12:00:00"),
           change(5, 700, "status", "Open", "2024-01-05 12:00:00")])                  # its ticket comes later
THIRD = ([issue(700, "2024-01-04 10:00:00", reporter="new", assignee="zed")], [change(6, 1, "assignee", None, "2024-01-09 10:00:00")])


def everything(spark, *waves):
    return raw_frames(spark, [i for w in waves for i in w[0]], [c for w in waves for c in w[1]])


def test_late_rows_move_tickets_and_names(spark, landing):
    for n, wave in enumerate((FIRST, SECOND, THIRD), 1):
        land(*raw_frames(spark, *wave), landing)
        base = run(spark, landing)
        assert named(inc.open_star(spark, base)) == \
            named(batch(spark, *everything(spark, *(FIRST, SECOND, THIRD)[:n])))
    held, last = inc.versions(spark, base)
    # the third wave has rows of tickets 1 and 700 only
    assert held["fact"] == {0: 2, 1: 2, 2: 0} and held["tickets"] == {0: 1, 1: 2, 2: 0} and last == 2


def test_an_epoch_exchanges_stored_rows_once(spark, landing, monkeypatch):
    plans, write = {}, inc._write

    def seen(rows, base, table, *args):
        write(rows, base, table, *args)
        # planned once more: the persisted rows are there now, so their layout is known
        plans[table] = rows.select("*")._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(inc, "_write", seen)
    for wave in (FIRST, SECOND):
        land(*raw_frames(spark, *wave), landing)
        base = run(spark, landing)
    for table in inc.VERSIONED:
        above, _, below = plans[table].partition("InMemoryRelation")
        assert "Exchange" not in above and re.search(r"Exchange hashpartitioning\(slice#\w+, \d+\), REPARTITION_BY_NUM", below)
    # a wave that is there already stays
    inc.remove(spark, f"{base}/deltas")
    move(spark, f"{landing}/issues", f"{base}/deltas/a")
    move(spark, f"{landing}/changes", f"{base}/deltas/a")
    assert not os.path.exists(local(f"{landing}/issues")) and os.path.exists(local(f"{landing}/changes"))


def test_an_epoch_sorts_its_rows_once(spark, landing, monkeypatch):
    plans, write = {}, inc._write

    def seen(rows, base, table, *args):
        write(rows, base, table, *args)
        plans[table] = rows.select("*")._jdf.queryExecution().executedPlan().toString(), rows.columns
    monkeypatch.setattr(inc, "_write", seen)
    for wave in (FIRST, SECOND):
        land(*raw_frames(spark, *wave), landing)
        run(spark, landing)
    for table in ("tickets", "latest"):
        above, _, below = plans[table][0].partition("InMemoryRelation")
        assert not re.search(r"\bSort \[", above) and re.search(r"\bSort \[slice", below)
    assert "struct<" not in plans["fact"][0].partition("InMemoryRelation")[2][:200] and tuple(plans["fact"][1]) == inc.FACT


def test_waves_leave_no_replaced_versions(spark, monkeypatch):
    swept = []
    monkeypatch.setattr(catalog, "sweep", swept.append)
    monkeypatch.setattr(stored, "state_of", lambda *args: "vacuumed")
    base = catalog.incremental_base(spark, SMOKE_DIR)
    held, last = inc.versions(spark, base)
    assert last == catalog.WAVES - 1 and len(swept) == 2 + catalog.WAVES
    for table in inc.VERSIONED:
        there = {(int(e[6:]), int(b[7:])) for e in os.listdir(local(f"{base}/{table}")) if e.startswith("epoch=")
                 for b in os.listdir(local(f"{base}/{table}/{e}")) if b.startswith("bucket=")}
        assert there == {(e, b) for b, e in held[table].items()}


def test_settings_end_with_their_block_also_on_errors(spark):
    known, other = "spark.sql.maxConcurrentOutputFileWriters", "spark.deskmetrics.other"
    before = spark.conf.get(known, None)
    with pytest.raises(RuntimeError), settings(spark, {known: "7", other: "x"}):
        assert spark.conf.get(known) == "7" and spark.conf.get(other) == "x"
        raise RuntimeError("lost")
    assert spark.conf.get(known, None) == before and spark.conf.get(other, None) is None


def test_persisting_ends_with_its_block_also_on_errors(spark):
    df = spark.range(3)
    with pytest.raises(RuntimeError), persisting() as keep:
        assert keep(df).is_cached and df.storageLevel.useMemory
        raise RuntimeError("lost")
    assert not df.storageLevel.useMemory


def test_nothing_new_is_no_epoch(spark, landing):
    land(*raw_frames(spark, *FIRST), landing)
    base = run(spark, landing)
    run(spark, landing)
    assert inc.versions(spark, base)[1] == 0


@pytest.mark.parametrize("step", ["extend", "signed_deltas", "_commit"])
def test_an_epoch_that_fails_is_replayed(spark, landing, monkeypatch, step):
    land(*raw_frames(spark, *FIRST), landing)
    base = run(spark, landing)
    land(*raw_frames(spark, *SECOND), landing)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(inc.keys if step == "extend" else inc, step, fail)
        with pytest.raises(StreamingQueryException):
            run(spark, landing)
    assert inc.versions(spark, base)[1] == 0
    assert named(inc.open_star(spark, base)) == named(batch(spark, *everything(spark, FIRST)))
    run(spark, landing)
    assert named(inc.open_star(spark, base)) == named(batch(spark, *everything(spark, FIRST, SECOND)))


def test_registry_keys_last_and_are_dense(spark):
    want = None
    for parts in (1, 7, 200):
        path = scratch(spark, "registry")
        pairs = lambda lo, hi: spark.range(lo, hi).select(
            F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("role"),
            F.concat(F.lit("n"), F.col("id") * 7919 % 1000).alias("name")).distinct().repartition(parts)
        first = {(r.role, r.name): r.key for r in keys.extend(pairs(0, 100), path, 0).collect()}
        both = {(r.role, r.name): r.key for r in keys.extend(pairs(50, 400), path, 1).collect()}
        again = {(r.role, r.name): r.key for r in keys.extend(pairs(50, 400), path, 1).collect()}
        assert first.items() <= both.items() and both == again
        for role in "ab":
            got = sorted(k for (r, _), k in both.items() if r == role)
            assert got == list(range(1, len(got) + 1))
        late = sorted((k, n) for (r, n), k in both.items() if r == "a" and (r, n) not in first)
        assert [n for _, n in late] == sorted(n for _, n in late)
        want = want or both
        assert both == want


def test_registry_of_no_names(spark):
    path = scratch(spark, "registry")
    assert keys.read(spark, path).count() == 0
    none = spark.createDataFrame([], "role string, name string")
    assert keys.extend(none, path, 0).count() == 0


def test_workspace_removes_folders_also_on_errors(spark, scratch_dir):
    before = set(os.listdir(scratch_dir))
    with pytest.raises(RuntimeError), workspace(spark):
        spark.range(3).write.parquet(scratch(spark, "left"))
        raise RuntimeError("lost")
    assert set(os.listdir(scratch_dir)) == before
    raw = raw_frames(spark, *FIRST)
    pipeline.run(spark, scan.scan_issues(raw[0]), scan.scan_changes(raw[1]), f"{scratch(spark, 'out')}")
    left = set(os.listdir(scratch_dir)) - before
    assert len(left) == 1 and left.pop().startswith("out-")
