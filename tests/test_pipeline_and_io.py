"""Sinks, the batch run, re-run safety, CSV scan and the streaming form."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from deskmetrics.operators import clean
from deskmetrics.plans import model, pipeline
from deskmetrics.schemas import CHANGES_SCHEMA, as_text
from deskmetrics.session import scratch, staged
from deskmetrics.sources import fixture, scan, sinks
from deskmetrics.streaming import current_state as streaming


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_round_trip_equals_direct_scan(spark, scratch_dir):
    path = f"{scratch_dir}/csv-{uuid.uuid4().hex[:8]}"
    raw = fixture.raw_issues(spark, SMOKE_DIR)
    scan.write_csv_text(raw, path)
    assert same(scan.read_issues_csv(spark, path), scan.scan_issues(raw))


def test_pipeline_twice_gives_same_tables(spark, scratch_dir):
    out = f"{scratch_dir}/curated-{uuid.uuid4().hex[:8]}"
    issues = scan.scan_issues(fixture.raw_issues(spark, SMOKE_DIR))
    changes = scan.scan_changes(fixture.raw_changes(spark, SMOKE_DIR))
    first = pipeline.run(spark, issues, changes, out)
    snap = {k: v.collect() for k, v in first.tables.items()}
    assert {k: first.metrics[k] for k in ("issues.rows_in", "changes.rows_in", "fact_tickets.rows_after_dedup")} == \
        {"issues.rows_in": 1530, "changes.rows_in": 6000, "fact_tickets.rows_after_dedup": 1476}
    second = pipeline.run(spark, issues, changes, out)
    for name, rows in snap.items():
        assert sorted(map(tuple, second.tables[name].collect()), key=repr) == \
            sorted(map(tuple, rows), key=repr), name
    # the fact folder is partitioned by priority, NULL priority included
    parts = sorted(p for p in os.listdir(f"{out}/fact_tickets") if p.startswith("priority="))
    assert "priority=__HIVE_DEFAULT_PARTITION__" in parts


DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}

# the warehouse's tables with their keys, in Derby's words (Spark binds a NULL text as CLOB there, so columns
# with NULLs are CLOBs)
WAREHOUSE_DDL = """
create schema analytics;
create table dim_customers (customer_id bigint primary key, reporter_name varchar(120) not null unique);
create table dim_agents (agent_id bigint primary key, agent_name varchar(120) not null unique);
create table dim_projects (project_id bigint primary key, project_name varchar(120) not null unique);
create table fact_tickets (ticket_id bigint primary key,
  customer_id bigint references dim_customers(customer_id), agent_id bigint references dim_agents(agent_id),
  project_id bigint references dim_projects(project_id), category clob, priority clob,
  start_time timestamp, resolution_time timestamp, resolution_duration_hours decimal(10,2), status clob,
  resolution_target_met boolean);
create table analytics.agent_performance (agent_id bigint, tickets_resolved int,
  avg_resolution_duration_hours decimal(10,2), rank_by_volume int);
create table analytics.resolution_performance (priority clob, "MONTH" timestamp, tickets_resolved int,
  compliance_rate decimal(5,2));
create table analytics.category_trends (category clob, "MONTH" timestamp, ticket_volume int,
  volume_change_pct decimal(12,2))
"""


def test_warehouse_refresh_respects_keys_names_and_types(spark, scratch_dir):
    """Two loads into tables with foreign keys (in-process Derby, no server)."""
    url = f"jdbc:derby:memory:w{uuid.uuid4().hex[:8]};create=true"
    for statement in WAREHOUSE_DDL.split(";"):
        sinks.empty_tables(spark, url, [""], DERBY, statement=statement.strip().replace("{", "{{"))
    issues = scan.scan_issues(fixture.raw_issues(spark, SMOKE_DIR))
    changes = scan.scan_changes(fixture.raw_changes(spark, SMOKE_DIR))
    sizes = []
    for _ in range(2):
        out = f"{scratch_dir}/curated-{uuid.uuid4().hex[:8]}"
        res = pipeline.run(spark, issues, changes, out, jdbc_url=url, jdbc_properties=DERBY, jdbc_connections=2)
        back = {n: sinks.read_jdbc(spark, url, pipeline.WAREHOUSE_NAMES.get(n, n), DERBY)
                for n in pipeline.CURATED_ORDER}
        sizes.append({n: t.count() for n, t in back.items()})
        assert sizes[-1] == {n: t.count() for n, t in res.tables.items()}
    assert sizes[0] == sizes[1]
    stored = {r.AGENT_ID: tuple(r) for r in back["agent_performance"].collect()}
    assert stored == {r.agent_id: tuple(r) for r in res.tables["agent_performance"].collect()}


def test_warehouse_load_needs_a_number_of_connections(spark, scratch_dir):
    with pytest.raises(ValueError, match="jdbc_connections"):
        pipeline.run(spark, None, None, scratch_dir, jdbc_url="jdbc:derby:memory:x")


def test_dashboard_from_stored_tables_equals_in_flight(spark, scratch_dir):
    from deskmetrics.operators import star
    from deskmetrics.plans import dashboard
    out = f"{scratch_dir}/curated-{uuid.uuid4().hex[:8]}"
    m = model.from_tables(spark, SMOKE_DIR)
    res = pipeline.run(spark, m.issues, m.changes, out)
    t = res.tables
    stored = dashboard.dashboard_base_stored(t["fact_tickets"], t["dim_projects"], t["dim_agents"])
    fact = staged(m.fact, scratch(spark, "fact"))
    in_flight = dashboard.dashboard_base(fact, star.build_dimensions(fact))
    assert same(stored.select(*in_flight.columns), in_flight)


def test_partitioned_jdbc_read(spark):
    df = spark.range(100).select(F.col("id").alias("ticket_id"))
    url = f"jdbc:derby:memory:p{uuid.uuid4().hex[:8]};create=true"
    sinks.append_jdbc(df, url, "t", 3, DERBY)
    back = sinks.read_jdbc(spark, url, "T", DERBY, partition_column="TICKET_ID",
                           lower_bound=0, upper_bound=100, num_partitions=4)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 100


def test_emptying_is_one_transaction(spark):
    df = spark.range(5).select(F.col("id").alias("ticket_id"))
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"
    sinks.append_jdbc(df, url, "t", 2, DERBY)
    with pytest.raises(Exception, match="NO_SUCH_TABLE"):
        sinks.empty_tables(spark, url, ["t", "no_such_table"], DERBY)
    assert sinks.read_jdbc(spark, url, "T", DERBY).count() == 5
    sinks.empty_tables(spark, url, ["t"], DERBY)
    assert sinks.read_jdbc(spark, url, "T", DERBY).count() == 0


# --- CSV by header name ---------------------------------------------------------

ROW = {"id": "6", "issueid": "1", "field": "status", "value": "Open", "created": "2020-01-02 03:04:05",
       "change_group_id": "9"}


def _write(folder, name, columns, row=ROW, opener=open):
    os.makedirs(folder, exist_ok=True)
    with opener(f"{folder}/{name}", "wt") as f:
        f.write(",".join(columns) + "\n" + ",".join(row.get(c, "junk") for c in columns) + "\n")


@pytest.mark.parametrize("columns", [
    list(ROW), list(reversed(ROW)), ["extra", *ROW], ["id", "issueid", "extra", "field", "value", "created",
                                                      "change_group_id"]])
def test_csv_columns_are_taken_by_name(spark, scratch_dir, columns):
    folder = f"{scratch_dir}/csv-{uuid.uuid4().hex[:8]}"
    _write(folder, "part.csv", columns)
    assert [tuple(r) for r in scan.read_changes_csv(spark, folder).collect()] == \
        [(6, 1, "status", "Open", "2020-01-02 03:04:05", 9)]


def test_csv_folder_with_different_headers_and_compression(spark, scratch_dir):
    import gzip
    folder = f"{scratch_dir}/csv-{uuid.uuid4().hex[:8]}"
    _write(folder, "a.csv", list(ROW))
    _write(folder, "b.csv", ["extra", *reversed(ROW)], {**ROW, "id": "7"})
    _write(folder, "c.csv.gz", list(reversed(ROW)), {**ROW, "id": "8"}, gzip.open)
    open(f"{folder}/empty.csv", "w").close()
    rows = scan.read_changes_csv(spark, folder).collect()
    assert sorted(tuple(r)[:3] for r in rows) == [(6, 1, "status"), (7, 1, "status"), (8, 1, "status")]


def test_csv_without_a_declared_column_fails(spark, scratch_dir):
    from pyspark.errors import AnalysisException
    folder = f"{scratch_dir}/csv-{uuid.uuid4().hex[:8]}"
    _write(folder, "a.csv", list(ROW))
    _write(folder, "b.csv", [c for c in ROW if c != "value"])
    with pytest.raises(AnalysisException, match="value"):
        scan.read_changes_csv(spark, folder)


def test_stream_equals_batch_with_out_of_order_files(spark, scratch_dir):
    """Change-log files landing newest first still give the batch state."""
    raw = fixture.raw_changes(spark, SMOKE_DIR)
    src = f"{scratch_dir}/stream-src-{uuid.uuid4().hex[:8]}"
    os.makedirs(src)
    pdf = raw.toPandas()  # 6,000 test rows, split into files by hand
    pdf = pdf.sort_values("created", ascending=False)
    for i, chunk in enumerate([pdf.iloc[k:k + 1500] for k in range(0, len(pdf), 1500)]):
        pq.write_table(pa.Table.from_pandas(chunk, preserve_index=False), f"{src}/part-{i}.parquet")
    state = streaming.run_available(
        spark, src, as_text(CHANGES_SCHEMA), "parquet",
        transform=lambda df: clean.parse_change_stamps(scan.scan_changes(df)),
        max_files_per_trigger=1)
    batch = model.from_tables(spark, SMOKE_DIR).state
    assert same(state, batch)


def test_entry_and_contract(spark):
    import __spark_entry__ as entry_mod
    df = entry_mod.entry(spark)
    assert df.count() == 6 and df.columns == ["priority", "total_tickets", "met_target",
                                              "compliance_rate_pct"]
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 70


def test_command_line_run_on_csv_extracts(spark, scratch_dir):
    from deskmetrics.__main__ import main
    base = f"{scratch_dir}/cli-{uuid.uuid4().hex[:8]}"
    scan.write_csv_text(fixture.raw_issues(spark, SMOKE_DIR), f"{base}/issues")
    scan.write_csv_text(fixture.raw_changes(spark, SMOKE_DIR), f"{base}/changes")
    report = main(["--issues", f"{base}/issues", "--changes", f"{base}/changes",
                   "--out", f"{base}/curated"], spark)
    assert report["inputs"]["issues.rows_in"] == 1530 and report["inputs"]["changes.rows_in"] == 6000
    assert report["tables"]["fact_tickets"] == 1476
    assert set(report["tables"]) == set(pipeline.CURATED_ORDER)


def test_stream_resumes_and_compacts(spark, scratch_dir):
    """Two runs of one named stream over files that arrive in two waves,
    with a compaction in between, give the batch state."""
    raw = fixture.raw_changes(spark, SMOKE_DIR)
    src = f"{scratch_dir}/stream-src-{uuid.uuid4().hex[:8]}"
    os.makedirs(src)
    pdf = raw.toPandas().sort_values("created", ascending=False)
    chunks = [pdf.iloc[k:k + 1500] for k in range(0, len(pdf), 1500)]
    name = f"resume_{uuid.uuid4().hex[:8]}"
    kwargs = dict(transform=lambda df: clean.parse_change_stamps(scan.scan_changes(df)), name=name)
    for wave in (chunks[:2], chunks[2:]):
        for chunk in wave:
            pq.write_table(pa.Table.from_pandas(chunk, preserve_index=False),
                           f"{src}/part-{uuid.uuid4().hex[:8]}.parquet")
        state = streaming.run_available(spark, src, as_text(CHANGES_SCHEMA), "parquet", **kwargs)
        if wave is chunks[:2]:
            base = streaming.stream_base(spark, name)
            assert streaming.compact(spark, base, state.schema, ("issueid",)) is not None
    batch = model.from_tables(spark, SMOKE_DIR).state
    assert same(state, batch)


def test_fact_from_csv_extracts_equals_fact_from_text_frames(spark, scratch_dir):
    base = f"{scratch_dir}/csvfact-{uuid.uuid4().hex[:8]}"
    scan.write_csv_text(fixture.raw_issues(spark, SMOKE_DIR), f"{base}/issues")
    scan.write_csv_text(fixture.raw_changes(spark, SMOKE_DIR), f"{base}/changes")
    from_csv = model.from_csv(spark, f"{base}/issues", f"{base}/changes").fact
    assert same(from_csv, model.from_tables(spark, SMOKE_DIR).fact)
