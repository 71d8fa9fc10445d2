"""Ticket-shaped raw inputs derived from the driver's TPC-H-style tables.

The reference reads two CSV extracts: tickets and a log of ticket changes.
The test data ships none, so both are derived here from ``orders`` /
``lineitem`` and their dimensions, as text columns with the same noise the
real extracts carry (three timestamp formats, stray blanks, mixed case,
duplicate ticket ids, tickets resolved before creation, unknown priorities,
NULL reporters/assignees/categories).  Every order becomes a ticket and every
line item a change-log row, so the work grows with the tables.

A quarter of the tickets have one of a few reporters and agents (heavy users
and hot keys); the others take theirs from all customers and suppliers, so the
dimensions grow with the tables.  Stamps are whole seconds, and durations are
fractions of hours.  Joins are left to the planner and AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CHANGES_SCHEMA, ISSUES_SCHEMA, TIMESTAMP_FORMAT

# Tickets whose id divides by HOT_SHARE have one of so many reporters / agents.
HOT_SHARE = 4
HOT_REPORTERS = 10
HOT_AGENTS = 7


# Declared column types of the driver tables this package reads; a declared
# schema spares the footer-inference job every read would otherwise start.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fmt(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_FORMAT)


def _suffix(key: Column, zero: str, one: str, two: str) -> Column:
    m = key % 3
    return F.when(m == 0, F.lit(zero)).when(m == 1, F.lit(one)).otherwise(F.lit(two))


def raw_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets as text, one row per order plus a shifted copy of every 50th."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    lines = (read_table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.sum("l_quantity").alias("q"),
                  F.min("l_partkey").alias("pk"),
                  F.min("l_suppkey").alias("sk"),
                  F.count(F.lit(1)).alias("n_lines")))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    reporters = (read_table(spark, sf_dir, "customer")
                 .select(F.col("c_custkey").alias("rep_key"), F.col("c_name").alias("rep_name")))
    agents = (read_table(spark, sf_dir, "supplier")
              .select(F.col("s_suppkey").alias("agent_key"), F.col("s_name").alias("agent_name")))
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")

    key = F.col("o_orderkey")
    # Large-to-large joins are shuffle joins at any real scale; the last one
    # is on the order (= ticket) key and hinted as sort-merge, so the
    # per-ticket text work below runs on every shuffle partition instead of
    # in the scan task of one file.  (The text round trip hides the layout
    # from the planner, as a real CSV extract would: de-dup shuffles by id
    # and the state join reuses that.)
    with_part = lines.join(part, F.col("p_partkey") == F.col("pk"), "left")
    hot = key % HOT_SHARE == 0
    with_customer = (orders.join(customer, customer.c_custkey == orders.o_custkey, "left")
                     .join(reporters, F.col("rep_key") == F.when(hot, F.col("o_custkey") % HOT_REPORTERS)
                           .otherwise(F.col("o_custkey")), "left")
                     .join(nation, F.col("n_nationkey") == F.col("c_nationkey"), "left"))
    with_agent = (orders.select(key.alias("a_orderkey")).join(with_part, F.col("a_orderkey") == F.col("l_orderkey"), "left")
                  .withColumn("a_key", F.when(F.col("a_orderkey") % HOT_SHARE == 0, F.col("a_orderkey") % HOT_AGENTS)
                              .otherwise(F.col("sk")))
                  .join(agents, F.col("agent_key") == F.col("a_key"), "left"))
    joined = with_customer.join(with_agent.hint("merge"), key == F.col("a_orderkey"), "left")

    q = F.col("q")
    hours = F.when(key % 40 == 0, -q).when(key % 17 == 0, q + 400).otherwise(q).cast("int")
    priority = (F.when(F.col("o_orderpriority") == "1-URGENT", "critical")
                .when(F.col("o_orderpriority") == "2-HIGH", " HIGH ")
                .when(F.col("o_orderpriority") == "3-MEDIUM", "Medium")
                .when(F.col("o_orderpriority") == "5-LOW", "low")
                .otherwise(F.when(key % 2 == 0, F.lit("blocker"))))
    one = joined.select(
        key.alias("id"),
        F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")).alias("issue_proj"),
        F.when(key % 29 != 0, F.col("rep_name")).alias("issue_reporter"),
        F.when(key % 13 != 0, F.col("agent_name")).alias("issue_assignee"),
        F.col("n_lines").alias("issue_contr_count"),
        priority.alias("issue_priority"),
        F.when(key % 17 != 0, F.concat(F.lit(" "), F.lower("p_type"))).alias("issue_type"),
        F.col("o_orderdate").alias("created"),
        F.when((F.col("o_orderstatus") != "O") & q.isNotNull(),
               F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hours, (key % 60).cast("int"), key * 7 % 60))
        .alias("resolved"),
        F.col("o_orderstatus").alias("issue_status"),
    )
    # Every 50th ticket is extracted twice, the copy one day later: one pass
    # with a copy flag instead of a union that would scan and join twice.
    copy_flags = F.when(F.col("id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    shift = F.make_dt_interval(F.col("_copy"))
    two = (one.withColumn("_copy", F.explode(copy_flags))
           .withColumns({"created": F.col("created") + shift,
                         "resolved": F.col("resolved") + shift}))

    tid = F.col("id")
    text = {
        "id": tid,
        "issue_num": tid,
        "issue_proj": F.col("issue_proj"),
        "issue_reporter": F.col("issue_reporter"),
        "issue_assignee": F.col("issue_assignee"),
        "issue_contr_count": F.col("issue_contr_count"),
        "issue_priority": F.col("issue_priority"),
        "issue_type": F.col("issue_type"),
        "issue_created": F.concat(_fmt(F.col("created")),
                                  _suffix(tid, "+00:00", ".564000", "")),
        "issue_resolution_date": F.concat(_fmt(F.col("resolved")),
                                          _suffix(tid, "", "+00:00", ".250000")),
        "issue_resolution": F.when(F.col("resolved").isNotNull(), F.lit("Done")),
        "issue_status": F.col("issue_status"),
        "issue_comments_count": tid % 11,
        "last_change_date": _fmt(F.col("created") + F.make_dt_interval(F.lit(2))),
        "wf_total_time": tid * 60,
        "processing_steps": tid % 9,
    }
    return two.select(*[text[f.name].cast("string").alias(f.name) for f in ISSUES_SCHEMA.fields])


def raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log as text: one row per line item, odd lines set the status,
    even lines the assignee (cleared for every 23rd part)."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_returnflag", "l_linestatus", "l_shipdate")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    # supplier grows with the data (10k rows per scale unit): a shuffle join,
    # which also spreads the per-line text work over all tasks.  Hash join
    # with the supplier partition as the build side: line items need no sort
    # to get a name attached.
    joined = lineitem.join(supplier.hint("shuffle_hash"), supplier.s_suppkey == lineitem.l_suppkey, "left")

    line = F.col("l_linenumber")
    odd = line % 2 == 1
    status = (F.when(F.col("l_returnflag") == "N", "In Progress")
              .when(F.col("l_returnflag") == "A", "Resolved")
              .otherwise(F.when(F.col("l_linestatus") == "F", "Closed").otherwise("Reopened")))
    text = {
        "id": F.col("l_orderkey") * 10 + line,
        "issueid": F.col("l_orderkey"),
        "field": F.when(odd, F.lit("status")).otherwise(F.lit("assignee")),
        "value": F.when(odd, status).otherwise(
            F.when(F.col("l_partkey") % 23 != 0, F.col("s_name"))),
        "created": F.concat(_fmt(F.col("l_shipdate")),
                            _suffix(line, "+00:00", ".100000", "")),
        "change_group_id": F.col("l_orderkey"),
    }
    return joined.select(*[text[f.name].cast("string").alias(f.name) for f in CHANGES_SCHEMA.fields])
