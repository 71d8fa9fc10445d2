"""Batch run from the command line (K7):

    python -m deskmetrics --issues s3a://raw/issues.csv \\
        --changes s3a://raw/issues_change_history.csv --out s3a://curated/ \\
        [--jdbc-url jdbc:postgresql://host/db --jdbc-connections 16 --jdbc-property user=... ...]

    (or ``spark-submit --py-files deskmetrics.zip deskmetrics/__main__.py ...``)

Reads the two CSV extracts, rebuilds the fact, writes the seven curated
tables (and loads the warehouse when a JDBC URL is given) and prints the
input counters and table sizes as JSON.  Errors propagate (non-zero exit).
The session comes from the environment (``getOrCreate``); only its zone and
checkpoint folder are checked.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="deskmetrics")
    ap.add_argument("--issues", required=True, help="tickets CSV (file or folder)")
    ap.add_argument("--changes", required=True, help="change-log CSV (file or folder)")
    ap.add_argument("--out", required=True, help="curated zone folder")
    ap.add_argument("--jdbc-url", default=None)
    ap.add_argument("--jdbc-connections", type=int, default=None,
                    help="concurrent writers of the warehouse load (required with --jdbc-url)")
    ap.add_argument("--jdbc-property", action="append", default=[],
                    help="key=value JDBC option (repeatable); "
                         "DESKMETRICS_JDBC_PASSWORD is used when no password is given")
    args = ap.parse_args(argv)

    from deskmetrics.plans import model, pipeline
    from deskmetrics.session import prepare

    spark = prepare(spark or SparkSession.builder.appName("deskmetrics").getOrCreate())
    props = dict(p.split("=", 1) for p in args.jdbc_property)
    if args.jdbc_url and "password" not in props and os.environ.get("DESKMETRICS_JDBC_PASSWORD"):
        props["password"] = os.environ["DESKMETRICS_JDBC_PASSWORD"]
    m = model.from_csv(spark, args.issues, args.changes)
    result = pipeline.run(spark, m.issues, m.changes, args.out,
                          jdbc_url=args.jdbc_url, jdbc_properties=props,
                          jdbc_connections=args.jdbc_connections)
    sizes = {r.table_name: r.rows for r in pipeline.table_sizes(result.tables).collect()}
    report = {"inputs": result.metrics, "tables": sizes}
    print(json.dumps(report))
    return report


if __name__ == "__main__":
    main(sys.argv[1:])
