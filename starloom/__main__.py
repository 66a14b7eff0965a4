"""Command line: the reference's scripts as Spark jobs.

    python -m starloom stage  --src CSV_DIR --warehouse ROOT [--tables a,b]
    python -m starloom build  --warehouse ROOT --run-ts "2025-03-01 00:00:00" [--unknown drop|member]
                              [--load append|if_empty|rebuild]
    python -m starloom verify --warehouse ROOT
    python -m starloom run    --src CSV_DIR --warehouse ROOT --run-ts ... [--catalog DB --buckets N]
    python -m starloom report --warehouse ROOT top_scorers|injury_impact|value_trend PATTERN|...

Each command prints small result tables (counts, checks, reports) with
``show``; the work runs on the cluster the session points at (use
``spark-submit -m starloom`` or set the master in the environment).
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark import SparkConf
from pyspark.sql import SparkSession


def _session() -> SparkSession:
    """The submitted session; a local one only where no master is set (by spark-submit, its files or the environment)."""
    if os.environ.get("SPARK_MASTER") or SparkConf().contains("spark.master"):
        return SparkSession.builder.appName("starloom").getOrCreate()
    from .session import local_session

    return local_session()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="starloom")
    sub = p.add_subparsers(dest="cmd", required=True)
    st = sub.add_parser("stage", help="load the CSV sources into staging parquet")
    st.add_argument("--src", required=True)
    st.add_argument("--warehouse", required=True)
    st.add_argument("--tables", default=None, help="comma-separated subset to reload")
    b = sub.add_parser("build", help="dimensions, facts and the aggregate from staging")
    b.add_argument("--warehouse", required=True)
    b.add_argument("--run-ts", required=True)
    b.add_argument("--unknown", choices=("drop", "member"), default="drop")
    b.add_argument("--load", choices=("append", "if_empty", "rebuild"), default="append")
    v = sub.add_parser("verify", help="counts and all quality checks")
    v.add_argument("--warehouse", required=True)
    r = sub.add_parser("run", help="stage + build + verify")
    r.add_argument("--src", required=True)
    r.add_argument("--warehouse", required=True)
    r.add_argument("--run-ts", required=True)
    r.add_argument("--unknown", choices=("drop", "member"), default="drop")
    r.add_argument("--load", choices=("append", "if_empty", "rebuild"), default="append")
    r.add_argument("--max-rejected", type=float, default=None, help="share of a fact's rows whose loss fails the run")
    r.add_argument("--catalog", default=None, help="also store as bucketed tables of this database")
    r.add_argument("--buckets", type=int, default=64)
    q = sub.add_parser("report", help="an analyst query")
    q.add_argument("--warehouse", required=True)
    q.add_argument("name", choices=("top_scorers", "value_trend", "injury_impact", "star_sample", "transfer_flows",
                                    "teammate_synergy", "scorers_by_season_competition", "team_comparison"))
    q.add_argument("arg", nargs="?", default=None)
    a = p.parse_args(argv)

    from .operators.quality import labelled
    from .plans import analytics as N
    from .plans import warehouse as W

    spark = spark or _session()
    stage_dir = os.path.join(a.warehouse, "_staging")
    if a.cmd == "stage":
        tables = a.tables.split(",") if a.tables else None
        W.load_staging(spark, a.src, stage_dir, tables).show(truncate=False)
    elif a.cmd == "build":
        st = W.read_staging(spark, stage_dir)
        lines = W.load_warehouse(spark, st, a.warehouse, a.run_ts, a.unknown, a.load)
        lines.orderBy("table_name", "reason").show(100, truncate=False)
    elif a.cmd == "verify":
        counts, checks, passed = W.verify(W.open_warehouse(spark, a.warehouse))
        counts.orderBy("table_kind", "table_name").show(50, truncate=False)
        labelled(checks).where("failures > 0").orderBy("table_name", "check_name").show(200, truncate=False)
        passed.show()
    elif a.cmd == "run":
        status, counts, checks, passed, audit = W.run_pipeline(spark, a.src, a.warehouse, a.run_ts, a.unknown,
                                                               a.catalog, a.buckets, a.load, a.max_rejected)
        status.show(truncate=False)
        audit.orderBy("table_name").show(50, truncate=False)
        labelled(checks).where("failures > 0").orderBy("table_name", "check_name").show(200, truncate=False)
        passed.show()
    elif a.cmd == "report":
        wh = W.open_warehouse(spark, a.warehouse)
        fn = getattr(N, a.name)
        df = fn(wh, a.arg) if a.name == "value_trend" else fn(wh)
        df.show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
