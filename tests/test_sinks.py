import os

from pyspark.sql import functions as F

from starloom.plans import warehouse as W
from starloom.sources import sinks

from football_fixture import write_fixture


def test_partition_overwrite_load_if_empty_and_manifest(spark, tmp_dir):
    df = spark.createDataFrame([(1, "23/24", 5), (2, "24/25", 7), (3, "24/25", 1)], "id INT, season STRING, v INT")
    path = os.path.join(tmp_dir, "fact")
    sinks.write_table(df, path, partition_by=["season"])
    assert sinks.write_if_empty(df, path, ["season"]) is False          # S16: already loaded → skipped
    assert spark.read.parquet(path).count() == 3
    fix = spark.createDataFrame([(9, "24/25", 0)], "id INT, season STRING, v INT")
    sinks.overwrite_partitions(fix, path, ["season"])                   # S15: only 24/25 replaced
    got = sorted((r.id, r.season) for r in spark.read.parquet(path).collect())
    assert got == [(1, "23/24"), (9, "24/25")]
    empty = os.path.join(tmp_dir, "empty")
    assert sinks.write_if_empty(df, empty) is True
    sinks.write_manifest(spark, tmp_dir, {"fact": path, "other": empty}, {"fact": "fact"})
    listed = {r.table_name: r.table_kind for r in sinks.list_tables(spark, tmp_dir).collect()}
    assert listed == {"fact": "fact", "other": "table"}                 # S13


def test_audit_delta(spark):
    from starloom.operators.quality import table_counts

    a = spark.range(10)
    before = sinks.audit_counts({"t": a.where("id < 4"), "gone": a}, "2025-01-01 00:00:00")
    after = table_counts({"t": a, "new": a.limit(2)})
    got = {r.table_name: (r.n_before, r.n_after, r.delta) for r in sinks.audit_delta(before, after).collect()}
    assert got == {"t": (4, 10, 6), "gone": (10, 0, -10), "new": (0, 2, 2)}


def test_subset_reload(spark, tmp_dir):
    src = write_fixture(os.path.join(tmp_dir, "src"))
    stage = os.path.join(tmp_dir, "stage")
    first = {r.table_name: r.status for r in W.load_staging(spark, src, stage).collect()}
    assert set(first.values()) == {"loaded"} and len(first) == 11
    again = W.load_staging(spark, src, stage, tables=["player_market_value", "player_latest_market_value"])
    assert [r.table_name for r in again.collect()] == ["player_market_value", "player_latest_market_value"]
    st = W.read_staging(spark, stage)
    assert st["player_market_value"].where(F.col("value").isNull()).count() == 0


def test_command_line(spark, tmp_dir, capsys):
    from starloom.__main__ import main

    src = write_fixture(os.path.join(tmp_dir, "src"))
    root = os.path.join(tmp_dir, "dw")
    assert main(["stage", "--src", src, "--warehouse", root], spark) == 0
    assert main(["build", "--warehouse", root, "--run-ts", "2025-03-01 00:00:00"], spark) == 0
    assert main(["report", "--warehouse", root, "top_scorers"], spark) == 0
    assert main(["report", "--warehouse", root, "value_trend", "%Lionel%"], spark) == 0
    out = capsys.readouterr().out
    assert "fact_player_performance" in out and "unknown_player" in out and "Lionel Test" in out
    root2 = os.path.join(tmp_dir, "dw2")
    assert main(["run", "--src", src, "--warehouse", root2, "--run-ts", "2025-03-01 00:00:00",
                 "--catalog", "cli_wh", "--buckets", "4"], spark) == 0
    assert {t.name for t in spark.catalog.listTables("cli_wh")} >= {"dim_player", "fact_player_performance"}
    assert spark.table("cli_wh.fact_player_performance").count() == 7
