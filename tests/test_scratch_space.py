"""What loads leave on disk while and after they run: no landed rows, no shuffle files, no CSV files."""

import contextlib
import glob
import os

from pyspark.sql import functions as F

from starloom.plans import star
from starloom.plans import warehouse as W
from starloom.session import checkpoint_root, shuffles_released
from starloom.sources import sinks

from football_fixture import write_fixture

SMALL = "/root/testdata/sf0.001"


def test_partitions_are_written_in_shares(spark, tmp_path, monkeypatch):
    """Every row once, NULL partitions too, whole partitions at a time; an overwrite leaves nothing of what was there."""
    rows = [(i, None if i % 7 == 0 else f"s{i % 7}") for i in range(700)]
    df = spark.createDataFrame(rows, "id INT, season STRING")
    hash_of = F.xxhash64("season")
    shares = sinks._shares(df, ["season"], 3)
    assert sorted(s.count() for s in shares) == [200, 200, 300]
    seen = [{r[0] for r in s.select(hash_of).distinct().collect()} for s in shares]
    assert sum(map(len, seen)) == len(set.union(*seen)) == 7
    path = str(tmp_path / "t")
    sinks.write_table(spark.createDataFrame([(-1, "old")], "id INT, season STRING"), path, partition_by=["season"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.write_table(df, path, partition_by=["season"], passes=3)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("id", "season").collect()) == sorted(rows)
    sinks.write_table(df.limit(0), str(tmp_path / "e"), partition_by=["season"], passes=3)
    assert os.path.isdir(tmp_path / "e")


def test_shuffles_are_removed_when_a_table_is_written(spark, tmp_path):
    left = lambda: set(glob.glob(f"{spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]}/**/shuffle_*", recursive=True))
    before = left()
    sinks.write_table(spark.range(10_000).repartition(4, "id"), str(tmp_path / "t"))
    assert not {f for f in left() - before if f.endswith(".data")}
    was = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    with contextlib.suppress(ValueError), shuffles_released(spark):
        raise ValueError
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == was


def test_landed_rows_go_when_their_fact_is_stored(spark, tmp_path):
    src, root = write_fixture(str(tmp_path / "src")), str(tmp_path / "wh")
    for run in ("2024-01-01 00:00:00", "2024-02-01 00:00:00"):
        W.run_pipeline(spark, src, root, run)
        assert glob.glob(f"{root}/_landing/*/*") and not glob.glob(f"{root}/_landing/**/*.parquet", recursive=True)
    lines = W.open_log(spark, root, "ledger").groupBy("run_ts").agg(F.countDistinct("table_name").alias("n")).collect()
    assert [r.n for r in lines] == [7, 7]


def test_csv_files_go_when_they_are_loaded(spark, monkeypatch):
    """One source's files at a time; none stays."""
    top = checkpoint_root(spark).removeprefix("file:")
    held = lambda: {f.split(".csv")[0] for f in glob.glob(f"{top}/star-csv-*/*.csv/*.csv*")}
    before, most, read = held(), [], W.read_source

    def counted(*args):
        most.append(len(held() - before))
        return read(*args)

    monkeypatch.setattr(W, "read_source", counted)
    rows = star.OUTPUT_QUERIES["staging_load"](spark, SMALL).collect()
    assert max(most) == 1 and len(most) == 11 and held() == before
    assert {(r.table_name, r.status) for r in rows if r.load == "all" and r.status != "loaded"} == {("team_children", "missing")}
    assert {(r.table_name, r.status) for r in rows if r.load == "again"} == {("player_market_value", "loaded"), ("transfer_history", "missing")}


def test_ledger_stores_no_split_that_only_it_reads(spark):
    star._SHARED.clear()
    rows = star.OUTPUT_QUERIES["fact_ledger"](spark, SMALL).collect()
    assert {r.table_name for r in rows} == set(W.FACTS)
    assert not any(star.known(spark, SMALL, f"split-{f}") for f in ("fact_transfer", "fact_national_performance", "fact_teammate_relationship"))
    assert star.known(spark, SMALL, "split-fact_player_performance")
