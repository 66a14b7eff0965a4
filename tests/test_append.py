"""A second run appends: facts, closed versions, the season aggregate and the row ledger."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from starloom.operators import facts as FX
from starloom.operators.quality import labelled, row_ledger, run_passed
from starloom.operators.summary import refresh_summary, season_summary
from starloom.plans import warehouse as W
from starloom.sources import sinks

RUNS = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"]


def staging(spark, perf, profiles, values=(), injuries=()):
    st = {n: spark.createDataFrame([], W.catalogue()[n].schema) for n in W.LOAD_ORDER}
    st["player_performances"] = spark.createDataFrame(
        [dict(player_id=p, season_name=s, competition_id="C", competition_name="Cup", team_id=t, nb_on_pitch=2, goals=g, assists=1,
              minutes_played=90, yellow_cards=0, second_yellow_cards=0, direct_red_cards=0) for p, s, t, g in perf],
        "player_id int, season_name string, competition_id string, competition_name string, team_id int, nb_on_pitch int, goals int, "
        "assists int, minutes_played int, yellow_cards int, second_yellow_cards int, direct_red_cards int")
    st["player_performances"] = _conform(st["player_performances"], "player_performances")
    st["player_profiles"] = _conform(spark.createDataFrame([(i, f"P{i}", pos) for i, pos in profiles], "player_id int, player_name string, position string"), "player_profiles")
    st["player_market_value"] = _conform(spark.createDataFrame([(p, d, v) for p, d, v in values], "player_id int, date_unix string, value int"), "player_market_value")
    st["player_injuries"] = _conform(spark.createDataFrame([(p, s, r, n) for p, s, r, n in injuries], "player_id int, season_name string, injury_reason string, days_missed int"), "player_injuries")
    return st


def _conform(df, name):
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in W.catalogue()[name].schema.fields])


FIRST = [(1, "23/24", 10, 5), (1, "23/24", 10, 5), (2, "23/24", None, 1), (9, "23/24", 10, 2), (2, None, 10, 7)]
MORE = FIRST + [(1, "23/24", 10, 5), (1, "24/25", 11, 3), (2, "23/24", 10, 4)]


@pytest.fixture(scope="module")
def two_runs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    W.load_warehouse(spark, staging(spark, FIRST, [(1, "GK"), (2, "DF")], [(1, "2023-08-01", 5), (1, None, 6), (2, "2023-08-01", None)]), root, RUNS[0])
    first = {n: [tuple(r) for r in df.collect()] for n, df in W.open_warehouse(spark, root).items()}
    closed = _files(root, "dim_player_closed")
    st = staging(spark, MORE, [(1, "FW"), (2, "DF"), (3, "GK")], [(1, "2023-08-01", 5), (1, "2024-05-01", 9)], [(2, "23/24", "Knee", 12)])
    W.load_warehouse(spark, st, root, RUNS[1])
    return root, first, st, closed


def _files(root, table):
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in glob.glob(f"{root}/{table}*/**/*.parquet", recursive=True)}


def test_second_run_adds_only_new_rows_and_moves_no_key(spark, two_runs):
    root, first, _, _ = two_runs
    wh = W.open_warehouse(spark, root)
    perf = wh["fact_player_performance"]
    rows = {bytes(r.performance_sk): r for r in perf.collect()}
    old = {bytes(r[0]) for r in first["fact_player_performance"]}
    assert len(old) == 4 and len(rows) == 7 and old <= set(rows)      # the third copy of a row is new, player 9 unknown
    assert {str(rows[k].load_datetime) for k in old} == {RUNS[0]} and {str(r.load_datetime) for k, r in rows.items() if k not in old} == {RUNS[1]}
    assert wh["fact_market_value"].count() == 2


def test_facts_keep_the_version_they_were_loaded_with(spark, two_runs):
    root, _, _, _ = two_runs
    wh = W.open_warehouse(spark, root)
    j = wh["fact_player_performance"].join(wh["dim_player"], "player_sk").where("player_nk = 1")
    assert sorted((r.position, str(r.load_datetime)) for r in j.collect()) == [("FW", RUNS[1])] * 2 + [("GK", RUNS[0])] * 2
    versions = {(r.player_nk, r.position, r.is_current) for r in wh["dim_player"].collect()}
    assert versions == {(1, "GK", False), (1, "FW", True), (2, "DF", True), (3, "GK", True)}


def test_closed_versions_are_only_added_to(spark, two_runs):
    root, _, st, closed = two_runs
    before = _files(root, "dim_player_closed")
    assert closed.items() <= before.items()
    again = dict(st)
    again["player_profiles"] = st["player_profiles"].withColumn("position", F.lit("XX"))
    W.load_warehouse(spark, again, root, RUNS[2])
    after = _files(root, "dim_player_closed")
    assert before.items() <= after.items() and len(after) > len(before)
    dim = W.open_warehouse(spark, root)["dim_player"]
    assert dim.where("is_current").count() == 3 and dim.count() == 7


def test_a_repeated_run_adds_nothing(spark, two_runs, tmp_path):
    _, _, st, _ = two_runs
    root = str(tmp_path / "wh")
    W.load_warehouse(spark, st, root, RUNS[0])
    counts = {n: df.count() for n, df in W.open_warehouse(spark, root).items()}
    W.load_warehouse(spark, st, root, RUNS[1])
    assert {n: df.count() for n, df in W.open_warehouse(spark, root).items()} == counts
    W.load_warehouse(spark, st, root, RUNS[2], load="rebuild")
    wh = W.open_warehouse(spark, root)
    assert {n: df.count() for n, df in wh.items()} == counts
    assert {str(r[0]) for r in wh["fact_player_performance"].select("load_datetime").distinct().collect()} == {RUNS[2]}
    more = dict(st)
    more["player_performances"] = st["player_performances"].unionByName(st["player_performances"])
    W.load_warehouse(spark, more, root, RUNS[2], load="if_empty")
    assert W.open_warehouse(spark, root)["fact_player_performance"].count() == counts["fact_player_performance"]
    with pytest.raises(ValueError):
        W.load_warehouse(spark, st, root, RUNS[2], load="sometimes")


def test_a_run_that_failed_between_facts_is_completed(spark, two_runs, tmp_path, monkeypatch):
    _, _, st, _ = two_runs
    root = str(tmp_path / "wh")
    W.load_warehouse(spark, staging(spark, FIRST, [(1, "GK"), (2, "DF")]), root, RUNS[0])
    real, seen = W._store_fact, []

    def fails(stored, name, *args):
        seen.append(name)
        if len(seen) == 3:
            raise RuntimeError("executor lost")
        return real(stored, name, *args)

    monkeypatch.setattr(W, "_store_fact", fails)
    with pytest.raises(RuntimeError):
        W.load_warehouse(spark, st, root, RUNS[1])
    monkeypatch.setattr(W, "_store_fact", real)
    W.load_warehouse(spark, st, root, RUNS[1])
    wh = W.open_warehouse(spark, root)
    assert wh["fact_player_performance"].count() == 7 and wh["fact_injury"].count() == 1
    assert wh["dim_player"].where("is_current").groupBy("player_nk").count().where("count > 1").count() == 0


def test_ledger_adds_up(spark, two_runs):
    root, _, st, _ = two_runs
    lines = [r for r in W.open_log(spark, root, "ledger").where(F.col("run_ts") == F.lit(RUNS[1]).cast("timestamp_ntz")).collect()]
    by = {(r.table_name, r.reason): r.n_rows for r in lines}
    assert by["fact_player_performance", "accepted"] == 7 and by["fact_player_performance", "unknown_player"] == 1
    assert by["fact_player_season_summary", "no_season"] == 1 and by["fact_player_season_summary", "accepted"] == 6
    assert all(r.rows_in == r.rows_out + r.rows_rejected for r in lines)
    assert {r.table_name for r in lines} == set(W.FACTS)
    lost = W.open_log(spark, root, "rejected").where("table_name = 'fact_market_value'")
    assert {(r.reject_reason, r.n_rows) for r in lost.collect()} == {("no_date", 1), ("no_value", 1)}
    ledger = W.open_log(spark, root, "ledger").where(F.col("run_ts") == F.lit(RUNS[1]).cast("timestamp_ntz"))
    none = spark.createDataFrame([("t", "null_key", 0)], "table_name string, check_name string, failures long")
    assert run_passed(none, ledger=ledger).first().passed is True
    assert run_passed(none, ledger=ledger, max_rejected=0.05).first().passed is False
    assert run_passed(none, ledger=ledger.withColumn("rows_in", F.col("rows_in") + 1)).first().passed is False


def test_duplicates_and_self_pairs_are_rejected_by_reason(spark):
    players = spark.createDataFrame([(1, 11, True), (2, 12, True)], "player_nk int, player_sk long, is_current boolean")
    pairs = spark.createDataFrame([(1, 2, 5, 1.0, 1), (1, 2, 5, 1.0, 1), (1, 2, 9, 1.0, 1), (1, 1, 5, 1.0, 1), (2, 7, 5, 1.0, 1), (7, 2, 5, 1.0, 1), (None, None, 1, 1.0, 1)],
                                  "player_id int, teammate_player_id int, minutes_played_with int, ppg_played_with double, joint_goal_participation int")
    split = FX.split_teammate_relationship(pairs, players, run_ts=RUNS[0])
    got = sorted((r.reject_reason or "", r.minutes_played_together, r.n_rows) for r in split.collect())
    assert got == [("", 9, 1), ("duplicate", 5, 2), ("self_pair", 1, 1), ("self_pair", 5, 1), ("unknown_player", 5, 1), ("unknown_teammate", 5, 1)]
    line = row_ledger({"f": split}, {"f": [pairs]}).where("reason = 'accepted'").first()
    assert (line.rows_in, line.rows_out, line.rows_rejected) == (7, 1, 6)
    nothing = row_ledger({"f": split.where("false")}, {"f": [pairs.where("false")]}).collect()
    assert [(r.reason, r.n_rows, r.rows_in) for r in nothing] == [("accepted", 0, 0)]


def test_no_global_sort_in_the_facts_plan(spark):
    st = staging(spark, FIRST, [(1, "GK"), (2, "DF")])
    d = {n: spark.createDataFrame(df.collect(), df.schema) for n, df in W.build_dimensions(spark, st, RUNS[0]).items()}
    plan = W.split_fact("fact_player_performance", st, d, run_ts=RUNS[0])._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and "Window" not in plan


def test_refreshed_summary_equals_a_rebuild_on_three_batches(spark):
    import random

    rng = random.Random(4)
    perf = [(rng.randint(1, 6), rng.choice([1, 2, None]), rng.randint(0, 4), rng.choice([1, None]), 90, 0, rng.choice([0, None]), 0) for _ in range(90)]
    inj = [(rng.randint(1, 7), rng.choice([1, 2]), float(rng.randint(1, 30)), rng.choice([1, None])) for _ in range(40)]
    val = [(rng.randint(1, 6), rng.choice([1, 2]), rng.randint(1, 99), k) for k in range(40)]
    p = spark.createDataFrame(perf, "player_sk long, season_sk long, goals int, assists int, minutes_played int, yellow_cards int, second_yellow_cards int, direct_red_cards int")
    p = p.withColumn("goals", F.col("goals").cast("decimal(10,2)"))
    i = spark.createDataFrame(inj, "player_sk long, season_sk long, days_missed double, games_missed int")
    v = spark.createDataFrame(val, "player_sk long, season_sk long, market_value int, value_order long").withColumn("market_value", F.col("market_value").cast("decimal(15,2)"))
    part = lambda df, n: df.withColumn("n", F.pmod(F.xxhash64(*df.columns), F.lit(3))).where(F.col("n") <= n)
    drop = lambda df: sorted(map(tuple, df.drop("load_datetime").collect()), key=repr)
    stored = season_summary(part(p, 0), part(i, 0), part(v, 0), RUNS[0])
    for n in (1, 2):
        new = [part(df, n).where(F.col("n") == n).select("player_sk", "season_sk") for df in (p, i, v)]
        touched = new[0].unionByName(new[1]).unionByName(new[2])
        stored = refresh_summary(stored, touched, part(p, n), part(i, n), part(v, n), RUNS[n])
        assert drop(stored) == drop(season_summary(part(p, n), part(i, n), part(v, n), RUNS[n]))


def test_seasons_have_a_file_each(spark, tmp_dir):
    """Eight tasks times twenty seasons give at most twenty files here, more only where a season's bytes ask for them."""
    df = spark.range(20_000).repartition(8).select("id", F.concat(F.lit("s"), F.col("id") % 20).alias("season_name"))
    sinks.write_table(df, f"{tmp_dir}/fact", partition_by=["season_name"])
    files = glob.glob(f"{tmp_dir}/fact/*/*.parquet")
    assert len(files) <= 20 and spark.read.parquet(f"{tmp_dir}/fact").count() == 20_000
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        one = spark.range(200_000).repartition(8).select("id", F.lit("s").alias("season_name"))
        sinks.write_table(one, f"{tmp_dir}/one", partition_by=["season_name"])
        assert len(glob.glob(f"{tmp_dir}/one/*/*.parquet")) > 1  # a large season is split
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_labels(spark):
    checks = spark.createDataFrame([("a", "total_rows", 3), ("a", "null_x", 1), ("a", "null_y", 0), ("s", "current_season_count_not_1", 1), ("f", "dropped_no_date", 2)],
                                   "table_name string, check_name string, failures long")
    assert [r.status for r in labelled(checks).collect()] == ["INFO", "ERROR", "OK", "WARNING", "INFO"]


def test_landing_rows_are_not_dealt_out(spark, tmp_path):
    """A landed split is written by the tasks that made it: no shuffle by accepted or rejected before its table is written."""
    root = str(tmp_path / "wh")
    W.load_warehouse(spark, staging(spark, FIRST, [(1, "GK")]), root, RUNS[0])
    landed = os.path.join(root, "_landing", "fact_player_performance")
    assert os.listdir(landed) and not [d for v in os.listdir(landed) for d in os.listdir(os.path.join(landed, v)) if "=" in d]
    rejected = W.open_log(spark, root, "rejected").groupBy("table_name").agg(F.sum("n_rows").alias("n")).collect()
    lines = {r.table_name: r.rows_rejected for r in W.open_log(spark, root, "ledger").collect() if r.rows_rejected}
    assert {r.table_name: r.n for r in rejected} == {t: n for t, n in lines.items() if t != "fact_player_season_summary"}
