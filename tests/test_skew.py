"""One member holds a third of all rows: the order-dependent operators must
give the window result without putting that member into one task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import facts
from starloom.operators.keys import frequent_keys, has_few_members, lookup_sk, sequence_keys
from starloom.operators.merge import pick_one
from starloom.operators.quality import orphan_check
from starloom.operators.windows import next_in_group, previous_in_group


def _skewed(spark, n=30_000):
    # member 0 holds every third row; the rest spread over 500 members
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("member"),
        F.col("id").alias("seq"), (F.col("id") * 7 % 101).alias("v"))


def test_previous_and_next_match_window_under_skew(spark):
    df = _skewed(spark)
    w = Window.partitionBy("member").orderBy("seq")
    want = {r.seq: (r.p, r.n) for r in df.select("seq", F.lag("v").over(w).alias("p"),
                                                 F.lead("v").over(w).alias("n")).collect()}
    span = F.floor(F.col("seq") / 1000)
    got = previous_in_group(df, ["member"], ["seq"], ["v"], span, prefix="p_")
    got = next_in_group(got, ["member"], ["seq"], ["v"], span, prefix="n_")
    assert {r.seq: (r.p_v, r.n_v) for r in got.collect()} == want


def test_neighbours_with_null_values_groups_and_spans(spark):
    rows = [(g, s, None if (g or 0) + s == 3 else s * 10) for g in (1, None) for s in range(6)]
    df = spark.createDataFrame(rows, "g int, seq int, v int")
    for span in (F.floor(F.col("seq") / 2), F.lit(0), F.when(F.col("seq") > 2, F.col("seq")), F.col("seq")):
        got = {(r.g, r.seq): (r.p_v, r.n_v) for r in next_in_group(
            previous_in_group(df, ["g"], ["seq"], ["v"], span, "p_"), ["g"], ["seq"], ["v"], span, "n_").collect()}
        at = {(g, s): v for g, s, v in rows}
        assert got == {(g, s): (at.get((g, s - 1)), at.get((g, s + 1))) for g, s, _ in rows}
    assert previous_in_group(df.where("false"), ["g"], ["seq"], ["v"], F.lit(0)).count() == 0


def _sizes(df):
    """Rows per partition of the shuffle by which ``df`` was joined."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_lookup_spreads_null_and_frequent_keys(spark):
    """Half of the keys are NULL and a third one team: no task gets above twice the median."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        key = F.when(F.col("id") % 2 == 0, None).when(F.col("id") % 3 < 2, F.lit(7)).otherwise(F.col("id") % 997)
        fact = spark.range(60_000).select(F.col("id").alias("row"), key.cast("int").alias("team"))
        dim = spark.range(0, 900).select(F.col("id").cast("string").alias("nk"), (F.col("id") + 5000).alias("sk"))
        hot = frequent_keys(fact, F.col("team").cast("string"), fraction=0.05)
        got = lookup_sk(fact, dim, "team", "nk", "sk", cast_to="string", hot=hot)
        sizes = sorted(_sizes(got))
        assert sum(sizes) == 60_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        plain = lookup_sk(fact, dim, "team", "nk", "sk", cast_to="string")
        assert max(_sizes(plain)) > 0.4 * 60_000
        assert sorted(got.collect()) == sorted(plain.collect())
        inner = lookup_sk(fact, dim, "team", "nk", "sk", cast_to="string", how="inner", hot=hot)
        assert inner.count() == lookup_sk(fact, dim, "team", "nk", "sk", cast_to="string", how="inner").count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_member_is_spread_over_tasks(spark):
    df = _skewed(spark)
    # the range partitioning behind sequence_keys
    sizes = [r["count"] for r in df.repartitionByRange(8, "member", "seq")
             .groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 0.25 * sum(sizes)  # the hot third is split, not one task
    keyed = sequence_keys(df, ["member", "seq"], "k", num_partitions=8)
    assert keyed.agg(F.min("k"), F.max("k"), F.count_distinct("k")).first() == (1, 30_000, 30_000)


def test_aggregate_paths_under_skew(spark):
    df = _skewed(spark)
    last = {r.member: r.seq for r in pick_one(df, ["member"], [("seq", "desc", "last")]).collect()}
    assert last[0] == 29_997 and len(last) == 501
    dim = spark.range(1, 501).select(F.col("id").alias("member"))
    assert orphan_check(df, "member", dim, "member", "t").first().failures == 10_000


def test_small_dimension_moves_no_fact_row(spark):
    """A lookup in a dimension of few members shuffles no fact row, above the automatic broadcast size too."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(1000).select(F.col("id").alias("row"), (F.col("id") % 50).alias("team"))
        dim = spark.range(40).select(F.col("id").alias("nk"), (F.col("id") + 100).alias("sk"))
        assert has_few_members(dim)
        got = lookup_sk(fact, dim, "team", "nk", "sk", few=True)
        assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(got.collect()) == sorted(lookup_sk(fact, dim, "team", "nk", "sk").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_frequent_grain_is_dealt_by_content(spark, monkeypatch):
    """One pair holds a third of the rows: the same winner and duplicates as when it is one window, in many tasks."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 90 + 1).cast("int").alias("player_id"),
        F.when(F.col("id") % 3 == 0, 2).otherwise(F.col("id") % 97 + 1).cast("int").alias("teammate_player_id"),
        F.lit("x").alias("teammate_player_name"), (F.col("id") % 11).cast("decimal(10,2)").alias("ppg_played_with"),
        (F.col("id") % 700).cast("int").alias("joint_goal_participation"), (F.col("id") % 5).cast("int").alias("minutes_played_with"))
    players = spark.range(1, 80).select(F.col("id").cast("int").alias("player_nk"), (F.col("id") * 10).alias("player_sk"),
                                        F.lit(True).alias("is_current"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = facts.split_teammate_relationship(rows, players, run_ts="2024-01-01", spread=False)
        monkeypatch.setattr(facts, "HOT_GRAIN", 5)
        spread = facts.split_teammate_relationship(rows, players, run_ts="2024-01-01", spread=True)
        assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
        pair = "source_record_id = '1|2'"
        assert max(_sizes(plain.where(pair))) == plain.where(pair).count() > 1500
        assert max(_sizes(spread.where(pair))) < 0.5 * spread.where(pair).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_rows_of_a_fact_are_made_once(spark):
    """The rows that compete for a grain are read once, not once more to find the winners."""
    pairs = spark.createDataFrame([(1, 2, "x", 1, 1, 90)] * 2, "player_id int, teammate_player_id int, teammate_player_name string, "
                                  "ppg_played_with int, joint_goal_participation int, minutes_played_with int")
    players = spark.createDataFrame([(1, 10, True), (2, 20, True)], "player_nk int, player_sk long, is_current boolean")
    split = facts.split_teammate_relationship(pairs, players, run_ts="2024-01-01")
    assert split._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    assert sorted((r.reject_reason or "", r.n_rows) for r in split.collect()) == [("", 1), ("duplicate", 1)]
