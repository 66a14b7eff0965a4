import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from starloom.plans import warehouse as W


def _plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_bucketed_star_join_has_no_exchange(spark):
    dim = spark.range(1, 2001).select(F.col("id").alias("player_sk"), F.concat(F.lit("p"), F.col("id")).alias("name"),
                                      F.lit(True).alias("is_current"))
    fact = spark.range(0, 20000).select((F.col("id") % 2000 + 1).alias("player_sk"), (F.col("id") % 7).alias("goals"))
    tables = W.save_to_catalog(spark, {"dim_player": dim, "fact_player_season_summary": fact, "dim_season":
                                       spark.range(3).withColumnRenamed("id", "season_sk")}, "starloom_test", 8)
    assert set(tables) == {"dim_player", "fact_player_season_summary", "dim_season"}
    wh = W.open_catalog_warehouse(spark, "starloom_test")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force a sort-merge join
    try:
        j = wh["fact_player_season_summary"].join(wh["dim_player"], "player_sk").groupBy("name").agg(F.sum("goals"))
        plan = _plan(j)
        join_part = plan.split("SortMergeJoin", 1)[1]
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning(player_sk" not in join_part
        assert j.agg(F.sum("sum(goals)")).first()[0] == fact.agg(F.sum("goals")).first()[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
