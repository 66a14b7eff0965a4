"""Analyst queries over the built star.

Each takes the warehouse as a mapping of table name → DataFrame.  Sorts that
feed a limit state their NULL order and end in a unique tie-break (T12), so
a top-k is the same on every run; Spark plans them as
``TakeOrderedAndProject`` (per-task top-k, then a merge of k rows per task).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.quality import duplicate_check, orphan_check


def top_scorers(wh: Mapping[str, DataFrame], k: int = 10) -> DataFrame:
    """Top scorers by season (season summary ⋈ player ⋈ season)."""
    ps, p, s = wh["fact_player_season_summary"], wh["dim_player"], wh["dim_season"]
    j = ps.where(F.col("total_goals") > 0).join(p.select("player_sk", "player_name"), "player_sk") \
        .join(s.select("season_sk", "season_name"), "season_sk")
    return j.select("player_name", "season_name", "total_goals", "total_assists", "total_matches", "player_sk") \
        .orderBy(F.col("total_goals").desc_nulls_last(), "player_sk", "season_name").limit(k)


def value_trend(wh: Mapping[str, DataFrame], name_pattern: str) -> DataFrame:
    """Market values of players whose name matches a LIKE pattern."""
    mv, p, d = wh["fact_market_value"], wh["dim_player"], wh["dim_date"]
    j = mv.join(p.where(F.col("player_name").like(name_pattern)).select("player_sk", "player_name"), "player_sk") \
        .join(d.select("date_sk", F.col("date_value").alias("full_date")), "date_sk")
    return j.select("player_name", "full_date", "market_value", "value_source").orderBy("full_date", "player_name")


def injury_impact(wh: Mapping[str, DataFrame], min_days: int = 100) -> DataFrame:
    """Seasons with more than ``min_days`` injury days, most first."""
    ps, p, s = wh["fact_player_season_summary"], wh["dim_player"], wh["dim_season"]
    j = ps.where(F.col("total_injury_days") > min_days).join(p.select("player_sk", "player_name"), "player_sk") \
        .join(s.select("season_sk", "season_name"), "season_sk")
    return j.select("player_name", "season_name", "total_injury_days", "total_games_missed", "total_matches") \
        .orderBy(F.col("total_injury_days").desc_nulls_first(), "player_name", "season_name")


def star_sample(wh: Mapping[str, DataFrame], k: int = 5) -> DataFrame:
    """Star join of the performance fact with all its dimensions."""
    f = wh["fact_player_performance"]
    j = (f.where(F.col("goals") > 0)
         .join(wh["dim_player"].select("player_sk", "player_name"), "player_sk")
         .join(wh["dim_team"].select("team_sk", "team_name"), "team_sk")
         .join(wh["dim_season"].select("season_sk", F.col("season_name").alias("season")), "season_sk")
         .join(wh["dim_competition"].select("competition_sk", F.col("competition_name").alias("competition")),
               "competition_sk"))
    return j.select("player_name", "team_name", "season", "competition", "goals", "assists", "performance_sk") \
        .orderBy(F.col("goals").desc(), "performance_sk").limit(k)


def member_samples(wh: Mapping[str, DataFrame], k: int = 5) -> dict[str, DataFrame]:
    """First k current players, teams and seasons by key."""
    return {
        "players": wh["dim_player"].where(F.col("is_current")).orderBy("player_sk").limit(k),
        "teams": wh["dim_team"].orderBy("team_sk").limit(k),
        "seasons": wh["dim_season"].orderBy("season_sk").limit(k),
    }


def transfer_flows(wh: Mapping[str, DataFrame]) -> DataFrame:
    """Transfers and fees from team → team by type (team in two roles)."""
    t, teams, types = wh["fact_transfer"], wh["dim_team"], wh["dim_transfer_type"]
    g = t.groupBy("from_team_sk", "to_team_sk", "transfer_type_sk").agg(
        F.count(F.lit(1)).alias("n_transfers"), F.sum("transfer_fee").alias("total_fee"))
    fr = teams.select(F.col("team_sk").alias("from_team_sk"), F.col("team_name").alias("from_team"))
    to = teams.select(F.col("team_sk").alias("to_team_sk"), F.col("team_name").alias("to_team"))
    return (g.join(fr, "from_team_sk", "left").join(to, "to_team_sk", "left")
            .join(F.broadcast(types.select("transfer_type_sk", "transfer_type_code")), "transfer_type_sk", "left"))


def teammate_synergy(wh: Mapping[str, DataFrame], k: int = 10) -> DataFrame:
    """Pairs with the most shared minutes."""
    f, p = wh["fact_teammate_relationship"], wh["dim_player"]
    a = p.select("player_sk", "player_name")
    b = p.select(F.col("player_sk").alias("teammate_player_sk"), F.col("player_name").alias("teammate_name"))
    return (f.join(a, "player_sk").join(b, "teammate_player_sk")
            .orderBy(F.col("minutes_played_together").desc_nulls_last(), "player_sk", "teammate_player_sk").limit(k))


def scorers_by_season_competition(wh: Mapping[str, DataFrame], k: int = 3) -> DataFrame:
    """Goal totals per player, season and competition, ranked within
    (season, competition); pre-aggregated before the window."""
    f = wh["fact_player_performance"]
    g = f.groupBy("season_sk", "competition_sk", "player_sk").agg(F.sum("goals").alias("goals"))
    w = Window.partitionBy("season_sk", "competition_sk").orderBy(F.col("goals").desc_nulls_last())
    return g.withColumn("rank", F.rank().over(w)).where(F.col("rank") <= k)


def team_comparison(wh: Mapping[str, DataFrame]) -> DataFrame:
    """Totals and averages per team and competition."""
    f = wh["fact_player_performance"]
    return f.groupBy("team_sk", "competition_sk").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("goals").alias("total_goals"),
        F.sum("minutes_played").alias("total_minutes"),
        (F.sum("goals").cast("double") / F.count("goals")).alias("avg_goals"))


def custom_checks(wh: Mapping[str, DataFrame]) -> DataFrame:
    """The manual orphan and duplicate queries."""
    return orphan_check(wh["fact_player_performance"], "player_sk", wh["dim_player"], "player_sk",
                        "fact_player_performance").unionByName(
        duplicate_check(wh["dim_player"], ["player_nk"], "dim_player", where=F.col("is_current")))
