"""Dimension builders (B1–B7, B10, B11) over the staging tables.

Each builder returns the full new dimension; pass ``existing`` to merge into a
previous version (keys of known members are kept, new members are numbered
after them).  Column names follow the warehouse DDL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from .keys import sequence_keys
from .merge import insert_if_absent, pick_one, seed, upsert

# The columns of the calendar, as the warehouse's DDL names them.
DIM_DATE_COLUMNS = (
    "date_sk", "date_value", "year", "quarter", "month", "month_name", "day",
    "day_of_week", "day_name", "week_of_year", "is_weekend", "is_holiday", "season_name",
)


# --- B1 / B2 / G7 / G1 -------------------------------------------------------

def _calendar_rows(days: DataFrame, col: str = "d") -> DataFrame:
    return days.select(*X.calendar_columns(F.col(col)), F.lit(False).alias("is_holiday")).select(*DIM_DATE_COLUMNS)


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """B1: one row per day in [start, end]; ``date_sk`` = yyyyMMdd (T4).

    Days come from ``spark.range`` so generation is spread over tasks.
    """
    import datetime as _dt

    n = (_dt.date.fromisoformat(str(end)[:10]) - _dt.date.fromisoformat(str(start)[:10])).days
    days = spark.range(0, n + 1).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("d"))
    return _calendar_rows(days)


def calendar_covering(dates: DataFrame, col: str) -> DataFrame:
    """B1 over the whole years spanned by a date column of the data.

    Bounds are one aggregate row; the days come from ``sequence`` on it, so
    the size of the calendar is bounded by the date span, not by the data.
    """
    b = dates.agg(F.min(F.col(col).cast("date")).alias("lo"), F.max(F.col(col).cast("date")).alias("hi"))
    days = b.select(F.explode(F.sequence(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)),
    )).alias("d"))
    return _calendar_rows(days)


def extend_calendar(cal: DataFrame, dates: DataFrame, col: str) -> DataFrame:
    """B2/G1: add calendar rows for dates the facts use but the calendar lacks.

    NULL dates never become members.  ``date_sk`` is derived from the date,
    so no key state is needed (T4).
    """
    missing = (
        dates.select(F.col(col).cast("date").alias("d")).where(F.col("d").isNotNull()).distinct()
        .join(cal.select(F.col("date_value").alias("d")), "d", "left_anti")
    )
    return cal.unionByName(_calendar_rows(missing))


def _real(existing: DataFrame, batch: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """A member that was inferred from a fact is no longer so once its own row arrives."""
    if "is_inferred" not in existing.columns:
        return batch, cols
    return batch.withColumn("is_inferred", F.lit(False)), [*cols, "is_inferred"]


# --- B3 ------------------------------------------------------------------------

def dim_agent(profiles: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct (agent id, name) with an id; upsert on agent_id."""
    batch = pick_one(
        profiles.where(F.col("player_agent_id").isNotNull())
        .select(F.col("player_agent_id").cast("int").alias("agent_id"), F.col("player_agent_name").alias("agent_name")),
        ["agent_id"], ["agent_name"],
    ).withColumn("is_active", F.lit(True))
    if existing is None:
        return sequence_keys(batch, ["agent_id"], "agent_sk").select("agent_sk", "agent_id", "agent_name", "is_active")
    return upsert(existing, batch, "agent_id", "agent_sk", ["agent_name"])


# --- B4 ------------------------------------------------------------------------

def dim_team(team_details: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """B4 (SCD1): string key, 'Unknown' defaults, tier from the division text.

    ``team_details`` is keyed by club *and* season; one row per club is picked
    by latest season, then latest modification, then name (T5).
    """
    rows = team_details.where(F.col("club_id").isNotNull()).select(
        F.col("club_id").cast("string").alias("team_nk"),
        F.col("club_name").alias("team_name"),
        F.col("club_slug").alias("team_slug"),
        X.or_unknown("country_name").alias("country_name"),
        F.lit("club").alias("team_type"),
        F.col("logo_url"),
        X.or_unknown("competition_name").alias("primary_competition_id"),
        X.first_digits_or("club_division").cast("string").alias("division_level"),
        F.col("season_id").alias("__season"),
        F.col("_last_modified_at").alias("__mod"),
    )
    batch = pick_one(rows, ["team_nk"], [("__season", "desc", "last"), ("__mod", "desc", "last"), "team_name"])
    batch = batch.drop("__season", "__mod").withColumn("is_active", F.lit(True))
    cols = ["team_sk", "team_nk", "team_name", "team_slug", "country_name", "team_type", "logo_url",
            "primary_competition_id", "division_level", "is_active"]
    if existing is None:
        return sequence_keys(batch, ["team_nk"], "team_sk").select(*cols)
    batch, update = _real(existing, batch, ["team_name", "country_name", "primary_competition_id", "division_level"])
    return upsert(existing, batch, "team_nk", "team_sk", update)


# --- B5 ------------------------------------------------------------------------

def dim_competition(team_details: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Slug key from the competition name, tier from the division text.

    Several (country, tier) rows per slug: the lowest tier, then country, then
    name wins (T5, our order).
    """
    rows = team_details.where(F.col("competition_name").isNotNull()).select(
        X.slug("competition_name").alias("competition_id"),
        F.col("competition_name"),
        X.slug("competition_name").alias("competition_slug"),
        F.lit("league").alias("competition_type"),
        F.col("country_name"),
        X.first_digits_or("club_division").alias("tier_level"),
    ).distinct()
    batch = pick_one(rows, ["competition_id"], ["tier_level", ("country_name", "asc", "last"), "competition_name"])
    cols = ["competition_sk", "competition_id", "competition_name", "competition_slug", "competition_type",
            "country_name", "tier_level"]
    if existing is None:
        return sequence_keys(batch, ["competition_id"], "competition_sk").select(*cols)
    batch, update = _real(existing, batch, ["competition_name", "country_name", "tier_level"])
    return upsert(existing, batch, "competition_id", "competition_sk", update)


# --- B6 ------------------------------------------------------------------------

def season_rows(names: DataFrame, col: str = "season_name") -> DataFrame:
    """B6 core: distinct parsed season names with the current flag.

    Current = the latest start year (T1: not the reference's text order).
    Seasons that do not parse keep NULL years and are never current.
    """
    s = names.select(F.col(col).alias("season_name")).where(F.col("season_name").isNotNull()).distinct()
    s = s.select("season_name", X.season_years("season_name").alias("__y")).select(
        "season_name",
        F.col("__y.start_year").alias("season_start_year"),
        F.col("__y.end_year").alias("season_end_year"),
    )
    latest = F.max("season_start_year").over(Window.partitionBy())  # bounded: one row per season
    return s.withColumn("is_current_season", F.coalesce(F.col("season_start_year") == latest, F.lit(False)))


def dim_season(names: DataFrame, col: str = "season_name", existing: DataFrame | None = None) -> DataFrame:
    """Season dimension keyed by name, numbered by start year then name."""
    rows = season_rows(names, col)
    cols = ["season_sk", "season_name", "season_start_year", "season_end_year", "is_current_season"]
    if existing is None:
        # bounded: one row per season name
        return sequence_keys(rows, [("season_start_year", "asc", "last"), "season_name"], "season_sk",
                             bounded=True).select(*cols)
    rows, update = _real(existing, rows, ["season_start_year", "season_end_year", "is_current_season"])
    out = upsert(existing, rows, "season_name", "season_sk", update)
    # the current flag is relative to all seasons, old ones included
    latest = F.max("season_start_year").over(Window.partitionBy())
    return out.withColumn("is_current_season", F.coalesce(F.col("season_start_year") == latest, F.lit(False)))


# --- B7 ------------------------------------------------------------------------

def category_rows(texts: DataFrame, col: str, rules=X.INJURY_RULES, default=X.INJURY_DEFAULT) -> DataFrame:
    """B7 core: categorise distinct texts, keep distinct (category, severity)."""
    t = texts.select(F.col(col)).where(F.col(col).isNotNull()).distinct()
    c = t.select(X.categorize(col, rules, default).alias("__c"))
    return c.select(F.col("__c.category").alias("injury_category"), F.col("__c.severity").alias("injury_severity")).distinct()


def dim_injury_type(injuries: DataFrame, existing: DataFrame | None = None, rules=X.INJURY_RULES,
                    default=X.INJURY_DEFAULT) -> DataFrame:
    """Insert the categories not yet present (insert-if-absent)."""
    rows = category_rows(injuries, "injury_reason", rules, default).withColumn(
        "typical_recovery_days", F.lit(None).cast("int"))
    keys = ["injury_category", "injury_severity"]
    if existing is None:
        # bounded: at most one row per rule outcome
        return sequence_keys(rows, keys, "injury_type_sk", bounded=True).select(
            "injury_type_sk", *keys, "typical_recovery_days")
    return insert_if_absent(existing, rows, keys, "injury_type_sk", bounded=True)


# --- B10 -----------------------------------------------------------------------

def dim_transfer_type(spark: SparkSession) -> DataFrame:
    """The six seeded transfer types, keys 1..6 in seed order."""
    rows = [(i + 1, *r) for i, r in enumerate(X.TRANSFER_TYPES)]
    return seed(spark, rows, "transfer_type_sk INT, transfer_type_code STRING, transfer_type_name STRING, "
                             "is_free_transfer BOOLEAN, is_loan BOOLEAN")


# --- B11 -----------------------------------------------------------------------

# The columns of the current-player view.
PLAYER_CURRENT_COLUMNS = (
    "player_sk", "player_nk", "player_name", "date_of_birth", "country_of_birth", "position", "main_position",
    "current_club_nk", "current_club_name", "contract_expires", "agent_sk",
)


def player_current(dim_player: DataFrame, columns: Sequence[str] = PLAYER_CURRENT_COLUMNS) -> DataFrame:
    """``v_dim_player_current``."""
    have = set(dim_player.columns)
    return dim_player.filter(F.col("is_current")).select(*[c for c in columns if c in have])

