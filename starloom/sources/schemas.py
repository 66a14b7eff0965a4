"""Declared schemas of the staging inputs (§1.4) and the source catalogue.

Fixed values: the column names, types and date columns of the 11 staging
sources, and the file each is read from.  They must equal the source data
for a switching user's files to load.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql.types import StructType

# --- fixed values: staging tables (name → Spark DDL, date columns, file) ----
STAGING_DDL = {
    "player_profiles": (
        "player_id INT, player_slug STRING, player_name STRING, player_image_url STRING, "
        "name_in_home_country STRING, date_of_birth DATE, place_of_birth STRING, country_of_birth STRING, "
        "height DECIMAL(5,2), citizenship STRING, is_eu BOOLEAN, position STRING, main_position STRING, "
        "foot STRING, current_club_id INT, current_club_name STRING, joined DATE, contract_expires DATE, "
        "outfitter STRING, social_media_url STRING, player_agent_id INT, player_agent_name STRING, "
        "contract_option STRING, date_of_last_contract_extension DATE, on_loan_from_club_id INT, "
        "on_loan_from_club_name STRING, contract_there_expires DATE, second_club_url STRING, "
        "second_club_name STRING, third_club_url STRING, third_club_name STRING, fourth_club_url STRING, "
        "fourth_club_name STRING, date_of_death DATE"
    ),
    "player_injuries": (
        "player_id INT, season_name STRING, injury_reason STRING, from_date DATE, end_date DATE, "
        "days_missed DECIMAL(10,2), games_missed INT"
    ),
    "player_market_value": "player_id INT, date_unix DATE, value DECIMAL(15,2)",
    "player_latest_market_value": "player_id INT, date_unix DATE, value DECIMAL(15,2)",
    "player_national_performances": (
        "player_id INT, team_id STRING, team_name STRING, first_game_date DATE, matches INT, goals INT"
    ),
    "player_performances": (
        "player_id INT, season_name STRING, competition_id STRING, competition_name STRING, team_id INT, "
        "team_name STRING, nb_in_group INT, nb_on_pitch INT, goals DECIMAL(10,2), assists INT, own_goals INT, "
        "subed_in INT, subed_out INT, yellow_cards INT, second_yellow_cards INT, direct_red_cards INT, "
        "penalty_goals INT, minutes_played INT, goals_conceded INT, clean_sheets INT"
    ),
    "player_teammates_played_with": (
        "player_id INT, teammate_player_id INT, teammate_player_name STRING, ppg_played_with DECIMAL(10,2), "
        "joint_goal_participation INT, minutes_played_with INT"
    ),
    "team_details": (
        "club_id INT, club_slug STRING, club_name STRING, logo_url STRING, country_name STRING, season_id INT, "
        "competition_id STRING, competition_slug STRING, competition_name STRING, club_division STRING, "
        "source_url STRING, _last_modified_at TIMESTAMP"
    ),
    "team_children": (
        "parent_team_id INT, parent_team_name STRING, child_team_id INT, child_team_name STRING, "
        "_last_modified_at TIMESTAMP"
    ),
    "team_competitions_seasons": (
        "club_id INT, team_name STRING, season_id INT, competition_name STRING, competition_id STRING, "
        "club_division STRING, _last_modified_at TIMESTAMP"
    ),
    "transfer_history": (
        "player_id INT, season_name STRING, transfer_date DATE, from_team_id INT, from_team_name STRING, "
        "to_team_id INT, to_team_name STRING, transfer_type STRING, value_at_transfer DECIMAL(15,2), "
        "transfer_fee DECIMAL(15,2)"
    ),
}

DATE_COLUMNS = {
    "player_profiles": ("date_of_birth", "joined", "contract_expires", "date_of_last_contract_extension",
                        "contract_there_expires", "date_of_death"),
    "player_injuries": ("from_date", "end_date"),
    "player_market_value": ("date_unix",),
    "player_latest_market_value": ("date_unix",),
    "player_national_performances": ("first_game_date",),
    "player_performances": (),
    "player_teammates_played_with": (),
    "team_details": (),
    "team_children": (),
    "team_competitions_seasons": (),
    "transfer_history": ("transfer_date",),
}

# Parent-first load order.
LOAD_ORDER = (
    "player_profiles", "team_details", "team_children", "team_competitions_seasons", "player_injuries",
    "player_market_value", "player_latest_market_value", "player_national_performances",
    "player_performances", "player_teammates_played_with", "transfer_history",
)


@dataclass(frozen=True)
class Source:
    """One catalogue entry; ``multi_line`` None lets the reader find out."""

    name: str
    file: str
    schema: StructType
    date_columns: tuple[str, ...]
    multi_line: bool | None = None


def columns(name: str) -> list[tuple[str, str]]:
    """(column, type) of a staging table, without a session."""
    return re.findall(r"(\w+) ([A-Z]+(?:\(\d+,\d+\))?)", STAGING_DDL[name])


def catalogue() -> dict[str, Source]:
    return {
        name: Source(name, f"{name}.csv", StructType.fromDDL(ddl), tuple(DATE_COLUMNS[name]))
        for name, ddl in STAGING_DDL.items()
    }
