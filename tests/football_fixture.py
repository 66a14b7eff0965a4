"""A tiny set of the 11 staging CSVs with the edge values of FIXTURES §2."""

from __future__ import annotations

import csv
import os

from starloom.sources.schemas import STAGING_DDL


def _cols(table):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(STAGING_DDL[table]).fieldNames()


def _write(path, table, rows):
    cols = _cols(table)
    with open(os.path.join(path, f"{table}.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(cols)
        for r in rows:
            w.writerow(["" if r.get(c) is None else r.get(c) for c in cols])


def write_fixture(path, changed: bool = False, skip=()):
    """Write the CSVs; ``changed`` alters tracked attributes of two players."""
    os.makedirs(path, exist_ok=True)
    profiles = [
        dict(player_id=1, player_name="Lionel Test", position="Attack", current_club_id=10, player_agent_id=100,
             player_agent_name="Agent A", contract_expires="2026-06-30", date_of_birth="1987-06-24", height="1.70"),
        dict(player_id=2, player_name="Kylian Sample", position="Attack", current_club_id=20, player_agent_id=100,
             player_agent_name="Agent A", contract_expires="2029-06-30", date_of_birth="1998-12-20"),
        dict(player_id=3, player_name="Nan Player", position="nan", current_club_id=10, player_agent_id=None,
             contract_expires="2025-07-01"),
        dict(player_id=4, player_name=None, position="Goalkeeper", current_club_id=10),
        dict(player_id=5, player_name="Erling Fixture", position="Attack", current_club_id=30, player_agent_id=200,
             player_agent_name="Agent B", contract_expires="2027-06-30"),
        dict(player_id=6, player_name="Jude Dummy", position="Midfield", current_club_id=20, player_agent_id="",
             contract_expires="not a date"),
    ]
    if changed:
        profiles[0]["current_club_id"] = 20        # tracked attribute changes
        profiles[2]["position"] = "Defender"       # NULL -> value
        profiles.append(dict(player_id=7, player_name="New Kid", position="Attack", current_club_id=10))
    teams = [
        dict(club_id=10, club_name="FC Alpha", country_name="Spain", season_id=2023, competition_name="La Liga",
             club_division="First Tier", _last_modified_at="2024-01-01 00:00:00"),
        dict(club_id=10, club_name="FC Alpha New", country_name="Spain", season_id=2024, competition_name="La Liga",
             club_division="First Tier", _last_modified_at="2024-06-01 00:00:00"),
        dict(club_id=20, club_name="Beta United", country_name=None, season_id=2024,
             competition_name="Premier League", club_division="2. Liga"),
        dict(club_id=40, club_name="Gamma", country_name="Wales", season_id=2024, competition_name="Premier League",
             club_division="Tier 10"),
        dict(club_id=50, club_name="Delta", country_name="Chile", season_id=2024, competition_name=None,
             club_division=None),
    ]
    perfs = [
        dict(player_id=1, season_name="24/25", competition_name="La Liga", team_id=10, nb_on_pitch=30, goals="25",
             assists=10, minutes_played=2500, yellow_cards=2, second_yellow_cards=0, direct_red_cards=1),
        dict(player_id=1, season_name="99/00", competition_name="La Liga", team_id=10, nb_on_pitch=0, goals="0",
             assists=0, minutes_played=0, yellow_cards=0, second_yellow_cards=None, direct_red_cards=1),
        dict(player_id=2, season_name="24/25", competition_name="Premier League", team_id=20, nb_on_pitch=20,
             goals="12", assists=5, minutes_played=1800, yellow_cards=1, second_yellow_cards=1, direct_red_cards=0),
        dict(player_id=2, season_name="24/25", competition_name="La Liga", team_id=99, nb_on_pitch=2, goals=None,
             assists=None, minutes_played=90, yellow_cards=0, second_yellow_cards=0, direct_red_cards=None),
        dict(player_id=3, season_name="2024", competition_name="La Liga", team_id=10, nb_on_pitch=5, goals="1",
             assists=1, minutes_played=400, yellow_cards=0, second_yellow_cards=0, direct_red_cards=0),
        dict(player_id=5, season_name="abc", competition_name="Premier League", team_id=40, nb_on_pitch=3,
             goals="2", assists=0, minutes_played=270, yellow_cards=0, second_yellow_cards=0, direct_red_cards=0),
        dict(player_id=5, season_name=None, competition_name="Premier League", team_id=40, nb_on_pitch=1,
             goals="1", assists=0, minutes_played=90),
        dict(player_id=99, season_name="24/25", competition_name="La Liga", team_id=10, nb_on_pitch=1, goals="1"),
    ]
    injuries = [
        dict(player_id=1, season_name="24/25", injury_reason="Muscle tear", from_date="2024-09-01",
             end_date="2024-10-15", days_missed="44", games_missed=8),
        dict(player_id=1, season_name="24/25", injury_reason="Knee fracture", from_date="2025-01-01",
             end_date="2025-05-01", days_missed="120", games_missed=0),
        dict(player_id=2, season_name="24/25", injury_reason="Ligament rupture", from_date="2024-07-01",
             end_date=None, days_missed=None, games_missed=None),
        dict(player_id=3, season_name="2024", injury_reason="Hip problem", from_date="2024-06-30",
             end_date="2024-07-02", days_missed="2", games_missed=1),
        dict(player_id=5, season_name="abc", injury_reason="Flu", from_date="not a date", end_date="2021-01-01",
             days_missed="3", games_missed=1),
        dict(player_id=6, season_name="24/25", injury_reason=None, from_date="2024-08-01", end_date="2024-08-03",
             days_missed="2", games_missed=0),
    ]
    values = [
        dict(player_id=1, date_unix="2024-06-30", value="0"),
        dict(player_id=1, date_unix="2024-07-01", value="100000000"),
        dict(player_id=1, date_unix="2025-01-01", value="150000000"),
        dict(player_id=2, date_unix="2024-07-01", value="180000000"),
        dict(player_id=99, date_unix="2024-07-01", value="1"),
    ]
    latest = [dict(player_id=1, date_unix="2025-01-01", value="150000000"),
              dict(player_id=2, date_unix="2025-02-01", value="200000000")]
    national = [
        dict(player_id=1, team_id="FS", team_name="Freestate", first_game_date="2005-08-17", matches=0, goals=0),
        dict(player_id=1, team_id="10", team_name="Alpha XI", first_game_date="2006-01-01", matches=100, goals=50),
        dict(player_id=1, team_id="10", team_name="Alpha XI", first_game_date="2007-01-01", matches=80, goals=40),
        dict(player_id=2, team_id="68592", team_name="Other", first_game_date=None, matches=70, goals=-1),
    ]
    mates = [
        dict(player_id=1, teammate_player_id=2, ppg_played_with="2.10", joint_goal_participation=10,
             minutes_played_with=900),
        dict(player_id=2, teammate_player_id=1, ppg_played_with="2.00", joint_goal_participation=9,
             minutes_played_with=900),
        dict(player_id=1, teammate_player_id=1, ppg_played_with="3.00", joint_goal_participation=99,
             minutes_played_with=100),
        dict(player_id=1, teammate_player_id=2, ppg_played_with="1.50", joint_goal_participation=12,
             minutes_played_with=1800),
    ]
    transfers = [
        dict(player_id=1, season_name="24/25", transfer_date="2024-07-01", from_team_id=10, to_team_id=20,
             transfer_type="Loan", value_at_transfer="100", transfer_fee="0"),
        dict(player_id=2, season_name="24/25", transfer_date="2024-08-31", from_team_id=None, to_team_id=20,
             transfer_type="free transfer", value_at_transfer="0", transfer_fee="0"),
        dict(player_id=3, season_name="99/00", transfer_date="1999-07-01", from_team_id=40, to_team_id=10,
             transfer_type=None, value_at_transfer=None, transfer_fee="5"),
        dict(player_id=5, season_name="24/25", transfer_date="2025-01-31", from_team_id=30, to_team_id=None,
             transfer_type="End of loan", value_at_transfer="50", transfer_fee="60"),
    ]
    children = [dict(parent_team_id=10, parent_team_name="FC Alpha", child_team_id=11, child_team_name="Alpha B")]
    comps = [dict(club_id=10, team_name="FC Alpha", season_id=2024, competition_name="La Liga", competition_id="ES1")]
    tables = {
        "player_profiles": profiles, "team_details": teams, "player_performances": perfs,
        "player_injuries": injuries, "player_market_value": values, "player_latest_market_value": latest,
        "player_national_performances": national, "player_teammates_played_with": mates,
        "transfer_history": transfers, "team_children": children, "team_competitions_seasons": comps,
    }
    for name, rows in tables.items():
        if name not in skip:
            _write(path, name, rows)
    return path
