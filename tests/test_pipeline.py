"""The warehouse build end to end on the football fixture, with the
invariants of SURVEY §5: no orphans, one current version per key, Σ summary =
Σ facts, a second run with the same data changes no dimension."""

import os

import pytest
from pyspark.sql import functions as F

from starloom.plans import analytics as N
from starloom.plans import warehouse as W

from football_fixture import write_fixture

RUN_1 = "2025-03-01 00:00:00"
RUN_2 = "2025-04-01 00:00:00"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("wh"))
    src = write_fixture(os.path.join(base, "src"), skip=("team_competitions_seasons",))
    root = os.path.join(base, "dw")
    status, counts, checks, passed, audit = W.run_pipeline(spark, src, root, RUN_1)
    wh = W.open_warehouse(spark, root)
    return dict(base=base, src=src, root=root, status=status, counts=counts, checks=checks, passed=passed, wh=wh,
                audit=audit)


def test_first_run_audit(built):
    audit = {r.table_name: (r.n_before, r.n_after) for r in built["audit"].collect()}
    assert len(audit) == 15 and audit["dim_player"] == (0, 5) and audit["dim_transfer_type"] == (0, 6)


def test_staging_status(built):
    st = {r.table_name: (r.status, r.n_rows) for r in built["status"].collect()}
    assert st["team_competitions_seasons"] == ("missing", None)  # missing file: recorded, run goes on
    assert st["player_profiles"] == ("loaded", 6)
    assert sum(1 for s, _ in st.values() if s == "loaded") == 10


def test_staging_cleaning(spark, built):
    prof = W.read_staging(spark, os.path.join(built["root"], "_staging"))["player_profiles"]
    r = {x.player_id: x for x in prof.collect()}
    assert r[3].position is None              # 'nan' -> NULL
    assert r[6].player_agent_id is None        # '' -> NULL
    assert r[6].contract_expires is None       # 'not a date' -> NULL
    assert str(r[1].contract_expires) == "2026-06-30"


def test_dimensions(built):
    wh = built["wh"]
    assert {(r.agent_id, r.agent_name) for r in wh["dim_agent"].collect()} == {(100, "Agent A"), (200, "Agent B")}
    teams = {r.team_nk: r for r in wh["dim_team"].collect()}
    assert set(teams) == {"10", "20", "40", "50"}
    assert teams["10"].team_name == "FC Alpha New"            # latest season wins (T5)
    assert teams["20"].country_name == "Unknown" and teams["20"].division_level == "2"
    assert teams["50"].primary_competition_id == "Unknown" and teams["50"].division_level == "99"
    comps = {r.competition_id: r for r in wh["dim_competition"].collect()}
    assert set(comps) == {"la_liga", "premier_league"}
    assert comps["premier_league"].tier_level == 2            # lowest tier of the duplicates
    seasons = {r.season_name: r for r in wh["dim_season"].collect()}
    assert (seasons["99/00"].season_start_year, seasons["99/00"].season_end_year) == (1999, 2000)
    assert seasons["abc"].season_start_year is None and not seasons["abc"].is_current_season
    assert seasons["24/25"].is_current_season and seasons["2024"].is_current_season
    cats = {(r.injury_category, r.injury_severity) for r in wh["dim_injury_type"].collect()}
    assert cats == {("Muscular", "Medium"), ("Bone/Ligament", "High"), ("Joint", "Medium"), ("Other", "Low")}
    assert wh["dim_transfer_type"].count() == 6
    players = {r.player_nk: r for r in wh["dim_player"].collect()}
    assert set(players) == {1, 2, 3, 5, 6}                     # NULL name dropped
    assert players[3].agent_sk is None and players[6].agent_sk is None
    assert wh["dim_date"].where("date_value = DATE '2021-01-01'").count() == 1   # B2 extension


def test_facts(built):
    wh = built["wh"]
    perf = wh["fact_player_performance"]
    assert perf.count() == 7                                   # unknown player 99 dropped (T8)
    r = {(x.season_name, x.competition_name, x.nb_on_pitch): x for x in perf.collect()}
    assert r[("99/00", "La Liga", 0)].goals_per_match is None   # 0 matches
    assert r[("24/25", "La Liga", 2)].team_sk is None           # team 99 unknown: left join
    assert r[("99/00", "La Liga", 0)].cards_total is None       # NULL card propagates
    mv = wh["fact_market_value"]
    assert mv.where("date_sk = 20250101").count() == 2           # same date, both sources
    first = mv.where("date_sk = 20240701 AND value_source = 'historical' AND previous_value IS NOT NULL").collect()
    assert first and first[0].value_change_pct is None         # previous value 0
    tr = {x.transfer_type_text: x for x in wh["fact_transfer"].collect()}
    codes = {r.transfer_type_sk: r.transfer_type_code for r in wh["dim_transfer_type"].collect()}
    assert codes[tr["Loan"].transfer_type_sk] == "LOAN"
    assert codes[tr["free transfer"].transfer_type_sk] == "FREE"
    assert codes[tr["End of loan"].transfer_type_sk] == "END_LOAN"
    assert codes[tr[None].transfer_type_sk] == "UNKNOWN"
    assert tr["free transfer"].fee_to_value_ratio is None and tr["free transfer"].from_team_sk is None
    inj = wh["fact_injury"].collect()
    assert len(inj) == 6
    by_days = {x.days_missed: x for x in inj if x.days_missed is not None}
    assert by_days[120].severity_score == 4 and by_days[120].avg_days_per_game is None
    nat = wh["fact_national_performance"].collect()
    assert len(nat) == 3 and {x.total_matches for x in nat} == {0, 100, 70}   # most matches wins
    mates = wh["fact_teammate_relationship"].collect()
    assert len(mates) == 2                                      # self pair dropped, duplicate pair picked
    assert max(x.minutes_played_together for x in mates) == 1800


def test_summary_and_invariants(built):
    wh = built["wh"]
    perf = wh["fact_player_performance"].where("season_sk IS NOT NULL")
    ps = wh["fact_player_season_summary"]
    assert ps.agg(F.sum("total_goals")).first()[0] == perf.agg(F.sum("goals")).first()[0]
    assert ps.agg(F.sum("total_matches")).first()[0] == perf.count()
    s = {(x.player_sk, x.season_sk): x for x in ps.collect()}
    p1 = wh["dim_player"].where("player_nk = 1").first().player_sk
    cur = wh["dim_season"].where("season_name = '24/25'").first().season_sk
    row = s[(p1, cur)]
    assert row.total_injury_days == 164 and row.season_start_value is not None
    checks = {(r.table_name, r.check_name): r.failures for r in built["checks"].collect()}
    assert all(v == 0 for (t, c), v in checks.items() if c.startswith("orphan_") and t.startswith("fact_"))
    assert checks[("dim_player", "duplicate_current_player_nk")] == 0
    assert checks[("dim_player", "overlapping_validity")] == 0
    assert checks[("player_performances", "orphan_player_id")] == 1       # staging FK (player 99)
    assert checks[("player_market_value", "orphan_player_id")] == 1
    assert checks[("dim_player", "null_player_name")] == 0
    assert checks[("player_profiles", "duplicate_player_id")] == 0
    assert checks[("fact_player_performance", "dropped_unknown_player")] == 1     # player 99 (T8)
    assert checks[("fact_injury", "dropped_unknown_player")] == 0
    assert checks[("dim_season", "current_season_count_not_1")] == 1   # '24/25' and '2024' share a start year
    assert checks[("fact_national_performance", "negative_goals")] == 1
    assert checks[("fact_teammate_relationship", "self_pair")] == 0
    assert built["passed"].first().passed is False  # orphans and unknown members in the fixture


def test_analyst_queries(built):
    wh = built["wh"]
    top = N.top_scorers(wh).collect()
    assert top[0].player_name == "Lionel Test" and float(top[0].total_goals) == 25.0
    assert N.value_trend(wh, "%Lionel%").count() == 4
    assert [r.total_injury_days for r in N.injury_impact(wh).collect()] == [164]
    assert N.star_sample(wh).count() >= 1
    assert N.transfer_flows(wh).count() == 4
    assert N.teammate_synergy(wh).count() == 2
    assert N.scorers_by_season_competition(wh).count() >= 3
    assert N.team_comparison(wh).count() >= 3
    assert {r.check_name for r in N.custom_checks(wh).collect()} == {"orphan_player_sk", "duplicate_player_nk"}
    assert all(df.count() >= 1 for df in N.member_samples(wh).values())


def test_second_run_is_idempotent_then_tracks_changes(spark, built):
    root = built["root"]
    before = {r.player_sk: (r.player_nk, r.source_row_hash, r.is_current)
              for r in W.open_warehouse(spark, root)["dim_player"].collect()}
    audit = W.run_pipeline(spark, built["src"], root, RUN_2)[4]
    assert all(r.delta == 0 for r in audit.collect())          # S12: nothing added by a repeated run
    after = {r.player_sk: (r.player_nk, r.source_row_hash, r.is_current)
             for r in W.open_warehouse(spark, root)["dim_player"].collect()}
    assert after == before                                     # same data: nothing changes (T11)
    changed_src = write_fixture(os.path.join(built["base"], "src2"), changed=True)
    W.run_pipeline(spark, changed_src, root, "2025-05-01 00:00:00")
    dim = W.open_warehouse(spark, root)["dim_player"]
    versions = {r.player_nk: r.c for r in dim.groupBy("player_nk").agg(F.count("*").alias("c")).collect()}
    assert versions == {1: 2, 2: 1, 3: 2, 5: 1, 6: 1, 7: 1}
    assert dim.where("is_current").groupBy("player_nk").count().where("count > 1").count() == 0
    old_keys = set(before)
    assert old_keys <= {r.player_sk for r in dim.collect()}    # known keys never change


def test_inferred_members_mode(spark, tmp_path):
    """unknown='member' (J8, G3–G5): unknown keys become 'Unknown' members and
    no fact row is dropped for them."""
    src = write_fixture(str(tmp_path / "src"))
    st = {n: __import__("starloom.sources.readers", fromlist=["read_source"]).read_source(spark, src, n)
          for n in W.LOAD_ORDER}
    wh = W.build_warehouse(spark, st, RUN_1, unknown="member")
    assert wh["fact_player_performance"].count() == 8                      # player 99 kept
    players = {r.player_nk: (r.player_name, r.is_inferred) for r in wh["dim_player"].collect()}
    assert players[99] == ("Unknown", True) and players[1][1] is False
    teams = {r.team_nk: (r.team_name, r.is_inferred) for r in wh["dim_team"].collect()}
    assert teams["99"] == ("Unknown", True) and teams["30"] == ("Unknown", True)
    assert teams["FS"] == ("Unknown", True) and teams["10"][1] is False
    assert wh["fact_player_performance"].where("team_sk IS NULL").count() == 0
    seasons = {r.season_name: r.is_inferred for r in wh["dim_season"].collect()}
    assert seasons == {"24/25": False, "99/00": False, "2024": False, "abc": False}
    assert wh["fact_transfer"].where("to_team_sk IS NULL AND transfer_type_text = 'End of loan'").count() == 1
