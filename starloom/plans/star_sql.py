"""DuckDB twins of the star queries (the driver's correctness oracle).

Written as plain SQL over the pre-registered views; the fragment builders
below keep each shared rule (season of a date, date key, calendar columns,
season parser, hash, category rules) in one place.  Facts and what is built
on them start from the staging rows (``st_…``), which ``star_staging`` shapes
for both engines; dimensions (``d_…``) and facts (``f_…``) are common table
expressions of their own here.
"""

from __future__ import annotations

from ..functions.exprs import INJURY_DEFAULT, INJURY_RULES
from ..sources.schemas import columns
from . import star_staging as SS
from .star import MEMBER_TRACKED, PART_DEFAULT, PART_RULES, PART_RULES_OLD, RUN_1, RUN_2


def season(d: str) -> str:
    first = f"(CASE WHEN month({d}) >= 7 THEN year({d}) ELSE year({d}) - 1 END)"
    return f"(substr(CAST({first} AS VARCHAR), 3, 2) || '/' || substr(CAST({first} + 1 AS VARCHAR), 3, 2))"


def datekey(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def calendar_cols(d: str) -> str:
    return f"""{datekey(d)} AS date_sk, {d} AS date_value, CAST(year({d}) AS INTEGER) AS year,
      CAST(quarter({d}) AS INTEGER) AS quarter, CAST(month({d}) AS INTEGER) AS month, monthname({d}) AS month_name,
      CAST(day({d}) AS INTEGER) AS day, CAST(dayofweek({d}) AS INTEGER) AS day_of_week, dayname({d}) AS day_name,
      CAST(weekofyear({d}) AS INTEGER) AS week_of_year, dayofweek({d}) IN (0, 6) AS is_weekend,
      FALSE AS is_holiday, {season(d)} AS season_name"""


def days(lo: str, hi: str, src: str = "") -> str:
    return (f"SELECT CAST(unnest(generate_series(CAST({lo} AS TIMESTAMP), CAST({hi} AS TIMESTAMP), "
            f"INTERVAL 1 DAY)) AS DATE) AS d {src}")


def season_start(s: str) -> str:
    y1 = f"TRY_CAST(trim(split_part({s}, '/', 1)) AS INTEGER)"
    y2 = f"TRY_CAST(trim(split_part({s}, '/', 2)) AS INTEGER)"
    return (f"(CASE WHEN contains({s}, '/') THEN (CASE WHEN {y1} IS NOT NULL AND {y2} IS NOT NULL THEN "
            f"(CASE WHEN {y1} >= 50 THEN {y1} + 1900 ELSE {y1} + 2000 END) END) "
            f"ELSE TRY_CAST(trim({s}) AS INTEGER) END)")


def md5_of(cols) -> str:
    return "md5(" + " || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in cols) + ")"


def tier(c: str) -> str:
    return f"COALESCE(TRY_CAST(regexp_extract({c}, '[0-9]+') AS INTEGER), 99)"


def slug(c: str) -> str:
    return f"replace(lower({c}), ' ', '_')"


def rate(a: str, b: str, scale: int = 4, times: int = 1) -> str:
    """a * times / b rounded half away from zero, by whole numbers: exact as a quotient of decimals is."""
    x, y = f"CAST(({a}) * 100 AS HUGEINT) * {times}", f"CAST(({b}) * 100 AS HUGEINT)"
    q = f"((2 * abs({x}) * {10 ** scale} + abs({y})) // (2 * abs({y})))"
    return (f"(CASE WHEN ({b}) <> 0 AND {q} < 10000000000 THEN CAST({q} * sign({x}) * sign({y}) AS DOUBLE) / {10 ** scale} END)")


def content(source: str) -> str:
    """The hash of all columns of a staging row."""
    return content_of([c for c, _ in columns(source)])


def content_of(cols) -> str:
    return "md5(concat_ws(chr(31), " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), chr(30))" for c in cols) + "))"


def record(*cols: str) -> str:
    return "concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in cols) + ")"


def categorize(c: str, rules=PART_RULES, default=PART_DEFAULT) -> tuple[str, str]:
    cat, sev = "CASE", "CASE"
    for words, (k, s) in rules:
        cond = " OR ".join(f"contains(lower({c}), '{w}')" for w in words)
        cat += f" WHEN {cond} THEN '{k}'"
        sev += f" WHEN {cond} THEN '{s}'"
    return cat + f" ELSE '{default[0]}' END", sev + f" ELSE '{default[1]}' END"


def severity(days_: str) -> str:
    return (f"(CASE WHEN {days_} <= 7 THEN 1 WHEN {days_} <= 28 THEN 2 WHEN {days_} <= 90 THEN 3 "
            f"WHEN {days_} <= 180 THEN 4 WHEN {days_} IS NOT NULL THEN 5 END)")


def line_code() -> str:
    return ("(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'LOAN_RETURN' WHEN l_returnflag = 'R' "
            "THEN 'END_LOAN' WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'LOAN' WHEN l_discount = 0 "
            "THEN 'FREE' WHEN l_returnflag IN ('A', 'N') THEN 'PERMANENT' ELSE 'UNKNOWN' END)")


TS1 = f"TIMESTAMP '{RUN_1}'"
TS2 = f"TIMESTAMP '{RUN_2}'"
HASH = md5_of(MEMBER_TRACKED)

# --- shared CTE bodies ---------------------------------------------------------------
MEMBER_BATCH = """SELECT c.c_custkey AS player_nk, c.c_name AS player_name, c.c_mktsegment AS position,
      CAST(c.c_nationkey AS VARCHAR) AS current_club_nk, n.n_name AS nation_name, c.c_acctbal
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""
MEMBER_DIM = f"""SELECT row_number() OVER (ORDER BY player_nk) AS player_sk, player_nk, player_name, position,
      current_club_nk, nation_name, {HASH} AS source_row_hash, {TS1} AS valid_from,
      CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
    FROM ({MEMBER_BATCH}) mb"""
COMP_DIM = f"""SELECT row_number() OVER (ORDER BY competition_id) AS competition_sk, competition_id, competition_name,
      competition_slug, competition_type, country_name, tier_level
    FROM (SELECT *, row_number() OVER (PARTITION BY competition_id
                  ORDER BY tier_level, country_name NULLS LAST, competition_name) AS rn
          FROM (SELECT DISTINCT {slug('p_name')} AS competition_id, p_name AS competition_name,
                  {slug('p_name')} AS competition_slug, 'league' AS competition_type, p_type AS country_name,
                  {tier('p_brand')} AS tier_level
                FROM part WHERE p_name IS NOT NULL) r) x
    WHERE rn = 1"""
SEASON_DIM = f"""SELECT row_number() OVER (ORDER BY season_start_year NULLS LAST, season_name) AS season_sk, season_name,
      season_start_year, season_start_year + 1 AS season_end_year,
      COALESCE(season_start_year = max(season_start_year) OVER (), FALSE) AS is_current_season
    FROM (SELECT season_name, {season_start('season_name')} AS season_start_year
          FROM (SELECT DISTINCT {season('CAST(o_orderdate AS DATE)')} AS season_name FROM orders) s0) s1"""
CAT, SEV = categorize("p_name")
CAT_OLD, SEV_OLD = categorize("p_name", PART_RULES_OLD)
CATEGORY_DIM = f"""SELECT row_number() OVER (ORDER BY category, severity) AS category_sk, category, severity
    FROM (SELECT DISTINCT {CAT} AS category, {SEV} AS severity FROM (SELECT DISTINCT p_name FROM part
          WHERE p_name IS NOT NULL) t) c"""


# --- staging rows, dimensions and facts of the warehouse as common table expressions --------------

_P, _Q = categorize("injury_reason", INJURY_RULES, INJURY_DEFAULT)


def _type_code(c: str) -> str:
    return (f"(CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 'UNKNOWN' WHEN contains(lower({c}), 'end of loan') THEN 'END_LOAN' "
            f"WHEN contains(lower({c}), 'loan return') OR contains(lower({c}), 'return from loan') THEN 'LOAN_RETURN' "
            f"WHEN contains(lower({c}), 'loan') THEN 'LOAN' WHEN contains(lower({c}), 'free') THEN 'FREE' "
            f"WHEN contains(lower({c}), '?') OR contains(lower({c}), '-') OR contains(lower({c}), 'unknown') THEN 'UNKNOWN' "
            f"ELSE 'PERMANENT' END)")


def _copy(source: str, st: str) -> str:
    """Staging rows with their content hash and their number among equal rows."""
    return f"SELECT *, row_number() OVER (PARTITION BY content) AS ordinal FROM (SELECT *, {content(source)} AS content FROM {st}) c0"


PROFILE_HASH = md5_of(["player_name", "position", "current_club_nk", "contract_expires", "agent_sk"])


def player_rows(profiles: str) -> str:
    return f"""SELECT player_id AS player_nk, player_name, position, CAST(current_club_id AS VARCHAR) AS current_club_nk,
          contract_expires, agent_sk
        FROM {profiles} p LEFT JOIN d_agent a ON p.player_agent_id = a.agent_id
        WHERE player_id IS NOT NULL AND player_name IS NOT NULL"""


CTES: dict[str, str] = {
    "st_profiles": SS.duck_sql("player_profiles"), "st_team": SS.duck_sql("team_details"),
    "st_perf": SS.duck_sql("player_performances"), "st_value": SS.duck_sql("player_market_value"),
    "st_latest": SS.duck_sql("player_latest_market_value"), "st_transfer": SS.duck_sql("transfer_history"),
    "st_injury": SS.duck_sql("player_injuries"), "st_nat": SS.duck_sql("player_national_performances"),
    "st_pair": SS.duck_sql("player_teammates_played_with"),
    "d_agent": """SELECT row_number() OVER (ORDER BY agent_id) AS agent_sk, agent_id, agent_name, TRUE AS is_active
        FROM (SELECT player_agent_id AS agent_id, min(player_agent_name) AS agent_name FROM st_profiles
              WHERE player_agent_id IS NOT NULL GROUP BY 1) a""",
    "d_team": f"""SELECT row_number() OVER (ORDER BY team_nk) AS team_sk, team_nk, team_name, country_name,
          primary_competition_id, division_level
        FROM (SELECT CAST(club_id AS VARCHAR) AS team_nk, club_name AS team_name, COALESCE(country_name, 'Unknown') AS country_name,
                COALESCE(competition_name, 'Unknown') AS primary_competition_id, CAST({tier('club_division')} AS VARCHAR) AS division_level,
                row_number() OVER (PARTITION BY club_id ORDER BY season_id DESC NULLS LAST, club_name) AS n
              FROM st_team WHERE club_id IS NOT NULL) t WHERE n = 1""",
    "d_comp": f"""SELECT row_number() OVER (ORDER BY competition_id) AS competition_sk, competition_id, competition_name
        FROM (SELECT *, row_number() OVER (PARTITION BY competition_id ORDER BY tier, country_name NULLS LAST, competition_name) AS n
              FROM (SELECT DISTINCT {slug('competition_name')} AS competition_id, competition_name, country_name,
                      {tier('club_division')} AS tier FROM st_team WHERE competition_name IS NOT NULL) r) x WHERE n = 1""",
    "d_season": f"""SELECT row_number() OVER (ORDER BY y NULLS LAST, season_name) AS season_sk, season_name, y AS season_start_year,
          y + 1 AS season_end_year, COALESCE(y = max(y) OVER (), FALSE) AS is_current_season
        FROM (SELECT season_name, {season_start('season_name')} AS y FROM (SELECT DISTINCT season_name FROM st_perf
              WHERE season_name IS NOT NULL) s) t""",
    "d_injury": f"""SELECT row_number() OVER (ORDER BY category, severity) AS injury_type_sk, category, severity
        FROM (SELECT DISTINCT {_P} AS category, {_Q} AS severity FROM st_injury WHERE injury_reason IS NOT NULL) c""",
    "d_type": """SELECT * FROM (VALUES (1, 'PERMANENT'), (2, 'FREE'), (3, 'LOAN'), (4, 'END_LOAN'), (5, 'LOAN_RETURN'), (6, 'UNKNOWN'))
        v(transfer_type_sk, transfer_type_code)""",
    "d_player": f"""SELECT row_number() OVER (ORDER BY player_nk) AS player_sk, *, {PROFILE_HASH} AS source_row_hash
        FROM ({player_rows('st_profiles')}) p""",
    "d_date": f"""SELECT {calendar_cols('d')} FROM ({days("DATE '2010-01-01'", "DATE '2030-12-31'")}
        UNION SELECT date_unix FROM st_value UNION SELECT date_unix FROM st_latest UNION SELECT transfer_date FROM st_transfer
        UNION SELECT from_date FROM st_injury UNION SELECT end_date FROM st_injury UNION SELECT first_game_date FROM st_nat) x
        WHERE d IS NOT NULL""",
    "f_perf": f"""SELECT md5(content || '|' || ordinal) AS performance_sk, p.player_sk, t.team_sk, c.competition_sk, s.season_sk,
          f.season_name, f.competition_name, nb_in_group, nb_on_pitch, goals, assists, own_goals, subed_in, subed_out, yellow_cards,
          second_yellow_cards, direct_red_cards, penalty_goals, minutes_played, goals_conceded, clean_sheets,
          {rate('goals', 'nb_on_pitch')} AS goals_per_match, {rate('assists', 'nb_on_pitch')} AS assists_per_match,
          {rate('minutes_played', 'goals', 2)} AS minutes_per_goal, yellow_cards + second_yellow_cards + direct_red_cards AS cards_total,
          'club' AS source_system, {record('player_id', 'f.season_name', 'f.competition_id', 'team_id')} AS source_record_id,
          {TS1} AS load_datetime
        FROM ({_copy('player_performances', 'st_perf')}) f JOIN d_player p ON f.player_id = p.player_nk
        LEFT JOIN d_team t ON CAST(team_id AS VARCHAR) = t.team_nk LEFT JOIN d_comp c ON {slug('f.competition_name')} = c.competition_id
        LEFT JOIN d_season s ON f.season_name = s.season_name""",
    "v_all": f"""SELECT *, {content_of(['player_id', 'value_date', 'market_value', 'value_source'])} AS content FROM (
          SELECT player_id, date_unix AS value_date, value AS market_value, 'historical' AS value_source FROM st_value
          UNION ALL SELECT player_id, date_unix, value, 'latest' FROM st_latest) v""",
    "f_value": f"""SELECT md5(content || '|1') AS market_value_sk, player_sk, {datekey('value_date')} AS date_sk, value_date, market_value,
          value_source = 'latest' AS is_latest_value, value_source, previous_value, market_value - previous_value AS value_change,
          {rate('market_value - previous_value', 'previous_value', times=100)} AS value_change_pct,
          {record('player_id', 'value_date', 'value_source')} AS source_record_id, {TS1} AS load_datetime
        FROM (SELECT *, lag(market_value) OVER (PARTITION BY player_sk, value_source ORDER BY value_date) AS previous_value
              FROM (SELECT v_all.*, p.player_sk, row_number() OVER (PARTITION BY player_id, value_date, value_source
                        ORDER BY market_value DESC, content) AS n
                    FROM v_all JOIN d_player p ON player_id = p.player_nk
                    WHERE value_date IS NOT NULL AND market_value IS NOT NULL) a WHERE n = 1) b""",
    "f_transfer": f"""SELECT md5(content || '|' || ordinal) AS transfer_sk, p.player_sk, a.team_sk AS from_team_sk, b.team_sk AS to_team_sk,
          {datekey('transfer_date')} AS transfer_date_sk, s.season_sk, y.transfer_type_sk, f.season_name, transfer_fee, value_at_transfer,
          {rate('transfer_fee', 'value_at_transfer')} AS fee_to_value_ratio, transfer_type AS transfer_type_text,
          {record('player_id', 'transfer_date', 'from_team_id', 'to_team_id')} AS source_record_id, {TS1} AS load_datetime
        FROM ({_copy('transfer_history', 'st_transfer')}) f JOIN d_player p ON f.player_id = p.player_nk
        LEFT JOIN d_team a ON CAST(from_team_id AS VARCHAR) = a.team_nk LEFT JOIN d_team b ON CAST(to_team_id AS VARCHAR) = b.team_nk
        LEFT JOIN d_season s ON f.season_name = s.season_name LEFT JOIN d_type y ON {_type_code('transfer_type')} = y.transfer_type_code""",
    "f_injury": f"""SELECT md5(content || '|' || ordinal) AS injury_sk, p.player_sk, {datekey('from_date')} AS injury_from_date_sk,
          {datekey('end_date')} AS injury_end_date_sk, s.season_sk, i.injury_type_sk, f.season_name, injury_reason, days_missed, games_missed,
          {rate('days_missed', 'games_missed', 2)} AS avg_days_per_game, {severity('days_missed')} AS severity_score,
          {record('player_id', 'f.season_name', 'from_date', 'injury_reason')} AS source_record_id, {TS1} AS load_datetime
        FROM ({_copy('player_injuries', 'st_injury')}) f JOIN d_player p ON f.player_id = p.player_nk
        LEFT JOIN d_season s ON f.season_name = s.season_name LEFT JOIN d_injury i ON i.category = {_P} AND i.severity = {_Q}""",
    "n_all": f"""SELECT f.*, p.player_sk, t.team_sk, row_number() OVER (PARTITION BY player_id, team_id ORDER BY matches DESC NULLS LAST,
            first_game_date NULLS LAST, goals DESC NULLS LAST, content) AS n
        FROM ({_copy('player_national_performances', 'st_nat')}) f LEFT JOIN d_player p ON player_id = p.player_nk
        LEFT JOIN d_team t ON team_id = t.team_nk""",
    "f_nat": f"""SELECT md5(content || '|1') AS national_performance_sk, player_sk, team_sk AS national_team_sk,
          {datekey('first_game_date')} AS first_game_date_sk, matches AS total_matches, goals AS total_goals,
          {rate('goals', 'matches')} AS goals_per_match, {record('player_id', 'team_id')} AS source_record_id, {TS1} AS load_datetime
        FROM n_all WHERE n = 1 AND player_sk IS NOT NULL""",
    "p_all": f"""SELECT f.*, p.player_sk, m.player_sk AS teammate_player_sk, row_number() OVER (PARTITION BY player_id, teammate_player_id
            ORDER BY minutes_played_with DESC NULLS LAST, joint_goal_participation DESC NULLS LAST, ppg_played_with DESC NULLS LAST, content) AS n
        FROM ({_copy('player_teammates_played_with', 'st_pair')}) f LEFT JOIN d_player p ON player_id = p.player_nk
        LEFT JOIN d_player m ON teammate_player_id = m.player_nk""",
    "f_pair": f"""SELECT md5(content || '|1') AS teammate_fact_sk, player_sk, teammate_player_sk, minutes_played_with AS minutes_played_together,
          ppg_played_with, joint_goal_participation, {rate('joint_goal_participation', 'minutes_played_with', times=90)} AS chemistry_score,
          {record('player_id', 'teammate_player_id')} AS source_record_id, {TS1} AS load_datetime
        FROM p_all WHERE n = 1 AND player_sk IS NOT NULL AND teammate_player_sk IS NOT NULL AND player_id <> teammate_player_id""",
}


def summary_sql(perf: str, injury: str, value: str) -> str:
    """X7 by one group per fact and left joins."""
    return f"""SELECT md5(a.player_sk || chr(31) || a.season_sk) AS player_season_sk, a.*,
          COALESCE(i.days, 0) AS total_injury_days, COALESCE(i.games, 0) AS total_games_missed, v.first AS season_start_value,
          v.last AS season_end_value, {rate('v.last - v.first', 'v.first', times=100)} AS value_change_pct
        FROM (SELECT player_sk, season_sk, count(*) AS total_matches, sum(goals) AS total_goals, sum(assists) AS total_assists,
                sum(minutes_played) AS total_minutes, sum(yellow_cards) AS total_yellow_cards,
                sum(second_yellow_cards + direct_red_cards) AS total_red_cards, {rate('sum(goals)', 'count(goals)')} AS avg_goals_per_match,
                {rate('sum(assists)', 'count(assists)')} AS avg_assists_per_match
              FROM {perf} WHERE season_sk IS NOT NULL GROUP BY ALL) a
        LEFT JOIN (SELECT player_sk, season_sk, CAST(sum(days_missed) AS BIGINT) AS days, sum(games_missed) AS games FROM {injury} GROUP BY ALL) i
          ON a.player_sk = i.player_sk AND a.season_sk = i.season_sk
        LEFT JOIN (SELECT player_sk, s.season_sk, arg_min(market_value, (date_sk, value_source)) AS first,
                     arg_max(market_value, (date_sk, value_source)) AS last
                   FROM {value} JOIN d_date USING (date_sk) JOIN d_season s USING (season_name) GROUP BY ALL) v
          ON a.player_sk = v.player_sk AND a.season_sk = v.season_sk"""


CTES["f_summary"] = f"SELECT *, {TS1} AS load_datetime FROM ({summary_sql('f_perf', 'f_injury', 'f_value')}) s0"


def wh(sql: str, more: dict[str, str] | None = None) -> str:
    """A query over the warehouse's tables."""
    return "WITH " + ",\n".join(f"{k} AS MATERIALIZED ({v})" for k, v in {**CTES, **(more or {})}.items()) + "\n" + sql


# --- what became of each source row ------------------------------------------------------------------

def _ledger(table: str, rows: str) -> str:
    """rows: (reason, n) of every source row."""
    return (f"SELECT '{table}' AS table_name, reason, CAST(sum(n) AS BIGINT) AS n_rows FROM "
            f"({rows} UNION ALL SELECT 'accepted', 0) x GROUP BY reason")


def _known(st: str) -> str:
    return (f"SELECT CASE WHEN p.player_sk IS NULL THEN 'unknown_player' ELSE 'accepted' END AS reason, 1 AS n "
            f"FROM {st} LEFT JOIN d_player p ON player_id = p.player_nk")


LEDGER = wh("SELECT *, CAST(sum(n_rows) OVER t AS BIGINT) AS rows_in, CAST(COALESCE(sum(n_rows) FILTER (reason = 'accepted') OVER t, 0) AS BIGINT) AS rows_out, "
            "CAST(COALESCE(sum(n_rows) FILTER (reason <> 'accepted') OVER t, 0) AS BIGINT) AS rows_rejected FROM (" + " UNION ALL ".join([
    _ledger("fact_player_performance", _known("st_perf")),
    _ledger("fact_transfer", _known("st_transfer")),
    _ledger("fact_injury", _known("st_injury")),
    _ledger("fact_market_value", """SELECT CASE WHEN value_date IS NULL THEN 'no_date' WHEN market_value IS NULL THEN 'no_value'
          WHEN p.player_sk IS NULL THEN 'unknown_player' WHEN row_number() OVER (PARTITION BY p.player_sk, value_date, value_source,
              value_date IS NULL OR market_value IS NULL ORDER BY market_value DESC) = 1 THEN 'accepted' ELSE 'duplicate' END AS reason, 1 AS n
        FROM v_all LEFT JOIN d_player p ON player_id = p.player_nk"""),
    _ledger("fact_national_performance", "SELECT CASE WHEN player_sk IS NULL THEN 'unknown_player' WHEN n = 1 THEN 'accepted' ELSE 'duplicate' END AS reason, 1 AS n FROM n_all"),
    _ledger("fact_teammate_relationship", """SELECT CASE WHEN player_id = teammate_player_id THEN 'self_pair' WHEN player_sk IS NULL THEN 'unknown_player'
          WHEN teammate_player_sk IS NULL THEN 'unknown_teammate' WHEN n = 1 THEN 'accepted' ELSE 'duplicate' END AS reason, 1 AS n FROM p_all"""),
    _ledger("fact_player_season_summary", "SELECT CASE WHEN season_sk IS NULL THEN 'no_season' ELSE 'accepted' END AS reason, 1 AS n FROM f_perf"),
]) + ") l WINDOW t AS (PARTITION BY table_name)")

# --- two runs: the second sees all facts and other positions of every seventh player ------------------

TWO_RUNS = {
    "early": "SELECT player_id AS player_nk, CASE WHEN player_id % 7 = 0 THEN 'YOUTH' ELSE position END AS position FROM st_profiles",
    "late": "SELECT player_id AS player_nk, position FROM st_profiles",
    # each fact row belongs to the version that was current when it was loaded
    "r_perf": f"""SELECT f.* REPLACE (CASE WHEN p.player_nk % 10 <> 3 THEN {TS1} ELSE {TS2} END AS load_datetime),
          p.player_nk, CASE WHEN p.player_nk % 10 <> 3 THEN e.position ELSE l.position END AS position
        FROM f_perf f JOIN d_player p USING (player_sk) JOIN early e ON e.player_nk = p.player_nk JOIN late l ON l.player_nk = p.player_nk""",
    "r_injury": """SELECT f.*, p.player_nk, CASE WHEN p.player_nk % 10 <> 3 THEN e.position ELSE l.position END AS position
        FROM f_injury f JOIN d_player p USING (player_sk) JOIN early e ON e.player_nk = p.player_nk JOIN late l ON l.player_nk = p.player_nk""",
    "r_value": """SELECT f.*, p.player_nk, CASE WHEN p.player_nk % 10 <> 3 THEN e.position ELSE l.position END AS position
        FROM f_value f JOIN d_player p USING (player_sk) JOIN early e ON e.player_nk = p.player_nk JOIN late l ON l.player_nk = p.player_nk""",
}

# --- every check -----------------------------------------------------------------------------------------

_NAMES = {"dim_date": "d_date", "dim_season": "d_season", "dim_competition": "d_comp", "dim_team": "d_team", "dim_agent": "d_agent",
          "dim_player": "d_player", "dim_injury_type": "d_injury", "dim_transfer_type": "d_type",
          "fact_player_performance": "f_perf", "fact_market_value": "f_value", "fact_transfer": "f_transfer", "fact_injury": "f_injury",
          "fact_national_performance": "f_nat", "fact_teammate_relationship": "f_pair", "fact_player_season_summary": "f_summary"}


def _null(*cols: str) -> dict[str, str]:
    return {f"null_{c}": f"{c} IS NULL" for c in cols}


def _neg(*cols: str) -> dict[str, str]:
    return {f"negative_{c}": f"{c} < 0" for c in cols}


MERGED = f"""WITH d1 AS (SELECT row_number() OVER (ORDER BY player_nk) AS player_sk, player_nk, player_name, position,
        current_club_nk, nation_name, {HASH} AS source_row_hash, {TS1} AS valid_from,
        CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
      FROM ({MEMBER_BATCH}) mb WHERE position <> 'HOUSEHOLD'),
    b AS (SELECT player_nk, player_name, CASE WHEN c_acctbal < 0 THEN 'DELINQUENT' ELSE position END AS position,
        current_club_nk, nation_name FROM ({MEMBER_BATCH}) mb),
    bh AS (SELECT *, {HASH} AS source_row_hash FROM b),
    kept AS (SELECT d1.player_sk, d1.player_nk, d1.player_name, d1.position, d1.current_club_nk, d1.nation_name,
        d1.source_row_hash, d1.valid_from,
        CASE WHEN bh.player_nk IS NOT NULL AND bh.source_row_hash <> d1.source_row_hash THEN {TS2}
             ELSE d1.valid_to END AS valid_to,
        CASE WHEN bh.player_nk IS NOT NULL AND bh.source_row_hash <> d1.source_row_hash THEN FALSE
             ELSE d1.is_current END AS is_current
      FROM d1 LEFT JOIN bh ON d1.player_nk = bh.player_nk),
    fresh AS (SELECT bh.* FROM bh LEFT JOIN d1 ON bh.player_nk = d1.player_nk
      WHERE d1.player_nk IS NULL OR d1.source_row_hash <> bh.source_row_hash)
    SELECT * FROM kept
    UNION ALL
    SELECT (SELECT COALESCE(max(player_sk), 0) FROM d1) + row_number() OVER (ORDER BY player_nk) AS player_sk,
      player_nk, player_name, position, current_club_nk, nation_name, source_row_hash, {TS2} AS valid_from,
      CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
    FROM fresh"""

CHECK = "table_name, check_name, CAST(failures AS BIGINT) AS failures"


def _counts(table: str, total: bool, checks: dict[str, str], src: str) -> str:
    parts = []
    if total:
        parts.append(f"SELECT '{table}' AS table_name, 'total_rows' AS check_name, CAST(count(*) AS BIGINT) AS failures "
                     f"FROM {src}")
    for name, cond in checks.items():
        parts.append(f"SELECT '{table}' AS table_name, '{name}' AS check_name, "
                     f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS failures FROM {src}")
    return "\nUNION ALL\n".join(parts)


def _dup(table: str, keys: str, src: str, name: str | None = None) -> str:
    name = name or "duplicate_" + keys.replace(", ", "_")
    return (f"SELECT '{table}' AS table_name, '{name}' AS check_name, CAST(count(*) AS BIGINT) AS failures "
            f"FROM (SELECT {keys} FROM {src} GROUP BY {keys} HAVING count(*) > 1) g")


def _orphan(table: str, key: str, src: str, dim: str, dkey: str, name: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{name}' AS check_name, CAST(count(*) AS BIGINT) AS failures "
            f"FROM {src} f WHERE f.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dkey} = f.{key})")


CAL_DAYS = days("make_date(year(lo), 1, 1)", "make_date(year(hi), 12, 31)",
                "FROM (SELECT min(d) AS lo, max(d) AS hi FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders "
                "UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem) u) b")
DIM_DATE = f"SELECT {calendar_cols('d')} FROM ({CAL_DAYS}) cd"
BASE_DAYS = days("DATE '1996-01-01'", "DATE '1998-12-31'")

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
DIMS = ("region", "nation", "customer", "supplier", "part")
FACTS = ("orders", "lineitem", "events")


def _kind(t: str) -> str:
    return "dimension" if t in DIMS else "fact" if t in FACTS else "other"


TABLE_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{_kind(t)}' AS table_kind, CAST(count(*) AS BIGINT) AS n_rows FROM {t}"
    for t in STAR_TABLES)
WH_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{_kind(t)}' AS table_kind, CAST(count(*) AS BIGINT) AS n_rows FROM {t}" for t in DIMS + FACTS)


def _warehouse_checks() -> str:
    ranges = {"quarter_out_of_range": "NOT (quarter BETWEEN 1 AND 4)", "month_out_of_range": "NOT (month BETWEEN 1 AND 12)",
              "day_out_of_range": "NOT (day BETWEEN 1 AND 31)", "dow_out_of_range": "NOT (day_of_week BETWEEN 0 AND 6)"}
    row_checks = {
        "dim_date": {**ranges, **_null("date_value", "year", "quarter", "month", "month_name", "day", "day_of_week", "day_name",
                                       "week_of_year", "is_weekend")},
        "dim_season": {"season_years_inconsistent": "season_end_year <> season_start_year + 1",
                       **_null("season_name", "season_start_year", "season_end_year")},
        "dim_competition": _null("competition_id", "competition_name"), "dim_team": _null("team_nk", "team_name"),
        "dim_agent": _null("agent_id", "agent_name"),
        "dim_player": {"current_without_agent": "agent_sk IS NULL", **_null("player_nk", "player_name"),
                       "null_valid_from": "FALSE", "null_is_current": "FALSE"},
        "dim_injury_type": {"null_injury_category": "category IS NULL"},
        "dim_transfer_type": {"null_transfer_type_code": "transfer_type_code IS NULL", "null_transfer_type_name": "FALSE"},
        "fact_player_performance": _neg("goals", "assists"),
        "fact_market_value": {**_neg("market_value"), **_null("player_sk", "date_sk", "market_value")},
        "fact_transfer": _neg("transfer_fee", "value_at_transfer"),
        "fact_injury": {**_neg("days_missed", "games_missed"), **_null("player_sk")},
        "fact_national_performance": {"negative_matches": "total_matches < 0", "negative_goals": "total_goals < 0", **_null("player_sk")},
        "fact_teammate_relationship": {"negative_minutes": "minutes_played_together < 0", "self_pair": "player_sk = teammate_player_sk",
                                       **_null("player_sk", "teammate_player_sk")},
        "fact_player_season_summary": _null("player_sk", "season_sk"),
    }
    parts = [_counts(t, False, checks, _NAMES[t]) for t, checks in row_checks.items()]
    parts += [
        _counts("Fact Player Performance", True, {**_null("player_sk", "team_sk"), "negative_goals": "goals < 0",
                                                  "negative_minutes": "minutes_played < 0"}, "f_perf"),
        _counts("Fact Market Value", True, {**_null("player_sk", "date_sk"), "negative_value": "market_value < 0"}, "f_value"),
        _counts("Fact Transfer", True, {**_null("player_sk"), "both_teams_null": "from_team_sk IS NULL AND to_team_sk IS NULL",
                                        "negative_fee": "transfer_fee < 0"}, "f_transfer"),
        _dup("dim_player", "player_nk", "d_player", "duplicate_current_player_nk"),
        "SELECT 'dim_player', 'overlapping_validity', 0",
        "SELECT 'dim_season', 'current_season_count_not_1', CAST(abs(count(*) FILTER (is_current_season) - 1) AS BIGINT) FROM d_season",
    ]
    for dim, key in (("dim_date", "date_value"), ("dim_season", "season_name"), ("dim_competition", "competition_id"),
                     ("dim_team", "team_nk"), ("dim_agent", "agent_id"), ("dim_transfer_type", "transfer_type_code")):
        parts.append(_dup(dim, key, _NAMES[dim]))
    for fact, grain in (("fact_market_value", "player_sk, date_sk, value_source"), ("fact_national_performance", "player_sk, national_team_sk"),
                        ("fact_teammate_relationship", "player_sk, teammate_player_sk"), ("fact_player_season_summary", "player_sk, season_sk")):
        parts.append(_dup(fact, grain, _NAMES[fact]))
    keys = {
        "fact_player_performance": {"player_sk": "dim_player", "team_sk": "dim_team", "competition_sk": "dim_competition", "season_sk": "dim_season"},
        "fact_market_value": {"player_sk": "dim_player", "date_sk": "dim_date"},
        "fact_transfer": {"player_sk": "dim_player", "season_sk": "dim_season", "from_team_sk": "dim_team", "to_team_sk": "dim_team",
                          "transfer_date_sk": "dim_date", "transfer_type_sk": "dim_transfer_type"},
        "fact_injury": {"player_sk": "dim_player", "season_sk": "dim_season", "injury_from_date_sk": "dim_date",
                        "injury_end_date_sk": "dim_date", "injury_type_sk": "dim_injury_type"},
        "fact_national_performance": {"player_sk": "dim_player", "national_team_sk": "dim_team", "first_game_date_sk": "dim_date"},
        "fact_teammate_relationship": {"player_sk": "dim_player", "teammate_player_sk": "dim_player"},
        "fact_player_season_summary": {"player_sk": "dim_player", "season_sk": "dim_season"},
    }
    own = {"dim_player": "player_sk", "dim_team": "team_sk", "dim_competition": "competition_sk", "dim_season": "season_sk",
           "dim_date": "date_sk", "dim_transfer_type": "transfer_type_sk", "dim_injury_type": "injury_type_sk"}
    for fact, mine in keys.items():
        for key, dim in mine.items():
            parts.append(_orphan(fact, key, _NAMES[fact], _NAMES[dim], own[dim], f"orphan_{key}"))
    return wh("SELECT *, CASE WHEN failures <= 0 THEN 'OK' WHEN check_name IN ('total_rows', 'current_without_agent') THEN 'INFO' "
              "WHEN check_name = 'current_season_count_not_1' THEN 'WARNING' ELSE 'ERROR' END AS status FROM (\n"
              + "\nUNION ALL\n".join(parts) + ") c")


def _staging_load() -> str:
    """Statuses of both loads and the rows that staging holds afterwards; a reload leaves the rest as it was."""
    named = {"player_profiles": "st_profiles", "team_details": "st_team", "player_injuries": "st_injury", "player_market_value": "st_value",
             "player_latest_market_value": "st_latest", "player_national_performances": "st_nat", "player_performances": "st_perf",
             "player_teammates_played_with": "st_pair", "transfer_history": "st_transfer"}
    rows = []
    for t in ("player_profiles", "team_details", "team_children", "team_competitions_seasons", *list(named)[2:]):
        n = f"(SELECT count(*) FROM {named[t]})" if t in named else "0"
        rows.append(f"SELECT '{t}' AS table_name, '{'missing' if t == 'team_children' else 'loaded'}' AS status, "
                    f"CAST({'NULL' if t == 'team_children' else n} AS BIGINT) AS n_rows, 'all' AS load")
        rows.append(f"SELECT '{t}', 'held', CAST({n} AS BIGINT), 'now'")
    rows.append("SELECT 'player_market_value', 'loaded', (SELECT count(*) FROM st_value), 'again'")
    rows.append("SELECT 'transfer_history', 'missing', NULL, 'again'")
    return wh("\nUNION ALL\n".join(rows))


SQL = {
    "dim_date": DIM_DATE,
    "dim_date_extend": f"""SELECT {calendar_cols('d')} FROM (
        {BASE_DAYS}
        UNION ALL
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
        WHERE CAST(o_orderdate AS DATE) NOT BETWEEN DATE '1996-01-01' AND DATE '1998-12-31') x""",
    "dim_agent_distinct": """SELECT row_number() OVER (ORDER BY agent_id) AS agent_sk, agent_id, agent_name, TRUE AS is_active
        FROM (SELECT agent_id, agent_name, row_number() OVER (PARTITION BY agent_id ORDER BY agent_name NULLS FIRST) AS rn
              FROM (SELECT NULLIF(c.c_nationkey, 0) AS agent_id, n.n_name AS agent_name
                    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey) a
              WHERE agent_id IS NOT NULL) b WHERE rn = 1""",
    "dim_team_upsert": wh(f"""SELECT ex.team_sk, ex.team_nk, t.team_name, ex.team_slug, t.country_name, 'club' AS team_type, CAST(NULL AS VARCHAR) AS logo_url,
          t.primary_competition_id, t.division_level, TRUE AS is_active
        FROM (SELECT row_number() OVER (ORDER BY team_nk) AS team_sk, team_nk, team_slug FROM team WHERE CAST(team_nk AS INT) % 2 = 0) ex
        JOIN team t USING (team_nk)
        UNION ALL
        SELECT (SELECT count(*) FROM team WHERE CAST(team_nk AS INT) % 2 = 0) + row_number() OVER (ORDER BY team_nk), team_nk, team_name, team_slug,
          country_name, 'club', NULL, primary_competition_id, division_level, TRUE
        FROM team WHERE CAST(team_nk AS INT) % 2 = 1""", {"team": "SELECT d_team.*, s.team_slug FROM d_team JOIN (SELECT DISTINCT CAST(club_id AS VARCHAR) AS team_nk, club_slug AS team_slug FROM st_team) s USING (team_nk)"}),
    "dim_competition_slug": COMP_DIM,
    "dim_season": SEASON_DIM,
    "category_rules": CATEGORY_DIM,
    "category_insert_if_absent": f"""WITH old AS (SELECT row_number() OVER (ORDER BY category, severity) AS category_sk,
            category, severity FROM (SELECT DISTINCT {CAT_OLD} AS category, {SEV_OLD} AS severity
            FROM (SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL) t) c),
        nw AS (SELECT DISTINCT {CAT} AS category, {SEV} AS severity
               FROM (SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL) t)
        SELECT * FROM old
        UNION ALL
        SELECT (SELECT COALESCE(max(category_sk), 0) FROM old) + row_number() OVER (ORDER BY category, severity),
          category, severity
        FROM nw WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.category = nw.category AND old.severity = nw.severity)""",
    "transfer_type_seed": f"""SELECT t.*, COALESCE(u.n, 0) AS n_transfers FROM (VALUES
          (1, 'PERMANENT', 'Permanent Transfer', FALSE, FALSE), (2, 'FREE', 'Free Transfer', TRUE, FALSE),
          (3, 'LOAN', 'Loan', FALSE, TRUE), (4, 'END_LOAN', 'End of Loan', FALSE, FALSE),
          (5, 'LOAN_RETURN', 'Return from Loan', FALSE, FALSE), (6, 'UNKNOWN', 'Unknown', FALSE, FALSE))
          t(transfer_type_sk, transfer_type_code, transfer_type_name, is_free_transfer, is_loan)
        LEFT JOIN (SELECT {line_code()} AS code, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1) u
          ON t.transfer_type_code = u.code""",
    "scd2_initial": MEMBER_DIM,
    "scd2_merge": MERGED,
    "scd2_current": f"""WITH m AS ({MERGED})
        SELECT m.player_sk, m.player_nk, m.player_name, m.position, m.current_club_nk,
          CAST(COALESCE(n.n_orders, 0) AS BIGINT) AS n_orders
        FROM m LEFT JOIN (SELECT m2.player_sk, count(*) AS n_orders FROM orders o
                          JOIN m m2 ON o.o_custkey = m2.player_nk AND m2.is_current GROUP BY m2.player_sk) n
          ON m.player_sk = n.player_sk
        WHERE m.is_current""",
    "scd2_history": f"""WITH h AS (SELECT user_id, event_type, ts, event_id, {md5_of(['event_type'])} AS source_row_hash,
            lag({md5_of(['event_type'])}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
        s AS (SELECT * FROM h WHERE prev IS NULL OR prev <> source_row_hash),
        v AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM s)
        SELECT row_number() OVER (ORDER BY user_id, ts, event_id) AS member_version_sk, user_id, event_type, event_id,
          source_row_hash, ts AS valid_from, valid_to, valid_to IS NULL AS is_current
        FROM v""",
    "fact_performance": wh("SELECT * FROM f_perf"),
    "fact_value_history": wh("SELECT * FROM f_value"),
    "fact_value_latest": f"""SELECT user_id, event_id, {datekey('ts')} AS date_sk,
          CAST(value AS DECIMAL(15,2)) AS market_value, 'latest' AS value_source, TRUE AS is_latest_value
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) e
        WHERE rn = 1""",
    "fact_transfer": wh("SELECT * FROM f_transfer"),
    "fact_interval": wh("SELECT * FROM f_injury"),
    "fact_national": wh("SELECT * FROM f_nat"),
    "fact_pairs": wh("SELECT * FROM f_pair"),
    "season_summary": wh("SELECT * FROM f_summary"),
    "fact_ledger": LEDGER,
    "fact_append": wh("SELECT performance_sk, player_nk, position, goals, load_datetime FROM r_perf", TWO_RUNS),
    "summary_refresh": wh(f"""SELECT s.* EXCLUDE (player_season_sk, player_sk, season_sk), k.player_nk, k.position, d.season_name
        FROM ({summary_sql('k_perf', 'k_injury', 'k_value')}) s JOIN k ON k.k = s.player_sk JOIN d_season d USING (season_sk)""",
        {**TWO_RUNS, "k": "SELECT row_number() OVER () AS k, player_nk, position FROM (SELECT player_nk, position FROM early UNION SELECT player_nk, position FROM late) u",
         **{f"k_{t}": f"SELECT f.* REPLACE (k.k AS player_sk) FROM r_{t} f JOIN k USING (player_nk, position)" for t in ("perf", "injury", "value")}}),
    "version_at": f"""WITH m AS ({MERGED})
        SELECT as_of, player_nk, position, valid_from, COALESCE(valid_to, TIMESTAMP '9999-12-31 00:00:00') AS valid_to
        FROM m, (VALUES ('between', TIMESTAMP '2024-01-15'), ('after', TIMESTAMP '2024-02-01')) v(as_of, t)
        WHERE valid_from <= t AND (valid_to IS NULL OR t < valid_to)""",
    "top_scorers": wh("""SELECT player_name, season_name, total_goals, total_assists, total_matches
        FROM f_summary JOIN d_player USING (player_sk) JOIN d_season USING (season_sk) WHERE total_goals > 0
        ORDER BY total_goals DESC, player_sk, season_name LIMIT 10"""),
    "value_trend": wh("""SELECT player_name, date_value AS full_date, market_value, value_source
        FROM f_value JOIN d_player USING (player_sk) JOIN d_date USING (date_sk) WHERE player_name LIKE '%7'"""),
    "interval_impact": wh("""SELECT player_name, season_name, total_injury_days, total_games_missed, total_matches
        FROM f_summary JOIN d_player USING (player_sk) JOIN d_season USING (season_sk) WHERE total_injury_days > 100"""),
    "star_sample": wh("""SELECT player_name, team_name, s.season_name AS season, c.competition_name AS competition, goals, assists, performance_sk
        FROM f_perf f JOIN d_player USING (player_sk) JOIN d_team USING (team_sk) JOIN d_season s USING (season_sk)
        JOIN d_comp c USING (competition_sk) WHERE goals > 0 ORDER BY goals DESC, performance_sk LIMIT 5"""),
    "flows": wh("""SELECT g.*, a.team_name AS from_team, b.team_name AS to_team, y.transfer_type_code
        FROM (SELECT from_team_sk, to_team_sk, transfer_type_sk, count(*) AS n_transfers, sum(transfer_fee) AS total_fee FROM f_transfer GROUP BY ALL) g
        LEFT JOIN d_team a ON from_team_sk = a.team_sk LEFT JOIN d_team b ON to_team_sk = b.team_sk LEFT JOIN d_type y USING (transfer_type_sk)"""),
    "pair_synergy": wh("""SELECT f.* EXCLUDE (teammate_fact_sk, load_datetime), a.player_name, b.player_name AS teammate_name
        FROM f_pair f JOIN d_player a ON f.player_sk = a.player_sk JOIN d_player b ON teammate_player_sk = b.player_sk
        ORDER BY minutes_played_together DESC, f.player_sk, teammate_player_sk LIMIT 10"""),
    "team_comparison": wh("""SELECT team_sk, competition_sk, count(*) AS n_rows, sum(goals) AS total_goals, sum(minutes_played) AS total_minutes,
          CAST(sum(goals) AS DOUBLE) / count(goals) AS avg_goals FROM f_perf GROUP BY ALL"""),
    "rank_by_season_group": wh("""SELECT * FROM (SELECT *, rank() OVER (PARTITION BY season_sk, competition_sk ORDER BY goals DESC) AS rank
        FROM (SELECT season_sk, competition_sk, player_sk, sum(goals) AS goals FROM f_perf GROUP BY ALL) g) r WHERE rank <= 3"""),
    "custom_checks": wh(_orphan("fact_player_performance", "player_sk", "f_perf", "d_player", "player_sk", "orphan_player_sk")
                        + "\nUNION ALL\n" + _dup("dim_player", "player_nk", "d_player")),
    "warehouse_checks": _warehouse_checks(),
    "staging_load": _staging_load(),
    "dq_counts": "\nUNION ALL\n".join([
        _counts("Fact Performance", True, {
            "null_second_yellow": "NULLIF(CAST(round(l_tax * 100) AS INTEGER), 0) IS NULL",
            "negative_goals": "l_quantity < 0", "zero_discount": "l_discount = 0"}, "lineitem"),
        _counts("Fact Season", True, {
            "null_red_cards": "NOT (o_orderstatus IN ('F', 'O'))", "negative_value": "o_totalprice < 0"}, "orders"),
        _counts("Fact Market Value", True, {
            "null_player_sk": "user_id IS NULL", "both_value_and_type_null": "value IS NULL AND event_type IS NULL",
            "negative_value": "value < 0"}, "events"),
    ]),
    "dq_orphans": "\nUNION ALL\n".join([
        _orphan("orders", "o_custkey", "orders", "(SELECT * FROM customer WHERE c_acctbal >= 0)", "c_custkey",
                "orphan_customer"),
        _orphan("lineitem", "l_orderkey", "lineitem", "orders", "o_orderkey", "orphan_order"),
        _orphan("lineitem", "l_partkey", "lineitem", "part", "p_partkey", "orphan_part"),
        _orphan("lineitem", "l_suppkey", "lineitem", "supplier", "s_suppkey", "orphan_supplier"),
    ]),
    "dq_duplicates": "\nUNION ALL\n".join([
        _dup("lineitem", "l_orderkey, l_linenumber", "lineitem"),
        """SELECT 'lineitem' AS table_name, 'rows_in_duplicate_keys' AS check_name,
             CAST(COALESCE(sum(n), 0) AS BIGINT) AS failures
           FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) g""",
        _dup("orders", "o_custkey, o_orderdate", "orders"),
        _dup("orders", "o_orderkey", "orders"),
    ]),
    "dq_range_unique_notnull": wh("\nUNION ALL\n".join([
        _counts("dim_date", False, {
            "quarter_out_of_range": "NOT (quarter BETWEEN 1 AND 4)", "month_out_of_range": "NOT (month BETWEEN 1 AND 12)",
            "day_out_of_range": "NOT (day BETWEEN 1 AND 31)", "dow_out_of_range": "NOT (day_of_week BETWEEN 0 AND 6)"},
            f"({DIM_DATE}) dd"),
        _counts("dim_season", False, {"season_years_inconsistent": "season_end_year <> season_start_year + 1"},
                f"({SEASON_DIM}) sd"),
        _counts("lineitem", False, {
            "negative_quantity": "l_quantity < 0", "discount_out_of_range": "NOT (l_discount BETWEEN 0 AND 1)",
            "null_ship_date": "l_shipdate IS NULL"}, "lineitem"),
        _counts("orders", False, {"negative_price": "o_totalprice < 0"}, "orders"),
        _counts("fact_injury", False, {"negative_days_missed": "days_missed < 0", "negative_games_missed": "games_missed < 0"}, "f_injury"),
        _counts("customer", False, {"null_c_custkey": "c_custkey IS NULL", "null_c_name": "c_name IS NULL",
                                    "null_c_nationkey": "c_nationkey IS NULL"}, "customer"),
        _dup("customer", "c_custkey", "customer"),
        _dup("dim_season", "season_name", f"({SEASON_DIM}) sd"),
        _counts("fact_pairs", False, {"self_pair": "player_sk = teammate_player_sk"}, "f_pair"),
    ])),
    "dq_scd2_validity": f"""WITH m AS ({MERGED}),
        nx AS (SELECT *, lead(valid_from) OVER (PARTITION BY player_nk ORDER BY valid_from, player_sk) AS next_from FROM m)
        SELECT 'dim_member' AS table_name, 'overlapping_validity' AS check_name,
          CAST(count(*) FILTER (WHERE next_from IS NOT NULL AND (valid_to IS NULL OR valid_to > next_from)) AS BIGINT)
            AS failures FROM nx
        UNION ALL
        SELECT 'dim_member', 'duplicate_current_member', CAST(count(*) AS BIGINT)
        FROM (SELECT player_nk FROM m WHERE is_current GROUP BY player_nk HAVING count(*) > 1) g
        UNION ALL
        SELECT 'dim_member', 'closed_without_end', CAST(count(*) FILTER (WHERE NOT is_current AND valid_to IS NULL) AS BIGINT)
        FROM m""",
    "dq_coverage": f"""SELECT 'min_order_date' AS metric_name, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS metric_value
          FROM orders
        UNION ALL SELECT 'max_order_date', CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) FROM orders
        UNION ALL SELECT 'members_without_agent', CAST(count(*) FILTER (WHERE NULLIF(c_nationkey, 0) IS NULL) AS VARCHAR)
          FROM customer
        UNION ALL SELECT 'current_seasons', CAST(count(*) FILTER (WHERE is_current_season) AS VARCHAR)
          FROM ({SEASON_DIM}) sd""",
    "table_status": f"""SELECT table_name, table_kind, n_rows, CASE WHEN n_rows > 0 THEN 'OK' ELSE 'EMPTY' END AS status,
          bool_and(n_rows > 0) OVER () AS run_passed
        FROM ({TABLE_COUNTS}) t""",
    "warehouse_summary": f"""SELECT table_kind, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_tables
          FROM ({WH_COUNTS}) w GROUP BY table_kind
        UNION ALL SELECT 'total', CAST(sum(n_rows) AS BIGINT), CAST(count(*) AS BIGINT) FROM ({WH_COUNTS}) w""",
    "clean_nulls_dates": """SELECT event_id, NULLIF(NULLIF(raw, ''), 'nan') AS date_text,
          CAST(COALESCE(try_strptime(NULLIF(NULLIF(raw, ''), 'nan'), '%Y-%m-%d'),
                        try_strptime(NULLIF(NULLIF(raw, ''), 'nan'), '%Y/%m/%d'),
                        try_strptime(NULLIF(NULLIF(raw, ''), 'nan'), '%d.%m.%Y')) AS DATE) AS parsed_date,
          NULLIF(NULLIF(CASE WHEN event_type = 'purchase' THEN 'nan' ELSE event_type END, ''), 'nan') AS event_type_clean
        FROM (SELECT *, CASE event_type WHEN 'signup' THEN strftime(ts, '%Y-%m-%d')
                                        WHEN 'click' THEN strftime(ts, '%d.%m.%Y')
                                        WHEN 'view' THEN strftime(ts, '%Y/%m/%d')
                                        WHEN 'error' THEN 'not a date' ELSE '' END AS raw FROM events) e""",
    "clean_text_columns": """SELECT doc_id, NULLIF(NULLIF(lang, ''), 'nan') AS lang, NULLIF(NULLIF(source, ''), 'nan') AS source,
          NULLIF(NULLIF(text, ''), 'nan') IS NULL AS text_missing, CAST(length(text) AS BIGINT) AS text_length
        FROM documents""",
    "get_or_create_members": """WITH dim AS (SELECT row_number() OVER (ORDER BY c_custkey) AS player_sk, c_custkey AS player_nk,
            c_name AS player_name, c_mktsegment AS position FROM customer WHERE c_acctbal >= 0)
        SELECT *, FALSE AS is_inferred FROM dim
        UNION ALL
        SELECT (SELECT COALESCE(max(player_sk), 0) FROM dim) + row_number() OVER (ORDER BY player_nk), player_nk,
          'Unknown', 'Unknown', TRUE
        FROM (SELECT DISTINCT o_custkey AS player_nk FROM orders WHERE o_custkey IS NOT NULL
              AND o_custkey NOT IN (SELECT player_nk FROM dim)) m""",
    "audit_delta": """SELECT table_name, n_before, n_after, n_after - n_before AS delta FROM (
          SELECT 'orders' AS table_name, CAST(count(*) FILTER (WHERE o_orderdate < TIMESTAMP '2000-01-01') AS BIGINT) AS n_before,
            CAST(count(*) AS BIGINT) AS n_after FROM orders
          UNION ALL SELECT 'lineitem', CAST(count(*) FILTER (WHERE l_shipdate < TIMESTAMP '2000-01-01') AS BIGINT),
            CAST(count(*) AS BIGINT) FROM lineitem
          UNION ALL SELECT 'events', CAST(count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-15') AS BIGINT),
            CAST(count(*) AS BIGINT) FROM events) x""",
    "category_frequency": f"""SELECT {CAT} AS category, {SEV} AS severity, count(*) AS n_parts FROM part
        GROUP BY ALL ORDER BY n_parts DESC, category""",
    "member_sample": """SELECT * FROM (SELECT 'customer' AS kind, c_custkey AS member_key, c_name AS member_name
          FROM customer ORDER BY c_custkey LIMIT 5)
        UNION ALL SELECT * FROM (SELECT 'supplier', s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 5)
        ORDER BY kind, member_key""",
    "epoch_date": """SELECT event_id, epoch_seconds, CAST(make_timestamp(epoch_seconds * 1000000) AS DATE) AS value_date,
          CAST(make_timestamp(epoch_seconds * 1000000) AS DATE) = CAST(ts AS DATE) AS same_day
        FROM (SELECT *, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch_seconds FROM events) e""",
    "csv_staging": """SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN replace(c_name, '#', chr(10) || '"#",') ELSE c_name END AS c_name)
        FROM customer""",
    "run_passed": """SELECT 'clean' AS case_name, bool_and(o_orderkey IS NOT NULL AND NOT coalesce(o_totalprice < 0, FALSE)) AS passed FROM orders
        UNION ALL SELECT 'dirty', bool_and(o_orderkey IS NOT NULL AND NOT coalesce(o_totalprice > 1000, FALSE)) FROM orders""",
    "warehouse_reload": wh(f"""SELECT table_name, table_kind, n_rows, CASE WHEN n_rows > 0 THEN 'OK' ELSE 'EMPTY' END AS status
        FROM (SELECT 'dim_date' AS table_name, 'dimension' AS table_kind, CAST(count(*) AS BIGINT) AS n_rows
              FROM ({DIM_DATE}) a
              UNION ALL SELECT 'dim_season', 'dimension', CAST(count(*) AS BIGINT) FROM ({SEASON_DIM}) b
              UNION ALL SELECT 'dim_member', 'dimension', CAST(count(*) AS BIGINT) FROM ({MEMBER_DIM}) c
              UNION ALL SELECT 'dim_team', 'dimension', CAST(count(*) AS BIGINT) FROM d_team
              UNION ALL SELECT 'fact_performance', 'fact', CAST(count(*) AS BIGINT) FROM f_perf) t"""),
}


# Result presentation, as ``star.as_output``: decimals leave as DOUBLE, integer
# sums (HUGEINT in DuckDB) as BIGINT.
OUTPUT_CASTS = {
    "fact_performance": (("goals",), ()),
    "fact_append": (("goals",), ()),
    "fact_value_history": (("market_value", "previous_value", "value_change"), ()),
    "fact_value_latest": (("market_value",), ()),
    "fact_transfer": (("transfer_fee", "value_at_transfer"), ()),
    "fact_interval": (("days_missed",), ()),
    "fact_pairs": (("ppg_played_with",), ()),
    "season_summary": (("total_goals", "season_start_value", "season_end_value"),
                       ("total_assists", "total_minutes", "total_yellow_cards", "total_red_cards",
                        "total_injury_days", "total_games_missed")),
    "summary_refresh": (("total_goals", "season_start_value", "season_end_value"),
                        ("total_assists", "total_minutes", "total_yellow_cards", "total_red_cards",
                         "total_injury_days", "total_games_missed")),
    "top_scorers": (("total_goals",), ("total_assists",)),
    "value_trend": (("market_value",), ()),
    "interval_impact": ((), ("total_injury_days", "total_games_missed")),
    "star_sample": (("goals",), ()),
    "flows": (("total_fee",), ()),
    "pair_synergy": (("ppg_played_with",), ()),
    "team_comparison": (("total_goals",), ("total_minutes",)),
    "rank_by_season_group": (("goals",), ()),
}


def output_sql(name: str) -> str:
    sql = SQL[name]
    doubles, bigints = OUTPUT_CASTS.get(name, ((), ()))
    if not doubles and not bigints:
        return sql
    repl = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles] + [f"CAST({c} AS BIGINT) AS {c}" for c in bigints]
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM ({sql}) q"


OUTPUT_SQL = {name: output_sql(name) for name in SQL}
