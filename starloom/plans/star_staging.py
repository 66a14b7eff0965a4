"""The driver's TPC-H-like star as staging tables (§1.4).

The test data has no football tables, so each staging source is a query over
the star with the source's own columns and types: customers are players,
suppliers teams, part names competitions, lines performances, transfers,
injuries and pairs, orders national performances, events market values.  Every
source reads its tables whole and holds what real sources hold: players and
teams that no profile knows, NULL keys, dates and values, repeated and
competing rows.

The queries are plain SQL that Spark and DuckDB both read; they shape the
input only.  Everything built from it is built by the warehouse's own
builders here, and by hand-written SQL in ``star_sql``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.schemas import catalogue, columns


def _season(d: str) -> str:
    first = f"(CASE WHEN month({d}) >= 7 THEN year({d}) ELSE year({d}) - 1 END)"
    return f"(substr(CAST({first} AS STRING), 3, 2) || '/' || substr(CAST({first} + 1 AS STRING), 3, 2))"


_LINES = "{lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey"
_PERFORMANCES = f"""SELECT CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN NULL ELSE o_custkey END AS player_id,
      CASE WHEN o_orderpriority = '5-LOW' AND l_linenumber = 4 THEN NULL ELSE {_season('o_orderdate')} END AS season_name,
      p_brand AS competition_id, CASE WHEN l_linenumber = 6 THEN p_name || ' cup' ELSE p_name END AS competition_name,
      CASE WHEN l_linenumber = 5 THEN NULL ELSE l_suppkey END AS team_id, p_type AS team_name,
      l_linenumber + 1 AS nb_in_group, l_linenumber - 1 AS nb_on_pitch, CAST(l_quantity AS DECIMAL(10,2)) AS goals,
      CAST(round(l_discount * 100) AS INT) AS assists, 0 AS own_goals, l_linenumber % 3 AS subed_in,
      CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS yellow_cards, NULLIF(CAST(round(l_tax * 100) AS INT), 0) AS second_yellow_cards,
      CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS direct_red_cards, l_linenumber * 90 AS minutes_played
    FROM {_LINES} JOIN {{part}} p ON l.l_partkey = p.p_partkey"""
_TEAMS = """SELECT s_suppkey AS club_id, lower(s_name) AS club_slug, s_name AS club_name,
      CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE n_name END AS country_name, 2000 + s_nationkey AS season_id,
      CASE WHEN s_nationkey % 7 = 0 THEN NULL ELSE r_name END AS competition_name, s_name AS club_division
    FROM {supplier} s LEFT JOIN {nation} n ON s.s_nationkey = n.n_nationkey LEFT JOIN {region} r ON n.n_regionkey = r.r_regionkey
    WHERE s_acctbal >= 0
    UNION ALL SELECT s_suppkey, lower(s_name), s_name || ' of old', NULL, 1990, NULL, NULL FROM {supplier} WHERE s_acctbal >= 0
    UNION ALL SELECT NULL, NULL, NULL, p_type, NULL, p_name, p_brand FROM {part}"""
_VALUES = """SELECT CASE WHEN user_id % 50 = 49 THEN 100000000 + user_id ELSE user_id END AS player_id,
      CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS date_unix,
      CASE WHEN event_type = 'signup' AND event_id % 4 = 0 THEN NULL ELSE CAST(value AS DECIMAL(15,2)) END AS value
    FROM {events} WHERE event_type """

#: Staging source → query; ``@days(a, b)`` stands for the days from b to a.
SOURCES = {
    "player_profiles": """SELECT c_custkey AS player_id, replace(lower(c_name), '#', '-') AS player_slug, c_name AS player_name,
      c_mktsegment AS position, c_nationkey AS current_club_id, NULLIF(c_nationkey, 0) AS player_agent_id,
      n_name AS player_agent_name
    FROM {customer} c LEFT JOIN {nation} n ON c.c_nationkey = n.n_nationkey WHERE c_acctbal >= 0""",
    "team_details": _TEAMS,
    "player_performances": _PERFORMANCES,
    "player_market_value": _VALUES + "<> 'purchase'",
    "player_latest_market_value": _VALUES + "= 'purchase'",
    "transfer_history": f"""SELECT o_custkey AS player_id, {_season('l_shipdate')} AS season_name,
      CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS transfer_date,
      CASE WHEN l_linenumber = 1 THEN NULL ELSE l_suppkey END AS from_team_id, l_partkey % 120 AS to_team_id,
      CASE l_linenumber WHEN 1 THEN 'Free transfer' WHEN 2 THEN 'Loan' WHEN 3 THEN 'End of loan' WHEN 4 THEN 'Loan return'
        WHEN 5 THEN '?' WHEN 6 THEN NULL ELSE 'EUR 3m' END AS transfer_type,
      CASE WHEN l_discount = 0 THEN 0 ELSE CAST(p_retailprice AS DECIMAL(15,2)) END AS value_at_transfer,
      CAST(l_extendedprice AS DECIMAL(15,2)) AS transfer_fee
    FROM {_LINES} JOIN {{part}} p ON l.l_partkey = p.p_partkey""",
    "player_injuries": f"""SELECT o_custkey AS player_id, {_season('o_orderdate')} AS season_name,
      CASE l_partkey % 6 WHEN 0 THEN 'Muscle strain' WHEN 1 THEN 'Knee injury' WHEN 2 THEN 'Fractured toe' WHEN 3 THEN 'Flu'
        WHEN 4 THEN 'Torn muscle, broken rib' ELSE NULL END AS injury_reason,
      CAST(o_orderdate AS DATE) AS from_date, CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS end_date,
      CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(@days(CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE)) AS DECIMAL(10,2)) END AS days_missed,
      CASE l_linenumber WHEN 3 THEN 0 WHEN 5 THEN NULL ELSE l_linenumber END AS games_missed
    FROM {_LINES}""",
    "player_national_performances": """SELECT o_custkey AS player_id,
      CASE WHEN o_custkey % 30 > 24 THEN 'N' || CAST(o_custkey % 30 AS STRING) ELSE CAST(o_custkey % 30 AS STRING) END AS team_id,
      o_orderstatus AS team_name, CAST(o_orderdate AS DATE) AS first_game_date, o_orderkey % 97 AS matches, o_orderkey % 13 AS goals
    FROM {orders}""",
    "player_teammates_played_with": f"""SELECT o_custkey AS player_id,
      CASE WHEN l_linenumber = 7 THEN o_custkey ELSE l_partkey END AS teammate_player_id, l_returnflag AS teammate_player_name,
      CAST(l_discount AS DECIMAL(10,2)) AS ppg_played_with, CAST(round(l_quantity) AS INT) AS joint_goal_participation,
      CASE WHEN l_linenumber = 2 THEN 0 ELSE l_linenumber * 90 END AS minutes_played_with
    FROM {_LINES}""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _dialect(sql: str, days: str) -> str:
    while "@days(" in sql:  # arguments hold balanced parentheses
        at = sql.index("@days(") + len("@days(")
        depth, comma, end = 0, None, at
        for end in range(at, len(sql)):
            depth += (sql[end] == "(") - (sql[end] == ")")
            if sql[end] == "," and depth == 0:
                comma = end
            if depth < 0:
                break
        sql = sql[: at - len("@days(")] + days.format(sql[at:comma], sql[comma + 1 : end].strip()) + sql[end + 1 :]
    return sql


def duck_sql(source: str) -> str:
    """The source's rows in DuckDB, in the schema of the staging table."""
    sql = _dialect(SOURCES[source], "date_diff('day', {1}, {0})").format(**{t: t for t in TABLES})
    names = sql_columns(source)
    cols = [f"CAST({c if c in names else 'NULL'} AS {t.replace('STRING', 'VARCHAR')}) AS {c}" for c, t in columns(source)]
    return f"SELECT {', '.join(cols)} FROM ({sql}) s0"


def sql_columns(source: str) -> set[str]:
    """Columns that the source's query gives; the others are NULL."""
    head = SOURCES[source].split("FROM {")[0]
    return {c for c, _ in columns(source) if re.search(rf" AS {c}\b", head)}


def is_projection(name: str) -> bool:
    """Whether a source is made row by row from the lines, or from one table of the star: reading it costs no join."""
    return name in SOURCES and " JOIN " not in SOURCES[name].replace(_LINES, "") and "UNION" not in SOURCES[name]


def of_lines(name: str) -> bool:
    return _LINES in SOURCES.get(name, "")


def lines(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The lines with their orders, which four sources start from: the columns that one of them names."""
    asked = " ".join(sql.replace(_LINES, "") for name, sql in SOURCES.items() if of_lines(name))
    columns = [c for t in ("lineitem", "orders") for c in tables[t].columns if re.search(rf"\b{c}\b", asked)]
    return spark.sql(f"SELECT {', '.join(columns)} FROM {_LINES}", **{t: tables[t] for t in ("lineitem", "orders")})


def source(spark: SparkSession, name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One staging table; one that the star can't fill is empty.  ``tables`` may hold :func:`lines` by that name."""
    schema = catalogue()[name].schema
    if name not in SOURCES:
        return spark.createDataFrame([], schema)
    sql = SOURCES[name].replace(_LINES, "{lines} l") if "lines" in tables else SOURCES[name]
    rows = spark.sql(_dialect(sql, "datediff({0}, {1})"), **{t: tables[t] for t in ("lines", *TABLES) if "{" + t + "}" in sql})
    have = set(rows.columns)
    return rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
