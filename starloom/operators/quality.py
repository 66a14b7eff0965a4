"""Data-quality checks as DataFrames (Q1–Q17).

Parquet enforces no keys, so every constraint of the reference's DDL becomes
a check that yields rows ``(table_name, check_name, failures)`` in long form
(T7: no positional UNION of differently-meant columns).  All conditions on a
table are counted in one aggregate, and all foreign keys of all facts in one
grouped pass against all dimensions, so adding a check costs an expression,
not another scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X

CHECK_SCHEMA = "table_name STRING, check_name STRING, failures BIGINT"


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def count_checks(df: DataFrame, table: str, checks: Mapping[str, Column], total: str | None = "total_rows") -> DataFrame:
    """Failures per named condition, one scan, long form.

    With ``total`` a row holding COUNT(*) is added (P13 literal table name).
    """
    aggs = [F.count_if(cond).cast("long").alias(name) for name, cond in checks.items()]
    if total:
        aggs = [F.count(F.lit(1)).cast("long").alias(total)] + aggs
    names = ([total] if total else []) + list(checks)
    wide = df.agg(*aggs)
    return wide.unpivot([], names, "check_name", "failures").select(
        F.lit(table).alias("table_name"), "check_name", "failures")


def not_null_checks(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """Q13: NOT NULL columns."""
    return count_checks(df, table, {f"null_{c}": F.col(c).isNull() for c in cols}, total=None)


def orphan_check(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, table: str,
                 check: str | None = None) -> DataFrame:
    """Fact rows whose non-NULL key has no dimension row.

    Fact keys are counted first (combined map-side), so the anti-join sees
    each key once: a key holding a third of the rows costs one row there.
    """
    k = (fact.select(F.col(fact_key).alias("__k")).where(F.col("__k").isNotNull())
         .groupBy("__k").agg(F.count(F.lit(1)).alias("__n")))
    d = dim.select(F.col(dim_key).alias("__k")).distinct()
    n = k.join(d, "__k", "left_anti").agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("failures"))
    return n.select(F.lit(table).alias("table_name"), F.lit(check or f"orphan_{fact_key}").alias("check_name"),
                    "failures")


def validity_overlap_check(dim: DataFrame, nk: str, table: str, check: str = "overlapping_validity") -> DataFrame:
    """SCD2 invariant: versions of one key do not overlap in time.

    Each version is compared with the next one of the same key (by
    ``valid_from``, then surrogate key): it overlaps when it is still open or
    ends after the next one starts.  Neighbours come from windows by (key,
    year), so no pairs are formed within a key and a long history is not one task.
    """
    from .windows import next_in_group

    sk = [c for c in dim.columns if c.endswith("_sk")][:1]
    v = dim.select(nk, "valid_from", "valid_to", *sk)
    v = next_in_group(v, [nk], ["valid_from", *sk], ["valid_from"], span=F.year("valid_from"), prefix="__next_")
    bad = F.col("__next_valid_from").isNotNull() & (
        F.col("valid_to").isNull() | (F.col("valid_to") > F.col("__next_valid_from")))
    return v.agg(F.count_if(bad).cast("long").alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "failures")


def duplicate_check(df: DataFrame, keys: Sequence[str], table: str, check: str | None = None,
                    where: Column | None = None) -> DataFrame:
    """Q4/Q11/A5: number of key values held by more than one row."""
    d = df.where(where) if where is not None else df
    g = d.groupBy(*keys).count().where(F.col("count") > 1)
    n = g.agg(F.count(F.lit(1)).cast("long").alias("failures"))
    return n.select(F.lit(table).alias("table_name"),
                    F.lit(check or ("duplicate_" + "_".join(keys))).alias("check_name"), "failures")


def duplicate_checks(keys: Sequence[tuple[str, Sequence[str], str | None, Column | None]],
                     tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q4/Q11/A5 for many keys at once: rows of (table, key columns, check name or None, rows looked at or None).

    All keys of all tables are counted in one grouped pass, by the text of
    their columns (NULL apart from every text), and the doubled ones once more.
    """
    met = []
    for table, cols, check, where in keys:
        df = tables[table] if where is None else tables[table].where(where)
        text = F.concat_ws("\x1f", *[F.coalesce(F.hex(c) if df.schema[c].dataType.typeName() == "binary" else F.col(c).cast("string"),
                                                F.lit("\x1e")) for c in cols])
        met.append(df.select(F.lit(table).alias("table_name"), F.lit(check or "duplicate_" + "_".join(cols)).alias("check_name"),
                             text.alias("k")))
    doubled = _union(met).groupBy("table_name", "check_name", "k").count().where("count > 1")
    n = doubled.groupBy("table_name", "check_name").agg(F.count(F.lit(1)).alias("n"))
    asked = n.sparkSession.createDataFrame([(t, c or "duplicate_" + "_".join(k)) for t, k, c, _ in keys],
                                           "table_name string, check_name string")
    return asked.join(F.broadcast(n), ["table_name", "check_name"], "left").select(  # a row per key at most
        "table_name", "check_name", F.coalesce("n", F.lit(0)).cast("long").alias("failures"))


def table_counts(tables: Mapping[str, DataFrame], kind: Mapping[str, str] | None = None) -> DataFrame:
    """Row count and OK/EMPTY per table."""
    kind = kind or {}
    rows = [
        df.agg(F.count(F.lit(1)).cast("long").alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.lit(kind.get(name, "table")).alias("table_kind"), "n_rows")
        for name, df in tables.items()
    ]
    return _union(rows).withColumn("status", X.status_label("n_rows"))


# Rows of the long form that count something without saying that it is wrong.
INFORMATIONAL = ("total_rows", "current_without_agent")
# Failures that ask for attention but don't make the data wrong.
WARNINGS = ("current_season_count_not_1",)


def _informs() -> Column:
    return F.col("check_name").isin(*INFORMATIONAL) | F.col("check_name").startswith("dropped_")


def labelled(checks: DataFrame) -> DataFrame:
    """each check with OK, INFO, WARNING or ERROR."""
    severity = (F.when(_informs(), "INFO")
                .when(F.col("check_name").isin(*WARNINGS), "WARNING").otherwise("ERROR"))
    return checks.withColumn("status", X.failure_label("failures", severity))


def run_passed(checks: DataFrame, col: str = "failures", ledger: DataFrame | None = None,
               max_rejected: float | None = None) -> DataFrame:
    """One row, TRUE when no check has failures; counts that only inform don't decide.

    With ``ledger`` (see :func:`row_ledger`) a run also fails where a fact
    rejects more than the share ``max_rejected`` of its source rows, or where
    its rows don't add up.
    """
    failing = checks.where(~_informs()).select((F.col(col) == 0).alias("ok"))
    if ledger is not None:
        lost = F.lit(False) if max_rejected is None else F.col("rows_rejected") > F.col("rows_in") * F.lit(max_rejected)
        sums = F.col("rows_in") != F.col("rows_out") + F.col("rows_rejected")
        totals = ledger.groupBy("table_name").agg(*[F.max(c).alias(c) for c in ("rows_in", "rows_out", "rows_rejected")])
        failing = failing.unionByName(totals.select((~lost & ~sums).alias("ok")))
    return failing.agg(F.coalesce(F.every("ok"), F.lit(True)).alias("passed"))


def row_ledger(splits: Mapping[str, DataFrame], sources: Mapping[str, Sequence[DataFrame]]) -> DataFrame:
    """What became of each fact's source rows.

    One row per fact and reason (``accepted`` for its fact rows) with
    ``n_rows``, and on each the fact's totals ``rows_in`` (counted in its
    sources), ``rows_out`` and ``rows_rejected``; the totals add up when no
    row was lost or made.  One aggregate per fact and one count per source.
    """
    counts = []
    for name, split in splits.items():
        met = split.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reason")).agg(F.sum("n_rows").alias("n"))
        none = split.sparkSession.createDataFrame([("accepted", 0)], "reason string, n long")  # a fact without rows has its line
        rows_in = [s.agg(F.lit("in").alias("reason"), F.count(F.lit(1)).alias("n")) for s in sources[name]]
        counts.append(_union([met, none, *rows_in]).withColumn("table_name", F.lit(name)))
    lines = _union(counts).groupBy("table_name", "reason").agg(F.sum("n").cast("long").alias("n_rows"))
    of_table = Window.partitionBy("table_name")  # a line per reason
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n_rows"))).over(of_table), F.lit(0)).cast("long")
    reason = F.col("reason")
    lines = lines.select("table_name", "reason", "n_rows", total(reason == "in").alias("rows_in"),
                         total(reason == "accepted").alias("rows_out"),
                         total(~reason.isin("in", "accepted")).alias("rows_rejected"))
    return lines.where(reason != "in")


def dropped_rows(ledger: DataFrame) -> DataFrame:
    """Source rows that a fact lost, by reason, as informational checks; a fact that lost none says so."""
    usual = F.when(F.col("table_name") == "fact_player_season_summary", "no_season").otherwise("unknown_player")
    kept = F.col("reason") == "accepted"
    lines = ledger.select("table_name", F.when(kept, usual).otherwise(F.col("reason")).alias("reason"),
                          F.when(kept, 0).otherwise(F.col("n_rows")).cast("long").alias("failures"))
    return lines.groupBy("table_name", F.concat(F.lit("dropped_"), F.col("reason")).alias("check_name")).agg(
        F.sum("failures").alias("failures"))


def warehouse_summary(counts: DataFrame) -> DataFrame:
    """Rows per kind (dimension / fact) and in total."""
    per_kind = counts.groupBy("table_kind").agg(F.sum("n_rows").cast("long").alias("n_rows"),
                                                 F.count(F.lit(1)).cast("long").alias("n_tables"))
    total = counts.agg(F.lit("total").alias("table_kind"), F.sum("n_rows").cast("long").alias("n_rows"),
                       F.count(F.lit(1)).cast("long").alias("n_tables"))
    return per_kind.unionByName(total)


def coverage(df: DataFrame, col: str, table: str) -> DataFrame:
    """Min and max of a column."""
    return df.agg(F.lit(table).alias("table_name"), F.min(col).alias("min_value"), F.max(col).alias("max_value"))


# --- the reference's checks over the built warehouse --------------------------

def foreign_key_checks(keys: Sequence[tuple[str, str, str, str]], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q3/Q12/J3 for many keys at once: rows of (fact, key, dimension, dimension key) whose non-NULL key has no member.

    Each fact is read once, all its keys exploded and counted by (dimension,
    key) map-side, so a key that a third of the rows share is one row per
    task; the counted keys of all facts meet the members of all dimensions in
    one anti-join.
    """
    facts: dict[str, list[tuple[str, str, str]]] = {}
    dims: dict[tuple[str, str], None] = {}
    for fact, key, dim, dim_key in keys:
        facts.setdefault(fact, []).append((key, dim, dim_key))
        dims[dim, dim_key] = None
    met = []
    for fact, mine in facts.items():
        each = F.explode(F.array(*[F.struct(F.lit(f"orphan_{key}").alias("check_name"), F.lit(f"{dim}.{dim_key}").alias("d"),
                                            F.col(key).cast("string").alias("k")) for key, dim, dim_key in mine]))
        met.append(tables[fact].select(each.alias("x")).select("x.*").where(F.col("k").isNotNull())
                   .groupBy("check_name", "d", "k").agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(fact)))
    members = _union([tables[dim].select(F.lit(f"{dim}.{k}").alias("d"), F.col(k).cast("string").alias("k")) for dim, k in dims])
    lost = _union(met).join(members, ["d", "k"], "left_anti").groupBy("table_name", "check_name").agg(F.sum("n").alias("n"))
    spark = lost.sparkSession
    asked = spark.createDataFrame([(fact, f"orphan_{key}") for fact, key, _, _ in keys], "table_name string, check_name string")
    return asked.join(F.broadcast(lost), ["table_name", "check_name"], "left").select(  # a row per foreign key at most
        "table_name", "check_name", F.coalesce("n", F.lit(0)).cast("long").alias("failures"))


def _negative(*cols: str) -> dict[str, Column]:
    """P10/Q10: measures below zero; a NULL measure passes, as a CHECK constraint lets it."""
    return {f"negative_{c}": F.col(c) < 0 for c in cols}


def _null(*cols: str) -> dict[str, Column]:
    return {f"null_{c}": F.col(c).isNull() for c in cols}


# The foreign keys, grains, NOT NULL and CHECK columns of the warehouse's tables.
WAREHOUSE_FOREIGN_KEYS = (
    ("fact_player_performance", "player_sk", "dim_player", "player_sk"),
    ("fact_player_performance", "team_sk", "dim_team", "team_sk"),
    ("fact_player_performance", "competition_sk", "dim_competition", "competition_sk"),
    ("fact_player_performance", "season_sk", "dim_season", "season_sk"),
    ("fact_market_value", "player_sk", "dim_player", "player_sk"),
    ("fact_market_value", "date_sk", "dim_date", "date_sk"),
    ("fact_transfer", "player_sk", "dim_player", "player_sk"),
    ("fact_transfer", "season_sk", "dim_season", "season_sk"),
    ("fact_transfer", "from_team_sk", "dim_team", "team_sk"),
    ("fact_transfer", "to_team_sk", "dim_team", "team_sk"),
    ("fact_transfer", "transfer_date_sk", "dim_date", "date_sk"),
    ("fact_transfer", "transfer_type_sk", "dim_transfer_type", "transfer_type_sk"),
    ("fact_injury", "player_sk", "dim_player", "player_sk"),
    ("fact_injury", "season_sk", "dim_season", "season_sk"),
    ("fact_injury", "injury_from_date_sk", "dim_date", "date_sk"),
    ("fact_injury", "injury_end_date_sk", "dim_date", "date_sk"),
    ("fact_injury", "injury_type_sk", "dim_injury_type", "injury_type_sk"),
    ("fact_national_performance", "player_sk", "dim_player", "player_sk"),
    ("fact_national_performance", "national_team_sk", "dim_team", "team_sk"),
    ("fact_national_performance", "first_game_date_sk", "dim_date", "date_sk"),
    ("fact_teammate_relationship", "player_sk", "dim_player", "player_sk"),
    ("fact_teammate_relationship", "teammate_player_sk", "dim_player", "player_sk"),
    ("fact_player_season_summary", "player_sk", "dim_player", "player_sk"),
    ("fact_player_season_summary", "season_sk", "dim_season", "season_sk"),
)
DIMENSION_KEYS = {"dim_date": "date_value", "dim_season": "season_name", "dim_competition": "competition_id",
                  "dim_team": "team_nk", "dim_agent": "agent_id", "dim_transfer_type": "transfer_type_code"}
FACT_GRAINS = {
    "fact_market_value": ("player_sk", "date_sk", "value_source"),
    "fact_national_performance": ("player_sk", "national_team_sk"),
    "fact_teammate_relationship": ("player_sk", "teammate_player_sk"),
    "fact_player_season_summary": ("player_sk", "season_sk"),
}


def table_conditions() -> dict[str, dict[str, Column]]:
    """Q1, Q5, Q9, Q10, Q13, Q14: every condition on a row, by table."""
    current = F.col("is_current")
    return {
        "dim_date": {
            "quarter_out_of_range": ~F.col("quarter").between(1, 4), "month_out_of_range": ~F.col("month").between(1, 12),
            "day_out_of_range": ~F.col("day").between(1, 31), "dow_out_of_range": ~F.col("day_of_week").between(0, 6),
            **_null("date_value", "year", "quarter", "month", "month_name", "day", "day_of_week", "day_name",
                    "week_of_year", "is_weekend")},
        "dim_season": {"season_years_inconsistent": F.col("season_end_year") != F.col("season_start_year") + 1,
                       **_null("season_name", "season_start_year", "season_end_year")},
        "dim_competition": _null("competition_id", "competition_name"),
        "dim_team": _null("team_nk", "team_name"),
        "dim_agent": _null("agent_id", "agent_name"),
        "dim_player": {"current_without_agent": current & F.col("agent_sk").isNull(),
                       **_null("player_nk", "player_name", "valid_from", "is_current")},
        "dim_injury_type": _null("injury_category"),
        "dim_transfer_type": _null("transfer_type_code", "transfer_type_name"),
        "fact_player_performance": _negative("goals", "assists"),
        "fact_market_value": {**_negative("market_value"), **_null("player_sk", "date_sk", "market_value")},
        "fact_transfer": _negative("transfer_fee", "value_at_transfer"),
        "fact_injury": {**_negative("days_missed", "games_missed"), **_null("player_sk")},
        "fact_national_performance": {"negative_matches": F.col("total_matches") < 0, "negative_goals": F.col("total_goals") < 0,
                                      **_null("player_sk")},
        "fact_teammate_relationship": {"negative_minutes": F.col("minutes_played_together") < 0,
                                       "self_pair": F.col("player_sk") == F.col("teammate_player_sk"),
                                       **_null("player_sk", "teammate_player_sk")},
        "fact_player_season_summary": _null("player_sk", "season_sk"),
    }


# Q1: the three facts of the reference's view, under its literal names and with their row counts.
QUALITY_VIEW = {
    "fact_player_performance": ("Fact Player Performance", lambda: {
        "null_player_sk": F.col("player_sk").isNull(), "null_team_sk": F.col("team_sk").isNull(),
        "negative_goals": F.col("goals") < 0, "negative_minutes": F.col("minutes_played") < 0}),
    "fact_market_value": ("Fact Market Value", lambda: {
        "null_player_sk": F.col("player_sk").isNull(), "null_date_sk": F.col("date_sk").isNull(),
        "negative_value": F.col("market_value") < 0}),
    "fact_transfer": ("Fact Transfer", lambda: {
        "null_player_sk": F.col("player_sk").isNull(),
        "both_teams_null": F.col("from_team_sk").isNull() & F.col("to_team_sk").isNull(),
        "negative_fee": F.col("transfer_fee") < 0}),
}


def quality_view(fact_perf: DataFrame, fact_value: DataFrame, fact_transfer: DataFrame) -> DataFrame:
    """Q1: ``v_data_quality_checks`` in long form."""
    facts = dict(zip(QUALITY_VIEW, (fact_perf, fact_value, fact_transfer)))
    return _union([count_checks(facts[t], label, conditions()) for t, (label, conditions) in QUALITY_VIEW.items()])


def _conditions_of(df: DataFrame, table: str, conditions: Mapping[str, Column]) -> DataFrame:
    """The table's conditions and, for the view's facts, the view's, in one aggregate."""
    label, more = QUALITY_VIEW.get(table, (None, dict))
    view = {f"\x1f{k}": v for k, v in more().items()}
    wide = count_checks(df, table, {**conditions, **view}, total="\x1ftotal_rows" if label else None)
    of_view = F.col("check_name").startswith("\x1f")
    return wide.select(F.when(of_view, F.lit(label)).otherwise(F.col("table_name")).alias("table_name"),
                       F.ltrim(F.col("check_name"), F.lit("\x1f")).alias("check_name"), "failures")


def warehouse_checks(wh: Mapping[str, DataFrame]) -> DataFrame:
    """Q1–Q14 over a built warehouse (dict of table name → DataFrame)."""
    out = [_conditions_of(wh[t], t, conditions) for t, conditions in table_conditions().items()]
    # Q4, Q11, Q7
    keys = [("dim_player", ["player_nk"], "duplicate_current_player_nk", F.col("is_current"))]
    keys += [(t, [nk], None, None) for t, nk in DIMENSION_KEYS.items()]
    keys += [(t, list(grain), None, None) for t, grain in FACT_GRAINS.items()]
    out.append(duplicate_checks(keys, wh))
    out.append(validity_overlap_check(wh["dim_player"], "player_nk", "dim_player"))
    out.append(wh["dim_season"].agg(F.lit("dim_season").alias("table_name"),
                                    F.lit("current_season_count_not_1").alias("check_name"),
                                    F.abs(F.count_if(F.col("is_current_season")) - 1).cast("long").alias("failures")))
    out.append(foreign_key_checks(WAREHOUSE_FOREIGN_KEYS, wh))
    return _union(out)


STAGING_FOREIGN_KEYS = ("player_injuries", "player_market_value", "player_latest_market_value",
                        "player_national_performances", "player_performances", "player_teammates_played_with",
                        "transfer_history")


def staging_checks(st: Mapping[str, DataFrame]) -> DataFrame:
    """Q12 on staging: every player_id of a dependent source is a profile."""
    keys = [(t, "player_id", "player_profiles", "player_id") for t in STAGING_FOREIGN_KEYS if t in st]
    if "player_teammates_played_with" in st:
        keys.append(("player_teammates_played_with", "teammate_player_id", "player_profiles", "player_id"))
    return foreign_key_checks(keys, st).unionByName(duplicate_check(st["player_profiles"], ["player_id"], "player_profiles"))
