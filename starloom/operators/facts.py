"""Fact builders X1–X6 over the staging tables (set-based INSERT … SELECT).

Every natural key is resolved to a surrogate key by a join whose kind is
stated: the player must exist (``unknown='drop'`` reproduces the reference's
inner joins, T8; ``'member'`` first adds inferred members, J8), the other
dimensions are optional (left joins, NULL key when unknown).  Dimensions are
joined unhinted unless their size is bounded (calendar, seeds), so AQE picks a
broadcast when the measured size allows it and a shuffle join otherwise.

Equal source rows are combined into one with their number before anything is
shuffled, and a fact row's key is the hash of its source row and its ordinal
among the equal ones (W1): the key needs no order, and a row has the same key
in every run.  Each builder's ``split_*`` form returns all source rows, the
accepted ones as fact rows (``reject_reason`` NULL, one row each) and the
others with the reason and their number in ``n_rows``, so that rows in = rows
out + rows by reason.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..session import scratch_path, shuffles_released
from .keys import content_key, frequent_keys, get_or_create_members, has_few_members, lookup_sk
from .merge import order_value
from .windows import previous_in_group

REASON, ROWS = "reject_reason", "n_rows"
_CONTENT = "__content"

# Our rules (the reference gives none) from transfer text to a seeded code;
# ordered, first match wins, substring match on the lower-cased text.
TRANSFER_TYPE_RULES = (
    (("end of loan",), "END_LOAN"),
    (("loan return", "return from loan"), "LOAN_RETURN"),
    (("loan",), "LOAN"),
    (("free",), "FREE"),
    (("?", "-", "unknown"), "UNKNOWN"),
)


# A grain that a sample (1 %) of the source holds this often, or more, is dealt out by content.
HOT_GRAIN = 100

# An inferred member is valid from before any fact.
INFERRED_VALID_FROM = "1900-01-01 00:00:00"


def transfer_type_code(text: str | Column, rules=TRANSFER_TYPE_RULES, default: str = "PERMANENT") -> Column:
    t = F.lower(F.col(text) if isinstance(text, str) else text)
    out = None
    for words, code in rules:
        cond = None
        for w in words:
            cond = t.contains(w) if cond is None else cond | t.contains(w)
        out = F.when(cond, F.lit(code)) if out is None else out.when(cond, F.lit(code))
    return F.when(t.isNull() | (F.trim(t) == ""), F.lit("UNKNOWN")).otherwise(out.otherwise(F.lit(default)))


def _lookups(source: DataFrame, spread: bool, *asked: tuple) -> Callable[[DataFrame], DataFrame]:
    """Lookups of (kind, dimension, key, out) in a frame that holds the keys of ``source``.

    With ``spread`` a small dimension is sent to every task; of a large one
    the members of the keys that ``source`` holds often.
    """
    steps, small = [], {}
    for kind, dim, key, out in asked:
        how = {"dim_key": "player_nk", "sk_col": "player_sk", "current_only": True} if kind == "player" else {
            "dim_key": "team_nk", "sk_col": "team_sk", "cast_to": "string"}
        if spread:
            few = small[kind] = small[kind] if kind in small else has_few_members(dim)
            k = F.col(key).cast(how["cast_to"]) if "cast_to" in how else F.col(key)
            how |= {"few": True} if few else {"hot": frequent_keys(source, k)}
        steps.append((dim, {"fact_key": key, "out_col": out, **how}))
    return lambda f: reduce(lambda g, step: lookup_sk(g, step[0], **step[1]), steps, f)


def _copies(source: DataFrame) -> DataFrame:
    """Equal source rows once, with their number and the hash of their content."""
    cells = source.groupBy(*source.columns).agg(F.count(F.lit(1)).alias(ROWS))
    return cells.withColumn(_CONTENT, content_key(source.columns))


def _settled(f: DataFrame) -> DataFrame:
    """Rows that several readers use, stored in the shared folder and so made once."""
    path = scratch_path(f.sparkSession, "rows")
    with shuffles_released(f.sparkSession):
        f.write.option("compression", "zstd").parquet(path)
    return f.sparkSession.read.schema(f.schema).parquet(path)


def _reason(*rules: tuple[str, Column]) -> Column:
    """The first rule that holds, NULL for an accepted row."""
    out = F.lit(None).cast("string")
    for name, cond in reversed(rules):
        out = F.when(cond, F.lit(name)).otherwise(out)
    return out


def _unknown(unknown: str, *rules: tuple[str, Column]) -> list[tuple[str, Column]]:
    """Rules that hold only where unknown members aren't created."""
    return list(rules) if unknown == "drop" else []


def _record(*cols: str) -> Column:
    """The source record's own key, NULL parts as ''."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]).alias("source_record_id")


def _keyed(f: DataFrame, sk: str, run_ts) -> DataFrame:
    """Accepted rows one by one under their keys; rejected ones keep their number."""
    accepted = F.col(REASON).isNull()
    f = f.withColumn("__ordinal", F.explode(F.when(accepted, F.sequence(F.lit(1).cast("long"), F.col(ROWS))).otherwise(
        F.array(F.lit(1).cast("long")))))
    key = F.when(accepted, F.unhex(F.md5(F.concat(F.lower(F.hex(_CONTENT)), F.lit("|"), F.col("__ordinal").cast("string")))))
    loaded = F.current_timestamp().cast("timestamp_ntz") if run_ts is None else F.lit(run_ts).cast("timestamp_ntz")
    f = f.withColumn(sk, key).withColumn(ROWS, F.when(accepted, F.lit(1).cast("long")).otherwise(F.col(ROWS)))
    f = f.withColumn("load_datetime", loaded)
    rest = [c for c in f.columns if c not in (sk, REASON, ROWS, _CONTENT, "__ordinal")]
    return f.select(sk, *rest, REASON, ROWS)


def _one_per_grain(rows: Callable[[DataFrame], DataFrame], source: DataFrame, ids: Sequence[str], grain: Sequence[str],
                   prefer: Sequence, spread: bool) -> DataFrame:
    """Of the accepted rows of a grain the first by ``prefer`` (then by content) stays; the others are duplicates.

    ``rows`` makes the fact's rows of source rows, and the columns ``ids`` of
    the source stand for its grain.  The rows are dealt by their grain once
    and the first of each is met there.  With ``spread``, grains that a sample of
    the source holds often are told apart: their winners come from a combined
    aggregate (HOT_KEYS rows at the most) and their rows are dealt by content,
    as rejected ones are, so a grain of any size is never one task.
    """
    f = rows(source)
    order = lambda g: [v for item in prefer for v in order_value(g, item)] + [F.col(_CONTENT)]
    accepted, alone = F.col(REASON).isNull(), F.col(REASON).isNotNull()
    id_hash = F.xxhash64(*ids)
    hot = [r[0] for r in frequent_keys(source, id_hash, least=HOT_GRAIN).collect()] if spread else []  # HOT_KEYS numbers at the most
    first = F.row_number()
    won = accepted
    if hot:
        many = rows(source.where(id_hash.isin(hot))).where(accepted)
        best = many.groupBy(*grain).agg(F.min_by(_CONTENT, F.struct(*order(many))).alias("__best"))
        best = best.select(*[F.col(g).alias(f"__hot_{g}") for g in grain], "__best")
        same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"__hot_{g}")) for g in grain])
        f = f.join(F.broadcast(best), same, "left")
        alone = alone | F.col("__best").isNotNull()
        won = won & (F.col("__best").isNull() | (F.col(_CONTENT) == F.col("__best")))
    dealt = Window.partitionBy(*grain, F.when(alone, F.col(_CONTENT))).orderBy(*order(f))
    f = f.withColumn("__won", won & (first.over(dealt) == 1))
    # the winner itself, then its own copies or the whole row as duplicates
    one = lambda reason, n: F.struct(reason.cast("string").alias("r"), n.cast("long").alias("n"))
    duplicate = F.lit("duplicate")
    parts = (F.when(~accepted, F.array(one(F.col(REASON), F.col(ROWS))))
             .when(F.col("__won"), F.array(one(F.lit(None), F.lit(1)), one(duplicate, F.col(ROWS) - 1)))
             .otherwise(F.array(one(duplicate, F.col(ROWS)))))
    f = f.withColumn("__part", F.explode(parts)).where(F.col("__part.n") > 0)
    return f.withColumn(REASON, F.col("__part.r")).withColumn(ROWS, F.col("__part.n")).drop(
        "__part", "__won", "__best", *[f"__hot_{g}" for g in grain])


def accepted(split: DataFrame) -> DataFrame:
    """The fact rows of a split."""
    return split.where(F.col(REASON).isNull()).drop(REASON, ROWS)


def rejected(split: DataFrame) -> DataFrame:
    """The rejected rows of a split: source record, reason and number."""
    return split.where(F.col(REASON).isNotNull())


def ensure_players(players: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """J8 for the player dimension: inferred current members named 'Unknown'."""
    k = keys.select(F.col(key).cast("int").alias("player_nk"))
    return get_or_create_members(
        players, k, "player_nk", "player_sk",
        defaults={"player_name": F.lit(X.UNKNOWN_TEXT), "is_current": F.lit(True),
                  "valid_from": F.lit(INFERRED_VALID_FROM).cast("timestamp_ntz"),
                  "source_row_hash": F.md5(F.lit("inferred"))},
    )


def ensure_teams(teams: DataFrame, keys: DataFrame) -> DataFrame:
    """Inferred teams for team keys the facts use (name 'Unknown')."""
    return get_or_create_members(teams, keys.select(F.col("team_nk").cast("string")), "team_nk", "team_sk", {
        "team_name": F.lit(X.UNKNOWN_TEXT), "country_name": F.lit(X.UNKNOWN_TEXT),
        "primary_competition_id": F.lit(X.UNKNOWN_TEXT), "division_level": F.lit(str(X.UNKNOWN_TIER)),
        "is_active": F.lit(True)})


def ensure_competitions(comps: DataFrame, names: DataFrame) -> DataFrame:
    """Inferred competitions (slug key) for competition names the facts use."""
    keys = names.where(F.col("competition_name").isNotNull()).select(
        X.slug("competition_name").alias("competition_id"), "competition_name")
    return get_or_create_members(comps, keys, "competition_id", "competition_sk", {
        "competition_name": F.col("competition_name"), "competition_slug": F.col("competition_id"),
        "tier_level": F.lit(X.UNKNOWN_TIER)})


def ensure_seasons(seasons: DataFrame, names: DataFrame) -> DataFrame:
    """Inferred seasons, years parsed by the same rule as the dimension."""
    y = X.season_years("season_name")
    return get_or_create_members(seasons, names.select("season_name"), "season_name", "season_sk", {
        "season_start_year": y.getField("start_year"), "season_end_year": y.getField("end_year"),
        "is_current_season": F.lit(False)})


def split_player_performance(perf: DataFrame, players: DataFrame, teams: DataFrame, comps: DataFrame,
                             seasons: DataFrame, unknown: str = "drop", run_ts=None, spread: bool = True) -> DataFrame:
    """X1 with the rejected rows: player × season × competition × team rows with per-match rates."""
    found = _lookups(perf, spread, ("player", players, "player_id", "player_sk"), ("team", teams, "team_id", "team_sk"))
    f = found(_copies(perf).withColumn("__comp", X.slug("competition_name")))
    f = lookup_sk(f, comps, "__comp", "competition_id", "competition_sk")
    f = lookup_sk(f, seasons, "season_name", "season_name", "season_sk")
    f = f.select(
        "player_sk", "team_sk", "competition_sk", "season_sk", "season_name", "competition_name",
        "nb_in_group", "nb_on_pitch", "goals", "assists", "own_goals", "subed_in", "subed_out",
        "yellow_cards", "second_yellow_cards", "direct_red_cards", "penalty_goals", "minutes_played",
        "goals_conceded", "clean_sheets",
        X.rate("goals", "nb_on_pitch").alias("goals_per_match"),
        X.rate("assists", "nb_on_pitch").alias("assists_per_match"),
        X.rate("minutes_played", "goals", scale=2).alias("minutes_per_goal"),
        (F.col("yellow_cards") + F.col("second_yellow_cards") + F.col("direct_red_cards")).alias("cards_total"),
        F.lit("club").alias("source_system"), _record("player_id", "season_name", "competition_id", "team_id"),
        _reason(*_unknown(unknown, ("unknown_player", F.col("player_sk").isNull()))).alias(REASON), ROWS, _CONTENT)
    return _keyed(f, "performance_sk", run_ts)


def value_date(df: DataFrame, c: str) -> Column:
    """``date_unix`` is a DATE in the DDL; epoch seconds are accepted too."""
    col = F.col(c)
    t = df.schema[c].dataType.typeName()
    if t == "date":
        return col
    if t.startswith("timestamp"):
        return col.cast("date")
    if t == "string":
        return F.coalesce(col.try_cast("date"), X.epoch_to_date(col.try_cast("long")))
    return X.epoch_to_date(col.cast("long"))


def split_market_value(history: DataFrame, latest: DataFrame, players: DataFrame, unknown: str = "drop",
                       include_latest: bool = True, run_ts=None, spread: bool = True) -> DataFrame:
    """X2 with the rejected rows: both value sources tagged by ``value_source`` (T20), with the
    change against the previous value of the same player and source (W2)."""
    src = history.select("player_id", value_date(history, "date_unix").alias("value_date"),
                         X.to_money("value").alias("market_value"), F.lit("historical").alias("value_source"))
    if include_latest:
        src = src.unionByName(latest.select("player_id", value_date(latest, "date_unix").alias("value_date"),
                                            X.to_money("value").alias("market_value"),
                                            F.lit("latest").alias("value_source")))
    found = _lookups(src, spread, ("player", players, "player_id", "player_sk"))

    def rows(src: DataFrame) -> DataFrame:
        f = found(_copies(src)).withColumn("date_sk", X.date_key("value_date"))
        return f.withColumn(REASON, _reason(("no_date", F.col("value_date").isNull()), ("no_value", F.col("market_value").isNull()),
                                            *_unknown(unknown, ("unknown_player", F.col("player_sk").isNull()))))

    # UNIQUE(player_sk, date_sk, value_source): the highest value of a day; the constraint keeps
    # NULL keys apart, so the source id stands in for an unknown player
    f = _settled(_one_per_grain(rows, src, ["player_id", "value_date", "value_source"],
                                ["player_sk", "player_id", "date_sk", "value_source"], [("market_value", "desc", "last")], spread))
    good = previous_in_group(f.where(F.col(REASON).isNull()), ["player_sk", "player_id", "value_source"], ["date_sk"],
                             ["market_value"], span=F.trunc("value_date", "month"), prefix="__previous_")
    f = good.withColumnRenamed("__previous_market_value", "previous_value").unionByName(
        f.where(F.col(REASON).isNotNull()), allowMissingColumns=True)
    f = f.select(
        "player_sk", "date_sk", "value_date", "market_value", (F.col("value_source") == "latest").alias("is_latest_value"),
        "value_source", "previous_value", (F.col("market_value") - F.col("previous_value")).cast("decimal(15,2)").alias("value_change"),
        X.pct_change("market_value", "previous_value").alias("value_change_pct"),
        _record("player_id", "value_date", "value_source"), REASON, ROWS, _CONTENT)
    return _keyed(f, "market_value_sk", run_ts)


def split_transfer(transfers: DataFrame, players: DataFrame, teams: DataFrame, seasons: DataFrame,
                   transfer_types: DataFrame, unknown: str = "drop", run_ts=None, spread: bool = True) -> DataFrame:
    """X3 with the rejected rows: from/to team in two roles (J4), type text → seeded code (our rules)."""
    f = _lookups(transfers, spread, ("player", players, "player_id", "player_sk"), ("team", teams, "from_team_id", "from_team_sk"),
                 ("team", teams, "to_team_id", "to_team_sk"))(_copies(transfers))
    f = lookup_sk(f, seasons, "season_name", "season_name", "season_sk")
    f = f.withColumn("__code", transfer_type_code("transfer_type"))
    f = lookup_sk(f, F.broadcast(transfer_types), "__code", "transfer_type_code", "transfer_type_sk")
    f = f.select(
        "player_sk", "from_team_sk", "to_team_sk", X.date_key("transfer_date").alias("transfer_date_sk"),
        "season_sk", "transfer_type_sk", "season_name",
        X.to_money("transfer_fee").alias("transfer_fee"), X.to_money("value_at_transfer").alias("value_at_transfer"),
        X.rate("transfer_fee", "value_at_transfer").alias("fee_to_value_ratio"),
        F.col("transfer_type").alias("transfer_type_text"),
        _record("player_id", "transfer_date", "from_team_id", "to_team_id"),
        _reason(*_unknown(unknown, ("unknown_player", F.col("player_sk").isNull()))).alias(REASON), ROWS, _CONTENT)
    return _keyed(f, "transfer_sk", run_ts)


def split_injury(injuries: DataFrame, players: DataFrame, seasons: DataFrame, injury_types: DataFrame,
                 unknown: str = "drop", rules=X.INJURY_RULES, default=X.INJURY_DEFAULT, run_ts=None,
                 spread: bool = True) -> DataFrame:
    """X4 with the rejected rows: nullable from/end date keys (J6), injury type by the same rules."""
    f = _lookups(injuries, spread, ("player", players, "player_id", "player_sk"))(_copies(injuries))
    f = lookup_sk(f, seasons, "season_name", "season_name", "season_sk")
    f = f.withColumn("__c", X.categorize("injury_reason", rules, default))
    t = injury_types.select(F.col("injury_category").alias("__cat"), F.col("injury_severity").alias("__sev"),
                            "injury_type_sk")
    f = f.join(F.broadcast(t), (F.col("__c.category") == F.col("__cat")) & (F.col("__c.severity") == F.col("__sev")),
               "left")
    f = f.select(
        "player_sk", X.date_key("from_date").alias("injury_from_date_sk"),
        X.date_key("end_date").alias("injury_end_date_sk"), "season_sk", "injury_type_sk", "season_name",
        "injury_reason", "days_missed", "games_missed",
        X.rate("days_missed", "games_missed", scale=2).alias("avg_days_per_game"),
        X.severity_score("days_missed").alias("severity_score"),
        _record("player_id", "season_name", "from_date", "injury_reason"),
        _reason(*_unknown(unknown, ("unknown_player", F.col("player_sk").isNull()))).alias(REASON), ROWS, _CONTENT)
    return _keyed(f, "injury_sk", run_ts)


def split_national_performance(nat: DataFrame, players: DataFrame, teams: DataFrame, unknown: str = "drop",
                               run_ts=None, spread: bool = True) -> DataFrame:
    """X5 with the rejected rows: unique (player, national team); the row with most matches wins."""
    found = _lookups(nat, spread, ("player", players, "player_id", "player_sk"), ("team", teams, "team_id", "national_team_sk"))

    def rows(nat: DataFrame) -> DataFrame:
        return found(_copies(nat)).select(
            "player_sk", "national_team_sk", "player_id", "team_id", X.date_key("first_game_date").alias("first_game_date_sk"),
            "matches", "goals", _reason(*_unknown(unknown, ("unknown_player", F.col("player_sk").isNull()))).alias(REASON), ROWS, _CONTENT,
            # a unique constraint keeps NULLs apart: the source id stands in for an unknown one
            F.when(F.col("player_sk").isNull(), F.col("player_id")).alias("__u0"),
            F.when(F.col("national_team_sk").isNull(), F.col("team_id")).alias("__u1"))

    f = _one_per_grain(rows, nat, ["player_id", "team_id"], ["player_sk", "national_team_sk", "__u0", "__u1"],
                       [("matches", "desc", "last"), ("first_game_date_sk", "asc", "last"), ("goals", "desc", "last")], spread)
    f = f.select("player_sk", "national_team_sk", "first_game_date_sk", F.col("matches").alias("total_matches"),
                 F.col("goals").alias("total_goals"), X.rate("goals", "matches").alias("goals_per_match"),
                 _record("player_id", "team_id"), REASON, ROWS, _CONTENT)
    return _keyed(f, "national_performance_sk", run_ts)


def split_teammate_relationship(pairs: DataFrame, players: DataFrame, unknown: str = "drop", run_ts=None,
                                spread: bool = True) -> DataFrame:
    """X6 with the rejected rows: player twice (J4), self pairs dropped (P12), one row per pair (T19:
    most shared minutes, then most joint goals, then highest ppg)."""
    found = _lookups(pairs, spread, ("player", players, "player_id", "player_sk"),
                     ("player", players, "teammate_player_id", "teammate_player_sk"))
    # a pair with an unknown member is no self pair unless its source ids say so
    same = F.col("player_id").eqNullSafe(F.col("teammate_player_id")) | F.coalesce(
        F.col("player_sk") == F.col("teammate_player_sk"), F.lit(False))

    def rows(pairs: DataFrame) -> DataFrame:
        return found(_copies(pairs)).select(
            "player_sk", "teammate_player_sk", "player_id", "teammate_player_id", "minutes_played_with", "ppg_played_with",
            "joint_goal_participation",
            _reason(("self_pair", same), *_unknown(unknown, ("unknown_player", F.col("player_sk").isNull()),
                                                   ("unknown_teammate", F.col("teammate_player_sk").isNull()))).alias(REASON),
            ROWS, _CONTENT,
            F.when(F.col("player_sk").isNull(), F.col("player_id")).alias("__u0"),
            F.when(F.col("teammate_player_sk").isNull(), F.col("teammate_player_id")).alias("__u1"))

    f = _one_per_grain(rows, pairs, ["player_id", "teammate_player_id"], ["player_sk", "teammate_player_sk", "__u0", "__u1"],
                       [("minutes_played_with", "desc", "last"), ("joint_goal_participation", "desc", "last"),
                        ("ppg_played_with", "desc", "last")], spread)
    # what is derived from a row is made after the rows are dealt
    f = f.select("player_sk", "teammate_player_sk", F.col("minutes_played_with").alias("minutes_played_together"),
                 "ppg_played_with", "joint_goal_participation",
                 X.chemistry_score("joint_goal_participation", "minutes_played_with").alias("chemistry_score"),
                 _record("player_id", "teammate_player_id"), REASON, ROWS, _CONTENT)
    return _keyed(f, "teammate_fact_sk", run_ts)


def fact_player_performance(*args, **kwargs) -> DataFrame:
    """The accepted rows of :func:`split_player_performance`."""
    return accepted(split_player_performance(*args, **kwargs))


def fact_market_value(*args, **kwargs) -> DataFrame:
    """The accepted rows of :func:`split_market_value`."""
    return accepted(split_market_value(*args, **kwargs))


def fact_transfer(*args, **kwargs) -> DataFrame:
    """The accepted rows of :func:`split_transfer`."""
    return accepted(split_transfer(*args, **kwargs))


def fact_injury(*args, **kwargs) -> DataFrame:
    """The accepted rows of :func:`split_injury`."""
    return accepted(split_injury(*args, **kwargs))


def fact_national_performance(*args, **kwargs) -> DataFrame:
    """The accepted rows of :func:`split_national_performance`."""
    return accepted(split_national_performance(*args, **kwargs))


def fact_teammate_relationship(*args, **kwargs) -> DataFrame:
    """The accepted rows of :func:`split_teammate_relationship`."""
    return accepted(split_teammate_relationship(*args, **kwargs))


# --- append load (S7, S11) ------------------------------------------------------------

def not_loaded(stored: DataFrame, batch: DataFrame, sk: str, grain: str | None = None) -> DataFrame:
    """Rows of ``batch`` that the stored fact lacks.

    A row is loaded when its key is; with ``grain`` (the source record's own
    key, for facts with one row per record) also when its record is, whatever
    its measures now say: stored rows are never changed.
    """
    new = batch.join(stored.select(sk), sk, "left_anti")
    if grain:
        new = new.join(stored.select(grain).distinct(), grain, "left_anti")
    return new.select(*batch.columns)
