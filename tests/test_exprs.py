import datetime as dt
import hashlib

from pyspark.sql import functions as F

from starloom.functions import exprs as X


def _one(spark, col, rows, schema="v STRING"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_season_years_edges(spark):
    rows = [("24/25",), ("99/00",), ("49/50",), ("50/51",), ("2024",), ("abc",), (None,), ("24/",), (" 24/25",)]
    got = _one(spark, X.season_years("v").alias("y"), rows)
    pairs = [(g.start_year, g.end_year) for g in got]
    assert pairs == [(2024, 2025), (1999, 2000), (2049, 2050), (1950, 1951), (2024, 2025),
                     (None, None), (None, None), (None, None), (2024, 2025)]


def test_categorize_first_match_wins(spark):
    rows = [("Muscle tear",), ("Ligament rupture",), ("Knee fracture",), ("Hip problem",), ("Flu",), (None,),
            ("Hamstring strain",)]
    got = [(r.category, r.severity) for r in _one(spark, X.categorize("v"), rows)]
    assert got == [("Muscular", "Medium"), ("Bone/Ligament", "High"), ("Bone/Ligament", "High"),
                   ("Joint", "Medium"), ("Other", "Low"), ("Other", "Low"), ("Muscular", "Medium")]


def test_tier_from_division(spark):
    rows = [("First Tier",), ("2. Liga",), ("Tier 10",), (None,)]
    assert _one(spark, X.first_digits_or("v"), rows) == [99, 2, 10, 99]


def test_slug(spark):
    assert _one(spark, X.slug("v"), [("La Liga",), ("PREMIER LEAGUE",)]) == ["la_liga", "premier_league"]


def test_row_hash_matches_reference_rule(spark):
    df = spark.createDataFrame([("Ann", None, "10", dt.date(2026, 6, 30), 3)],
                               "n STRING, p STRING, c STRING, e DATE, a INT")
    got = df.select(X.row_hash("n", "p", "c", "e", "a")).first()[0]
    assert got == hashlib.md5(b"Ann102026-06-303").hexdigest()
    sep = df.select(X.row_hash("n", "p", sep="|")).first()[0]
    assert sep == hashlib.md5(b"Ann|").hexdigest()


def test_calendar_columns(spark):
    days = [dt.date(2024, 6, 30), dt.date(2024, 7, 1), dt.date(2021, 1, 1), dt.date(2024, 1, 6), dt.date(2024, 1, 7)]
    df = spark.createDataFrame([(d,) for d in days], "d DATE").select(*X.calendar_columns("d"))
    r = {row.date_value: row for row in df.collect()}
    assert r[dt.date(2024, 6, 30)].season_name == "23/24"
    assert r[dt.date(2024, 7, 1)].season_name == "24/25"
    assert r[dt.date(2024, 7, 1)].date_sk == 20240701
    assert r[dt.date(2021, 1, 1)].week_of_year == 53
    assert r[dt.date(2024, 1, 6)].day_of_week == 6 and r[dt.date(2024, 1, 6)].is_weekend
    assert r[dt.date(2024, 1, 7)].day_of_week == 0 and r[dt.date(2024, 1, 7)].day_name == "Sunday"
    assert r[dt.date(2024, 7, 1)].month_name == "July" and r[dt.date(2024, 7, 1)].quarter == 3


def test_null_tokens_and_lenient_date(spark):
    rows = [("",), ("nan",), ("NaN",), ("x",), (None,)]
    assert _one(spark, X.null_if_blank("v"), rows) == [None, None, "NaN", "x", None]
    rows = [("2024-07-01",), ("2024/07/01",), ("01.07.2024",), ("Jul 1, 2024",), ("not a date",), (None,)]
    got = _one(spark, X.lenient_date("v"), rows)
    assert got[:4] == [dt.date(2024, 7, 1)] * 4 and got[4:] == [None, None]


def test_ratio_and_ladders(spark):
    df = spark.createDataFrame([(3, 0), (3, 2), (None, 2), (5, None)], "a INT, b INT")
    assert [r[0] and float(r[0]) for r in df.select(X.rate("a", "b")).collect()] == [None, 1.5, None, None]
    days = spark.createDataFrame([(0,), (7,), (8,), (90,), (181,), (None,)], "d INT")
    assert [r[0] for r in days.select(X.severity_score("d")).collect()] == [1, 1, 2, 3, 5, None]
    assert _one(spark, X.status_label("n"), [(0,), (3,)], "n INT") == ["EMPTY", "OK"]


def test_epoch_round_trip(spark):
    ts = dt.datetime(2024, 1, 1, 23, 59, 59)
    df = spark.createDataFrame([(ts,)], "t TIMESTAMP_NTZ")
    e = df.select(X.epoch_seconds("t").alias("e")).first()[0]
    assert e == 1704153599
    assert df.select(X.epoch_to_date(F.lit(e))).first()[0] == dt.date(2024, 1, 1)
