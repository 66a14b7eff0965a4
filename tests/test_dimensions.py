import datetime as dt

from pyspark.sql import functions as F

from starloom.operators import dimensions as D


def test_calendar_range_and_extension(spark):
    cal = D.calendar(spark, "2010-01-01", "2030-12-31")
    assert cal.count() == 7670                       # the reference's initial calendar
    assert cal.where("date_sk = 20240229").count() == 1
    dates = spark.createDataFrame([(dt.date(2031, 1, 1),), (None,), (dt.date(2020, 5, 5),), (dt.date(2031, 1, 1),)],
                                  "d DATE")
    ext = D.extend_calendar(cal, dates, "d")
    assert ext.count() == 7671                       # one new day; NULL never becomes a member
    row = ext.where("date_value = DATE '2031-01-01'").first()
    assert (row.date_sk, row.season_name, row.day_name) == (20310101, "30/31", "Wednesday")


def test_calendar_covering_whole_years(spark):
    dates = spark.createDataFrame([(dt.datetime(1999, 3, 4),), (dt.datetime(2000, 7, 1),)], "d TIMESTAMP_NTZ")
    cal = D.calendar_covering(dates, "d")
    assert cal.agg(F.min("date_value"), F.max("date_value"), F.count("*")).first() == (
        dt.date(1999, 1, 1), dt.date(2000, 12, 31), 731)


def test_season_dimension_and_upsert(spark):
    names = spark.createDataFrame([("23/24",), ("99/00",), ("abc",), (None,), ("23/24",)], "season_name STRING")
    s = D.dim_season(names)
    got = {r.season_name: (r.season_sk, r.season_start_year, r.is_current_season) for r in s.collect()}
    assert got == {"99/00": (1, 1999, False), "23/24": (2, 2023, True), "abc": (3, None, False)}
    later = spark.createDataFrame([("24/25",), ("23/24",)], "season_name STRING")
    s2 = {r.season_name: (r.season_sk, r.is_current_season) for r in D.dim_season(later, existing=s).collect()}
    assert s2 == {"99/00": (1, False), "23/24": (2, False), "abc": (3, False), "24/25": (4, True)}


def test_team_upsert_keeps_keys(spark):
    schema = ("club_id INT, club_slug STRING, club_name STRING, logo_url STRING, country_name STRING, season_id INT, "
              "competition_name STRING, club_division STRING, _last_modified_at TIMESTAMP")
    first = spark.createDataFrame([(10, None, "A", None, "ES", 2023, "La Liga", "First Tier", None),
                                   (20, None, "B", None, None, 2023, None, "2. Liga", None)], schema)
    t1 = D.dim_team(first)
    second = spark.createDataFrame([(20, None, "B new", None, "EN", 2024, "PL", "Tier 3", None),
                                    (5, None, "C", None, "FR", 2024, "L1", None, None)], schema)
    t2 = {r.team_nk: (r.team_sk, r.team_name, r.country_name, r.division_level)
          for r in D.dim_team(second, existing=t1).collect()}
    assert t2 == {"10": (1, "A", "ES", "99"), "20": (2, "B new", "EN", "3"), "5": (3, "C", "FR", "99")}


def test_transfer_type_seed_and_injury_types(spark):
    tt = {r.transfer_type_code: (r.transfer_type_sk, r.is_free_transfer, r.is_loan)
          for r in D.dim_transfer_type(spark).collect()}
    assert tt["FREE"] == (2, True, False) and tt["LOAN"] == (3, False, True) and len(tt) == 6
    inj = spark.createDataFrame([("Muscle tear",), ("Flu",), (None,)], "injury_reason STRING")
    first = D.dim_injury_type(inj)
    assert first.count() == 2
    more = spark.createDataFrame([("Knee fracture",), ("Flu",)], "injury_reason STRING")
    both = {(r.injury_category, r.injury_type_sk)
            for r in D.dim_injury_type(more, existing=first).collect()}
    assert ("Bone/Ligament", 3) in both and len(both) == 3
