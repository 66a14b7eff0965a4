import random

from pyspark.sql import functions as F

from starloom.operators.keys import get_or_create_members, lookup_sk, sequence_keys
from starloom.operators.merge import insert_if_absent, pick_one, upsert


def test_sequence_keys_equals_row_number(spark):
    random.seed(7)
    rows = [(random.randint(0, 50), random.choice("abcde"), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k INT, s STRING, i INT").repartition(5)
    out = sequence_keys(df, ["k", "s", "i"], "sk", start=10, num_partitions=7).collect()
    expect = {r: 11 + n for n, r in enumerate(sorted(rows))}
    assert {(r.k, r.s, r.i): r.sk for r in out} == expect


def test_sequence_keys_descending_nulls_last(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (2,)], "v INT")
    out = sequence_keys(df, [("v", "desc", "last")], "sk").orderBy("sk").collect()
    assert [r.v for r in out] == [3, 2, 1, None]


def test_pick_one_orders(spark):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 9, "a"), (1, None, "c"), (2, None, "x"), (2, None, "w")], "k INT, v INT, s STRING")
    hi = {r.k: (r.v, r.s) for r in pick_one(df, ["k"], [("v", "desc", "last"), "s"]).collect()}
    assert hi == {1: (9, "a"), 2: (None, "w")}
    lo_nulls_first = {r.k: (r.v, r.s) for r in pick_one(df, ["k"], ["v", "s"]).collect()}
    assert lo_nulls_first == {1: (None, "c"), 2: (None, "w")}


def test_upsert_updates_inserts_and_keeps_keys(spark):
    existing = spark.createDataFrame([(1, "10", "A", "x"), (2, "20", "B", "y"), (3, "30", "C", "z")],
                                     "sk LONG, nk STRING, name STRING, extra STRING")
    batch = spark.createDataFrame([("20", "B2"), ("30", None), ("05", "E"), ("40", "D"), (None, "X")],
                                  "nk STRING, name STRING")
    out = {r.nk: (r.sk, r.name, r.extra) for r in upsert(existing, batch, "nk", "sk", ["name"]).collect()}
    assert out["10"] == (1, "A", "x")
    assert out["20"] == (2, "B2", "y")
    assert out["30"] == (3, None, "z")  # EXCLUDED.* overwrites with NULL too
    assert out["05"] == (4, "E", None) and out["40"] == (5, "D", None)  # new keys in key order
    assert None not in out                                             # NULL keys never become members


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([(1, "Other", "Low")], "sk LONG, cat STRING, sev STRING")
    batch = spark.createDataFrame([("Other", "Low"), ("Joint", "Medium"), ("Joint", "Medium")], "cat STRING, sev STRING")
    out = sorted((r.sk, r.cat, r.sev) for r in insert_if_absent(existing, batch, ["cat", "sev"], "sk").collect())
    assert out == [(1, "Other", "Low"), (2, "Joint", "Medium")]
    again = insert_if_absent(spark.createDataFrame(out, "sk LONG, cat STRING, sev STRING"), batch, ["cat", "sev"], "sk")
    assert again.count() == 2


def test_get_or_create_members(spark):
    dim = spark.createDataFrame([(1, 100, "Ann"), (2, 300, "Bob")], "sk LONG, nk INT, name STRING")
    keys = spark.createDataFrame([(100,), (200,), (None,), (400,), (200,)], "nk INT")
    out = {r.nk: (r.sk, r.name, r.is_inferred) for r in get_or_create_members(
        dim, keys, "nk", "sk", {"name": F.lit("Unknown")}).collect()}
    assert out == {100: (1, "Ann", False), 300: (2, "Bob", False), 200: (3, "Unknown", True),
                   400: (4, "Unknown", True)}


def test_lookup_cast_and_null_keys(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id INT, club INT")
    dim = spark.createDataFrame([(7, "10")], "team_sk LONG, team_nk STRING")
    left = {r.id: r.team_sk for r in lookup_sk(fact, dim, "club", "team_nk", "team_sk", cast_to="string").collect()}
    assert left == {1: 7, 2: None, 3: None}
    inner = lookup_sk(fact, dim, "club", "team_nk", "team_sk", cast_to="string", how="inner")
    assert [r.id for r in inner.collect()] == [1]
