"""CSV files with quoted line breaks, read in many splits, against pandas."""

import csv
import os
import random

import pandas as pd
import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from starloom.plans import warehouse as W
from starloom.sources import csv_records
from starloom.sources.readers import read_csv_text, read_csv_typed

SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("note", StringType())])


@pytest.fixture()
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def rows(seed, n=200):
    rng = random.Random(seed)
    texts = ["plain", "a,b", 'say "hi"', "two\nlines", '"\n"', "x\n\n\ny", "\n" * 3 + "end", 'quote at end"', "ü,\n中", "long\n" * 300]
    return [(i, rng.choice(texts), rng.choice(texts)) for i in range(n)]


def write(path, data, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["id", "name", "note"])
        w.writerows(data)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_equal_pandas(spark, tmp_dir, small_splits, end):
    folder = os.path.join(tmp_dir, "in")
    os.makedirs(folder)
    for k in range(3):  # a folder of files, each with its header
        write(os.path.join(folder, f"{k}.csv"), rows(k), end)
    assert csv_records.has_quoted_breaks(spark, folder)
    frame = read_csv_text(spark, folder, SCHEMA)
    want = pd.concat(pd.read_csv(os.path.join(folder, f"{k}.csv"), dtype=str, keep_default_na=False) for k in range(3))
    got = sorted((r.id, r.name, r.note) for r in frame.collect())
    assert got == sorted(want.itertuples(index=False, name=None))
    lines = csv_records._lines(spark, folder)
    assert lines.rdd.getNumPartitions() > 20  # records run over many splits


def test_records_over_several_splits(spark, tmp_dir, small_splits):
    path = os.path.join(tmp_dir, "x.csv")
    huge = "line, with \"quotes\"\n" * 400
    write(path, [(1, huge, "a"), (2, "b", huge), (3, "c", "d\ne")])
    got = sorted((r.id, r.name, r.note) for r in read_csv_typed(spark, path, SCHEMA).collect())
    assert got == [(1, huge, "a"), (2, "b", huge), (3, "c", "d\ne")]


def test_a_quote_inside_an_unquoted_field_is_text(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x.csv")
    with open(path, "w") as f:
        f.write('id,name,note\n1,5" pipe,x\n2,b,"two\nlines"\n3,c" d",y\n')
    got = [(r.id, r.name, r.note) for r in read_csv_typed(spark, path, SCHEMA).collect()]
    want = pd.read_csv(path, dtype=str)
    assert sorted(got) == sorted((int(a), b, c) for a, b, c in want.itertuples(index=False, name=None))


def test_states():
    assert csv_records.ends_inside('a,"b', False) and not csv_records.ends_inside('a,"b"', False)
    assert csv_records.ends_inside('a,"b ""c', False) and not csv_records.ends_inside('x"', True)
    assert not csv_records.ends_inside('5" pipe', False) and csv_records.ends_inside('x",y,"', True)
    ends = [("f", 0, True, True, True), ("f", 10, False, True, False), ("f", 20, True, True, True), ("f", 30, False, False, True)]
    # the record begun in the first split runs through the second into the third, where another one begins
    assert csv_records.first_states(ends) == {("f", 0): (False, 0), ("f", 10): (True, 0), ("f", 20): (True, 0), ("f", 30): (True, 20)}


def test_files_without_quoted_breaks_keep_the_plain_reader(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x.csv")
    write(path, [(1, "a,b", 'say "hi"'), (2, "", "z")])
    assert not csv_records.has_quoted_breaks(spark, path)
    assert [(r.id, r.name, r.note) for r in read_csv_typed(spark, path, SCHEMA).orderBy("id").collect()] == [(1, "a,b", 'say "hi"'), (2, None, "z")]


def test_empty_and_header_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x.csv")
    write(path, [])
    assert read_csv_typed(spark, path, SCHEMA).count() == 0 and read_csv_typed(spark, path, SCHEMA, multi_line=True).count() == 0


def test_failed_reload_leaves_the_old_rows(spark, tmp_dir):
    src, stage = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "stage")
    os.makedirs(src)
    name = "player_market_value"
    with open(os.path.join(src, f"{name}.csv"), "w") as f:
        f.write("player_id,date_unix,value\n1,2024-01-01,5\n2,2024-01-02,6\n3,2024-01-03,7\n")
    W.load_staging(spark, src, stage, [name])
    real = W.read_source

    def broken(spark, src, source):  # fails while rows are written, after the first ones
        from pyspark.sql import functions as F

        df = real(spark, src, source)
        return df.withColumn("value", F.when(F.col("player_id") == 3, F.raise_error(F.lit("disk full")).cast("decimal(15,2)")).otherwise(F.col("value")))

    W.read_source = broken
    try:
        status = W.load_staging(spark, src, stage, [name]).first()
    finally:
        W.read_source = real
    assert status.status.startswith("failed") and W.read_staging(spark, stage)[name].count() == 3
