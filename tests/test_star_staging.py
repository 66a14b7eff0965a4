"""The star's staging sources, from lines that were joined with their orders once."""

import datetime as dt

from starloom.plans import star_staging as SS


def _tables(spark):
    day = dt.datetime(1999, 6, 30)
    part = [(1, "hot bolt", "B#1", "TYPE", 9.5), (1, "hot bolt again", "B#2", "TYPE", 1.5), (2, "plate", "B#1", None, None)]
    orders = [(1, 10, "F", day, "5-LOW"), (2, None, "O", day, "1-URGENT"), (2, 12, "O", None, None), (None, 13, "F", day, "5-LOW")]
    lines = [(o, p, 5, n, 2.0, 100.0, 0.04, 0.02, "R", "O", day) for o in (1, 2, 3, None) for p in (1, 2, 9, None) for n in (4, 7)]
    return {
        "part": spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double"),
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, "
                                                "o_orderpriority string"),
        "lineitem": spark.createDataFrame(lines + lines[:3], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                                          "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                                          "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    }


def test_sources_from_joined_lines(spark):
    """Four sources start from the same join; made once it gives each the rows it had, with NULL and repeated keys."""
    tables = _tables(spark)
    lines = SS.lines(spark, tables)
    assert not {"l_orderkey", "o_orderkey"} & set(lines.columns)
    of_lines = [n for n in SS.SOURCES if SS.of_lines(n)]
    assert sorted(of_lines) == ["player_injuries", "player_performances", "player_teammates_played_with", "transfer_history"]
    for name in of_lines:
        alone = SS.source(spark, name, tables)
        got = SS.source(spark, name, {"part": tables["part"], "lines": lines})
        assert got.schema == alone.schema
        assert sorted(map(str, got.collect())) == sorted(map(str, alone.collect()))
        assert alone.count() > 0
