from collections import Counter

import numpy as np
import pytest

from starloom.llm import sharding, topk


def vectors(n=300, width=8, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(size=width)]) for i in range(n)]
    rows += [(i, rows[0][1]) for i in (1000, 1001, 1020, 1040)]  # ties
    return rows + [(2000, None), (2020, [1.0, None] * 4), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8), (None, [0.5] * 8), (3000, [0.25, -0.5]), (3020, []), (7, rows[7][1])]


def brute(rows, k=20, every=20):
    good = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in good:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    return out


@pytest.mark.parametrize("rows", [topk.ROWS, 32])
def test_top_k(spark, rows):
    data = vectors()
    frame = spark.createDataFrame([(i, v, 0) for i, v in data], "vec_id long, embedding array<double>, score int").repartition(3)
    got = [tuple(r) for r in topk.top_k(frame, rows=rows).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(data)


def test_few_and_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0]), (20, [2.0])], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in topk.top_k(few).collect()} == {(0, 1, 20, 64 * 128), (20, 1, 0, 64 * 128)}
    assert topk.top_k(few.where("false")).count() == 0


@pytest.mark.parametrize("size", [2.0**25, 3e7, 2.0**40, 2.0**52 + 1])
def test_wide_components(spark, size):
    """Scores beyond 2^53 and sums that 64 bits hold only by chance are exact; no finite vector is left out."""
    data = vectors(120) + [(5000 + i, [size * (i % 7 - 3) / 64] + [0.0] * 7) for i in range(40)]
    data += [(6000, [size / 64 + 1, -3.0] + [0.5] * 6), (6020, [1 / 64, size / 64] + [0.0] * 6)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    want = brute(data)
    if any(not -(2**63) <= s < 2**63 for *_, s in want):
        with pytest.raises(Exception, match="does not fit 64 bits"):
            topk.top_k(frame, rows=64).collect()
        return
    got = [tuple(r) for r in topk.top_k(frame, rows=64).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_scores_beyond_64_bits(spark):
    rows = [(0, [1e200, 0.0]), (20, [0.0, 1.0]), (1, [0.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.top_k(frame).collect()} == {(0, 1, 1, 0), (0, 2, 20, 0), (20, 1, 1, 64 * 192), (20, 2, 0, 0)}
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.top_k(frame.unionByName(spark.createDataFrame([(2, [1.0, 0.0])], frame.schema))).collect()


def test_bounds_hold_at_every_depth():
    rng = np.random.default_rng(2)
    matrix = rng.integers(-60, 60, (50, 6))
    lists, query = topk.Lists(np.arange(50), matrix), rng.integers(-60, 60, (4, 6))
    exact = query @ matrix.T
    for depth in (1, 5, 20, 49, 50):
        lower, upper = lists.bounds(np.maximum(query, 0).astype(float), np.minimum(query, 0).astype(float), depth, float)
        assert (lower <= exact).all() and (exact <= upper).all()


def by_turns(shards, size):
    order = {}
    for s in shards:
        start, step = sharding._number(f"offset {s}") % size, sharding._number(f"skip {s}") % (size - 1) + 1
        order[s] = [(start + i * step) % size for i in range(size)]
    table = {}
    while len(table) < size:
        for n, s in enumerate(shards):
            free = next((x for x in order[s] if x not in table), None)
            if free is not None:
                table[free] = n
    return [table[i] for i in range(size)]


def test_table():
    shards = [f"s{i}" for i in range(5)]
    table = sharding.lookup_table(shards, 101)
    assert table.tolist() == by_turns(shards, 101)
    assert max(Counter(table.tolist()).values()) - min(Counter(table.tolist()).values()) <= 1
    weighted = Counter(sharding.lookup_table(["a", "b"], 1009, [3, 1]).tolist())
    assert 2.9 < weighted[0] / weighted[1] < 3.1
    whole, fewer = sharding.lookup_table(shards, 10_007), sharding.lookup_table(shards[:-1], 10_007)
    stay = whole != 4
    assert (whole[stay] == fewer[stay]).mean() > 0.8
    for bad in (([], 101), (["a", "a"], 101), (["a"], 100), (["a"], 101, [0]), ([f"{i}" for i in range(10)], 7)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_placement(spark, texts, no_texts):
    import hashlib

    rows = sharding.place(texts.withColumn("shard", sharding.F.lit("old")), ["doc_id"]).collect()
    table = sharding.lookup_table()
    assert len(rows) == 15
    for r in rows:
        key = "null" if r.doc_id is None else f"={r.doc_id}"
        assert r.slot == int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % sharding.SIZE
        assert r.shard == sharding.SHARDS[table[r.slot]]
    assert sharding.place(no_texts, ["doc_id"]).count() == 0


def test_written_shards(spark, texts, tmp_dir):
    placed = sharding.place(texts, ["doc_id"], shards=["a", "b", "c"], size=101)
    sharding.write_shards(placed, f"{tmp_dir}/shards")
    assert spark.read.parquet(f"{tmp_dir}/shards").count() == 15
