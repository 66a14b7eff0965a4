import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators.scd2 import current_view, scd2_from_snapshots, scd2_initial, scd2_merge, version_at

SCHEMA = "nk INT, name STRING, pos STRING"
TRACKED = ("name", "pos")


def _rows(df):
    return sorted((r.sk, r.nk, r.name, r.pos, str(r.valid_from), str(r.valid_to), r.is_current) for r in df.collect())


def test_initial_and_merge(spark):
    b1 = spark.createDataFrame([(1, "A", "GK"), (2, "B", None), (3, "C", "DF")], SCHEMA)
    dim = scd2_initial(b1, "nk", TRACKED, "2024-01-01 00:00:00", "sk")
    assert [r.sk for r in dim.orderBy("nk").collect()] == [1, 2, 3]
    h = {r.nk: r.source_row_hash for r in dim.collect()}
    assert h[2] == hashlib.md5(b"B").hexdigest()
    # 1 unchanged, 2 NULL -> value, 3 value -> NULL, 4 new; member 5 never seen stays absent
    b2 = spark.createDataFrame([(1, "A", "GK"), (2, "B", "MF"), (3, "C", None), (4, "D", "FW")], SCHEMA)
    m = scd2_merge(dim, b2, "nk", TRACKED, "2024-02-01 00:00:00", "sk")
    rows = _rows(m)
    assert len(rows) == 6
    cur = {r.nk: (r.sk, r.pos) for r in current_view(m).collect()}
    assert cur == {1: (1, "GK"), 2: (4, "MF"), 3: (5, None), 4: (6, "FW")}
    closed = {r.nk: str(r.valid_to) for r in m.where(~F.col("is_current")).collect()}
    assert closed == {2: "2024-02-01 00:00:00", 3: "2024-02-01 00:00:00"}
    # idempotent: the same batch again changes nothing
    again = scd2_merge(m, b2, "nk", TRACKED, "2024-03-01 00:00:00", "sk")
    assert _rows(again) == rows
    # one current version per key, validity as of a time
    assert m.where("is_current").groupBy("nk").count().where("count > 1").count() == 0
    from starloom.operators.quality import validity_overlap_check

    assert validity_overlap_check(m, "nk", "dim").first().failures == 0
    broken = m.withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))   # every version left open
    assert validity_overlap_check(broken, "nk", "dim").first().failures == 2
    old = {r.nk: r.pos for r in version_at(m, "2024-01-15 00:00:00").collect()}
    assert old == {1: "GK", 2: None, 3: "DF"}


def test_from_snapshots(spark):
    snaps = spark.createDataFrame(
        [(1, "A", "GK", "2024-01-01"), (1, "A", "GK", "2024-02-01"), (1, "A", "DF", "2024-03-01"),
         (2, "B", "MF", "2024-02-01")], SCHEMA + ", snap STRING").withColumn("snap", F.col("snap").cast("timestamp_ntz"))
    v = scd2_from_snapshots(snaps, "nk", TRACKED, "snap", "sk")
    got = sorted((r.nk, r.pos, str(r.valid_from)[:10], str(r.valid_to)[:10] if r.valid_to else None, r.is_current)
                 for r in v.collect())
    assert got == [(1, "DF", "2024-03-01", None, True), (1, "GK", "2024-01-01", "2024-03-01", False),
                   (2, "MF", "2024-02-01", None, True)]


def test_versions_from_snapshots_are_numbered_in_order(spark):
    rows = [(nk, "A", pos, f"2024-01-{d:02d}") for nk in range(20, 0, -1) for d, pos in ((1, "GK"), (2, "GK"), (3, "DF"))]
    snaps = spark.createDataFrame(rows, SCHEMA + ", snap STRING").withColumn("snap", F.col("snap").cast("timestamp_ntz"))
    v = scd2_from_snapshots(snaps.repartition(5), "nk", TRACKED, "snap", "sk").orderBy("nk", "valid_from").collect()
    assert [r.sk for r in v] == list(range(1, 41))
    assert [(r.nk, r.pos) for r in v[:3]] == [(1, "GK"), (1, "DF"), (2, "GK")]


def _model(batches):
    """Plain-Python SCD2: list of versions (nk, name, pos, run, end_run, current)."""
    versions, next_sk = [], 1
    for run, batch in enumerate(batches):
        current = {v["nk"]: v for v in versions if v["cur"]}
        new = []
        for nk, name, pos in sorted(batch):
            c = current.get(nk)
            if c is not None and (c["name"], c["pos"]) == (name, pos):
                continue
            if c is not None:
                c["cur"], c["end"] = False, run
            new.append({"nk": nk, "name": name, "pos": pos, "start": run, "end": None, "cur": True})
        for v in new:
            v["sk"] = next_sk
            next_sk += 1
        versions.extend(new)
    return sorted((v["sk"], v["nk"], v["name"], v["pos"], v["start"], v["end"], v["cur"]) for v in versions)


batch_strategy = st.lists(
    st.dictionaries(st.integers(0, 6), st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["x", "y", None])),
                    max_size=6),
    min_size=1, max_size=3)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=batch_strategy)
def test_merge_matches_python_model(spark, batches):
    runs = [f"2024-0{i + 1}-01 00:00:00" for i in range(len(batches))]
    rows = [[(nk, n, p) for nk, (n, p) in b.items()] for b in batches]
    dim = None
    for run, b in zip(runs, rows):
        df = spark.createDataFrame(b, SCHEMA)
        dim = scd2_initial(df, "nk", TRACKED, run, "sk") if dim is None else scd2_merge(dim, df, "nk", TRACKED, run, "sk")
    idx = {r: i for i, r in enumerate(runs)}
    got = sorted((r.sk, r.nk, r.name, r.pos, idx[str(r.valid_from)], idx[str(r.valid_to)] if r.valid_to else None,
                  r.is_current) for r in dim.collect())
    assert got == _model(rows)
