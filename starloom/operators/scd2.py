"""Type-2 slowly changing dimension.

Version rows carry ``valid_from``, ``valid_to`` (TIMESTAMP_NTZ, like the
reference's zone-less TIMESTAMP; NULL = open, T3),
``is_current`` and ``source_row_hash`` (MD5 over the tracked attributes).

* :func:`scd2_initial` – first load: every batch row is a current version.
* :func:`scd2_changes` – increment: one null-safe full outer join of the
  current versions and the batch, by hash: changed members get their current
  row closed and a new version, new members get a first version, the rest is
  untouched.  A second run with the same batch changes nothing (unlike the
  reference's insert-only load, T11).  Closed versions take no part: stored
  apart, their files are only added to.
* :func:`scd2_merge` – the whole dimension after such an increment.
* :func:`scd2_from_snapshots` – full-history build from dated snapshots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import OPEN_VALID_TO, row_hash
from ..session import checkpoint_root
from .keys import max_key, sequence_keys
from .windows import next_in_group, previous_in_group

HASH = "source_row_hash"


def _ts(run_ts) -> Column:
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp_ntz")


def scd2_initial(
    batch: DataFrame,
    nk: str,
    tracked: Sequence[str | Column],
    run_ts,
    sk_col: str,
    start: int = 0,
    hash_col: str = HASH,
) -> DataFrame:
    """First load; ``batch`` holds one row per natural key (NULL keys are skipped)."""
    rows = (
        batch.where(F.col(nk).isNotNull()).withColumn(hash_col, row_hash(*tracked))
        .withColumn("valid_from", _ts(run_ts))
        .withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
        .withColumn("is_current", F.lit(True))
    )
    return sequence_keys(rows, [nk], sk_col, start=start)


def scd2_changes(
    current: DataFrame,
    batch: DataFrame,
    nk: str,
    tracked: Sequence[str | Column],
    run_ts,
    sk_col: str,
    start: int,
    hash_col: str = HASH,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(current versions that stay, versions that close now, new versions).

    ``current`` holds the current versions, ``batch`` one row per key (NULL
    keys are skipped); new versions are numbered after ``start``, the largest
    key of the dimension.  Each side is shuffled once; the outcome is
    checkpointed, so the three frames read it and not the join.
    """
    checkpoint_root(current.sparkSession)
    batch_h = batch.where(F.col(nk).isNotNull()).withColumn(hash_col, row_hash(*tracked))
    old = current.select(F.col(nk).alias("__k"), F.struct(*current.columns).alias("__old"))
    new = batch_h.select(F.col(nk).alias("__b"), F.struct(*batch_h.columns).alias("__new"))
    j = old.join(new, F.col("__k") == F.col("__b"), "full_outer")
    # null-safe: an inferred member may hold no hash, and the first real version must close it
    same = F.col(f"__old.{hash_col}").eqNullSafe(F.col(f"__new.{hash_col}"))
    j = j.select(F.when(F.col("__b").isNull(), "stays").when(F.col("__k").isNull(), "new").when(same, "stays")
                 .otherwise("changes").alias("__kind"), "__old",
                 F.when(F.col("__k").isNull() | ~same, F.col("__new")).alias("__new")).checkpoint()
    stays = j.where("__kind = 'stays'").select("__old.*")
    closes = j.where("__kind = 'changes'").select("__old.*").withColumn("valid_to", _ts(run_ts)).withColumn(
        "is_current", F.lit(False))
    fresh = j.where("__kind != 'stays'").select("__new.*")
    fresh = (fresh.withColumn("valid_from", _ts(run_ts)).withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
             .withColumn("is_current", F.lit(True)))
    if "is_inferred" in current.columns and "is_inferred" not in fresh.columns:
        fresh = fresh.withColumn("is_inferred", F.lit(False))
    fresh = sequence_keys(fresh, [nk], sk_col, start=start)
    have = set(fresh.columns)
    fresh = fresh.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in current.schema.fields
    ])
    return stays, closes, fresh


def scd2_merge(
    dim: DataFrame,
    batch: DataFrame,
    nk: str,
    tracked: Sequence[str | Column],
    run_ts,
    sk_col: str,
    hash_col: str = HASH,
    start: int | None = None,
) -> DataFrame:
    """The whole type-2 dimension after a batch (one row per key).

    Members missing from the batch stay as they are (no deletes).
    """
    current, history = dim.filter(F.col("is_current")), dim.filter(~F.col("is_current"))
    stays, closes, fresh = scd2_changes(current, batch, nk, tracked, run_ts, sk_col,
                                        max_key(dim, sk_col) if start is None else start, hash_col)
    return history.unionByName(stays).unionByName(closes).unionByName(fresh)


def scd2_from_snapshots(
    snapshots: DataFrame,
    nk: str,
    tracked: Sequence[str | Column],
    snapshot_ts: str,
    sk_col: str,
    hash_col: str = HASH,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Versions from dated snapshots (one row per key and snapshot).

    A version starts where the hash differs from the previous snapshot of the
    same key; ``valid_to`` is the start of the next version.  ``tie_break``
    columns order snapshots of one key taken at the same time.  Previous and
    next rows come from windows by (key, day) (:mod:`.windows`), so a member
    with a very long history is spread over many tasks.  Versions are numbered
    from 1 in the order of member, start and ``tie_break``.
    """
    order = [snapshot_ts, *tie_break]
    day = F.col(snapshot_ts).cast("date")
    h = snapshots.withColumn(hash_col, row_hash(*tracked))
    h = previous_in_group(h, [nk], order, [hash_col], span=day, prefix="__prev_")
    starts = h.where(F.col(f"__prev_{hash_col}").isNull() | (F.col(f"__prev_{hash_col}") != F.col(hash_col))).drop(
        f"__prev_{hash_col}")
    v = starts.withColumn("valid_from", F.col(snapshot_ts).cast("timestamp_ntz")).drop(snapshot_ts)
    v = next_in_group(v, [nk], ["valid_from", *tie_break], ["valid_from"], span=F.col("valid_from").cast("date"),
                      prefix="__next_")
    v = v.withColumnRenamed("__next_valid_from", "valid_to")
    # versions of equal member, start and tie-break are told apart by what they hold
    v = sequence_keys(v, [nk, "valid_from", *tie_break, hash_col, ("valid_to", "asc", "last")], sk_col)
    return v.withColumn("is_current", F.col("valid_to").isNull())


def current_view(dim: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Current versions only (``v_dim_player_current``)."""
    cur = dim.filter(F.col("is_current"))
    return cur.select(*columns) if columns else cur


def valid_to_or_open(c: str | Column = "valid_to") -> Column:
    """NULL (open) as 9999-12-31 for range tests."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(OPEN_VALID_TO).cast("timestamp_ntz"))


def version_at(dim: DataFrame, as_of) -> DataFrame:
    """Versions valid at ``as_of`` (valid_from <= t < valid_to)."""
    t = _ts(as_of)
    return dim.filter((F.col("valid_from") <= t) & (t < valid_to_or_open()))
