"""Surrogate keys and natural-key lookups.

Fact rows are keyed by their content (:func:`content_key`): no order, no
sort, and the same row has the same key in every run.  Dimension members are
numbered (:func:`sequence_keys`), never by a window over the whole table in
one partition: rows are range-partitioned by the ordering columns, numbered inside each
partition, and shifted by the row count of all earlier partitions.  Since the
partitions are ordered ranges, the result equals ``row_number() OVER (ORDER BY
…)`` whatever the range boundaries were; the partitioned frame is
checkpointed to the shared folder so that partition ids and positions are
fixed before the offsets are computed (a lost executor recomputes from the
checkpoint, not from a resampled range).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

_PID = "__sl_pid"
_MID = "__sl_mid"
_OFF = "__sl_off"


def order_col(item) -> Column:
    """Order item → sort expression: a name (ascending, NULLs first), a sort
    Column, or a tuple ``(name, 'asc'|'desc', 'first'|'last')``."""
    if isinstance(item, str):
        return F.col(item).asc_nulls_first()
    if isinstance(item, tuple):
        name, direction, nulls = (tuple(item) + ("asc", "first"))[:3]
        return getattr(F.col(name), f"{direction}_nulls_{nulls}")()
    return item


def _order_cols(order_by) -> list[Column]:
    return [order_col(c) for c in order_by]


def sequence_keys(
    df: DataFrame,
    order_by: Sequence[str | Column],
    key_col: str,
    start: int = 0,
    num_partitions: int | None = None,
    bounded: bool = False,
) -> DataFrame:
    """``key_col = start + row_number() over (order by order_by)``.

    ``order_by`` must be a total order over the rows (add tie-breakers), so that
    keys repeat run after run.  Scales with the cluster: one range shuffle, a
    checkpoint, and a broadcast of one offset per partition (bounded by the
    partition count, not by the data), computed once.

    ``bounded=True`` is for inputs whose size has a fixed bound that does not
    grow with the data (seasons, rule outcomes, seeded codes): a plain window
    numbers them in one small task, with no shuffle of data and no checkpoint.
    """
    cols = _order_cols(order_by)
    if bounded:
        w = Window.orderBy(*cols)
        return df.withColumn(key_col, (F.lit(start) + F.row_number().over(w)).cast("long"))
    spark = df.sparkSession
    checkpoint_root(spark)
    # Without an explicit count the range shuffle can be coalesced by AQE to
    # the data size; merged partitions are adjacent ranges, so partition ids
    # stay in key order and the offsets below stay right.
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    ranged = (
        ranged
        .sortWithinPartitions(*cols)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_MID, F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    # One count per partition (bounded by the partition count, not the data):
    # computed once here, so later uses of the keyed frame do not rescan it.
    counts = sorted((r[0], r[1]) for r in ranged.groupBy(_PID).agg(F.count(F.lit(1))).collect())
    running, rows = 0, []
    for pid, n in counts:
        rows.append((pid, running))
        running += n
    offsets = spark.createDataFrame(rows, f"{_PID} INT, {_OFF} LONG")
    pos = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (
        ranged.join(F.broadcast(offsets), _PID)
        .withColumn(key_col, (F.lit(start) + F.col(_OFF) + pos + 1).cast("long"))
        .drop(_PID, _MID, _OFF)
    )


def max_key(df: DataFrame, key_col: str) -> int:
    """Largest existing key (0 for an empty table); one scalar to the driver."""
    v = df.agg(F.max(key_col)).first()[0]
    return int(v) if v is not None else 0


def content_key(columns: Sequence[str | Column]) -> Column:
    """128 bits of MD5 over the text of the columns, NULL apart from every text.

    Two rows share a key when they are equal in all of ``columns``; add an
    ordinal among equal rows to tell copies apart.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\x1e")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


#: Frequent keys that a lookup answers from a broadcast, at the most.
HOT_KEYS = 1_000


#: Members of a dimension that a lookup sends to every task, at the most.
FEW_MEMBERS = 1_000_000


def frequent_keys(fact: DataFrame, fact_key: str | Column, fraction: float = 0.01, least: int = 1) -> DataFrame:
    """The HOT_KEYS keys met most often, ``least`` times or more, in a sample of ``fact`` (column ``__hot``).

    Only what the sample says is frequent is treated apart, and both ways give
    the same result, so the sample decides the work and never the rows.
    """
    k = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    met = fact.select(k.alias("__hot")).where(F.col("__hot").isNotNull()).sample(fraction, seed=7)
    met = met.groupBy("__hot").count().where(F.col("count") >= least)
    return met.orderBy(F.col("count").desc(), "__hot").limit(HOT_KEYS).select("__hot")


def has_few_members(dim: DataFrame) -> bool:
    """Whether a lookup may send the whole dimension to every task: FEW_MEMBERS at the most, however the facts grow."""
    return dim.limit(FEW_MEMBERS + 1).count() <= FEW_MEMBERS


def lookup_sk(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str | Column,
    dim_key: str,
    sk_col: str,
    out_col: str | None = None,
    how: str = "left",
    current_only: bool = False,
    cast_to: str | None = None,
    hot: DataFrame | None = None,
    few: bool = False,
) -> DataFrame:
    """Natural key → surrogate key.

    ``cast_to`` casts the fact key first (J5, ``club_id::varchar = team_nk``);
    ``current_only`` joins to the current SCD2 version (J7); ``how='left'``
    keeps facts with an unknown key (their key is NULL), ``'inner'`` drops them
    as the reference does (T8).  NULL fact keys never match (J6).

    With ``hot`` (see :func:`frequent_keys`, of keys as the dimension holds
    them) the members of those keys are sent to every task, HOT_KEYS rows at
    the most; their fact rows, and those with a NULL key, are spread over all
    partitions by their content, so no key gathers them in one.  With ``few``
    (see :func:`has_few_members`) all members are, and no fact row is shuffled.
    """
    out_col = out_col or sk_col
    d = dim.filter(F.col("is_current")) if current_only else dim
    d = d.select(F.col(dim_key).alias("__lk_nk"), F.col(sk_col).alias(out_col))
    k = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    if cast_to:
        k = k.cast(cast_to)
    if few:
        return fact.join(F.broadcast(d), k == F.col("__lk_nk"), how).drop("__lk_nk")
    if hot is None:
        return fact.join(d, k == F.col("__lk_nk"), how).drop("__lk_nk")
    members = d.join(F.broadcast(hot), F.col("__lk_nk") == F.col("__hot")).select(
        F.col("__lk_nk").alias("__lk_few"), F.col(out_col).alias("__lk_sk"))
    met = fact.join(F.broadcast(members), k == F.col("__lk_few"), "left")
    done = k.isNull() | F.col("__lk_few").isNotNull()
    key = F.when(done, F.concat(F.lit("-"), F.xxhash64(*fact.columns).cast("string"))).otherwise(
        F.concat(F.lit("="), k.cast("string")))
    rest = d.where(F.col("__lk_nk").isNotNull()).withColumn("__lk_nk", F.concat(F.lit("="), F.col("__lk_nk").cast("string")))
    out = met.withColumn("__lk_key", key).join(rest, F.col("__lk_key") == F.col("__lk_nk"), "left")
    out = out.withColumn(out_col, F.coalesce("__lk_sk", out_col)).drop("__lk_nk", "__lk_key", "__lk_few", "__lk_sk")
    return out if how == "left" else out.where(F.col(out_col).isNotNull())


def get_or_create_members(
    dim: DataFrame,
    keys: DataFrame,
    nk: str,
    sk_col: str,
    defaults: Mapping[str, Column] | None = None,
    flag_col: str | None = "is_inferred",
) -> DataFrame:
    """Add an inferred member for every key not in ``dim``.

    ``keys`` holds the natural keys seen in the facts (column ``nk``, plus
    optional attributes seen with them that ``defaults`` may use); NULL keys
    never become members.  New members get ``defaults`` (e.g. name
    'Unknown') and keys after the current maximum, in key order.  The set-based
    form replaces the reference's per-row get-or-create function.
    """
    defaults = dict(defaults or {})
    extra = [c for c in keys.columns if c != nk]
    seen = keys.where(F.col(nk).isNotNull())
    if extra:  # attributes seen with the key (e.g. a name), one row per key, for the defaults
        seen = seen.groupBy(nk).agg(*[F.min(c).alias(c) for c in extra])
    else:
        seen = seen.select(nk).distinct()
    missing = seen.join(dim.select(nk), nk, "left_anti")
    cols = []
    for f in dim.schema.fields:
        if f.name in (nk, sk_col):
            continue
        if f.name == flag_col:
            continue
        cols.append(defaults.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name))
    new = missing.select(F.col(nk), *cols)
    if flag_col:
        new = new.withColumn(flag_col, F.lit(True))
    new = sequence_keys(new, [nk], sk_col, start=max_key(dim, sk_col))
    base = dim
    if flag_col and flag_col not in dim.columns:
        base = dim.withColumn(flag_col, F.lit(False))
    return base.unionByName(new.select(*base.columns))
