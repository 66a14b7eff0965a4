"""Set-based write patterns of the dimensions.

Parquet tables have no row-level MERGE, so an upsert computes the new full
table: existing rows (updated where the batch has their key) plus batch rows
with unseen keys, which get new surrogate keys after the current maximum.
Keys of known members never change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import max_key, sequence_keys


def order_value(df: DataFrame, item) -> list[Column]:
    """One order item → comparable (null flag, value) columns for ``min_by``.

    ``item`` is a column name (ascending, NULLs first) or a tuple
    ``(name, 'asc'|'desc', 'first'|'last')``.  Descending order is encoded
    by negation, so it is defined for numbers, dates, timestamps and booleans.
    """
    name, direction, nulls = (item, "asc", "first") if isinstance(item, str) else (tuple(item) + ("asc", "first"))[:3]
    c = F.col(name)
    flag = F.when(c.isNull(), F.lit(0 if nulls == "first" else 1)).otherwise(F.lit(1 if nulls == "first" else 0))
    if direction == "asc":
        return [flag, c]
    dtype = df.schema[name].dataType.typeName()
    if dtype == "date":
        v = -F.datediff(c, F.lit("1970-01-01").cast("date"))
    elif dtype.startswith("timestamp"):
        v = -F.unix_micros(c.cast("timestamp"))
    elif dtype == "boolean":
        v = ~c
    elif dtype == "string":
        raise ValueError(f"descending order on text column {name!r} is not supported by pick_one")
    else:
        v = -c
    return [flag, v]


def pick_one(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """T5: one row per key — the first by ``order_by`` (make it a total order).

    Runs as an aggregate (``min_by``), so Spark combines map-side before the
    shuffle and a hot key costs one partial row per task, not one huge window.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = F.struct(*[v for item in order_by for v in order_value(df, item)])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__pick"))
    return picked.select(*keys, *[F.col(f"__pick.{c}").alias(c) for c in rest])


def _conform(df: DataFrame, target: DataFrame) -> DataFrame:
    """Select ``target``'s columns from ``df``; missing ones become typed NULLs."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in target.schema.fields
    ])


def upsert(
    existing: DataFrame,
    batch: DataFrame,
    key: str,
    sk_col: str,
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """INSERT … ON CONFLICT (key) DO UPDATE SET update_cols = EXCLUDED.*.

    ``batch`` must hold one row per key (see :func:`pick_one`).  Matched rows
    take the batch values of ``update_cols`` (NULL included, as EXCLUDED
    does); new keys are appended with keys ``max(sk) + 1 …`` in key order.
    """
    batch = batch.where(F.col(key).isNotNull())
    update_cols = list(update_cols or [c for c in batch.columns if c in existing.columns and c not in (key, sk_col)])
    incoming = batch.select(
        F.col(key), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in update_cols]
    )
    joined = existing.join(incoming, key, "left")
    updated = joined.select(*[
        (F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).cast(f.dataType) if c in update_cols else F.col(c)).alias(c)
        for f in existing.schema.fields
        for c in [f.name]
    ])
    inserts = batch.join(existing.select(key), key, "left_anti")
    inserts = sequence_keys(inserts, [key], sk_col, start=max_key(existing, sk_col))
    return updated.unionByName(_conform(inserts, existing))


def insert_if_absent(existing: DataFrame, batch: DataFrame, keys: Sequence[str], sk_col: str,
                     bounded: bool = False) -> DataFrame:
    """INSERT … ON CONFLICT DO NOTHING / check-then-insert, set-based.

    ``bounded`` as in :func:`sequence_keys` (reference data of fixed size)."""
    keys = list(keys)
    new = batch.select(*keys).distinct().join(existing.select(*keys), keys, "left_anti")
    batch_rest = [c for c in batch.columns if c not in keys and c != sk_col]
    if batch_rest:
        new = new.join(pick_one(batch.select(*keys, *batch_rest), keys, batch_rest), keys, "left")
    new = sequence_keys(new, keys, sk_col, start=max_key(existing, sk_col), bounded=bounded)
    return existing.unionByName(_conform(new, existing))


def seed(spark, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Reference rows from literals."""
    return spark.createDataFrame(list(rows), schema)
