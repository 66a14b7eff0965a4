"""Incremental dimension loads from a stream of member snapshots.

The reference loads in batches only; its incremental path is the SCD2 merge
(B9).  :func:`start_scd2_stream` drives that same merge from Structured
Streaming with ``foreachBatch``.

The dimension is stored partitioned by a hash bucket of the natural key, so
a micro-batch reads only the buckets its keys fall into (partition pruning),
merges them, and replaces only those partitions (dynamic partition
overwrite); the rest of the dimension is neither read nor rewritten.  The
merged rows are checkpointed first, so the partitions being replaced are
never read by the job that replaces them.  New version keys are
``batch_id · 2^32 + n``: no scan for the current maximum, and a micro-batch
replayed after a failure (same id, same data) assigns the same keys, while
the hash merge makes the replay change nothing already applied.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import pick_one
from ..operators.scd2 import scd2_initial, scd2_merge
from ..session import checkpoint_root
from ..sources.readers import is_missing

BUCKET = "nk_bucket"
KEYS_PER_BATCH = 2 ** 32


def key_bucket(nk: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(nk)), F.lit(buckets)).cast("int")


def _data(root: str) -> str:
    return os.path.join(root, "data")


def current_version(spark: SparkSession, root: str) -> DataFrame | None:
    """The stored dimension, or None before the first batch."""
    try:
        return spark.read.parquet(_data(root))
    except AnalysisException as e:
        if is_missing(e):
            return None
        raise


def merge_batch(batch: DataFrame, root: str, nk: str, tracked: Sequence[str], sk_col: str,
                order_col: str, run_ts_col: str | None = None, batch_id: int = 0, buckets: int = 64) -> list[int]:
    """Merge one batch of snapshots; returns the buckets it rewrote."""
    spark = batch.sparkSession
    checkpoint_root(spark)
    latest = pick_one(batch.where(F.col(nk).isNotNull()), [nk], [(order_col, "desc", "last")])
    stamp = (latest.agg(F.max(run_ts_col)).first()[0] if run_ts_col else None) or "1970-01-01 00:00:00"
    body = latest.drop(*(c for c in (order_col, run_ts_col) if c)).withColumn(BUCKET, key_bucket(nk, buckets))
    touched = sorted(r[0] for r in body.select(BUCKET).distinct().collect())  # at most `buckets` values
    start = batch_id * KEYS_PER_BATCH
    dim = current_version(spark, root)
    if dim is None:
        new = scd2_initial(body, nk, tracked, str(stamp), sk_col, start=start)
    else:
        part = dim.where(F.col(BUCKET).isin(touched))
        new = scd2_merge(part, body, nk, tracked, str(stamp), sk_col, start=start)
    new = new.checkpoint(eager=True)
    (new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(_data(root)))
    return touched


def start_scd2_stream(stream: DataFrame, root: str, checkpoint: str, nk: str, tracked: Sequence[str],
                      sk_col: str, order_col: str, run_ts_col: str | None = None, buckets: int = 64,
                      available_now: bool = True):
    """Start the streaming query; returns the ``StreamingQuery``."""
    def each(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            merge_batch(df, root, nk, tracked, sk_col, order_col, run_ts_col, batch_id, buckets)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
