"""What several operators of this folder share: folds, scratch tables, column guards."""

from __future__ import annotations

import ctypes
import math
import os
import uuid

import pyarrow
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import checkpoint_root, drop_path, shuffles_released


def fold(column: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


def text_of(column: Column) -> Column:
    """Null text counts as empty text."""
    return F.coalesce(column, F.lit(""))


#: Rows of an Arrow batch: texts of a few KB on average, some of a hundred, fit a task's share of memory.
BATCH_ROWS = 1_000


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of whole texts; sessions with Spark's default batch size get a smaller one."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 10_000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{folder}/{table}.parquet")


_PLACE = "_starloom_place"


def stored(df: DataFrame, name: str, *used: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again.

    Cuts the lineage where a frame is used more than once: the table survives
    the loss of any executor.  Tables of one application share a folder, so
    that an operator of the cluster can drop them together.  What the job
    shuffled is removed when the table is written, and so are the stored tables
    ``used``, which nothing else may read afterwards.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_root(spark), f"llm-{spark.sparkContext.applicationId}", f"{name}-{uuid.uuid4().hex[:12]}")
    with shuffles_released(spark):
        df.write.parquet(path)
    release(*used)
    return placed(spark.read.schema(df.schema).parquet(path), path)


def placed(df: DataFrame, path: str) -> DataFrame:
    """``df``, which reads the stored table at ``path`` and no other."""
    vars(df)[_PLACE] = path
    return df


def release(*frames: DataFrame) -> None:
    """Drop the tables of :func:`stored` frames that nothing reads any more."""
    for df in frames:
        drop_path(df.sparkSession, vars(df)[_PLACE])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"llm-{spark.sparkContext.applicationId}", f"{name}-{uuid.uuid4().hex[:12]}")


#: Keys that are answered from a broadcast hold more than one row in HEAVY, so there are HEAVY of them at the most.
HEAVY = 65_536


def answered(rows: DataFrame, answers: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with the one answer of their key, whatever share of the rows a key holds.

    ``answers`` has a row per key with ``rows_of``, how many of the ``total`` rows
    hold it.  Answers of keys with more than a row in HEAVY go to all tasks; the
    others' rows, none of which weighs on a task, are joined.  Rows without an
    answer are left out.  ``rows`` is read twice: a stored table.
    """
    heavy = F.broadcast(answers.where(F.col("rows_of") > total // HEAVY).drop("rows_of"))
    others = answers.where(F.col("rows_of") <= total // HEAVY).drop("rows_of")
    return rows.join(heavy, key).unionByName(rows.join(heavy.select(key), key, "left_anti").join(others, key))


def give_back() -> None:
    """A Python worker's freed memory back to its machine, where the C library can.

    Workers are reused; what they keep after a large batch would count against
    the executor's memory in every later task.
    """
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def blocks_for(total: int, per_block: int) -> int:
    """How many blocks hold ``total`` at about ``per_block`` each."""
    return max(1, math.ceil((total or 0) / per_block))
