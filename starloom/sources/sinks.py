"""Sinks (S3, S7, S11, S12, S13, S14, S15, S16).

Tables are parquet directories under a warehouse root.  A table is never
overwritten while it is being read: a rebuilt table (SCD2 merge, upsert) is
written to a new version directory and the manifest — a small table of
(table_name → path) written by Spark itself — is replaced afterwards.
A failed job leaves the previous version in place (T9) where tables are
written to version directories, as the warehouse's and the staging tables
are; :func:`write_table` on an existing path replaces it, and a failure there
can leave it empty.  Facts are appended to (S7): Spark's committer makes the
new files visible when the job ends, and a run that failed half-way adds the
missing rows when it is repeated.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.quality import table_counts
from ..session import drop_path, shuffles_released
from .readers import is_missing

#: Passes over a stored table whose rows are dealt by their partitions: what one pass shuffles is gone before the next.
PASSES = 4


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None,
                passes: int = 1) -> str:
    """Write parquet; ``partition_by`` for large facts.

    What the job shuffled is removed when it ends.

    Partitioned rows are dealt by the partition first, and adaptive execution
    splits and joins the shares by the bytes it measures (its advisory size):
    a season has one file, or as many as its size asks for, however many tasks
    made its rows.  With ``passes``, for rows that are stored already, the
    partitions are written a share at a time, and only a share is shuffled at once.
    """
    with shuffles_released(df.sparkSession):
        if not partition_by:
            df.write.mode(mode).option("compression", "zstd").parquet(path)
            return path
        for k, share in enumerate(_shares(df, partition_by, passes)):
            w = share.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode(mode if k == 0 else "append")
            if passes > 1 and mode == "overwrite" and k == 0:
                w = w.option("partitionOverwriteMode", "static")
            w.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return path


def _shares(df: DataFrame, partition_by: Sequence[str], passes: int) -> list[DataFrame]:
    """The rows in ``passes`` shares of whole partitions at the most, about as large as each other."""
    if passes == 1:
        return [df]
    of = F.xxhash64(*partition_by)
    counts = sorted(((r["n"], r["of"]) for r in df.groupBy(of.alias("of")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    shares: list[list] = [[0, []] for _ in range(passes)]
    for n, partition in counts:  # one number a partition folder
        least = min(shares, key=lambda share: share[0])
        least[0] += n
        least[1].append(partition)
    return [df.where(of.isin(partitions)) for _, partitions in shares if partitions] or [df]


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Replace only the partitions present in ``df`` (dynamic overwrite)."""
    with shuffles_released(df.sparkSession):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy(*partition_by).parquet(path))
    return path


def table_has_rows(spark: SparkSession, path: str) -> bool:
    try:
        return spark.read.parquet(path).limit(1).count() > 0
    except AnalysisException as e:
        if is_missing(e):
            return False
        raise


def write_if_empty(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> bool:
    """Load only if the target is still empty; True when written."""
    if table_has_rows(df.sparkSession, path):
        return False
    write_table(df, path, "overwrite", partition_by)
    return True


def version_path(root: str, table: str) -> str:
    """A fresh directory for a new version of ``table``."""
    return os.path.join(root, table, f"v-{uuid.uuid4().hex[:12]}")


_MANIFEST = "table_name STRING, path STRING, table_kind STRING, table_schema STRING"


def write_manifest(spark: SparkSession, root: str, entries: Mapping[str, str], kinds: Mapping[str, str],
                   schemas: Mapping[str, str] | None = None) -> str:
    """Record table_name → path and schema (JSON: an empty partitioned table has no file that says it);
    replaces the previous manifest."""
    rows = [(name, path, kinds.get(name, "table"), (schemas or {}).get(name)) for name, path in sorted(entries.items())]
    m = spark.createDataFrame(rows, _MANIFEST)
    path = os.path.join(root, "_manifest", f"m-{uuid.uuid4().hex[:12]}")
    m.coalesce(1).write.parquet(path)
    # a pointer file of its own per manifest, committed by Spark; the newest counts
    spark.createDataFrame([(time.time_ns(), path)], "written LONG, manifest STRING").coalesce(1).write.mode("append").json(
        os.path.join(root, "_manifest_pointer"))
    return path


class Tables:
    """The tables under a root as its newest manifest has them: read, replaced or added to, then committed."""

    def __init__(self, spark: SparkSession, root: str):
        m = read_manifest(spark, root)
        rows = [] if m is None else m.collect()  # one row per table
        self.spark, self.root = spark, root
        self.paths = {r["table_name"]: r["path"] for r in rows}
        self.schemas = {r["table_name"]: r["table_schema"] for r in rows if r["table_schema"]}

    def __contains__(self, name: str) -> bool:
        return name in self.paths

    def read(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in self.schemas:
            reader = reader.schema(StructType.fromJson(json.loads(self.schemas[name])))
        return reader.parquet(self.paths[name])

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] | None = None, passes: int = 1) -> DataFrame:
        """A new version of a table, beside the old one; returns it as stored."""
        path = version_path(self.root, name.rstrip("@"))
        write_table(df, path, partition_by=partition_by, passes=passes)
        self.paths[name], self.schemas[name] = path, df.schema.json()
        return self.read(name)

    def add(self, name: str, df: DataFrame, partition_by: Sequence[str] | None = None, passes: int = 1) -> None:
        """Rows added to a table (S7); they are visible when the job that writes them ends."""
        write_table(df, self.paths[name], mode="append", partition_by=partition_by, passes=passes)

    def commit(self, kind) -> None:
        write_manifest(self.spark, self.root, self.paths, {n: kind(n) for n in self.paths}, self.schemas)


def read_manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest manifest; None where there is no warehouse.  A warehouse whose pointers can't be read raises."""
    try:
        pointers = spark.read.schema("written LONG, manifest STRING").json(os.path.join(root, "_manifest_pointer"))
    except AnalysisException as e:
        if is_missing(e):
            return None
        raise
    newest = pointers.agg(F.max(F.struct("written", "manifest")).alias("p")).first()["p"]
    if newest is None:
        raise RuntimeError(f"no manifest pointer can be read under {root}; the stored warehouse is not replaced")
    return spark.read.parquet(newest["manifest"])


def list_tables(spark: SparkSession, root: str) -> DataFrame:
    """Tables of a warehouse (from its manifest)."""
    m = read_manifest(spark, root)
    if m is None:
        return spark.createDataFrame([], _MANIFEST)
    return m


def append_rows(df: DataFrame, path: str) -> str:
    """Rows of a run added to a log table (audit, ledger, rejected rows)."""
    return write_table(df, path, mode="append")


def empty_landing(spark: SparkSession, *paths: str) -> None:
    """Empty the folders of landing tables that nothing reads any more; an empty one is that of a load that ended."""
    for path in paths:
        drop_path(spark, path, stays=True)


def audit_counts(tables: Mapping[str, DataFrame], run_ts, kinds: Mapping[str, str] | None = None) -> DataFrame:
    """Row count per table, stamped with the run time."""
    return table_counts(tables, kinds).withColumn("run_ts", F.lit(run_ts).cast("timestamp_ntz"))


def audit_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts before and after a load, joined per table."""
    b = before.select("table_name", F.col("n_rows").alias("n_before"))
    a = after.select("table_name", F.col("n_rows").alias("n_after"))
    j = b.join(a, "table_name", "full_outer")
    return j.select(
        "table_name",
        F.coalesce("n_before", F.lit(0)).cast("long").alias("n_before"),
        F.coalesce("n_after", F.lit(0)).cast("long").alias("n_after"),
        (F.coalesce("n_after", F.lit(0)) - F.coalesce("n_before", F.lit(0))).cast("long").alias("delta"),
    )


def save_bucketed(df: DataFrame, table: str, bucket_by: Sequence[str], num_buckets: int,
                  sort_by: Sequence[str] | None = None, partition_by: Sequence[str] | None = None,
                  mode: str = "overwrite") -> str:
    """Catalog table bucketed (and sorted) by a join key: later joins of tables
    bucketed the same way on that key read co-located buckets and shuffle
    neither side."""
    w = df.write.mode(mode).bucketBy(num_buckets, *bucket_by).sortBy(*(sort_by or bucket_by))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format("parquet").saveAsTable(table)
    return table


__all__ = [
    "write_table", "overwrite_partitions", "write_if_empty", "table_has_rows", "version_path", "write_manifest",
    "read_manifest", "list_tables", "append_rows", "Tables", "audit_counts", "audit_delta", "save_bucketed",
]
