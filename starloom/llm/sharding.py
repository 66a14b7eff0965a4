"""Sharding: a permutation-filled lookup table (2).

Every shard has its own order of preference over the slots of a table of prime
size: it starts at an offset and skips by a step, both hashed from its name, so
that it meets every slot once.  Shards take turns, each claiming the next free
slot of its order, until the table is full.  A shard of weight w takes w turns
a round.  All shards get nearly equal (or proportional) numbers of slots, and
when one goes, nearly all slots of the others stay theirs.

A row's slot is the hash of its key modulo the table size; the table, whose
size is fixed, is broadcast, so placement takes one look-up and no shuffle.
Keys are spread by id, so that no source or host makes a shard hot.

Defined cases: null key columns count as a key of their own, distinct from the
empty text; repeated keys go to the same shard; texts play no part however long
they are; columns with the added names are replaced; an empty table gives an
empty result; no shards, shards without a weight above 0, repeated names or a
size that isn't prime or is below the number of shards raise ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots; a prime well above a hundred times the number of shards.
SIZE = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str] = SHARDS, size: int = SIZE, weights: Sequence[int] | None = None) -> np.ndarray:
    """The shard (by place in ``shards``) of each slot."""
    weights = [1] * len(shards) if weights is None else list(weights)
    if not shards or len(set(shards)) != len(shards) or len(weights) != len(shards) or max(weights) <= 0 or min(weights) < 0:
        raise ValueError("shards need different names and weights of 0 or more, one above 0")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the size must be a prime, and no shard may go without a slot")
    offset = [_number(f"offset {s}") % size for s in shards]
    skip = [_number(f"skip {s}") % (size - 1) + 1 for s in shards]
    at = list(offset)
    table = np.full(size, -1, dtype=np.int32)
    free = size
    while free:
        for shard, turns in enumerate(weights):
            for _ in range(turns):
                while table[at[shard]] >= 0:
                    at[shard] = (at[shard] + skip[shard]) % size
                table[at[shard]] = shard
                free -= 1
                if not free:
                    return table
    return table


def slot(keys: Sequence[str], size: int = SIZE):
    """The slot of the key columns: the first 15 hex digits of an MD5, modulo the size."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("null")) for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(df: DataFrame, keys: Sequence[str], shards: Sequence[str] = SHARDS, size: int = SIZE, weights: Sequence[int] | None = None) -> DataFrame:
    """``df`` with its slot and shard."""
    table = lookup_table(shards, size, weights)
    rows = [(i, shards[s]) for i, s in enumerate(table.tolist())]
    known = df.sparkSession.createDataFrame(rows, "slot int, shard string")  # SIZE rows, whatever the input
    return df.drop("slot", "shard").withColumn("slot", slot(keys, size)).join(F.broadcast(known), "slot").select(*[c for c in df.columns if c not in ("slot", "shard")], "slot", "shard")


def write_shards(df: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """A placed frame as one folder per shard; rows of a shard are spread over ``files_per_shard`` files by slot."""
    df.withColumn("__part", F.pmod(F.hash("slot"), F.lit(files_per_shard))).repartition("shard", "__part").drop("__part").write.partitionBy("shard").parquet(path)
