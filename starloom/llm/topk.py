"""Exact top-k search (8): no-random-access aggregation over sorted lists.

Components become floor(64 x) and the score is the integer inner product.  The
candidates are cut into blocks; a block keeps one list per component, sorted by
value.  For a query a component's contribution is its own value times the
candidate's, so the list is read from the top where the query's value is
positive and from the bottom where it is negative.  All lists are read to the
same depth.  A candidate's lower bound adds to what was seen of it the least
that each unread list can give, the upper bound what each list would give at its
next entry.  Reading stops when no candidate outside the k best lower bounds
has an upper bound that reaches the k-th best; those that remain get their
scores from their whole vectors.  Otherwise the lists are read deeper.

Depths double, and the bounds of a block of queries are products of matrices:
the entries seen are the block's matrix under a mask, the same for all queries
with the same sign in a component.

Before the blocks are read each query gets a floor: its k-th best score in one
block of candidates.  What cannot reach the floor is an outsider everywhere,
so blocks return few rows; their k best are merged per query.

Queries are those rows whose id is divisible by EVERY; a query block meets each
candidate block once, as a row of packed arrays.

Scaled components are whole numbers that a double holds exactly, whatever their
size.  Bounds are sums of doubles, with as much slack as their rounding needs;
scores are computed exactly, in 64 bits or, where these don't hold a sum, in
integers of any length.  Vectors with components of WIDE or more have blocks of
their own, so that the others keep tight bounds.  A score among the k best that
64 bits don't hold is an error.

Defined cases: vectors that are null or hold null or non-finite components
(before or after scaling) and rows without an id take no part; shorter vectors
count as padded with zeros; an empty vector scores 0 with all; ties go
to the smaller id; rows of a query's own id are not its candidates; of repeated
ids each row is a candidate of its own and each query row is answered once per
id and vector; an empty table gives an empty result; only the id and the vector
are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.common import blocks_for, stored

SCALE, K, EVERY = 64, 20, 20
#: Rows of a block of candidates and of queries.
ROWS, QUERIES = 4096, 512
#: Scaled components from here on are wide.
WIDE = float(1 << 25)
#: First depth, as a share of the list.
FIRST_DEPTH = 1 / 8


def quantised(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and the whole-number components, as doubles, of the vectors that take part."""
    scaled = F.transform(F.col(vec_col), lambda x: x.cast("double") * SCALE)
    finite = F.coalesce(F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    # doubles of 2^52 and more are whole
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x))
    given = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.when(finite, whole).alias("vec"))
    return given.where(F.col("vec").isNotNull())


def _packed(df: DataFrame, blocks: int, name: str) -> DataFrame:
    """One row per block: ids and vectors, the vectors padded to the block's longest."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id", kind="stable")
        width = max(map(len, part["vec"]))
        matrix = np.zeros((len(part), width), dtype="<f8")
        for row, vec in zip(matrix, part["vec"]):
            row[: len(vec)] = vec
        return pd.DataFrame({"block": [part["block"].iloc[0]], "ids": [part["id"].to_numpy("<i8").tobytes()], "vecs": [matrix.tobytes()], "width": [width]})

    # by vector too, so that rows that share an id are spread
    wide = F.exists("vec", lambda x: F.abs(x) >= WIDE)
    dealt = df.withColumn("block", (F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)) + F.when(wide, blocks).otherwise(0)).cast("int"))
    return stored(dealt.groupBy("block").applyInPandas(pack, "block int, ids binary, vecs binary, width int"), name)


def exact_scores(matrix: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as doubles, as 64-bit integers; an error where these don't hold one."""
    reach = int(np.abs(query).max(initial=0)) * int(np.abs(matrix).max(initial=0)) * max(1, matrix.shape[1])
    if reach < 1 << 53:
        return (matrix @ query).astype(np.int64)
    if reach < 1 << 63:
        return matrix.astype(np.int64) @ query.astype(np.int64)
    asked = [int(x) for x in query]
    return np.array([sum(int(x) * y for x, y in zip(row, asked, strict=True) if y) for row in matrix], dtype=object)


def _fitting(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers."""
    if scores.dtype == object:
        for x in scores:
            if not -(1 << 63) <= x < 1 << 63:
                raise ValueError(f"a score of {x} does not fit 64 bits")
        return scores.astype(np.int64)
    return scores


def _arrays(ids: bytes, vecs: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    return ids, np.frombuffer(vecs, "<f8").reshape(len(ids), width)


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


class Lists:
    """The sorted lists of a block of candidates."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        self.order = np.argsort(matrix, axis=0, kind="stable")  # list j from the bottom: rows order[:, j]
        self.sorted = np.take_along_axis(matrix, self.order, axis=0)
        self.rank = np.empty_like(self.order)
        np.put_along_axis(self.rank, self.order, np.arange(len(ids))[:, None], axis=0)

    def bounds(self, up: np.ndarray, down: np.ndarray, depth: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) of each query and candidate after ``depth`` entries of every list; up, down: the queries' positive and negative parts."""
        n = len(self.ids)
        seen_up, seen_down = self.rank >= n - depth, self.rank < depth
        if depth >= n:
            score = (up + down) @ self.matrix.T.astype(kind)
            return score, score
        matrix = self.matrix.astype(kind)
        seen = up @ np.where(seen_up, matrix, 0).T + down @ np.where(seen_down, matrix, 0).T
        least, most = self.sorted[0].astype(kind), self.sorted[-1].astype(kind)
        next_up, next_down = self.sorted[n - depth - 1].astype(kind), self.sorted[depth].astype(kind)
        open_up, open_down = (~seen_up).T.astype(kind), (~seen_down).T.astype(kind)
        lower = seen + (up * least) @ open_up + (down * most) @ open_down
        upper = seen + (up * next_up) @ open_up + (down * next_down) @ open_down
        return lower, upper

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query's place, ids, scores) of the k best that reach the query's floor."""
        n = len(self.ids)
        reach = int(np.abs(queries).max(initial=0)) * int(np.abs(self.matrix).max(initial=0)) * max(1, self.matrix.shape[1])
        kind = np.float32 if reach < 1 << 24 else np.float64  # all sums exact below 2^24 or 2^53
        if reach >= 1 << 1000:  # doubles hold no bound: every candidate is looked at
            inside = self.ids[None, :] != query_ids[:, None]
            for place in range(len(queries)):
                yield self._answer(place, np.flatnonzero(inside[place]), queries[place], k, floors[place])
            return
        slack = float(reach) * 1e-9 if reach >= 1 << 53 else 0
        left, depth = np.arange(len(queries)), max(1, int(n * FIRST_DEPTH))
        while len(left):
            depth = min(depth, n)
            up, down = np.maximum(queries[left], 0).astype(kind), np.minimum(queries[left], 0).astype(kind)
            lower, upper = self.bounds(up, down, depth, kind)
            own = self.ids[None, :] == query_ids[left][:, None]
            lower = np.where(own, -np.inf, lower)
            bar = np.maximum(np.partition(lower, n - k, axis=1)[:, n - k], floors[left]) if n >= k else floors[left].astype(np.float64)
            inside = (upper >= (bar - slack)[:, None]) & ~own
            done = (inside.sum(axis=1) <= 4 * k) | (depth >= n)
            for place, some in zip(left[done], inside[done]):
                yield self._answer(place, np.flatnonzero(some), queries[place], k, floors[place])
            left, depth = left[~done], depth * 2

    def _answer(self, place: int, rows: np.ndarray, query: np.ndarray, k: int, floor: float) -> tuple[int, np.ndarray, np.ndarray]:
        """The k best of some rows, by their whole vectors."""
        score = exact_scores(self.matrix[rows], query)
        if score.dtype == object:
            order = np.array(sorted(range(len(rows)), key=lambda i: (-score[i], self.ids[rows[i]]))[:k], dtype=np.int64)
        else:
            order = np.lexsort((self.ids[rows], -score))[:k]
        order = order[[score[i] >= floor for i in order]] if len(order) else order
        return place, self.ids[rows[order]], _fitting(score[order])


def top_k(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = EVERY, rows: int = ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every query."""
    whole = stored(quantised(df, id_col, vec_col), "topk-vectors")
    n = whole.count()
    blocks = blocks_for(n, rows)
    candidates = _packed(whole, blocks, "topk-candidates")
    asking = whole.where(F.pmod(F.col("id"), F.lit(every)) == 0).distinct()
    queries = _packed(asking, blocks_for(asking.count(), QUERIES), "topk-queries").select(F.col("block").alias("query_block"), F.col("ids").alias("query_ids"), F.col("vecs").alias("queries"), F.col("width").alias("query_width"))
    first, last = (x or 0 for x in candidates.agg(F.min("block"), F.max("block")).first())

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, lists = None, None
        for batch in batches:
            for row in batch.itertuples():
                ids, matrix = _arrays(row.ids, row.vecs, row.width)
                query_ids, asked = _arrays(row.query_ids, row.queries, row.query_width)
                asked, matrix = _same_width(asked, matrix)
                if (row.block, matrix.shape) != block:
                    block, lists = (row.block, matrix.shape), Lists(ids, matrix)
                floors = np.frombuffer(row.floors, "<f8") if row.floors is not None else np.full(len(query_ids), -np.inf)
                out = [pd.DataFrame({"query_block": row.query_block, "place": np.int32(p), "query_id": query_ids[p], "vec_id": i, "score": s.astype(np.int64)}) for p, i, s in lists.best(query_ids, asked, k, floors)]
                if out:
                    yield pd.concat(out, ignore_index=True)

    kind = "query_block int, place int, query_id long, vec_id long, score long"

    def floors_of(part: pd.DataFrame) -> pd.DataFrame:
        floors = np.full(part["place"].max() + 1, -np.inf)
        for place, scores in part.groupby("place")["score"]:
            if len(scores) >= k:  # not above the k-th best, though a double may round it
                least = int(scores.min())
                floors[place] = float(least) if int(float(least)) <= least else np.nextafter(float(least), -np.inf)
        return pd.DataFrame({"query_block": [part["query_block"].iloc[0]], "floors": [floors.astype("<f8").tobytes()], "n": [len(floors)]})

    # the floors: a query block against one block of candidates
    start = queries.withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(first)))).withColumn("floors", F.lit(None).cast("binary")).join(candidates.where(F.col("block") == first), "block")
    head = stored(start.mapInPandas(searched, kind), "topk-head")
    floors = head.groupBy("query_block").applyInPandas(floors_of, "query_block int, floors binary, n int")
    # then all the others, each pair of blocks a row
    pairs = queries.join(floors.where(F.col("n") * 8 == F.length("floors")), "query_block", "left").withColumn("floors", F.when(F.col("n") * 8 == F.length("query_ids"), F.col("floors")))
    pairs = pairs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last)))).where(F.col("block") != first).repartition(max(1, blocks), "block")
    rest = pairs.join(candidates, "block").mapInPandas(searched, kind)
    order = Window.partitionBy("query_block", "place").orderBy(F.desc("score"), "vec_id")
    ranked = head.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
