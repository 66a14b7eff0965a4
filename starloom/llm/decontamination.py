"""Benchmark decontamination (1): SimHash of item-sized windows.

For each benchmark item the documents are looked through in windows of the
item's length in words.  A window and an item match when their weighted
five-word shingles are similar: each shingle weighs as often as it occurs, and
the common weight is 0.75 or more of the united weight.

1. A window that matches holds 0.75 of the item's shingles, so of any
   n - ceil(0.75 n) + 1 of them at least one.  Only these (the ones with the
   smallest hashes) are looked up.  A whole window and an item of n shingles each
   share ceil(6 n / 7) at least, so that the window holds all looked up but
   n - ceil(6 n / 7): every window that holds as many is laid, wherever in it
   they stand.
2. Each window and item has a 64-bit SimHash.  It is cut into RADIUS + 1 blocks;
   fingerprints within RADIUS bits agree in a block at least, so that the join on
   (length, block, bits) returns all of them, and their distance is then counted.
   At a similarity of 0.75 the distance is 11 bits on average with a standard
   deviation of 3, so that RADIUS leaves 3.6 of these.
3. Whole shingle weights are compared for the pairs within the radius.

Everything is DataFrame operations.  The item side is broadcast in groups of
items that hold GROUP_SHINGLES shingles on average, however many items there
are; documents are looked through once per group.  Only texts with a found
shingle are joined again with their windows.

Defined cases: null and empty texts and items have no shingles and match
nothing; an item of fewer than five words has its whole sequence as its one
shingle; a document shorter than an item is one window; documents equal in id
and text count once, the others each by themselves, null ids included; of equal
similarities the first window is returned; repeated items are items each (of
the same id: once); empty tables give an empty result; of the documents only id
and text are read, whatever other columns are called.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import blocks_for, stored, text_of

WIDTH = 5
PERCENT = 75
#: Bits in which fingerprints may differ.
RADIUS = 22
BITS = 64
#: Shingles of a group of items.
GROUP_SHINGLES = 200_000


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[ \\t-\\r]+"), lambda w: w != "")


def _shingles(words: Column, width: Column | int) -> Column:
    """Hashes of all runs of ``width`` words (at most WIDTH), in order."""
    width = F.lit(width) if isinstance(width, int) else width
    none = F.array().cast("array<bigint>")
    parts = [lambda i, k=k: F.when(F.lit(k) < width, F.get(words, i + k)) for k in range(WIDTH)]
    made = F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: F.xxhash64(*[p(i) for p in parts]))
    return F.when((width > 0) & (F.size(words) >= width), made).otherwise(none)


def _fixed_shingles(words: Column, width: int) -> Column:
    """The same hashes for a width that is known."""
    none = F.array().cast("array<bigint>")
    made = F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: F.xxhash64(*[F.get(words, i + k) if k < width else F.lit(None).cast("string") for k in range(WIDTH)]))
    return F.when(F.size(words) >= width, made).otherwise(none)


def simhash(shingles: Column) -> Column:
    """Each bit as the majority of the shingles' bits, each as often as it occurs."""
    ones = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.aggregate(shingles, F.lit(0), lambda n, x: n + F.call_function("getbit", x, b).cast("int")))
    bits = F.transform(ones, lambda n, b: F.when(2 * n > F.size(shingles), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def blocks(fingerprint: Column) -> Column:
    """(block, bits): RADIUS + 1 pieces that together are the fingerprint."""
    edges = [BITS * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    pieces = [F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("bits")) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    return F.array(*pieces)


def common_weight(a: Column, b: Column) -> Column:
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda n, x: n + F.least(F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))


def prepared_items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, length, width, shingles, fingerprint, probes (the shingles looked up, with their places)."""
    out = items.select(F.col(id_col).alias("item_id"), _words(text_of(F.col(text_col))).alias("w")).withColumn("length", F.size("w")).where("length > 0").withColumn("width", F.least("length", F.lit(WIDTH)))
    out = out.select("item_id", "length", "width", _shingles(F.col("w"), F.col("width")).alias("shingles")).distinct()
    size = F.size("shingles")
    looked_up = size - F.ceil(size * PERCENT / 100).cast("int") + 1
    placed = F.array_sort(F.transform("shingles", lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    # places of one shingle count as one of the set that the bound is about, so all of them are looked up
    out = out.withColumn("placed", placed).withColumn("last", F.element_at("placed", looked_up)["h"])
    return out.withColumn("probes", F.filter("placed", lambda p: p["h"] <= F.col("last"))).withColumn("fingerprint", simhash(F.col("shingles"))).drop("placed", "last")


def windows(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """doc_id, doc_hash, length, start, shingles of the windows to look at.  items: of one width, one group."""
    size = F.size("shingles")
    least = F.size("probes") - size + F.ceil(size * (2 * PERCENT) / (100 + PERCENT)).cast("int")
    probes = items.select("length", F.xxhash64("shingles").alias("of"), F.greatest(least, F.lit(1)).alias("least"), F.explode(F.array_distinct(F.col("probes.h"))).alias("h")).distinct()
    cut = docs.withColumn("w", _words(F.col("text"))).withColumn("s", _fixed_shingles(F.col("w"), width))
    spread = cut.select("doc_id", "doc_hash", F.size("w").alias("n"), F.posexplode_outer("s").alias("pos", "h"))  # outer: else the filter for empty arrays computes them again
    hits = spread.join(F.broadcast(probes), "h")  # GROUP_SHINGLES rows, or one item's, at the most
    found = hits.groupBy("doc_id", "doc_hash", "n", "length", "of", "least").agg(F.array_sort(F.collect_list("pos")).alias("at"))
    # between the last of ``least`` places in a row at the window's end and the first at its start
    runs = F.transform(F.slice("at", F.lit(1), F.greatest(F.size("at") - F.col("least") + 1, F.lit(0))), lambda first, i: F.struct((F.get("at", i + F.col("least") - 1) - F.col("length") + width).alias("lo"), first.alias("hi")))
    fit = F.transform(F.filter(runs, lambda r: r["lo"] <= r["hi"]), lambda r: F.sequence(r["lo"], r["hi"]))
    fit = F.filter(F.array_distinct(F.flatten(fit)), lambda x: (x >= 0) & (x <= F.col("n") - F.col("length")))
    starts = F.when(F.col("n") <= F.col("length"), F.array(F.lit(0))).otherwise(fit)
    # distinct first: a document's windows are at most its words times the lengths of items
    laid = found.select("doc_id", "doc_hash", "length", F.explode(starts).alias("start")).distinct().groupBy("doc_id", "doc_hash").agg(F.collect_list(F.struct("length", "start")).alias("laid"))
    laid = laid.select(F.col("doc_id").alias("of_id"), F.col("doc_hash").alias("of_hash"), "laid")
    found = docs.join(laid, docs["doc_id"].eqNullSafe(F.col("of_id")) & (docs["doc_hash"] == F.col("of_hash")))
    found = found.withColumn("w", _words(F.col("text"))).withColumn("s", _fixed_shingles(F.col("w"), width))
    # the explosion also keeps the shingles from being computed anew for each window
    laid_out = found.select("doc_id", "doc_hash", "s", F.explode("laid").alias("x"))
    return laid_out.select("doc_id", "doc_hash", "x.length", "x.start", F.slice("s", F.col("x.start") + 1, F.col("x.length") - (width - 1)).alias("shingles"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, doc_hash, item_id, start, similarity: the best window of each document and item that match."""
    items = stored(prepared_items(benchmark, item_col, item_text_col), "decontamination-items")
    shapes = items.groupBy("width").agg(F.sum(F.size("probes")).alias("n")).collect()  # WIDTH rows at the most
    given = docs.select(F.col(id_col).alias("doc_id"), text_of(F.col(text_col)).alias("text")).withColumn("doc_hash", F.xxhash64("text"))
    parts = []
    for shape in sorted(shapes, key=lambda r: r["width"]):
        groups = blocks_for(shape["n"], GROUP_SHINGLES)
        for group in range(groups):
            some = items.where((F.col("width") == shape["width"]) & (F.pmod(F.xxhash64("item_id", "shingles"), F.lit(groups)) == group))
            parts.append(_matches(windows(given, some, shape["width"]), some))
    if not parts:
        kind = f"doc_id {dict(docs.dtypes)[id_col]}, doc_hash long, item_id {dict(benchmark.dtypes)[item_col]}, start int, similarity double"
        return docs.sparkSession.createDataFrame([], kind)
    best = F.max_by(F.struct("start", "similarity"), F.struct(F.col("similarity"), -F.col("start"))).alias("best")
    out = reduce(DataFrame.unionByName, parts).groupBy("doc_id", "doc_hash", "item_id").agg(best)
    return out.select("doc_id", "doc_hash", "item_id", "best.start", "best.similarity")


def _matches(found: DataFrame, items: DataFrame) -> DataFrame:
    """The windows and items within the radius whose shingle weights are similar."""
    marked = found.withColumn("fingerprint", simhash(F.col("shingles")))
    side = items.select("item_id", "length", F.col("fingerprint").alias("item_print"), F.col("shingles").alias("item_shingles"))
    index = side.select("item_id", "length", "item_print", F.explode(blocks(F.col("item_print"))).alias("k")).select("item_id", "length", "item_print", "k.*")
    spread = marked.select("doc_id", "doc_hash", "length", "start", "fingerprint", "shingles", F.explode(blocks(F.col("fingerprint"))).alias("k")).select("doc_id", "doc_hash", "length", "start", "fingerprint", "shingles", "k.*")
    near = spread.join(index, ["length", "block", "bits"]).where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    # a pair that agrees in several blocks is taken where it first does
    first = F.array_min(F.transform(F.filter(F.arrays_zip(blocks(F.col("fingerprint")).alias("a"), blocks(F.col("item_print")).alias("b")), lambda z: z["a"]["bits"] == z["b"]["bits"]), lambda z: z["a"]["block"]))
    near = near.where(F.col("block") == first).join(side.select("item_id", "item_print", "length", "item_shingles"), ["item_id", "item_print", "length"])
    common = common_weight(F.col("shingles"), F.col("item_shingles"))
    near = near.withColumn("common", common).withColumn("united", F.size("shingles") + F.size("item_shingles") - F.col("common"))
    return near.where(F.col("common") * 100 >= F.col("united") * PERCENT).select("doc_id", "doc_hash", "item_id", "start", (F.col("common") / F.col("united")).alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a leak, all columns kept."""
    found = leaks(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("__leak_id"), F.col("doc_hash").alias("__leak_hash")).distinct()
    return docs.join(found, F.col(id_col).eqNullSafe(F.col("__leak_id")) & (F.xxhash64(text_of(F.col(text_col))) == F.col("__leak_hash")), "left_anti")
