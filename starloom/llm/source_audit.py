"""Source divergence audit with duplicate-text collapse (11).

Identical texts of a language are one text with the number of times that each
source holds it.  Each is cut into terms once; a term's occurrences and documents
are added with those multiplicities to the counts of its (language, source).
Terms of at least ``min_docs`` documents of the language are kept, and every
group's smoothed share of each kept term, in billionths, is

    p = 1 + floor(10^9 * (count + 5) / (N + 5 V)).

Pairs of sources are compared by the sum of abs(p - q) over all kept terms.  A
source's terms with no occurrence share one value z, so that a pair needs only
the terms that either holds: sums against the other's z for each, a correction
for the terms of both, and abs(z - z') for each of the rest.  Terms are dealt
over blocks and sources over squares of blocks, so that a task holds a bounded
part of the (source, term) table and SQUARE x SQUARE sums; the result itself has
a row for each pair.

Everything is exact: shares by decimals of 38 digits, sums by whole numbers below
2^53.  Texts are told apart by SHA-256.  Defined cases: null text, language and
source count as empty names; repeated rows count each; a group without kept
terms has shares of the smoothing alone, and with V = 0 all values are 0; texts
of any length; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import blocks_for, stored

MIN_DOCS, SMOOTHING, SCALE, TERMS_SHOWN = 30, 5, 1_000_000_000, 50
#: Terms that a task holds before it hands its counts on.
HELD = 400_000
#: Sources of a square's side, and rows of the (source, term) table in a block of terms.
SQUARE, BLOCK_ROWS = 512, 50_000
#: All but ASCII letters and bytes of letters beyond ASCII separates terms; A-Z are lowered.
_TERMS = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_TERMS).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per (lang, source, term) of texts with their sources' multiplicities."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed_on() -> pa.RecordBatch:
        langs, sources, found, n, docs = [], [], [], [], []
        for (lang, source), (counts, documents) in held.items():
            langs += [lang] * len(counts)
            sources += [source] * len(counts)
            found += counts.keys()
            n += counts.values()
            docs += map(documents.__getitem__, counts)
        held.clear()
        columns = [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(found, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _COUNTS.split(", ")])

    for batch in batches:
        for lang, text, sources in zip(batch.column("lang").to_pylist(), batch.column("text"), batch.column("sources").to_pylist(), strict=True):
            found = terms(text.as_py())
            once = None if len(sources) == 1 and sources[0]["n"] == 1 else Counter(found)
            for source in sources:
                counts, documents = held.setdefault((lang, source["source"]), (Counter(), Counter()))
                if once is None:
                    counts.update(found)
                    documents.update(set(found))
                    continue
                times = source["n"]
                for term, n in once.items():
                    counts[term] += n * times
                    documents[term] += times
        if sum(len(counts) for counts, _ in held.values()) >= HELD:
            yield handed_on()
    if held:
        yield handed_on()


def collapsed(docs: DataFrame) -> DataFrame:
    """Each different text of a language once, with an array of (source, n): no longer than the language's sources."""
    hashed = docs.withColumn("h", F.unhex(F.sha2(F.encode("text", "utf-8"), 256)))
    times = hashed.groupBy("lang", "h", "source").agg(F.count("*").alias("n")).groupBy("lang", "h").agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    texts = hashed.groupBy("lang", "h").agg(F.first("text").alias("text"))
    return texts.join(times, ["lang", "h"]).select("lang", "text", "sources")


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n and the language's total, for kept terms that the group holds; stored."""
    counts = collapsed(docs).mapInArrow(_counted, _COUNTS)
    counts = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    counts = counts.withColumn("total", F.sum("n").over(of_term)).withColumn("docs", F.sum("docs").over(of_term))
    return stored(counts.where(F.col("docs") >= min_docs).select("lang", "source", "term", "n", "total"), "source-terms")


def share(n: Column, all_n: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 5) / (N + 5 V)), whatever the counts' size."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + F.lit(SMOOTHING)).cast("decimal(20,0)")
    below = (all_n + F.lit(SMOOTHING) * kept).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, F.when(below > 0, below))


def _against(p: np.ndarray, z: np.ndarray) -> np.ndarray:
    """For each z the sum of abs(p - z) over p."""
    p = np.sort(p)
    sums = np.concatenate(([0], np.cumsum(p)))
    at = np.searchsorted(p, z)
    return z * at - sums[at] + (sums[-1] - sums[at]) - z * (len(p) - at)


def _square(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over a block of terms for each pair a < b of a square: of the terms that either holds, and their number."""
    lang, i, j = rows["lang"].iloc[0], int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
    members = rows[rows["term"].isna()].sort_values("sid")
    sids, z = members["sid"].to_numpy(np.int64), members["p"].to_numpy(np.int64)
    held = rows[rows["term"].notna()]
    code = pd.factorize(held["term"])[0]
    who, p = np.searchsorted(sids, held["sid"].to_numpy(np.int64)), held["p"].to_numpy(np.int64)
    order = np.lexsort((who, code))  # by term
    code, who, p = code[order], who[order], p[order]
    of = np.argsort(who, kind="stable")
    mine = np.split(of, np.cumsum(np.bincount(who, minlength=len(sids)))[:-1])
    size = np.array([len(m) for m in mine])
    alone = np.stack([_against(p[m], z) for m in mine])  # [a, b]: a's terms against b's share of absent terms
    side = sids // SQUARE
    left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
    keep = side[who] == j  # the terms of the right side
    code_r, who_r, p_r = code[keep], who[keep] - (right[0] if len(right) else 0), p[keep]
    starts = np.searchsorted(code_r, np.arange(code.max(initial=-1) + 2))
    out = []
    for a in left:
        cells = mine[a]
        n = starts[code[cells] + 1] - starts[code[cells]]
        first = np.repeat(starts[code[cells]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        b, pb, pa_ = who_r[first], p_r[first], np.repeat(p[cells], n)
        zb = z[right][b]
        change = np.abs(pa_ - pb) - np.abs(pa_ - zb) - np.abs(pb - z[a])
        both = np.bincount(b, minlength=len(right))
        # whole numbers far below 2^53, so that sums of doubles are exact
        total = alone[a, right] + alone[right, a] + np.bincount(b, change, minlength=len(right)).astype(np.int64)
        ahead = sids[right] > sids[a]
        out.append(pd.DataFrame({"a": sids[a], "b": sids[right][ahead], "total": total[ahead], "held": (size[a] + size[right] - both)[ahead]}))
    out = pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("a", "b", "total", "held")})
    out.insert(0, "lang", lang)
    return out


def _blocks(counts: DataFrame, groups: DataFrame) -> int:
    """Blocks of terms: as many as give each about BLOCK_ROWS rows, but no more sums over blocks than rows."""
    rows, pairs = counts.count(), groups.groupBy("lang").count().agg(F.sum(F.col("count") * F.col("count") / 2)).first()[0] or 0
    return max(1, min(blocks_for(rows, BLOCK_ROWS), int(rows / max(pairs, 1))))


def _pairs(cells: DataFrame, groups: DataFrame, blocks: int) -> DataFrame:
    """lang, a, b (numbers of sources, a < b) and the sum of abs(p - q) over all kept terms."""
    blocks_of = groups.groupBy("lang").agg(F.max(F.floor(F.col("sid") / SQUARE)).alias("last"))
    numbered, zero = groups.join(blocks_of, "lang"), F.lit(0).cast("long")
    members = numbered.select("lang", "sid", F.col("z").alias("p"), F.lit(None).cast("string").alias("term"), "last", F.explode(F.sequence(zero, F.lit(blocks - 1).cast("long"))).alias("block"))
    held = cells.join(numbered.select("lang", "source", "sid", "last"), ["lang", "source"]).select("lang", "sid", "p", "term", "last", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"))
    # a source takes part in the squares of its own block with every block
    own = F.floor(F.col("sid") / SQUARE)
    rows = members.unionByName(held).withColumn("other", F.explode(F.sequence(zero, F.col("last"))))
    rows = rows.withColumn("i", F.least(own, "other")).withColumn("j", F.greatest(own, "other")).select("lang", "i", "j", "block", "sid", "term", "p")
    sums = rows.groupBy("lang", "i", "j", "block").applyInPandas(_square, "lang string, a long, b long, total long, held long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("total").alias("total"), F.sum("held").alias("held"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, terms_shown: int = TERMS_SHOWN) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    empty = F.lit("")
    given = docs.select(F.coalesce(F.col(lang_col), empty).alias("lang"), F.coalesce(F.col(source_col), empty).alias("source"), F.coalesce(F.col(text_col), empty).alias("text"))
    counts = term_counts(given, min_docs)
    by_lang = counts.groupBy("lang", "term").agg(F.max("total").alias("total")).groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_n"))
    by_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = given.select("lang", "source").distinct().join(by_lang, "lang", "left").join(by_group, ["lang", "source"], "left").na.fill(0, ["kept", "lang_n", "group_n"])
    sid = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long")
    # a group's number, its share of absent terms; with V = 0 nothing is compared
    groups = stored(groups.select("*", sid.alias("sid"), F.coalesce(share(F.lit(0).cast("long"), F.col("group_n"), F.col("kept")), F.lit(0).cast("long")).alias("z")), "source-groups")
    cells = counts.join(groups.select("lang", "source", "kept", "lang_n", "group_n"), ["lang", "source"])
    cells = cells.select("lang", "source", "term", share(F.col("n"), F.col("group_n"), F.col("kept")).alias("p"), share(F.col("total"), F.col("lang_n"), F.col("kept")).alias("q"))

    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    above = cells.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    above = above.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= terms_shown)

    # squares copy a source's cells once a block of sources; both bound what a task holds
    pairs = _pairs(cells.drop("q"), groups, _blocks(counts, groups))
    named = groups.select("lang", "sid", "source", "z", "kept")
    a, b = (named.select(F.col("lang").alias(f"l{x}"), F.col("sid").alias(f"s{x}"), F.col("source").alias(f"source_{x}"), F.col("z").alias(f"z{x}"), F.col("kept").alias(f"v{x}")) for x in "ab")
    pairs = pairs.join(a, (F.col("lang") == F.col("la")) & (F.col("a") == F.col("sa"))).join(b, (F.col("lang") == F.col("lb")) & (F.col("b") == F.col("sb")))
    value = F.col("total") + (F.col("va") - F.col("held")) * F.abs(F.col("za") - F.col("zb"))
    sides = F.explode(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")), F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))
    pairs = pairs.select("lang", sides.alias("x"), value.alias("value")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(above)
