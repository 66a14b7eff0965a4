"""Quality rules with cross-document line frequency (12).

Every text is measured once: words, repeated windows of five words, lines that
repeat within it, symbols.  Each of its different lines is normalised (A-Z lower,
digits as 0, words joined by one space), hashed together with its host, and
counted over the distinct documents of that host.  Lines of more than
``min_docs`` documents and more than ``permille`` in a thousand of the host's are
removed; a text left with fewer than MIN_WORDS words or less than half of its
words is depleted and rejected, as is one that fails the base rules.

Counting goes by map-side combined aggregates.  The lines above the limits go
back to their documents in two ways that together do all of them: those in more
than one row of HEAVY of all rows are at most HEAVY, and are sent to every task;
the others, none of which is frequent enough to weigh on one task, are joined.

Lines are told apart by 64 bits of their hash, hosts by another 64.  Defined
cases: null text has no words and fails the base rules; a null host counts as an
empty name; rows that repeat an id are one document when documents are counted,
and each get a result; null ids are one document; texts of any length; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored

#: Words of a repeated window; the base rules' least number of words and most repeated words in a hundred.
WINDOW, MIN_WORDS, MOST_REPEATED = 5, 10, 20
#: A line goes beyond this many documents of its host, and beyond this many in a thousand of them.
MIN_DOCS, PERMILLE = 10, 1
#: Lines sent to every task are in more than one row in HEAVY, so there are HEAVY of them at the most.
HEAVY = 65_536
_SYMBOLS, _WHITE = "#*$%&|<>", " \t\n\x0b\x0c\r"
_ALIKE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
_MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<struct<key:long,words:long,at:array<int>>>"


def repeated_words(words: list[bytes]) -> int:
    """How many words stand in a window that is found twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    window, size = ids[:n].copy(), len(numbers)
    for k in range(1, WINDOW):  # a window's number, exact: numbered anew before it could overflow
        if size * len(numbers) >= 1 << 62:
            window = np.unique(window, return_inverse=True)[1].astype(np.int64)
            size = int(window.max()) + 1
        window = window * len(numbers) + ids[k : n + k]
        size *= len(numbers)
    order = np.sort(window)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    twice = np.unique(twice)
    place = np.minimum(np.searchsorted(twice, window), len(twice) - 1)
    found = twice[place] == window
    inside = np.zeros(len(words), bool)
    for k in range(WINDOW):
        inside[k : n + k] |= found
    return int(inside.sum())


def normalised(line: bytes) -> bytes:
    return b" ".join(line.translate(_ALIKE).split())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    return len(lines) - len(set(lines))


def _lines(raw: bytes, host: bytes) -> dict[int, list]:
    """By key: words of all the line's copies, and their places among the text's lines."""
    found: dict[int, list] = {}
    for at, line in enumerate(raw.translate(_ALIKE).split(b"\n")):
        words = line.split()
        if words:
            key = xxhash.xxh64_intdigest(host + b"\n" + b" ".join(words))
            mine = found.setdefault(key, [0, []])
            mine[0] += len(words)
            mine[1].append(at)
    return found


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers = [[] for _ in range(5)]
        ends, keys, words_of, place_ends, places = [0], [], [], [0], []
        for text, host in zip(batch.column("text"), batch.column("host").to_pylist(), strict=True):
            text = text.as_py()
            raw = text.encode()
            words = raw.split()
            measures = len(words), len(text) - sum(map(text.count, _WHITE)), sum(map(text.count, _SYMBOLS)), duplicate_lines(text), repeated_words(words)
            for column, value in zip(numbers, measures, strict=True):
                column.append(value)
            for key, (n, at) in _lines(raw, host.encode()).items():
                keys.append(key)
                words_of.append(n)
                places += at
                place_ends.append(len(places))
            ends.append(len(keys))
        lines = pa.StructArray.from_arrays(
            [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(words_of, pa.int64()), pa.ListArray.from_arrays(pa.array(place_ends, pa.int32()), pa.array(places, pa.int32()))], ["key", "words", "at"]
        )
        columns = [batch.column(n) for n in ("doc", "host")]
        columns += [pa.array(c, pa.int64()) for c in numbers] + [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines)]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"])


def measures(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """A stored row per document with its measures and different lines; ``row`` names it."""
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = given.mapInArrow(_measured, f"doc {kind}, host string, {_MEASURES}")
    return stored(found.select(F.monotonically_increasing_id().alias("row"), F.xxhash64("host").alias("home"), *[c for c in found.columns if c != "host"]), "line-measures")


def frequent_lines(measured: DataFrame, min_docs: int = MIN_DOCS, permille: int = PERMILLE) -> DataFrame:
    """key, home, docs and rows of the lines above the limits."""
    lines = measured.select("home", "doc", F.explode("lines.key").alias("key"))
    by_doc = lines.groupBy("home", "key", "doc").agg(F.count("*").alias("rows"))
    counts = by_doc.groupBy("home", "key").agg(F.count("*").alias("docs"), F.sum("rows").alias("rows")).where(F.col("docs") > min_docs)
    hosts = measured.select("home", "doc").distinct().groupBy("home").agg(F.count("*").alias("of"))
    return counts.join(hosts, "home").where(F.col("docs") * 1000 > F.col("of") * permille).select("key", "home", "docs", "rows")


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_docs: int = MIN_DOCS, permille: int = PERMILLE) -> DataFrame:
    """Per row: its measures, base_failed, the places of its lines that go, the words left, and kept."""
    measured = measures(docs, id_col, text_col, host_col)
    frequent = stored(frequent_lines(measured, min_docs, permille), "line-frequent")
    rows = measured.agg(F.sum(F.size("lines"))).first()[0] or 0
    heavy = frequent.where(F.col("rows") > rows // HEAVY).select("key", "home")
    others = frequent.where(F.col("rows") <= rows // HEAVY).select("key", "home")
    lines = measured.select("row", "home", F.explode("lines").alias("line")).select("row", "home", "line.key", "line.words", "line.at")
    sent = F.broadcast(heavy)
    gone = lines.join(sent, ["key", "home"], "leftsemi").unionByName(lines.join(sent, ["key", "home"], "leftanti").join(others, ["key", "home"], "leftsemi"))
    gone = gone.groupBy("row").agg(F.sum("words").alias("words_gone"), F.sort_array(F.flatten(F.collect_list("at"))).alias("lines_gone"))
    out = measured.drop("home", "lines").join(gone, "row", "left")
    out = out.withColumn("words_left", F.col("n_words") - F.coalesce("words_gone", F.lit(0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    depleted = (F.col("words_left") < MIN_WORDS) | (2 * F.col("words_left") < F.col("n_words"))
    return out.select(
        F.col("doc").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
        "words_left", F.coalesce("lines_gone", F.array().cast("array<int>")).alias("lines_gone"),
    )


def without_lines(text: F.Column, gone: F.Column) -> F.Column:
    """A text without the lines at these places (from 0)."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda line, at: ~F.array_contains(gone, at)), "\n")
