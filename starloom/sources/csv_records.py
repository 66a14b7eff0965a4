"""CSV records with quoted line breaks, read in splits.

A line break inside quotes belongs to its field, so a split of a file can't
know by itself whether its first line starts a record.  Each split is told by
two small passes:

1. every split reports in which state (inside quotes or not) it ends for
   either state in which it may begin, and whether a record that runs into it
   ends in it: three bits a split;
2. these bits, put together in file order, give each split its first state,
   and the split cuts its lines into records.  A record that runs over the
   end of a split is handed over in pieces, which are joined by its place.

Records are parsed by Spark's CSV expression.  Nothing but the bits of the
splits passes through the driver, and no task holds more than its split's
batch and one record.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LINES = "file string, start long, line string"
_PIECES = "file string, start long, part long, whole boolean, header boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.col("value").alias("line"))


def has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a line may end inside quotes: it holds some besides those of whole quoted fields."""
    line = F.col("line")
    rest = F.regexp_replace(F.rtrim(line, F.lit("\r")), r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)', "$1")
    return bool(_lines(spark, path).agg(F.bool_or(F.contains(line, F.lit('"')) & F.contains(rest, F.lit('"')))).first()[0])


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the end of ``line`` is inside quotes; a quote opens a field only at the field's start."""
    if '"' not in line:
        return inside
    at, n = 0, len(line)
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            inside, at = False, at + 1
        elif at < n and line[at] == '"':  # a field's start
            inside, at = True, at + 1
            continue
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, outside, inside, closes, out = None, False, True, False, []
    for batch in batches:
        for file, start, line in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "line")), strict=True):
            if (file, start) != key:
                if key is not None:
                    out.append((*key, outside, inside, closes))
                key, outside, inside, closes = (file, start), False, True, False
            if '"' in line:
                outside, inside = ends_inside(line, outside), ends_inside(line, inside)
            closes = closes or not inside
    if key is not None:
        out.append((*key, outside, inside, closes))
        names = ("file", "start", "outside", "inside", "closes")
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out])


def first_states(ends: list[tuple[str, int, bool, bool, bool]]) -> dict[tuple[str, int], tuple[bool, int]]:
    """For every split whether it begins inside quotes, and the split in which its first line's record began."""
    found, state, began, last = {}, False, 0, None
    for file, start, outside, inside, closes in sorted(ends):
        if file != last:
            state, began, last = False, start, file
        if not state:
            began = start
        found[file, start] = (state, began)
        if state and closes:
            began = start
        state = inside if state else outside
    return found


def records(spark: SparkSession, path: str) -> DataFrame:
    """(header, record) of the files at ``path``; ``header`` marks a file's first record."""
    lines = _lines(spark, path)
    ends = lines.mapInArrow(_states, "file string, start long, outside boolean, inside boolean, closes boolean")
    sent = spark.sparkContext.broadcast(first_states([tuple(r) for r in ends.collect()]))  # one row a split

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, began, held, first = None, False, 0, [], False
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                              [f.split()[0] for f in _PIECES.split(", ")])

        def close(ended: bool) -> None:
            """The lines held are a record, or a piece of one that other splits share."""
            nonlocal held, first, whole
            if held:
                whole_here = whole and ended
                out.append((key[0], began, key[1], whole_here, first, "\n".join(held)))
                first, held = False, []
            whole = True

        whole = True
        for batch in batches:
            for file, start, line in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "line")), strict=True):
                if (file, start) != key:
                    if key is not None:
                        close(False if inside else True)
                    key = (file, start)
                    inside, began = sent.value[key]
                    whole, first = not inside, start == 0
                inside = ends_inside(line, inside)
                held.append(line)
                if not inside:
                    close(True)
                    began = start
            if len(out) >= 1000:
                yield made()
        if key is not None:
            close(not inside)
        if out:
            yield made()

    pieces = lines.mapInArrow(cut, _PIECES)
    whole = pieces.where("whole").select("header", "record")
    parts = pieces.where("not whole").groupBy("file", "start").agg(  # the pieces of one record
        F.bool_or("header").alias("header"), F.sort_array(F.collect_list(F.struct("part", "record"))).alias("p"))
    joined = parts.select("header", F.array_join(F.col("p.record"), "\n").alias("record"))
    return whole.unionByName(joined).withColumn("record", F.rtrim(F.col("record"), F.lit("\r")))


def read(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The records as text columns, named as the header names them."""
    rows = records(spark, path).where("not header").where(F.trim("record") != "")
    schema = ", ".join(f"`c{i}` STRING" for i in range(len(columns)))
    parsed = rows.select(F.from_csv("record", schema, {"escape": '"', "mode": "PERMISSIVE"}).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(columns)])
