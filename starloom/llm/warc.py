"""WARC files with a two-level capture index (10).

Writing: every row becomes one WARC record, a gzip member of its own.  Rows with
equal payloads (by SHA-1) of at least ``min_revisit`` bytes share one response,
that of the largest id; the others become revisit records that name it.  Which
rows those are is found on ids and digests; payloads are moved once, by digest,
to meet that answer (those of digests that are more than a row in HEAVY are not
moved at all: their answers, HEAVY at the most, go to all tasks), and written to
archives where they arrive.  Only index lines are sorted, by reversed-host URL
key: lines of key, record place, type and id, in compressed blocks.  The
directory has one row per block with the block's first key and place; blocks
grow with the number of records, so that the directory has DIRECTORY rows at the
most and can be sent to all tasks.

Reading: a look-up binary-searches the directory, reads and unpacks that block
by its byte range, binary-searches the block, and reads the record by its range.
Reading everything unpacks every block once and deals its lines by archive, a
range of CHUNK bytes a time; a revisit's length is that of the response with its
digest, as it was read back, by one join.

Files are written to a shared folder under names of their own; the directory,
written by Spark's commit protocol, alone says which files count, so that a lost
or repeated task leaves at most an unused file.  The folder is any that pyarrow
can open from a URI (file, hdfs, s3, gs).

Defined cases: null payload counts as empty; a null URL has an empty key and no
target URI; of rows that repeat the largest id of a payload each is a response;
a null id counts as smaller than any; control characters in URLs are percent-
encoded; payloads of any length are one record each; an empty table writes an
empty directory and reads as an empty table; only the id, the URL and the payload
are read, whatever other columns are called.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import shared_folder, stored, text_of
from starloom.llm.urls import reversed_key

#: Rows of the directory at the most, and records of a block at the least.
DIRECTORY, BLOCK_RECORDS = 65_536, 500
#: Digests whose rows stay where they are hold more than one row in HEAVY, so there are HEAVY of them at the most.
HEAVY = 4_096
#: Bytes of an archive that are read at a time.
CHUNK = 4_000_000
_DIRECTORY = "first_key string, index_file string, at long, size long, records long"
_LINES = "key string, page long, line string"
_PLACES = "archive string, at long, size long"
_READ = "id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_text(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(kind: str, page: int | None, url: str | None, payload: bytes, sha1: str, of: tuple[int | None, str | None] | None, date: str) -> bytes:
    """One record as a gzip member."""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {url} {sha1}')}>", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{sha1}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_text(url)}")
    if page is not None:
        head.append(f"X-Page-Id: {page}")
    if of:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Date: {date}"]
        head += [f"WARC-Refers-To-Target-URI: {_header_text(of[1])}"] if of[1] is not None else []
        head += [f"X-Refers-To-Page-Id: {of[0]}"] if of[0] is not None else []
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    else:
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of a gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def index_key(key: str | None, page: int | None) -> str:
    """Sorts as bytes by URL key, then id; no white space inside."""
    return f"{_header_text(key or '')} {'-' if page is None else format(page + (1 << 63), '020d')}"


def decided(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_revisit: int) -> DataFrame:
    """page, url, payload, key, sha1 and, for revisits, of (page and url of the response)."""
    given = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), text_of(F.col(payload_col)).alias("payload"))
    given = given.withColumn("sha1", F.sha1(F.encode("payload", "utf-8"))).withColumn("size", F.octet_length("payload"))
    # nulls sort below all ids, in structs too; partial aggregation meets hot payloads before the shuffle
    best = given.where(F.col("size") >= min_revisit).groupBy("sha1").agg(F.max(F.struct("page", "url")).alias("of"), F.count("*").alias("rows"))
    best = stored(best.select(F.col("sha1").alias("same"), "of", "rows"), "warc-responses")
    rows = best.agg(F.sum("rows")).first()[0] or 0
    heavy = F.broadcast(best.where(F.col("rows") > rows // HEAVY).drop("rows"))
    same = given["sha1"] == F.col("same")
    near = given.join(heavy, same)
    far = given.join(heavy, same, "left_anti").join(best.where(F.col("rows") <= rows // HEAVY).drop("rows"), same, "left")
    out = near.unionByName(far)
    first = F.col("of").isNull() | F.col("page").eqNullSafe(F.col("of.page"))
    # a revisit's payload isn't stored
    return out.select("page", "url", F.when(first, F.col("payload")).otherwise(F.lit("")).alias("payload"), "sha1", F.when(~first, F.col("of")).alias("of"), reversed_key(F.col("url")).alias("key"))


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes archives and index files to ``folder``; returns the directory, sorted by no order in particular."""
    rows = decided(pages, id_col, url_col, payload_col, min_revisit)

    def archived(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive, name, at = None, uuid.uuid4().hex, 0
        for batch in batches:
            lines = []
            for page, url, payload, sha1, of_page, of_url, revisit, key in batch.itertuples(index=False):
                if archive is None:
                    system, base = _open(folder)
                    system.create_dir(base, recursive=True)
                    archive = system.open_output_stream(f"{base}/{name}.warc.gz", compression=None)
                page = None if page is None else int(page)  # ids as text: a float would round large ones
                of = (None if of_page is None else int(of_page), of_url) if revisit else None
                sha1 = base64.b32encode(bytes.fromhex(sha1)).decode()
                member = record("revisit" if revisit else "response", page, url, payload.encode(), sha1, of, date)
                archive.write(member)
                lines.append((_header_text(key or ""), page, f"{index_key(key, page)} {at} {len(member)} {name}.warc.gz {'revisit' if revisit else 'response'}"))
                at += len(member)
            keys, ids, told = zip(*lines, strict=True) if lines else ((), (), ())
            yield pd.DataFrame({"key": keys, "page": pd.array(ids, dtype="Int64"), "line": told})
        if archive is not None:
            archive.close()

    dealt = rows.select(F.col("page").cast("string").alias("page"), "url", "payload", "sha1", F.col("of.page").cast("string").alias("of_page"), F.col("of.url").alias("of_url"), F.col("of").isNotNull().alias("revisit"), "key")
    lines = stored(dealt.mapInPandas(archived, _LINES), "warc-lines")  # archives are written once, whatever reads the lines
    total = lines.count()
    per_block = max(BLOCK_RECORDS, math.ceil(total / (DIRECTORY / 2)))
    files = min(max(1, total // (64 * per_block)), DIRECTORY // 2)

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, name, at, lines, found = None, uuid.uuid4().hex, 0, [], []

        def close_block() -> None:
            nonlocal at, lines
            packed = zlib.compress("\n".join(lines).encode(), 6)
            index.write(packed)
            found.append((lines[0].rsplit(" ", 4)[0], f"{folder}/{name}.idx", at, len(packed), len(lines)))
            at, lines = at + len(packed), []

        for batch in batches:
            for line in batch["line"]:
                if index is None:
                    system, base = _open(folder)
                    index = system.open_output_stream(f"{base}/{name}.idx", compression=None)
                lines.append(line)
                if len(lines) == per_block:
                    close_block()
        if lines:
            close_block()
        if index is not None:
            index.close()
        if found:
            yield pd.DataFrame(found, columns=["first_key", "index_file", "at", "size", "records"])

    # the order of index_key: by bytes of the escaped key, then id
    order = ["key", "page", "line"]
    return stored(lines.repartitionByRange(files, *order).sortWithinPartitions(*order).select("line").mapInPandas(indexed, _DIRECTORY), "warc-directory")


class Reader:
    """Look-ups by key through the directory."""

    def __init__(self, directory: list[tuple]):
        self.rows = sorted(directory)
        self.first = [r[0] for r in self.rows]
        self.files: dict[str, object] = {}
        self.block_of, self.block = None, []

    def range(self, path: str, at: int, size: int) -> bytes:
        if path not in self.files:
            if len(self.files) >= 16:
                self.files.pop(next(iter(self.files))).close()
            system, base = _open(path)
            self.files[path] = system.open_input_file(base)
        return self.files[path].read_at(size, at)

    def lines(self, row: tuple) -> list[list[str]]:
        """The lines of a block, split: key and id, place, size, archive, type."""
        if self.block_of != row:
            _, path, at, size, _ = row
            self.block = [line.rsplit(" ", 4) for line in zlib.decompress(self.range(path, at, size)).decode().split("\n")]
            self.block_of = row
        return self.block

    def lookup(self, key: str, kind: str | None = None) -> tuple[dict[str, str], bytes] | None:
        """The record of a key and id (of a type), or None."""
        i = bisect.bisect_left(self.first, key)  # blocks before it may end with the key
        i = max(0, i - 1)
        while i < len(self.rows) and (self.first[i] <= key):
            lines = self.lines(self.rows[i])
            j = bisect.bisect_left(lines, key, key=lambda x: x[0])
            while j < len(lines) and lines[j][0] == key:
                if kind in (None, lines[j][4]):
                    path = self.rows[i][1].rsplit("/", 1)[0] + "/" + lines[j][3]
                    return parse(self.range(path, int(lines[j][1]), int(lines[j][2])))
                j += 1
            i += 1
        return None


def _uri_key(url: str | None) -> str:
    """``reversed_key`` of a stored URL."""
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", url or "")
    host = m[1].lower().rstrip(".") if m else ""
    if not host:
        return url or ""
    return ",".join(reversed(host.split("."))) + ")" + re.match(r"[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", url)[1]


def read_all(directory: DataFrame) -> DataFrame:
    """id, payload_bytes, payload_digest, record_type, refers_to of every record, read back from the archives."""

    def unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, at, size in zip(batch["index_file"], batch["at"], batch["size"]):
                folder = path.rsplit("/", 1)[0]
                system, base = _open(path)
                with system.open_input_file(base) as f:
                    lines = [x.rsplit(" ", 4) for x in zlib.decompress(f.read_at(int(size), int(at))).decode().split("\n")]
                yield pd.DataFrame([(f"{folder}/{x[3]}", int(x[1]), int(x[2])) for x in lines], columns=["archive", "at", "size"])

    def back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, f = None, None
        for batch in batches:
            out, i = [], 0
            places = list(batch[["archive", "at", "size"]].itertuples(index=False, name=None))
            while i < len(places):  # records that stand in a row: some MB at a time
                archive, start, size = places[i]
                j = i + 1
                while j < len(places) and places[j][0] == archive and places[j][1] == start + size and size < CHUNK:
                    size += places[j][2]
                    j += 1
                if archive != path:
                    if f is not None:
                        f.close()
                    system, base = _open(archive)
                    path, f = archive, system.open_input_file(base)
                raw, at = f.read_at(size, start), 0
                for _, _, n in places[i:j]:
                    out.append(_answer(*parse(raw[at : at + n])))
                    at += n
                i = j
            names = [c.split() for c in _READ.split(", ")]
            columns = zip(*out, strict=True) if out else [()] * len(names)
            yield pd.DataFrame({n: pd.array(c, dtype="Int64") if kind == "long" else list(c) for (n, kind), c in zip(names, columns, strict=True)})
        if f is not None:
            f.close()

    chunk = F.floor(F.col("at") / CHUNK)
    places = directory.repartition("index_file", "at").mapInPandas(unpacked, _PLACES)
    places = places.repartition("archive", chunk).sortWithinPartitions("archive", "at")
    read = stored(places.mapInPandas(back, _READ), "warc-records")
    first = F.col("record_type") == "response"
    responses = read.where(first).groupBy(F.col("payload_digest").alias("same")).agg(F.max("payload_bytes").alias("bytes"))
    revisits = read.where(~first)
    asked = revisits.groupBy(F.col("payload_digest").alias("digest")).agg(F.count("*").alias("rows")).join(responses, F.col("digest") == F.col("same"), "left")
    # a revisit without a response of its digest is an error, not a row
    lost = F.raise_error(F.concat(F.lit("no response for revisits of the payload "), F.col("digest")))
    asked = stored(asked.select("digest", "rows", F.coalesce("bytes", lost.cast("long")).alias("bytes")), "warc-revisited")
    rows = asked.agg(F.sum("rows")).first()[0] or 0
    same = F.col("payload_digest") == F.col("digest")
    heavy = F.broadcast(asked.where(F.col("rows") > rows // HEAVY).drop("rows"))
    found = revisits.join(heavy, same).unionByName(revisits.join(heavy, same, "left_anti").join(asked.where(F.col("rows") <= rows // HEAVY).drop("rows"), same))
    return read.where(first).unionByName(found.select("id", F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))


def _answer(fields: dict[str, str], payload: bytes) -> tuple:
    """What a record says; a response's digest is that of its payload, or an error."""
    page = int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None
    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] != "response":
        return page, None, said, fields["WARC-Type"], int(fields["X-Refers-To-Page-Id"]) if "X-Refers-To-Page-Id" in fields else None
    if digest(payload) != said:
        raise ValueError(f"record of {page}: the payload's digest is {digest(payload)}, the record says {said}")
    return page, len(payload), said, "response", None


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = 0) -> DataFrame:
    """Writes a record per row to a new shared folder and reads the archives back."""
    directory = write(pages, shared_folder(pages.sparkSession, "warc"), id_col, url_col, payload_col, min_revisit)
    return read_all(directory).withColumnRenamed("id", id_col)
