"""WARC archives: a writer and a splittable reader.

Writer: one gzip member per record, whole archives by Spark's own file commit, so
a lost executor repeats its task and nothing is written twice. Of records with
equal payloads of at least ``min_bytes`` bytes the one with the smallest id holds
the payload (``response``); the others are ``revisit`` records that name it and
keep the HTTP headers only. Equal payloads are found by their digests, which are
counted before anything is shuffled; the pages themselves are not shuffled as
long as the list of repeated digests is small (checked).

Reader: archives are cut into byte ranges, wherever these fall. A task looks for
the gzip magic in its range, decodes the start of every candidate and takes it if
WARC headers with a type and a length come out; it owns the records that start in
its range and reads beyond its end for the last one. Magic bytes inside a
member fail that test or lie inside a record that is already owned. A task
holds one range and one record. Ranges are opened through ``pyarrow.fs`` by the
path's scheme (local or mounted folders, S3, GCS, and HDFS where libhdfs is).

Defined results: a null payload is empty; a null id is never the smallest, and
where all ids of a group are null, all are responses; records that share the
smallest id are all responses; repeated rows are records of their own; a null
URL leaves out the header, and its control characters are percent-encoded; a
record whose member is cut off or damaged is returned with ``error`` and
reading goes on behind its start; empty tables and empty archives give no rows;
other columns aren't read. A record that holds another gzipped archive unpacked
byte for byte (stored, not deflated) could be entered in the middle of it.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkiln.llm.common import slices

MAGIC = b"\x1f\x8b\x08"
#: Bytes of an archive that a task scans.
RANGE_BYTES = 16 << 20
#: Bytes read at once beyond a range, and decoded at once while looking at a candidate.
STEP, LOOK = 1 << 20, 4096
#: Repeated digests that are sent to all tasks at most; more are joined by a shuffle.
SMALL = 100_000
URN = "urn:feedkiln:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

READ = ("path string, offset long, length long, warc_type string, record_id string, target_uri string, refers_to string, "
        "payload_bytes long, payload_digest string, payload binary, error string")


# writing ------------------------------------------------------------------

def _record(kind: str, ident: str | None, url: str | None, first: str | None, digest: str, size: int, payload: bytes, date: str) -> bytes:
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode() + payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{URN}{'' if ident is None else quote(ident, safe='')}>"), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)))
    head.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if kind == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{URN}{quote(first, safe='')}>")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member whose last byte is zero: that byte is the top of its size,
    so an empty member follows one of 16 MB and more."""
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = pack.compress(data) + pack.flush()
    if out[-1]:
        empty = zlib.compressobj(level, zlib.DEFLATED, 31)
        out += empty.flush()
    return out


def _members(batches: Iterator[pa.RecordBatch], date: str, level: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "payload"):
            rows = zip(*[part[c].to_pylist() for c in ("kind", "ident", "url", "first", "digest", "payload")], strict=True)
            out = []
            for kind, ident, url, first, digest, payload in rows:
                raw = (payload or "").encode()
                out.append(member(_record(kind, ident, url, first, digest, len(raw), b"" if kind == "revisit" else raw, date), level)[:-1])
            yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])


def roles(pages: DataFrame, payload: str = "html", ident: str = "page_id", min_bytes: int = 100) -> DataFrame:
    """The pages with ``_digest``, ``_kind`` and ``_first`` (the id of the
    response that a revisit names)."""
    text = F.coalesce(F.col(payload), F.lit(""))
    keyed = pages.withColumn("_digest", F.sha2(F.encode(text, "utf-8"), 256))
    repeated = (keyed.filter(F.octet_length(text) >= min_bytes).groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"), F.min(ident).alias("_first"))
                .filter("_n > 1 and _first is not null").select("_digest", "_first")).checkpoint()
    small = repeated.count() <= SMALL
    revisit = F.col("_first").isNotNull() & ~F.col(ident).eqNullSafe(F.col("_first"))
    return (keyed.join(F.broadcast(repeated) if small else repeated, "_digest", "left")
            .withColumn("_kind", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("_first", F.when(revisit, F.col("_first"))))


def write_archive(pages: DataFrame, path: str, payload: str = "html", ident: str = "page_id", url: str = "url", min_bytes: int = 100,
                  date: str = "2024-01-01T00:00:00Z", level: int = 6) -> None:
    """Archives with one record per page below ``path``, one file per task.

    The members end with a zero byte each, which Spark's text writer puts there
    as its line separator: the files are plain concatenated members, on any file
    system that Spark writes to."""
    slim = pages.select(F.col(ident).alias("ident"), F.col(payload).cast("string").alias("payload"), F.col(url).cast("string").alias("url"))
    told = roles(slim, "payload", "ident", min_bytes).select(
        F.col("_kind").alias("kind"), F.col("ident").cast("string"), "url", F.col("_first").cast("string").alias("first"),
        F.col("_digest").alias("digest"), "payload")
    records = told.mapInArrow(lambda it: _members(it, date, level), "value binary")
    records.select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)


# reading ------------------------------------------------------------------

def headers(data: bytes) -> tuple[dict[str, str], int] | None:
    """WARC headers at the start of a record and where they end; ``None`` if
    there are none (or they go on)."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/1.") or end < 0:
        return None
    lines = data[:end].decode(errors="replace").split("\r\n")[1:]
    found = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if "warc-type" not in found or not re.fullmatch(r"[0-9]{1,18}", found.get("content-length", "")):
        return None
    return found, end + 4


class Archive:
    """A file read from any place, in steps that are kept while they are needed."""

    def __init__(self, file, start: int, end: int):
        self.file, self.base = file, start
        self.data = bytearray(file.read_at(end - start, start))

    def more(self) -> bool:
        got = self.file.read_at(STEP, self.base + len(self.data)) if self.base + len(self.data) < self.file.size() else b""
        self.data += got
        return bool(got)

    def candidate(self, at: int) -> bool:
        """Whether WARC headers decode at a magic."""
        unpack, out, i = zlib.decompressobj(31), b"", at
        while len(out) <= 1 << 20 and not unpack.eof:
            if i >= len(self.data) and not self.more():
                return False
            step = bytes(self.data[i: i + LOOK])
            i += len(step)
            try:
                out += unpack.decompress(step)
            except zlib.error:
                return False
            if out[:7] != b"WARC/1."[: len(out)]:
                return False
            if headers(out):
                return True
        return False

    def record(self, at: int) -> tuple[bytes | None, int, str | None]:
        """The decoded member at a candidate, its length, and what is wrong with it."""
        unpack, out, i = zlib.decompressobj(31), [], at
        while not unpack.eof:
            if i >= len(self.data) and not self.more():
                return b"".join(out), i - at, "cut off"
            step = bytes(self.data[i: i + STEP])
            try:
                out.append(unpack.decompress(step))
            except zlib.error:
                return b"".join(out), i - at, "damaged"
            i += len(step)
        return b"".join(out), i - len(unpack.unused_data) - at, None


def _parsed(raw: bytes, error: str | None) -> dict:
    found, begin = headers(raw)
    size = int(found["content-length"])
    block = raw[begin: begin + size]
    if error is None and (len(block) != size or raw[begin + size:] != b"\r\n\r\n"):
        error = "wrong length"
    http, sep, payload = block.partition(b"\r\n\r\n") if "http" in found.get("content-type", "") else (b"", b"", block)
    digest, full = hashlib.sha256(payload).hexdigest(), len(payload)
    named = re.fullmatch(r"sha256:([0-9a-f]{64})", found.get("warc-payload-digest", ""))
    if found["warc-type"] == "revisit":  # the payload is elsewhere: its size and digest are told
        told = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", http + b"\r\n")
        full, digest, payload = int(told[1]) if told else None, named[1] if named else None, None
    elif error is None and named and named[1] != digest:
        error = "wrong digest"
    bare = lambda k: found[k].strip("<>") if k in found else None
    return {"warc_type": found["warc-type"], "record_id": bare("warc-record-id"), "target_uri": found.get("warc-target-uri"),
            "refers_to": bare("warc-refers-to"), "payload_bytes": full, "payload_digest": digest, "payload": payload, "error": error}


def records_in(file, path: str, start: int, end: int) -> Iterator[dict]:
    """The records of an archive that start in ``[start, end)``."""
    size = file.size()
    end = min(end, size)
    held = Archive(file, start, min(end + len(MAGIC) - 1, size))
    at = held.data.find(MAGIC)
    while 0 <= at < end - start:
        nxt = at + 1
        if held.candidate(at):
            raw, length, error = held.record(at)
            yield {"path": path, "offset": start + at, "length": length, **_parsed(raw, error)}
            nxt = at + 1 if error else at + length
        at = held.data.find(MAGIC, nxt)


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs
    names = [c.split()[0] for c in READ.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary(), pa.string()]

    def table(rows: list[dict]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)

    for batch in batches:
        for path, start, end in zip(*[batch[c].to_pylist() for c in ("path", "start", "end")], strict=True):
            system, inner = fs.FileSystem.from_uri(path)
            with system.open_input_file(inner) as file:
                rows, size = [], 0
                for r in records_in(file, path, start, end):
                    size += 1000 + (len(r["payload"] or b"") if payloads else 0)
                    rows.append(r if payloads else {**r, "payload": None})
                    if size > 4 << 20:
                        yield table(rows)
                        rows, size = [], 0
                yield table(rows)


def byte_ranges(spark: SparkSession, path: str, size: int = RANGE_BYTES, glob: str = "*") -> DataFrame:
    """``path, start, end`` of all ranges of the files below ``path``; only their
    names and lengths are read here, by Spark."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
             .select(F.regexp_replace("path", r"^file:/+", "file:///").alias("path"), "length"))
    return (files.filter("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))).alias("start"))
            .select("path", "start", F.least(F.col("start") + size, F.col("length")).alias("end")))


def read_archive(spark: SparkSession, path: str, size: int = RANGE_BYTES, payloads: bool = True, glob: str = "*") -> DataFrame:
    """All records of the archives below ``path`` (columns ``READ``)."""
    ranges = byte_ranges(spark, path, size, glob)
    n = ranges.count()
    dealt = ranges.repartition(max(1, min(n, 16 * spark.sparkContext.defaultParallelism)))
    return dealt.mapInArrow(lambda it: _read(it, payloads), READ)


def id_of(urn: Column, kind: str) -> Column:
    """The id that a record's URN names, in its table's type."""
    bare = F.substring(urn, len(URN) + 1, 1 << 30)
    return F.when(bare != "", F.url_decode(F.replace(bare, F.lit("+"), F.lit("%2B"))).cast(kind))


