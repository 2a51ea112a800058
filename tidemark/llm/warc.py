"""WARC archives: writing, reading, and resolving revisits by payload digest.

Archives are WARC/1.1, one gzip member a record, in parts that Spark's own writer
puts into the shared folder.  Records
are written by classes of size: a part holds PART_BYTES of records or fewer, or
one record.  Parts are read a member at a time.

1. Every page becomes a response record, with the base-32 SHA-1 of its payload.
2. Headers alone are kept from a first reading (with the byte range of each
   record's member) and grouped by digest: counts and maxima combine before the
   shuffle, so a digest that a third of all pages share is one row a task.
   Headers then join their digest's original; Spark can split a hot one.
3. The archive is read once more and written anew, with new record ids and
   headers: originals with their payload, revisits with the headers that refer
   to the original.  Names of parts are joined with what is to be done in them;
   tasks open the parts where they lie (a folder that Spark and Arrow reach), so
   contents are neither shuffled nor sorted.

A page's digest is compared with the payload found at every reading.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .session import new_path, remove, written

#: Payload bytes of one part at most (or one record), and of the least class of payloads; each class is four times the one before.
PART_BYTES, LEAST_CLASS = 64 << 20, 16 << 10
#: Tasks that rewrite parts, at most; beyond that number of parts a task has several.
MOST_TASKS = 100_000
#: Bytes of a part that are unpacked at once.
CHUNK = 1 << 16
_END = b"\r\n\r\n"
_NO_DATA = gzip.compress(b"", mtime=0)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Record(NamedTuple):
    headers: dict[str, str]
    start: int  # of the payload
    end: int


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_id(page_id: int, sha: str, archive: str) -> str:
    """The id of a page's record in an archive: another one for each payload, and in each archive."""
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}:{page_id}:{sha}').urn}>"


def now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def safe(url: str | None) -> str:
    """The URL without characters that would break a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")


def header(fields: list[tuple[str, str]]) -> str:
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"


def response(page_id: int, url: str | None, payload: bytes, sha: str, archive: str, date: str) -> bytes:
    return header([("WARC-Type", "response"), ("WARC-Record-ID", record_id(page_id, sha, archive)), ("WARC-Date", date), ("WARC-Target-URI", safe(url)), ("WARC-Payload-Digest", f"sha1:{sha}"), ("X-Page-ID", str(page_id)), ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]).encode() + payload


def revisit(page_id: int, url: str, sha: str, original: int, original_url: str, size: int, archive: str, date: str, original_date: str) -> bytes:
    return header([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(page_id, sha, archive)), ("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{sha}"), ("X-Page-ID", str(page_id)), ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(original, sha, archive)), ("X-Refers-To-Page-ID", str(original)), ("WARC-Refers-To-Target-URI", original_url), ("WARC-Refers-To-Date", original_date), ("X-Original-Payload-Length", str(size)), ("Content-Length", "0")]).encode()


def records(data: bytes) -> Iterator[Record]:
    """The records of an archive, in order; ValueError where it is damaged."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n") if stop >= 0 else [""]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        size, start = int(headers.get("content-length", -1)), stop + 4
        if size < 0 or data[start + size : start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut off")
        yield Record(headers, start, start + size)
        at = start + size + 4


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(first byte, end, content) of each gzip member that holds anything; ValueError where one is cut off."""
    view, at = memoryview(data), 0
    while at < len(data):
        unpack, out, end = zlib.decompressobj(31), [], at
        try:
            while not unpack.eof and end < len(data):
                out.append(unpack.decompress(view[end : end + CHUNK]))
                end = min(end + CHUNK, len(data))
        except zlib.error as error:
            raise ValueError(f"no gzip member at byte {at}") from error
        if not unpack.eof:
            raise ValueError(f"member at byte {at} is cut off")
        end -= len(unpack.unused_data)
        content = b"".join(out)
        if content:
            yield at, end, content
        at = end


def packed_records(data: bytes) -> Iterator[tuple[int, int, Record, bytes]]:
    """(first byte, end, record, content) of each member of a part."""
    for a, b, content in members(data):
        for record in records(content):
            yield a, b, record, content


def member(record: bytes) -> bytes:
    """A record, with the blank lines that end it, as a gzip member whose last byte is 0.

    A member ends with the top byte of its size, which is 0 below 16 MB; a
    larger one is followed by a member without data.
    """
    out = gzip.compress(record + _END, 6, mtime=0)
    return out if out[-1] == 0 else out + _NO_DATA


def size_class(size: Column) -> Column:
    """0 for payloads up to LEAST_CLASS bytes, 1 up to four times that, and so on, up to that of PART_BYTES."""
    most = math.ceil(math.log(PART_BYTES / LEAST_CLASS, 4))
    return F.least(F.greatest(F.ceil(F.log(F.greatest(size, F.lit(1)) / float(LEAST_CLASS)) / math.log(4) - 1e-9), F.lit(0)), F.lit(most)).cast("int")


def write_archive(lines: DataFrame, path: str, of_class: int = 0) -> None:
    """One column of members, of payloads of one class of size.

    The text writer puts bytes out as they are, and a byte 0 after each row: the
    last one of every member, which is left out here.
    """
    most = max(1, PART_BYTES // (LEAST_CLASS * 4**of_class))
    body = F.expr(f"substring({lines.columns[0]}, 1, length({lines.columns[0]}) - 1)")
    lines.select(body.cast("string").alias("value")).write.option("lineSep", "\x00").option("compression", "none").option("maxRecordsPerFile", most).text(f"{path}/class={of_class}")


def _write_responses(archive: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, html = batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), batch.column("html").cast(pa.binary())
            for i in range(0, len(ids), 200):
                payloads = [x.as_py() or b"" for x in html.slice(i, 200)]
                yield pa.record_batch([pa.array([member(response(p, u, x, digest(x), archive, date)) for p, u, x in zip(ids[i : i + 200], urls[i : i + 200], payloads)], pa.binary())], ["record"])

    return run


_HEADERS = "file string, page_id long, record_type string, url string, payload_digest string, payload_bytes long, refers_to long, member_start long, member_end long"


def _read_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            for a, b, r, data in packed_records(content.as_py()):
                h = r.headers
                sha = h["warc-payload-digest"].removeprefix("sha1:")
                kind = h["warc-type"]
                if kind == "response" and digest(data[r.start : r.end]) != sha:
                    raise ValueError(f"{h['warc-record-id']} in {path} does not have its digest")
                refers = int(h["x-refers-to-page-id"]) if "x-refers-to-page-id" in h else None
                rows.append((path, int(h["x-page-id"]), kind, h["warc-target-uri"], sha, int(h.get("x-original-payload-length", r.end - r.start)), refers, a, b))
        cols = list(zip(*rows)) if rows else [()] * 9
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * 4]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in _HEADERS.split(", ")])


def _files(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path).select("path", "content")


def read_headers(spark, path: str) -> DataFrame:
    """A row per record of the archives in a folder; payloads are checked and left there."""
    return _files(spark, path).mapInArrow(_read_headers, _HEADERS)


def _content(path: str) -> bytes:
    """A part of an archive, opened where it lies: in the shared folder, through Arrow's file systems (local mounts, HDFS, object stores)."""
    scheme, rest = path.split(":", 1)
    fs, at = pa_fs.FileSystem.from_uri(f"{scheme}:{'//' if not rest.startswith('//') else ''}{quote(rest)}")
    with fs.open_input_stream(at) as part:
        return part.read()


def _rewrite(archive: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, plans in zip(batch.column("file").to_pylist(), batch.column("plans")):
                plan = {(p["page_id"], p["payload_digest"]): p for p in plans.as_py() or []}
                out, size = [], 0
                for _, _, r, data in packed_records(_content(path)):
                    h = r.headers
                    page = int(h["x-page-id"])
                    sha = h["warc-payload-digest"].removeprefix("sha1:")
                    p = plan.get((page, sha))
                    if p:
                        new = revisit(page, h["warc-target-uri"], sha, p["original"], p["original_url"], r.end - r.start, archive, date, h["warc-date"])
                    else:
                        new = response(page, h["warc-target-uri"], data[r.start : r.end], sha, archive, date)
                    out.append(member(new))
                    size += len(out[-1])
                    if len(out) == 200 or size > 1 << 20:
                        yield pa.record_batch([pa.array(out, pa.binary())], ["record"])
                        out, size = [], 0
                yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    return run


def _planned(spark, path: str, plans: DataFrame) -> DataFrame:
    """(file, plans) of the parts in a folder: names alone are joined and dealt, a part to a task; contents stay where they are."""
    names = _files(spark, path).select(F.col("path").alias("file"))
    return names.join(plans, "file", "left").select("file", "plans").repartition(max(1, min(names.count(), MOST_TASKS)), "file")


def archive_pages(pages: DataFrame, least_bytes: int = 0, date: str | None = None) -> tuple[str, str]:
    """Write (page_id, url, html), resolve revisits, and give the folders of the raw and of the deduplicated archives.

    Of records with equal payloads of at least least_bytes bytes that with the
    largest page_id stays a response.  A null html is an empty payload, a null
    url about:blank; pages without page_id are left out; a page_id that stands
    more than once with one payload is one page, and with several payloads a record
    of each, resolved by itself.  Other columns are ignored.  Both archives are
    dated `date`, or with the time of the call; a table without rows gives
    folders without parts.
    """
    spark, date = pages.sparkSession, date or now()
    raw, clean = new_path(spark, "warc-raw"), new_path(spark, "warc")
    rows = pages.where(F.col("page_id").isNotNull()).select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    of_class = size_class(F.coalesce(F.octet_length("html"), F.lit(0)))
    classes = sorted(r.c for r in rows.groupBy(of_class.alias("c")).agg(F.count("*")).collect()) or [0]
    for c in classes:
        write_archive(rows.where(of_class == c).mapInArrow(_write_responses("raw", date), "record binary"), raw, c)
    heads = written(read_headers(spark, raw), "warc-headers")
    large = heads.where(F.col("payload_bytes") >= least_bytes)
    first = large.groupBy("payload_digest").agg(F.max(F.struct("page_id", "url")).alias("o"), F.count("*").alias("c")).where("c > 1")
    first = written(first.select("payload_digest", F.col("o.page_id").alias("original"), F.col("o.url").alias("original_url")), "warc-originals")
    again = large.select("file", "page_id", "payload_digest").join(first, "payload_digest").where("page_id <> original")
    plans = written(again.groupBy("file").agg(F.collect_list(F.struct("page_id", "payload_digest", "original", "original_url")).alias("plans")), "warc-plans")
    for c in classes:
        write_archive(_planned(spark, f"{raw}/class={c}", plans).mapInArrow(_rewrite("clean", date), "record binary"), clean, c)
    for table in (heads, first, plans):
        remove(table)
    return raw, clean


def resolved_pages(pages: DataFrame, least_bytes: int = 0, keep_raw: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, file, member_start, member_end, read from the deduplicated archives."""
    spark = pages.sparkSession
    raw, clean = archive_pages(pages, least_bytes)
    if not keep_raw:
        remove(raw, spark)
    return read_headers(spark, clean).select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "member_start", "member_end")
