"""WARC archives: writing, and normalising monolithic gzip.

``write_archives`` writes rows as WARC records, each archive one gzip stream
as careless tools make it.  ``normalise`` inflates such a stream once, from
front to back, and rewrites every record as a gzip member of its own, with a
sidecar index of (record, offset, length), so that a record can be read
alone; on the way, records whose payload another record holds become revisit
records.  ``read_records`` reads the rewritten archives by their index.

Archives are files under a folder that driver and executors share, opened
through pyarrow's file systems.  A task writes under a name of its own and
reports it in its output rows; only reported files are read, so a task that
runs twice leaves a stray file and no harm.  An archive is closed at a size,
so a task holds one record at a time, and what it keeps per archive (the
index, the revisits) is bounded.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinreach.llm.common import stored
from twinreach.session import scratch_path

ARCHIVE_BYTES = 64 << 20  # of records, before compression
READ = 1 << 20
MIN_REVISIT = 1000
# a record's date is a fixed value: the tables have none
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(), folder)


def record(kind: str, name: str, uri: str, payload: bytes | None, size: int, sha1: str,
           refers_to: str | None = None) -> bytes:
    """One WARC record.  The block is an HTTP header and the payload; that of
    a revisit is the header alone, which still tells the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (payload or b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", DATE),
              ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{sha1}")]
    if refers_to is not None:
        fields += [("WARC-Refers-To", refers_to), (
            "WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "application/http;msgtype=response"),
               ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parsed_head(raw: bytes) -> dict[str, str]:
    lines = raw.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record begins with {raw[:40]!r}")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def records_of(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of every record of a stream of inflated bytes."""
    held = bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(stream, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while fill(1):
        end, seen = held.find(b"\r\n\r\n"), 0
        while end < 0:
            seen = max(0, len(held) - 3)
            if not fill(len(held) + 1):
                raise ValueError("the archive ends inside of a header")
            end = held.find(b"\r\n\r\n", seen)
        head = parsed_head(bytes(held[:end]))
        size = int(head["Content-Length"])
        if not fill(end + 4 + size + 4):
            raise ValueError("the archive ends inside of a record")
        block = bytes(held[end + 4:end + 4 + size])
        del held[:end + 8 + size]
        yield head, block


def inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Bytes of a gzip file, whether it is one member or many."""
    z, begun = zlib.decompressobj(31), False
    for chunk in chunks:
        while chunk:
            begun = True
            out = z.decompress(chunk)
            if out:
                yield out
            chunk = z.unused_data
            if z.eof and chunk:
                z = zlib.decompressobj(31)
    # a member counts as whole once its trailer is read
    if begun and not z.eof:
        raise ValueError("the gzip stream is cut off")


def chunks_of(system: fs.FileSystem, path: str) -> Iterator[bytes]:
    with system.open_input_stream(path, compression=None) as f:
        while chunk := f.read(READ):
            yield chunk


def split_http(block: bytes) -> tuple[int, bytes]:
    """(the header's Content-Length, payload)."""
    head, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(line.split(b":")[1]) for line in head.split(b"\r\n")
                if line.lower().startswith(b"content-length:"))
    return size, payload


_WRITTEN = "archive string, number long, page_id long, bytes long, sha1 string"


def write_archives(folder: str, archive_bytes: int = ARCHIVE_BYTES):
    """Over rows (page_id, url, body): monolithic archives; a row per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        name, out, z, size, number = None, None, None, 0, 0
        for batch in batches:
            rows = []
            for page, url, body in zip(*(batch.column(c) for c in ("page_id", "url", "body"))):
                page, url, body = page.as_py(), url.as_py(), body.as_py()
                if out is None or size >= archive_bytes:
                    if out is not None:
                        out.write(z.flush())
                        out.close()
                    name, size, number = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                sha1 = hashlib.sha1(body).hexdigest()
                raw = record("response", record_id(page), one_line(url), body, len(body), sha1)
                out.write(z.compress(raw))
                rows.append((name, number, page, len(body), sha1))
                size += len(raw)
                number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (
                    pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                ["archive", "number", "page_id", "bytes", "sha1"])
        if out is not None:
            out.write(z.flush())
            out.close()

    return run


def record_id(page) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def page_of(name: str) -> int | None:
    text = name.rstrip(">").rpartition(":")[2]
    return int(text) if text else None


def one_line(url: str | None) -> str:
    return " ".join((url or "").split())


_INDEX = "archive string, record_id string, offset long, length long"


def normalise(source: str, target: str):
    """Over rows (archive, numbers, refers): one member per record, and the
    index rows.  ``numbers`` are the records that become revisits of the
    pages in ``refers``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, old_root = file_system(source)
        new, new_root = file_system(target)
        for batch in batches:
            for archive, numbers, refers in zip(*(batch.column(c).to_pylist() for c in
                                                  ("archive", "numbers", "refers"))):
                revisits = dict(zip(numbers or [], refers or []))
                name, offset, index = f"{uuid.uuid4().hex}.warc.gz", 0, []
                with new.open_output_stream(f"{new_root}/{name}", compression=None) as out:
                    stream = inflated(chunks_of(old, f"{old_root}/{archive}"))
                    for number, (head, block) in enumerate(records_of(stream)):
                        size, payload = split_http(block)
                        sha1 = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        refers_to = revisits.get(number)
                        kind = "response" if number not in revisits else "revisit"
                        raw = record(kind, head["WARC-Record-ID"], head["WARC-Target-URI"],
                                     payload if kind == "response" else None, size, sha1,
                                     record_id(refers_to) if kind == "revisit" else None)
                        z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = z.compress(raw) + z.flush()
                        out.write(member)
                        index.append((name, head["WARC-Record-ID"], offset, len(member)))
                        offset += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*index) if index else [[]] * 4, (
                        pa.string(), pa.string(), pa.int64(), pa.int64()))],
                    ["archive", "record_id", "offset", "length"])

    return run


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(folder: str):
    """Over index rows (archive, offset, length), sorted within an archive:
    each record is read alone, by its offset.  A response's digest and size
    are taken from its payload, and must agree with its header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        name, f = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in
                                                 ("archive", "offset", "length"))):
                if archive != name:
                    if f is not None:
                        f.close()
                    name, f = archive, system.open_input_file(f"{root}/{archive}")
                raw = zlib.decompress(f.read_at(length, offset), 31)
                head, block = next(records_of(iter([raw])))
                size, payload = split_http(block)
                sha1 = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if head["WARC-Type"] == "response":
                    found = hashlib.sha1(payload).hexdigest()
                    if (len(payload), found) != (size, sha1):
                        raise ValueError(f"damaged record {head['WARC-Record-ID']} in {archive}")
                refers = head.get("WARC-Refers-To")
                rows.append((page_of(head["WARC-Record-ID"]), size, sha1, head["WARC-Type"],
                             None if refers is None else page_of(refers)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (
                    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if f is not None:
            f.close()

    return run


def archive_round_trip(pages: DataFrame, min_revisit: int = MIN_REVISIT,
                       archive_bytes: int = ARCHIVE_BYTES, folder: str | None = None
                       ) -> tuple[DataFrame, DataFrame]:
    """Write ``pages`` (page_id, url, html) as monolithic archives, normalise
    them, and read them back: (index, records).

    The payload is the html in UTF-8; null is empty.  Of records with equal
    payloads of at least ``min_revisit`` bytes the one with the largest
    page_id (a null id counts as smallest) is a response and the others
    revisit it; of several rows with that id one is the response and the
    others revisit it too.  An empty table gives no archive.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    mono, members = f"{folder}/monolithic", f"{folder}/members"
    for path in (mono, members):
        system, root = file_system(path)
        system.create_dir(root, recursive=True)
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("body")
    written = stored(pages.select("page_id", "url", body).mapInArrow(
        write_archives(mono, archive_bytes), _WRITTEN), "warc-written")

    # equal payloads: same length and digest; the first in line stays
    place = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("p"), F.col("archive"),
                     F.col("number"))
    large = written.where(F.col("bytes") >= min_revisit).withColumn("place", place)
    groups = stored(large.groupBy("bytes", "sha1").agg(
        F.max("place").alias("best"), F.max("page_id").alias("refers"),
        F.count(F.lit(1)).alias("n")).where("n > 1"), "warc-groups")
    revisits = (large.join(groups, ["bytes", "sha1"]).where("place <> best")
                .select("archive", "number", "refers"))
    # per archive at most its own records
    todo = (written.select("archive").distinct()
            .join(revisits.groupBy("archive").agg(
                F.collect_list(F.struct("number", "refers")).alias("_all")), "archive", "left")
            .select("archive", F.col("_all.number").alias("numbers"),
                    F.col("_all.refers").alias("refers")))
    # an archive is a task's work: spread them over all tasks
    tasks = _tasks(spark, todo)
    index = stored(todo.repartition(tasks).mapInArrow(normalise(mono, members), _INDEX),
                   "warc-index")
    # index rows are small and what they point to is not, so tasks follow archives
    by_place = (index.repartitionByRange(tasks, "archive", "offset")
                .sortWithinPartitions("archive", "offset"))
    return index, by_place.select("archive", "offset", "length").mapInArrow(
        read_records(members), _READ)


def _tasks(spark, todo: DataFrame) -> int:
    """As many tasks as archives, up to the session's number of partitions."""
    return max(1, min(todo.count(), 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def warc_report(pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` per
    row of ``pages``, as read back from the archives."""
    return archive_round_trip(pages)[1]
