"""Operator 6: WARC archives with a two-level capture index.

Captures are sorted by key (reversed host, then path) and page_id. Each task
writes one range of them: an archive of WARC records (one gzip member each),
an index file of compressed blocks of sorted index lines, and a sparse
directory with the first line of every block. A lookup takes sorted captures,
finds the range by binary search over the ranges' first captures, the block by
binary search in that range's directory, reads the block's bytes, and then the
record's bytes from the archive.

Of records with equal payloads the one with the largest page_id is written as
``response``, earlier ones as ``revisit`` without payload, which name it.

Files are written by the tasks into the shared folder; a name holds the task
attempt, and only the rows of attempts that Spark commits name files, so a
lost executor leaves at most unused files.

Defined cases: a null html is an empty payload; a null url has an empty key; a
null page_id sorts first and is always a response; pages may share key and
page_id (or have no page_id): a lookup gives all their records, and repeated rows
have a record each; an empty table writes no archive
and gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormmart.llm.common import scratch, staged, text_bytes, tidy

#: Payload bytes of one archive file.
ARCHIVE_BYTES = 32_000_000
#: Index lines in one compressed block.
BLOCK_LINES = 256
#: Bytes read at once when records follow each other in an archive.
READ_AHEAD = 1_000_000

# --- fixed values: the digest's alphabet and record formats ----------------------
WARC_VERSION = "WARC/1.1"
CONTENT_TYPE = "application/http; msgtype=response"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# --- end of fixed values -------------------------------------------------------


def capture_key(url: Column) -> Column:
    """com,example,www)/path of a URL: host labels reversed, then the rest."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.regexp_replace(F.coalesce(key, F.lit("")), r"[\x00-\x20]", "_")


def digest_text(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def captures(pages: DataFrame) -> DataFrame:
    """page_id, url, key, payload and its SHA-1 of every page."""
    return (pages.select("page_id", "url", capture_key(F.col("url")).alias("key"),
                         text_bytes("html").alias("payload"))
            .withColumn("sha1", F.sha1("payload")))


def with_originals(rows: DataFrame) -> DataFrame:
    """Captures with ``refers_to``: the largest page_id with the same payload, if
    that is another one. Only payloads that occur again are joined."""
    again = staged(rows.groupBy("sha1").agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
                   .where(F.col("n") > 1).select(F.col("sha1").alias("again"), "original"), "payloads")
    return (rows.join(again, F.col("sha1") == F.col("again"), "left")
            .withColumn("refers_to", F.when(F.col("original") > F.col("page_id"), F.col("original")))
            .drop("again", "original", "sha1"))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http + payload if refers_to is None else http
    head = [WARC_VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {' '.join((url or '').split())}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{digest_text(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"Content-Type: {CONTENT_TYPE}", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """Headers and payload of a WARC record."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    number = lambda name: int(fields[name][10:-1]) if fields.get(name, "")[10:-1] else None
    return {"page_id": number("WARC-Record-ID"), "type": fields["WARC-Type"], "url": fields["WARC-Target-URI"],
            "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "bytes": size,
            "refers_to": number("WARC-Refers-To"), "payload": payload}


def _zip(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _unzip(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


def _order(key: str, page_id: int | None) -> tuple[str, bool, int]:
    return key, page_id is not None, page_id or 0


def _line(key: str, page_id: int | None, *rest) -> str:
    return " ".join([key, "" if page_id is None else str(page_id), *map(str, rest)])


def _of_line(line: str) -> tuple[tuple[str, bool, int], list[str]]:
    key, page_id, *rest = line.split(" ")
    return _order(key, int(page_id) if page_id else None), rest


class ArchiveWriter:
    """An archive, its index blocks and its directory, written in key order."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs

        self.files, root = fs.FileSystem.from_uri(folder)
        self.files.create_dir(root, recursive=True)
        self.base = f"{root}/{name}"
        self.archive = self.files.open_output_stream(f"{self.base}.warc.gz", compression=None)
        self.index = self.files.open_output_stream(f"{self.base}.idx", compression=None)
        self.lines: list[str] = []
        self.directory: list[str] = []

    def add(self, key: str, page_id: int | None, data: bytes) -> None:
        member = _zip(data)
        self.lines.append(_line(key, page_id, self.archive.tell(), len(member)))
        self.archive.write(member)
        if len(self.lines) == BLOCK_LINES:
            self._block()

    def _block(self) -> None:
        block = _zip("\n".join(self.lines).encode())
        self.directory.append(f"{self.lines[0]} {self.index.tell()} {len(block)}")
        self.index.write(block)
        self.lines = []

    def close(self) -> None:
        if self.lines:
            self._block()
        self.archive.close()
        self.index.close()
        with self.files.open_output_stream(f"{self.base}.dir", compression=None) as out:
            out.write("\n".join(self.directory).encode())


RANGES = "name string, first_key string, first_page long, captures long"


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write archives and indexes of all captures; one row for each file range."""
    size = rows.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    files = max(math.ceil(size / ARCHIVE_BYTES), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = rows.repartitionByRange(files, "key", "page_id").sortWithinPartitions("key", "page_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        writer, first, n = None, None, 0
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        for batch in batches:
            cols = [batch.column(c) for c in ("key", "page_id", "url", "payload", "refers_to")]
            for key, page_id, url, payload, refers_to in zip(*cols):
                if writer is None:
                    writer, first = ArchiveWriter(folder, name), (key.as_py(), page_id.as_py())
                writer.add(key.as_py(), page_id.as_py(),
                           record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py()))
                n += 1
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([first[0]]), pa.array([first[1]], pa.int64()), pa.array([n])],
                names=["name", "first_key", "first_page", "captures"])

    return staged(ranges.select("key", "page_id", "url", "payload", "refers_to").mapInArrow(tidy(write), RANGES),
                  "archive-ranges")


class ArchiveReader:
    """Range reads from one archive by its index."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs

        self.files, root = fs.FileSystem.from_uri(folder)
        self.base = f"{root}/{name}"
        with self.files.open_input_stream(f"{self.base}.dir", compression=None) as f:
            entries = [_of_line(x) for x in f.read().decode().split("\n")]
        self.firsts = [e[0] for e in entries]
        self.blocks = [tuple(map(int, e[1][-2:])) for e in entries]
        self.index = self.files.open_input_file(f"{self.base}.idx")
        self.archive = self.files.open_input_file(f"{self.base}.warc.gz")
        self.block_no = -1
        self.lines: dict[tuple[str, bool, int], list[list[str]]] = {}
        self.ahead, self.ahead_at = b"", 0

    def _member(self, offset: int, size: int) -> bytes:
        at = offset - self.ahead_at
        if at < 0 or at + size > len(self.ahead):
            self.archive.seek(offset)
            self.ahead, self.ahead_at, at = self.archive.read(max(size, READ_AHEAD)), offset, 0
        return self.ahead[at:at + size]

    def _load(self, block_no: int) -> None:
        if block_no != self.block_no:
            offset, size = self.blocks[block_no]
            self.index.seek(offset)
            self.lines = {}
            for line in _unzip(self.index.read(size)).decode().split("\n"):
                capture, place = _of_line(line)
                self.lines.setdefault(capture, []).append(place)
            self.block_no = block_no

    def get(self, key: str, page_id: int | None) -> Iterator[dict]:
        """All records of a capture; cheap when captures are asked for in order."""
        wanted = _order(key, page_id)
        # The records may begin in the block before the first one that starts with them.
        first = max(0, bisect.bisect_left(self.firsts, wanted) - 1)
        for block_no in range(first, bisect.bisect_right(self.firsts, wanted)):
            self._load(block_no)
            for place in self.lines.get(wanted, []):
                yield parsed(_unzip(self._member(*map(int, place))))


RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "verified boolean")


def read_captures(wanted: DataFrame, ranges: DataFrame, folder: str) -> DataFrame:
    """The records of captures (key, page_id), by index lookups. ``verified``: the
    payload in the archive has the digest and the length that its record states."""
    # One row for each archive file.
    firsts = sorted((_order(r["first_key"], r["first_page"]), r["name"]) for r in ranges.collect())
    starts, names = [f for f, _ in firsts], [n for _, n in firsts]

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist())
            at = [bisect.bisect_right(starts, _order(k, p)) - 1 for k, p in asked]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] if i >= 0 else None for i in at], pa.string()),
                 batch.column("key"), batch.column("page_id")], names=["name", "key", "page_id"])

    def fetch(table: pa.Table) -> pa.Table:
        name = table.column("name")[0].as_py()
        rows = []
        if name is not None:
            reader = ArchiveReader(folder, name)
            asked = set(zip(table.column("key").to_pylist(), table.column("page_id").to_pylist()))
            for key, page_id in sorted(asked, key=lambda x: _order(*x)):
                for r in reader.get(key, page_id):
                    whole = r["type"] == "revisit" or (
                        len(r["payload"]) == r["bytes"] and digest_text(r["payload"]) == r["digest"])
                    rows.append((r["page_id"], r["bytes"], r["digest"], r["type"], r["refers_to"], whole))
        cols = list(zip(*rows)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                    names=[x.split()[0] for x in RECORDS.split(", ")])

    located = wanted.select("key", "page_id").mapInArrow(tidy(locate), "name string, key string, page_id long")
    # Dealt by a number of tasks that does not depend on the lookups' small rows.
    return located.repartition(max(1, len(names)), "name").groupBy("name").applyInArrow(fetch, RECORDS)


def op6_two_level_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back through their index."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = scratch(spark, "warc")
    ranges = write_archives(with_originals(captures(pages)), folder)
    wanted = pages.select(capture_key(F.col("url")).alias("key"), F.col("page_id").cast("long").alias("page_id"))
    return read_captures(wanted, ranges, folder)


# Base32 from the digest's hexadecimal digits: five of them are four characters.
ORACLE_OP6 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
o AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS original,
             list_transform(range(8), lambda i: ('0x' || substr(hex, 5 * i + 1, 5))::INTEGER) AS parts FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       array_to_string(list_transform(parts, lambda v: array_to_string(list_transform([15, 10, 5, 0],
         lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to, true AS verified
FROM o
"""
