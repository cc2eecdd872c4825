"""WARC archives: a writer with revisits, and a reader that salvages what damaged archives still hold.

``write`` turns rows into records, each a gzip member of its own, in archives of bounded size; of equal payloads the one
with the largest id is a response and the others are revisits.  ``read`` goes through archives member by member.  A record
must have its version line, its header, the length that the header states, the closing blank lines and the digest of its
block; where one of these checks fails, the bytes up to the next valid member (or, in archives that are not compressed,
the next valid version line) are quarantined and logged as a gap, and reading goes on behind them.  An archive is read as
a stream: a task holds one record and what was read beyond it, however large the archive is.

Archives are written by tasks to the shared folder, through the file system that the folder's address names, each attempt
of a task under names of its own.  The manifest lists those of the attempts that counted, and ``read_written`` reads these.

Defined results: null payloads are empty; a row without an id is a response without one, or revisits the response of an
equal payload; if a row with the largest id is repeated, each copy is a response; an empty table gives no archive;
what claims to be a record of more than ``LONGEST`` bytes, packed or not, is no record but part of a gap.
"""

from __future__ import annotations

import base64
import hashlib
import io
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.llm.common import partitions
from tidetable.session import materialize, new_folder

VERSION = b"WARC/1.1"
_VERSIONS = re.compile(rb"WARC/1\.[01]\r\n")
_LINE = len(b"WARC/1.1\r\n")
_GZIP = b"\x1f\x8b\x08"
_CLOSE = b"\r\n\r\n"
_LEVEL, _PIECE = 4, 1 << 16
#: Bound on the digests that all tasks know.
HOT = 1000
#: Bytes that are read at a time, that one record may have, and of an archive that Spark hands over as one value.
STEP, LONGEST, WHOLE = 1 << 20, 1 << 30, 64 << 20
_ONCE = ("warc-type", "warc-record-id", "content-length")


def digest32(payload: bytes) -> str:
    """SHA-1 in base 32, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class Unfinished(ValueError):
    """A failed check that might not fail if more of the archive were known."""


@dataclass(frozen=True)
class Record:
    """One record as it is written."""

    page_id: int | None
    url: str | None
    payload: bytes
    kind: str
    refers_to: int | None
    digest: str

    def pack(self) -> bytes:
        """The record as one gzip member; a revisit keeps no payload, only its length and digest."""
        block = self.payload if self.kind == "response" else b""
        head = {
            "WARC-Type": self.kind,
            "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{self.page_id} {self.url} {self.digest}')}>",
            "WARC-Date": "1970-01-01T00:00:00Z",
            "Content-Type": "text/html; charset=utf-8",
            "WARC-Payload-Digest": f"sha1:{self.digest}",
            "WARC-Block-Digest": f"sha1:{digest32(block)}",
            "X-Payload-Length": len(self.payload),
        }
        if self.page_id is not None:
            head["X-Page-ID"] = self.page_id
        if self.url:
            head["WARC-Target-URI"] = re.sub(r"[\r\n]", "", self.url)
        if self.kind == "revisit":
            head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
            head["X-Refers-To-Page-ID"] = self.refers_to
        head["Content-Length"] = len(block)
        lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items())
        squeeze = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
        return squeeze.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + _CLOSE) + squeeze.flush()


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(header, block, end) of the record at ``at``; ValueError names the check that failed."""
    version = _VERSIONS.match(data, at)
    if not version:
        raise (Unfinished if len(data) - at < _LINE else ValueError)("version line")
    stop = data.find(b"\r\n\r\n", version.end())
    if stop < 0:
        raise Unfinished("header")
    try:
        pairs = [line.split(":", 1) for line in data[version.end() : stop].decode("utf-8").split("\r\n")]
        head = {k.strip().lower(): v.strip() for k, v in pairs}
        size = int(head["content-length"])
        # a second one belongs to another record, whose beginning is lost
        if any(sum(k.strip().lower() == once for k, _ in pairs) != 1 for once in _ONCE):
            raise ValueError("header")
    except (ValueError, KeyError):
        raise ValueError("header") from None
    begin = stop + 4
    if size < 0 or size > LONGEST:
        raise ValueError("length")
    if begin + size + 4 > len(data):
        raise Unfinished("length")
    block = data[begin : begin + size]
    if data[begin + size : begin + size + 4] != _CLOSE:
        raise ValueError("end of record")
    if head.get("warc-block-digest", "").partition(":")[2] not in ("", digest32(block)):
        raise ValueError("digest")
    return head, block, begin + size + 4


def _member(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """The record in the gzip member at ``at``, and the member's end."""
    if data[at : at + 3] != _GZIP:
        raise (Unfinished if len(data) - at < 3 else ValueError)("member")
    inflate, raw, end = zlib.decompressobj(31), [], at
    size = 0
    try:
        while not inflate.eof and end < len(data):
            raw.append(inflate.decompress(memoryview(data)[end : end + _PIECE]))
            size, end = size + len(raw[-1]), min(end + _PIECE, len(data))
            if size > LONGEST:
                raise ValueError("length")
    except zlib.error:
        raise ValueError("member") from None
    if not inflate.eof:
        raise Unfinished("member")
    whole = b"".join(raw)
    try:
        head, block, stop = parse_record(whole)
    except Unfinished as e:
        raise ValueError(str(e)) from None  # the member has no more
    if stop != len(whole):
        raise ValueError("end of record")
    return head, block, end - len(inflate.unused_data)


class _Held:
    """What is known of an archive: its bytes from ``start`` on, as far as they have been read."""

    def __init__(self, source: BinaryIO, step: int) -> None:
        self.source, self.step, self.start, self.data = source, step, 0, b""

    @property
    def end(self) -> int:
        return self.start + len(self.data)

    def more(self) -> bool:
        """Read as much again as is held, at least a step; False at the end of the archive."""
        got = self.source.read(max(self.step, len(self.data)))
        self.data += got
        return bool(got)

    def drop(self, at: int) -> None:
        """Let go of what lies before ``at``, a step or more at a time."""
        if at - self.start >= self.step:
            self.data, self.start = self.data[at - self.start :], at

    def record(self, at: int, parse) -> tuple[dict[str, str], bytes, int]:
        """The record at ``at``, for which as much is read as it takes."""
        while True:
            try:
                head, block, end = parse(self.data, at - self.start)
                return head, block, self.start + end
            except Unfinished:
                # header and closing lines come on top of the block
                if self.end - at > LONGEST + STEP or not self.more():
                    raise

    def later(self, at: int, packed: bool) -> int | None:
        """Where the next member or version line behind ``at`` may begin."""
        at += 1
        while True:
            if packed:
                found = self.data.find(_GZIP, at - self.start)
            else:
                line = _VERSIONS.search(self.data, at - self.start)
                found = line.start() if line else -1
            if found >= 0:
                return self.start + found
            # the last bytes may begin what the next ones end
            at = max(at, self.end - _LINE + 1)
            self.drop(at)
            if not self.more():
                return None


def _compressed(source: BinaryIO, step: int) -> bool:
    """Whether an archive begins as gzip does, or has no version line that could be read as it stands."""
    kept, first = source.read(max(step, _LINE)), True
    try:
        while kept:
            if first and kept[:3] == _GZIP:
                return True
            if _VERSIONS.search(kept):
                return False
            got, first = source.read(step), False
            kept = kept[-_LINE + 1 :] + got if got else b""
        return True
    finally:
        source.seek(0)


def salvage(archive: bytes | BinaryIO, step: int = STEP) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str | None]]:
    """(start, end, header, block, failure) of each record and each gap of an archive, which may be an open file.

    A gap has no header, and its failure is that of the record it begins with.
    """
    source = io.BytesIO(archive) if isinstance(archive, bytes) else archive
    packed = _compressed(source, step)
    held = _Held(source, step)
    at, gap, failure = 0, None, None
    while at < held.end or held.more():
        held.drop(at)
        try:
            head, block, end = held.record(at, _member if packed else parse_record)
        except ValueError as e:
            if gap is None:
                gap, failure = at, str(e)
            later = held.later(at, packed)
            if later is None:
                break
            at = later
            continue
        if gap is not None:
            yield gap, at, None, b"", failure
            gap = None
        yield at, end, head, block, None
        at = end
    if gap is not None:
        yield gap, held.end, None, b"", failure


def write(df: DataFrame, folder: str, row_id: str, payload: str, url: str | None = None, archive_bytes: int = 8 << 20) -> DataFrame:
    """Write a record for each row of ``df`` and return (path, records, bytes) of the archives."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = df.select(F.col(row_id).cast("long").alias("id"), (F.col(url) if url else F.lit(None).cast("string")).alias("url"), body.alias("body"), F.sha1(body).alias("sha"))
    # only the digests that occur more than once are joined, one row each, whatever the number of copies
    same = materialize(rows.groupBy("sha").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1 AND last IS NOT NULL"), "copies")
    # those of many rows are fewer than HOT, so their payloads need not be dealt by digest
    most = same.agg(F.sum("n")).first()[0] or 0
    hot = same.where(F.col("n") > most / HOT).select("sha", F.col("last").alias("_hot"))
    others = same.where(F.col("n") <= most / HOT).select(F.col("sha").alias("_sha"), F.col("last").alias("_last"))
    marked = rows.join(F.broadcast(hot), "sha", "left")
    # a key of its own for each row that is done, as equal keys meet in one task
    key = F.when(F.col("_hot").isNull(), F.col("sha")).otherwise(F.concat(F.lit("-"), F.coalesce("id", F.lit(0)).cast("string")))
    marked = marked.withColumn("_sha", key).join(others, "_sha", "left").withColumn("last", F.coalesce("_hot", "_last"))
    marked = marked.withColumn("kind", F.when(F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last")), "revisit").otherwise("response"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        task = TaskContext.get()
        part, number, held, size = f"{task.partitionId():06d}-{task.taskAttemptId():06d}", 0, [], 0

        def closed() -> pa.RecordBatch:
            path = f"part-{part}-{number:05d}.warc.gz"
            draft = posixpath.join(base, f".{path}.{uuid.uuid4().hex}")
            with files.open_output_stream(draft) as out:
                for x in held:
                    out.write(x)
            files.move(draft, posixpath.join(base, path))
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{path}"]), pa.array([len(held)], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])

        for batch in batches:
            columns = [batch.column(batch.schema.names.index(c)) for c in ("id", "url", "body", "kind", "last")]
            for row in zip(*columns):
                i, address, raw, kind, last = (x.as_py() for x in row)
                held.append(Record(i, address, raw, kind, last if kind == "revisit" else None, digest32(raw)).pack())
                size += len(held[-1])
                if size >= archive_bytes:
                    yield closed()
                    number, held, size = number + 1, [], 0
        if held:
            yield closed()

    return materialize(marked.select("id", "url", "body", "kind", "last").mapInArrow(work, "path string, records bigint, bytes bigint"), "archives")


RECORD_SCHEMA = "path string, start bigint, end bigint, page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary, failure string"


def _whole_number(head: dict[str, str], name: str) -> int | None:
    """A header field of ours; archives of others may hold anything there."""
    value = head.get(name, "")
    return int(value) if re.fullmatch(r"-?[0-9]{1,18}", value) else None


def _records(path: str, archive: bytes | BinaryIO, with_payload: bool) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size_held = 0
    for start, end, head, block, failure in salvage(archive):
        if head is None:
            rows.append((path, start, end, None, None, None, None, None, None, failure))
        else:
            kind = head.get("warc-type")
            whole = kind != "revisit"
            digest = digest32(block) if whole else head.get("warc-payload-digest", "").partition(":")[2]
            size = len(block) if whole else _whole_number(head, "x-payload-length")
            page, refers = _whole_number(head, "x-page-id"), _whole_number(head, "x-refers-to-page-id")
            payload = block if with_payload and whole else None
            rows.append((path, start, end, page, kind, refers, size, digest, payload, None))
            size_held += len(payload or b"")
        if len(rows) >= 512 or size_held >= 8 * STEP:
            yield _batch(rows)
            rows, size_held = [], 0
    if rows:
        yield _batch(rows)


def _opened(path: str, with_payload: bool) -> Iterator[pa.RecordBatch]:
    """The records of an archive that is read as a stream."""
    files, place = pafs.FileSystem.from_uri(path)
    with files.open_input_file(place) as source:
        yield from _records(path, source, with_payload)


def read(spark: SparkSession, folder: str, with_payload: bool = True, whole_bytes: int = WHOLE) -> DataFrame:
    """Every record and every gap of all archives below ``folder``; gaps have a ``failure`` and no record.

    Spark hands over archives of at most ``whole_bytes`` as values; larger ones are opened where they lie.
    """

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                yield from _records(path.as_py(), content.as_py(), with_payload)

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder)
    small = archives.where(F.col("length") <= whole_bytes).select("path", "content").mapInArrow(values, RECORD_SCHEMA)
    return small.unionByName(_streamed(archives.where(F.col("length") > whole_bytes), with_payload))


def _streamed(archives: DataFrame, with_payload: bool) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                # Hadoop writes local paths with one slash
                yield from _opened(re.sub(r"^file:/(?!/)", "file:///", path), with_payload)

    return archives.select("path").repartition(partitions(archives), "path").mapInArrow(work, RECORD_SCHEMA)


def read_written(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record and gap of the archives that ``write`` returned, and of no others in their folder.

    A task that was repeated may have left archives that are not in the manifest.
    """
    return _streamed(manifest, with_payload)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def round_trip(df: DataFrame, row_id: str, payload: str, url: str | None = None) -> DataFrame:
    """Write the rows of ``df`` to a new folder and read the archives back, without payloads."""
    return read_written(write(df, new_folder(df.sparkSession, "warc"), row_id, payload, url), with_payload=False)
