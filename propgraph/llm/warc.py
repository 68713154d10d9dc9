"""WARC archives: a writer with revisit records and a salvaging reader.

Writing. Payload digests are grouped first (narrow rows, combined map-side):
of equal payloads of at least ``min_bytes``, the row with the largest page_id
becomes a response and the others revisit it. Records are then written by page
id into one gzip member each; a task rolls its file at ``file_bytes``. File
names hold a random part, and only files listed in the manifest (written after
the task's files are complete) are read, so a lost or repeated task leaves at
worst an unlisted file. Files go through ``pyarrow.fs``, so the folder may be a
local path or the URI of any store it knows.

Reading. A file is streamed in blocks. A member (or, in an uncompressed file, a
record) is accepted if it inflates with a right checksum, starts with a WARC
version line, has its header fields once (folded over lines or not), is as long as
Content-Length says and matches its block digest, and, for a response, its payload
digest. After a failed check the reader looks for the next gzip magic or version line
at which a valid record starts, goes on from there, and reports the bytes between as
one quarantined gap. A member may hold many records: those that pass are recovered,
and if some fail, a gap names the member. Memory is bounded by one record (or
member, inflated) and one block.

Nothing is lost in silence: a record that no reader could take back (over ``MAX_RECORD``
bytes, or a header over ``MAX_HEADER``) stops the writer; a file that gives back
fewer records than the manifest says yields a gap; ``round_trip`` stops on any gap.

Cases: null payload counts as empty; a null page_id ranks below any other and
is written as an empty id; control characters of a URL are written as blanks; rows
that repeat the winning page_id and payload are all responses; an empty table gives no
files and no records; extra columns are not read; an empty or fully broken file gives
only a gap.
"""

from __future__ import annotations

import base64
import hashlib
import io
import posixpath
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.llm.common import checkpointed, split_join
from propgraph.session import scratch_path

FILE_BYTES = 32 << 20
READ_BYTES = 256 << 10
#: A record said to be longer than this counts as broken (its length field is).
MAX_RECORD = 1 << 30
MAX_HEADER = 16 << 20
_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/"
_VERSION_LINE = re.compile(rb"WARC/\d+\.\d+")
_HEADER_LINE = re.compile(rb"([A-Za-z0-9_-]+):([^\x00-\x08\x0a-\x1f]*)")
_FOLDED = re.compile(rb"\r\n[ \t]+")
_REQUIRED = {"warc-type", "warc-record-id", "warc-date", "content-length"}
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a full URI: without a scheme it lies on the cluster's default store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    uri = re.sub("^s3[an]:", "s3:", path if ":/" in path else "file://" + path)
    fs, inner = pa.fs.FileSystem.from_uri(uri)
    return fs, inner


# ----------------------------------------------------------------- records
@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        if not self.headers.get("content-type", "").startswith("application/http"):
            return self.block
        return self.block.partition(b"\r\n\r\n")[2]

    @property
    def http_length(self) -> int | None:
        """Content-Length of the HTTP header inside the block."""
        for line in self.block.partition(b"\r\n\r\n")[0].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length" and value.strip().isdigit():
                return int(value)
        return None


def page_uri(page_id: object) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def build_record(page_id: object, url: str | None, payload: bytes, size: int, digest: str,
                 refers_to: object = None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    target = "".join(" " if c < " " else c for c in (url or ""))
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Target-URI", target), ("WARC-Page-ID", page_uri(page_id)),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
            ("Content-Type", "application/http;msgtype=response"),
            ("Content-Length", str(len(block)))]
    if revisit:
        head += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", page_uri(refers_to))]
    lines = ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode("utf-8", "surrogatepass")
    if len(lines) > MAX_HEADER or len(lines) + len(block) > MAX_RECORD:
        raise ValueError(f"page {page_id}: a header of {len(lines)} and a block of {len(block)} bytes could not be read back")
    return lines + block + b"\r\n\r\n"


class Broken(Exception):
    """A failed check."""


class _Short(Exception):
    """More bytes are needed to decide."""


def parse_record(buf: bytes, whole: bool) -> tuple[Record, int]:
    """The record at the start of ``buf`` and its length. ``whole``: no more
    bytes follow. Raises ``_Short`` when more are needed, ``Broken`` on a
    failed check."""
    def missing(why: str) -> Exception:
        return Broken(why) if whole else _Short()

    if not buf.startswith(_VERSION[:len(buf)] if not whole else _VERSION):
        raise Broken("no version line")
    end = buf.find(b"\r\n\r\n")
    if end < 0:
        # a long header goes on only while its lines are header lines
        if len(buf) > MAX_HEADER or len(buf) > 1 << 16 and not all(
                _HEADER_LINE.fullmatch(x) for x in _FOLDED.sub(b" ", buf).split(b"\r\n")[1:-1]):
            raise Broken("header without end")
        raise missing("header cut off")
    version, *lines = _FOLDED.sub(b" ", buf[:end]).split(b"\r\n")
    if not _VERSION_LINE.fullmatch(version):
        raise Broken("bad version line")
    headers: dict[str, str] = {}
    for line in lines:
        found = _HEADER_LINE.fullmatch(line)
        if not found:
            raise Broken("bad header line")
        name = found[1].decode().lower()
        # a repeated field shows a header cut off and run on into the next record's
        if name in headers and name != "warc-concurrent-to":
            raise Broken(f"repeated header field {name}")
        headers[name] = found[2].decode("utf-8", "replace").strip()
    if not _REQUIRED <= headers.keys():
        raise Broken("header fields missing")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Broken("no content length")
    stop = end + 4 + int(length)
    if stop > MAX_RECORD:
        raise Broken("content length out of range")
    if len(buf) < stop + 4:
        raise missing("record cut off")
    if buf[stop:stop + 4] != b"\r\n\r\n":
        raise Broken("no record end")
    record = Record(headers, buf[end + 4:stop])
    _check_digest(headers.get("warc-block-digest"), record.block, "block")
    if headers.get("warc-type") == "response":
        _check_digest(headers.get("warc-payload-digest"), record.payload, "payload")
    return record, stop + 4


def _check_digest(stated: str | None, data: bytes, what: str) -> None:
    kind, _, value = (stated or "").partition(":")
    if kind.lower() == "sha1" and value.upper() != payload_digest(data):
        raise Broken(f"{what} digest differs")


def _member(buf: bytes, whole: bool) -> tuple[list[Record], int, str]:
    """The records of the gzip member at the start of ``buf``, its length, and why
    records of it are missing ('' if none are)."""
    if not buf.startswith(_MAGIC[:len(buf)] if not whole else _MAGIC):
        raise Broken("no gzip member")
    inflate = zlib.decompressobj(31)
    try:
        data = inflate.decompress(buf, MAX_RECORD)
    except zlib.error as e:
        raise Broken(f"gzip: {e}") from None
    if len(data) >= MAX_RECORD:
        raise Broken("member too long")
    if not inflate.eof:
        if not data.startswith(_VERSION[:len(data)]):
            raise Broken("no version line")
        raise Broken("member cut off") if whole else _Short()
    size = len(buf) - len(inflate.unused_data)
    try:
        record, end = parse_record(data, True)
        if end == len(data):
            return [record], size, ""
    except Broken:
        # one broken record is the member's fault; others may follow it
        if data.find(_VERSION, 1) < 0:
            raise
    inside = list(salvage(io.BytesIO(data).read))
    records = [x[1] for x in inside if isinstance(x, tuple)]
    faults = [x.reason for x in inside if isinstance(x, Gap)]
    if not records:
        raise Broken(faults[0])
    return records, size, faults[0] if faults else ""


@dataclass
class Gap:
    begin: int
    end: int
    reason: str


def salvage(read: Callable[[int], bytes], read_bytes: int = READ_BYTES) -> Iterator[tuple[int, Record] | Gap]:
    """Valid records with their offsets, and the gaps between, in file order.

    ``read(n)`` gives the next at most n bytes, b'' at the end.
    """
    buf, base, whole = b"", 0, False
    gap: Gap | None = None
    pos = 0  # of the next byte to look at, within buf
    ask = read_bytes

    def more(size: int) -> None:
        nonlocal buf, whole
        new = read(size)
        whole = not new
        buf += new

    while True:
        if pos > read_bytes:
            buf, base, pos = buf[pos:], base + pos, 0
        if len(buf) - pos < 16 and not whole:
            more(read_bytes)
            continue
        if pos >= len(buf):
            break
        try:
            rest = buf[pos:]
            if rest[:1] == _MAGIC[:1]:
                records, size, fault = _member(rest, whole)
            else:
                record, size = parse_record(rest, whole)
                records, fault = [record], ""
        except _Short:
            more(ask)  # doubled, so a long record is parsed a logarithmic number of times
            ask *= 2
            continue
        except Broken as e:
            ask = read_bytes
            if gap is None:
                gap = Gap(base + pos, 0, str(e))
            # the next place a record could start; a mark cut by the block's end is kept
            hits = [h for h in (buf.find(_MAGIC, pos + 1), buf.find(_VERSION, pos + 1)) if h >= 0]
            pos = min(hits) if hits else len(buf) if whole else max(pos + 1, len(buf) - len(_VERSION) + 1)
            continue
        ask = read_bytes
        if gap is not None:
            gap.end = base + pos
            yield gap
            gap = None
        for record in records:
            yield base + pos, record
        if fault:
            yield Gap(base + pos, base + pos + size, f"inside a member: {fault}")
        pos += size
    if gap is not None:
        gap.end = base + len(buf)
        yield gap


# ----------------------------------------------------------------- Spark: write
MANIFEST = "path string, n_records bigint, n_bytes bigint"


def plan_records(pages: DataFrame, min_bytes: int = 0, max_wins: bool = True) -> DataFrame:
    """(page_id, sha, refers_to): refers_to is null for responses."""
    pick = F.max if max_wins else F.min
    payload = F.coalesce("html", F.lit("")).cast("binary")
    slim = checkpointed(pages.select("page_id", F.sha2(payload, 256).alias("sha"),
                                     F.length(payload).alias("size")))
    winner = slim.where(F.col("size") >= min_bytes).groupBy("sha").agg(pick("page_id").alias("first_id"))
    joined = split_join(slim.select("page_id", "sha"), winner, "sha", slim.count(), "left")
    same = F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.where(F.col("first_id").isNotNull() & ~same).select(
        F.col("page_id").alias("_page"), F.col("sha").alias("_sha"), F.col("first_id").alias("refers_to")
    ).distinct()


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0,
               file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes one record per page below ``folder``; returns the manifest."""
    folder = _qualified(pages.sparkSession, folder)
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = (pages.select("page_id", "url", payload.alias("payload"))
            .withColumn("sha", F.sha2("payload", 256)))
    revisits = plan_records(pages, min_bytes)
    decided = (rows.join(revisits, F.col("page_id").eqNullSafe(F.col("_page"))
                         & (F.col("sha") == F.col("_sha")), "left")
               .select("page_id", "url", "payload", "refers_to",
                       F.col("_sha").isNotNull().alias("revisit")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = _filesystem(folder)
        out = path = None
        records = size = 0
        done: list[tuple[str, int, int]] = []
        for b in batches:
            for page, url, data, refers, revisit in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    path = f"part-{uuid.uuid4().hex}.warc.gz"
                    fs.create_dir(inner, recursive=True)
                    out, records, size = fs.open_output_stream(posixpath.join(inner, path),
                                                               compression=None), 0, 0
                raw = build_record(page, url, data, len(data), payload_digest(data), refers, revisit)
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = pack.compress(raw) + pack.flush()
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        if done:
            names, counts, sizes = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{n}" for n in names]), pa.array(counts, pa.int64()),
                 pa.array(sizes, pa.int64())], ["path", "n_records", "n_bytes"])

    return checkpointed(decided.mapInArrow(run, MANIFEST))


# ----------------------------------------------------------------- Spark: read
RECORDS = ("path string, offset bigint, record_type string, page_uri string, target_uri string, "
           "payload_bytes bigint, payload_digest string, refers_to_uri string, payload binary, "
           "gap_begin bigint, gap_end bigint, gap_reason string")


def read_warc(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of the files in column ``path`` (with ``n_records``,
    as in a manifest: a file with another number of them gives a gap).

    One row per record (gap columns null) or per gap (record columns null).
    ``payload_bytes`` of a revisit is the length its HTTP header states.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, expected in zip(*(c.to_pylist() for c in b.columns)):
                fs, inner = _filesystem(path)
                with fs.open_input_stream(inner, compression=None) as f:
                    rows, held, found, end = [], 0, 0, 0
                    for item in salvage(f.read):
                        if isinstance(item, Gap):
                            rows.append(_gap_row(path, item))
                        else:
                            rows.append(_record_row(path, *item, with_payload))
                            found, end = found + 1, item[0]
                        held += 200 + len(rows[-1][8] or b"")
                        if held > 4 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                    if expected is not None and found != expected:
                        rows.append(_gap_row(path, Gap(end, end, f"{found} of {expected} records")))
                    if rows:
                        yield _batch(rows)

    # files are the unit of work: spread them, whatever layout the list had
    n = max(1, files.count())
    expected = F.col("n_records") if "n_records" in files.columns else F.lit(None)
    return files.select("path", expected.cast("long").alias("n_records")).repartition(n).mapInArrow(run, RECORDS)


_ARROW = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()),
                    ("page_uri", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("refers_to_uri", pa.string()),
                    ("payload", pa.binary()), ("gap_begin", pa.int64()), ("gap_end", pa.int64()),
                    ("gap_reason", pa.string())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)],
                                      schema=_ARROW)


def _gap_row(path: str, gap: Gap) -> tuple:
    return (path, *[None] * 8, gap.begin, gap.end, gap.reason)


def _record_row(path: str, offset: int, r: Record, with_payload: bool) -> tuple:
    h = r.headers
    revisit = h.get("warc-type") == "revisit"
    size = r.http_length if revisit else len(r.payload)
    return (path, offset, h.get("warc-type"), h.get("warc-page-id"), h.get("warc-target-uri"), size,
            h.get("warc-payload-digest", "").rpartition(":")[2] or None, h.get("warc-refers-to"),
            r.payload if with_payload and not revisit else None, None, None, None)


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes ``pages`` as archives and reads them back, without payloads; stops if a
    page was not written or a file gives a gap."""
    folder = folder or scratch_path(spark, "warc")
    manifest = write_warc(pages, folder)
    written, given = manifest.agg(F.sum("n_records")).first()[0] or 0, pages.count()
    if written != given:
        raise RuntimeError(f"{written} of {given} pages were written")
    lost = F.raise_error(F.concat(F.lit("gap in "), "path", F.lit(": "), "gap_reason"))
    back = read_warc(manifest, with_payload=False)
    return back.withColumn("record_type", F.when(F.col("gap_reason").isNotNull(), lost).otherwise(F.col("record_type")))
