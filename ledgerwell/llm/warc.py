"""WARC archives: written as Spark text files, read back by a reader that survives damage."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwell.llm.shared import scratch_path, stage

CRLF = "\r\n"
LEAST_BYTES = 1000
# An archive holds at most so many records, and bytes unless it is a single record.
ROWS_PER_FILE = 4000
FILE_BYTES = 64 << 20
# Pages up to these many bytes share archives.
SIZE_CLASSES = (1 << 14, 1 << 17, 1 << 20, 1 << 23)
# So many revisits are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 500_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def records(pages: DataFrame, least_bytes: int = LEAST_BYTES, carried: Column | None = None) -> DataFrame:
    """One WARC record per page as text without its final two line ends: column ``value``, and what of the
    page is ``carried`` along under that name.

    Reads page_id, url and html. A null html is an empty payload; a null url has no header. Of pages
    with equal payloads of at least ``least_bytes``, the one with the largest page_id is the response
    and others are revisits of it; rows that repeat that id are all responses, so are rows without id.
    The copies are found from narrow (id, digest) rows; a page of its own needs no look-up.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    chosen = pages.select(F.col("page_id").cast("long"), F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), "[\\r\\n]+", " ").alias("url"), html.alias("html"), (F.lit(None) if carried is None else carried).alias("carried"))
    digest = F.sha1(F.encode("html", "UTF-8"))
    narrow = chosen.where((F.octet_length("html") >= least_bytes) & F.col("page_id").isNotNull()).select("page_id", digest.alias("digest"))
    groups = narrow.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1")
    groups = stage(groups.select("digest", "keeper"), "payload-copies")
    revisits = stage(narrow.join(groups, "digest").where("page_id <> keeper").select(F.col("page_id").alias("_id"), "keeper").distinct(), "revisits")
    few = revisits.count() <= BROADCAST_ROWS
    # A repeated id may hold another payload, which is no revisit.
    met = chosen.join(F.broadcast(revisits) if few else revisits, (F.col("page_id") == F.col("_id")) & (F.octet_length("html") >= least_bytes), "left")
    is_revisit = F.col("keeper").isNotNull()
    n = F.octet_length("html").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), n, F.lit(CRLF * 2))
    block = F.concat(http, F.when(is_revisit, F.lit("")).otherwise(F.col("html")))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:>"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.when(F.col("url") != "", F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        line("WARC-Refers-To", urn(F.col("keeper"))),
        line("WARC-Profile", F.when(is_revisit, F.lit(PROFILE))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
    )
    return met.select(F.concat(head, block).alias("value"), *([] if carried is None else ["carried"]))


def write_archives(pages: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, file_bytes: int = FILE_BYTES) -> None:
    """Archives below ``path``; a record ends in two line ends, which Spark writes as line separators.

    Pages are written by classes of size, each with as many records to an archive as keep it within
    ``file_bytes``, headers apart; pages beyond the last class get an archive each. Only classes that
    occur cost a pass. Without pages the folder is made and stays empty.
    """
    size = F.coalesce(F.octet_length(F.col("html").cast("string")), F.lit(0)) + F.coalesce(F.octet_length(F.col("url").cast("string")), F.lit(0))
    bounds = F.array(*[F.lit(b) for b in SIZE_CLASSES])
    size_class = F.size(F.filter(bounds, lambda b: b < size))
    found = sorted(r["c"] for r in pages.select(size_class.alias("c")).distinct().collect())
    made = records(pages, carried=size_class)
    for nth, c in enumerate(found or [0]):
        rows = min(rows_per_file, max(1, file_bytes // SIZE_CLASSES[c])) if c < len(SIZE_CLASSES) else 1
        some = made.where(F.col("carried") == c).select("value")
        some.write.mode("append" if nth else "errorifexists").option("lineSep", CRLF * 2).option("maxRecordsPerFile", rows).text(path)


_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_GZIP = b"\x1f\x8b\x08"
_END = b"\r\n\r\n"
_STEP = 1 << 16


def _bare_digest(value: str) -> str:
    """Lower-case hexadecimal SHA-1 from a header in either form; other digests as they are."""
    name, _, digest = value.partition(":")
    if name.lower() == "sha1" and len(digest) == 32:
        try:
            return base64.b32decode(digest.upper()).hex()
        except ValueError:
            return digest
    return digest.lower() if name.lower() == "sha1" else value


def parse_record(data: bytes, at: int) -> tuple[dict, int] | str:
    """The record that starts at ``at`` and where it ends, or why there is none."""
    version = _VERSION.match(data, at)
    if not version:
        return "no version line"
    end = data.find(_END, version.end() - 2)
    if end < 0:
        return "header without end"
    headers: dict[str, str] = {}
    for line in data[version.end() : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if line and not colon:
            return "bad header line"
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not size.isascii() or not size.isdigit():
        return "bad length"
    start, stop = end + 4, end + 4 + int(size)
    if data[stop : stop + 4] != _END:
        return "length does not meet the record's end"
    block = data[start:stop]
    http = block.find(_END) if block.startswith(b"HTTP/") else -1
    payload = block[http + 4 :] if http >= 0 else block
    kind, digest = headers.get("warc-type", ""), _bare_digest(headers.get("warc-payload-digest", ""))
    if kind == "response" and len(digest) == 40 and hashlib.sha1(payload).hexdigest() != digest:
        return "payload does not match its digest"
    length = len(payload)
    if kind == "revisit" and http >= 0 and (m := re.search(rb"(?im)^content-length:\s*(\d+)", block[:http])):
        length = int(m[1])
    made = {
        "record_type": kind, "record_id": headers.get("warc-record-id"), "refers_to": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"), "payload_digest": digest, "payload_bytes": length, "payload": payload,
    }
    return made, stop + 4


def _member(data: bytes, at: int) -> tuple[bytes, int, bool]:
    """A gzip member's content as far as it can be read, where that ends, and whether it is whole and its
    checksum holds."""
    machine, content, view = zlib.decompressobj(31), [], memoryview(data)
    start = at
    while at < len(data) and not machine.eof:
        try:
            content.append(machine.decompress(view[at : at + _STEP]))
        except zlib.error:
            return *_up_to_error(view, start, at), False
        at = min(at + _STEP, len(data))
    return b"".join(content), at - len(machine.unused_data), machine.eof


def _up_to_error(view: memoryview, start: int, step: int) -> tuple[bytes, int]:
    """The content from ``start`` up to the error in the step that begins at ``step``, and where it is."""
    machine, content = zlib.decompressobj(31), []
    for at in range(start, step, _STEP):
        content.append(machine.decompress(view[at : at + _STEP]))
    at = step
    try:
        while at < len(view):
            content.append(machine.decompress(view[at : at + 1]))
            at += 1
    except zlib.error:
        pass
    return b"".join(content), at


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None, str | None]]:
    """(offset, length, record, problem): all records that pass their checks, and the gaps between them.

    Where a check fails, the next member or version line from which a record passes is searched; the
    bytes up to there are one gap with the first problem met. Offsets count in the file as stored: records
    of one gzip member, and gaps inside a member with records, have the member's. Of a broken member the
    records before the error are kept, with the bytes read up to it; the member is a gap as well.
    """
    at, gap, why = 0, None, ""
    packed = data.startswith(_GZIP) or not _VERSION.match(data) and 0 <= data.find(_GZIP)
    # Records of the last broken member and where its reading ended: stored blocks show them again.
    known, known_to = [], 0
    while at < len(data):
        found: list[dict] = []
        inner: list[tuple] = []
        problem: str = ""
        stop = at
        whole = True
        if packed and data.startswith(_GZIP, at):
            content, stop, whole = _member(data, at)
            inner = list(salvage(content))
            found = [r for _, _, r, _ in inner if r]
            # The cut end of a broken member is told by the gap that follows it.
            inner = [g for g in inner if not g[2] and (whole or g[0] + g[1] < len(content))]
            problem = "broken member" if not whole else inner[0][3] if inner else ""
        else:
            parsed = parse_record(data, at)
            if isinstance(parsed, str):
                problem = parsed
            else:
                found, stop = [parsed[0]], parsed[1]
                if at < known_to and found[0] in known:
                    at = stop
                    continue
        if found:
            if gap is not None and gap < at:
                yield gap, at - gap, None, why
            gap = None
            for record in found:
                yield at, stop - at, record, None
            for _, _, _, inside in inner:
                yield at, stop - at, None, inside
            if whole:
                at = stop
                continue
            known, known_to = found, stop
        if gap is None:
            gap, why = at, problem
        places = [data.find(_GZIP, at + 1)] if packed else []
        if m := _VERSION.search(data, at + 1):
            places.append(m.start())
        at = min((p for p in places if p >= 0), default=len(data))
    if gap is not None:
        yield gap, len(data) - gap, None, why


_READ = (
    "file string, offset long, length long, problem string, record_type string, record_id string, refers_to string, "
    "target_uri string, payload_digest string, payload_bytes long, payload binary"
)
_FIELDS = ["record_type", "record_id", "refers_to", "target_uri", "payload_digest", "payload_bytes", "payload"]


def read_archives(spark: SparkSession, path: str, *, payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of all archives below ``path``, plain or of gzip members.

    A row without ``problem`` is a record; one with it is a gap of ``length`` bytes at ``offset``.
    Each file is read whole by one task, so files are bounded by what a task can hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column(0), b.column(1), strict=True):
                rows: list[tuple] = []
                size = 0
                for offset, length, record, problem in salvage(content.as_buffer().to_pybytes()):
                    values = [record[f] for f in _FIELDS] if record else [None] * len(_FIELDS)
                    if not payload:
                        values[-1] = None
                    size += len(values[-1] or b"")
                    rows.append((file.as_py(), offset, length, problem, *values))
                    if len(rows) >= 5000 or size > 16_000_000:
                        yield _batch(rows)
                        rows, size = [], 0
                yield _batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, _READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "offset", "length", "problem", *_FIELDS])


def page_of(urn: str) -> F.Column:
    return F.regexp_extract(urn, "<urn:page:([-0-9]+)>", 1).try_cast("long")


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages as archives and read the records back; the archives stay at ``path``."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path, payload=False)
