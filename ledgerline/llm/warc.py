"""WARC archives compressed with Zstandard and a dictionary (.warc.zst).

An archive starts with a skippable frame that holds the dictionary, then has
one Zstandard frame for each record. Archives are packed and unpacked as binary
rows of bounded size, so that Spark's own writers commit them and an executor
that is lost leaves nothing behind; ``read_archives`` unpacks .warc.zst files
of any folder that Spark reads, ``write_archives`` makes such files.

Of records with equal payloads the one with the largest page id is a response,
the others are revisit records that refer to it. Only digests are grouped and
shuffled, payloads are not.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.staging import stage

ARCHIVE_BYTES = 4 << 20       # compressed size after which an archive is closed
DICTIONARY_BYTES = 16 << 10
SAMPLE_BYTES = 1 << 20        # payload that an archive's dictionary is trained on, at most
MIN_REVISIT_BYTES = 0         # smaller payloads are always responses

#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ID_PREFIX = "urn:ledgerline:page:"
EPOCH = "1970-01-01T00:00:00Z"

RECORD = ("page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
          "payload_digest string, payload string, error string")


def digest(payload: bytes) -> str:
    """SHA-1 in bare upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record_id(page_id) -> str:
    return f"<{ID_PREFIX}{'' if page_id is None else page_id}>"


def _page_id(text: str | None) -> int | None:
    inner = (text or "").strip("<>")
    if not inner.startswith(ID_PREFIX):
        raise ValueError(f"record id {text!r}")
    return int(inner[len(ID_PREFIX):]) if len(inner) > len(ID_PREFIX) else None


def _header_text(value: str) -> str:
    """A header value on one line: controls are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 or c == "%" else c for c in value)


def _header_value(text: str) -> str:
    parts = text.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def build_record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode("ascii")
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", EPOCH),
               ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if url is not None:
        headers.append(("WARC-Target-URI", _header_text(url)))
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    headers.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers).encode("utf-8", "surrogatepass")
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError(f"header line {line[:60]!r}")
        out[name.strip().lower().decode("ascii")] = value.strip().decode("utf-8", "surrogatepass")
    return out


def parse_record(raw: bytes) -> dict:
    """One record's columns; raises ValueError on a wrong version, header, length or digest."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    first, _, lines = head.partition(b"\r\n")
    if not gap or first != VERSION:
        raise ValueError(f"not a {VERSION.decode()} record: {first[:40]!r}")
    headers = _headers(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in headers:
            raise ValueError(f"no {name} header")
    length = int(headers["content-length"])
    if length != len(rest) - 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"content-length is {length}, the block has {len(rest) - 4} bytes")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise ValueError("the block is no HTTP response")
    told = int(_headers(lines)["content-length"])
    kind = headers["warc-type"]
    own = headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (told != len(payload) or digest(payload) != own):
        raise ValueError("the payload doesn't fit its length or digest")
    if kind not in ("response", "revisit") or kind == "revisit" and (
            payload or "warc-refers-to" not in headers):
        raise ValueError(f"a wrong {kind} record")
    uri = headers.get("warc-target-uri")
    return {"page_id": _page_id(headers["warc-record-id"]),
            "url": None if uri is None else _header_value(uri), "record_type": kind,
            "refers_to": _page_id(headers["warc-refers-to"]) if kind == "revisit" else None,
            "payload_bytes": told, "payload_digest": own,
            "payload": payload.decode("utf-8", "surrogatepass") if kind == "response" else None,
            "error": None}


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from the samples; empty where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


class ArchiveWriter:
    """Frames of one archive in memory; the dictionary comes from the first records."""

    def __init__(self):
        self.waiting: list[bytes] = []
        self.waiting_bytes = self.records = self.size = 0
        self.frames: list[bytes] = []
        self.packer = None

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.packer:
            self._frame(record)
            return
        self.waiting.append(record)
        self.waiting_bytes += len(record)
        if self.waiting_bytes >= SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        head = train_dictionary([r[:64 << 10] for r in self.waiting])
        self.frames.append(struct.pack("<II", DICTIONARY_MAGIC, len(head)) + head)
        self.packer = zstandard.ZstdCompressor(
            level=3, dict_data=zstandard.ZstdCompressionDict(head) if head else None)
        for record in self.waiting:
            self._frame(record)
        self.waiting = []

    def _frame(self, record: bytes) -> None:
        self.frames.append(self.packer.compress(record))
        self.size += len(self.frames[-1])

    def close(self) -> bytes:
        if not self.packer:
            self._start()
        return b"".join(self.frames)


def records_of(archive: bytes):
    """Each record's bytes: load the dictionary of the leading skippable frame,
    then decode frame after frame. A broken frame raises ValueError."""
    view, at, known = memoryview(archive), 0, None
    if len(view) >= 8:
        magic, size = struct.unpack("<II", view[:8])
        if magic == DICTIONARY_MAGIC:
            if len(view) < 8 + size:
                raise ValueError("the dictionary frame is cut off")
            head, at = bytes(view[8:8 + size]), 8 + size
            if head[:4] == ZSTD_MAGIC:       # a dictionary may itself be compressed
                head = zstandard.ZstdDecompressor().decompress(head, max_output_size=64 << 20)
            known = zstandard.ZstdCompressionDict(head) if head else None
    unpacker = zstandard.ZstdDecompressor(dict_data=known)
    while at < len(view):
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if at >= len(view):
                raise ValueError("the last frame is cut off")
            chunk = view[at:at + (64 << 10)]
            try:
                parts.append(frame.decompress(chunk))
            except zstandard.ZstdError as e:
                raise ValueError(f"frame at byte {at}: {e}") from e
            at += len(chunk)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def with_originals(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html`` (null as empty) and ``original``: the largest page_id
    of the rows with an equal payload where there are several, else null."""
    base = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    key = [F.sha1("html").alias("sha1"), F.octet_length("html").alias("size")]
    shared = stage(base.where(F.octet_length("html") >= min_bytes).select("page_id", *key)
                   .groupBy("sha1", "size").agg(F.max("page_id").alias("original"),
                                                F.count(F.lit(1)).alias("n"))
                   .where("n > 1").select("sha1", "size", "original"), "shared-payloads")
    return (base.select("*", *key).join(shared, ["sha1", "size"], "left")
            .select("page_id", "url", "html", "original"))


def pack(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> ``(n_records, content)``: archives as binary
    rows. Every row becomes a record: a null html is an empty payload. Of rows
    that repeat the largest page_id all are responses; rows without a page_id
    are revisits where another row has one, else responses. No pages: no
    archives."""

    def write(batches):
        archive = ArchiveWriter()
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(4))):
                page_id, url, html, original = (x.as_py() for x in row)
                archive.add(build_record(page_id, url, html.encode("utf-8", "surrogatepass"), original,
                                         original is not None and page_id != original))
                if archive.size >= ARCHIVE_BYTES:
                    yield _archive_row(archive)
                    archive = ArchiveWriter()
        if archive.records:
            yield _archive_row(archive)

    return with_originals(pages).mapInArrow(write, "n_records bigint, content binary")


def _archive_row(archive: ArchiveWriter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([archive.records], pa.int64()),
                                       pa.array([archive.close()], pa.binary())],
                                      names=["n_records", "content"])


def unpack(archives: DataFrame, content_col: str = "content") -> DataFrame:
    """Rows with archive bytes -> one row per record. A record that fails its
    validation has only ``error`` set; a broken frame ends its archive with such
    a row. Null contents have no records."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest",
             "payload", "error"]
    kinds = pa.schema(list(zip(names, [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(),
                                       pa.string(), pa.string(), pa.string()])))

    def read(batches):
        for batch in batches:
            for content in batch.column(batch.schema.get_field_index(content_col)):
                out, size = [], 0
                for row in _read_archive(content.as_buffer() if content.is_valid else b""):
                    out.append(row)
                    size += len(row["payload"] or "")
                    if size > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema=kinds)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return archives.select(content_col).mapInArrow(read, RECORD)


def _read_archive(content):
    bare = dict.fromkeys(("page_id", "url", "record_type", "refers_to", "payload_bytes",
                          "payload_digest", "payload"))
    try:
        for raw in records_of(content):
            try:
                row = parse_record(raw)
            except (ValueError, KeyError) as e:
                row = bare | {"error": str(e)}
            yield row
    except ValueError as e:
        yield bare | {"error": str(e)}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all .warc.zst files below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option(
        "recursiveFileLookup", "true")
    return unpack(files.load(path))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Make .warc.zst files in ``folder`` (a URI that pyarrow writes and all
    executors share); returns ``(file, n_records)``. A file appears under its
    name when it is whole, named by its content, so a repeated task leaves the
    same file."""

    def write(batches):
        from pyarrow import fs
        place, root = fs.FileSystem.from_uri(folder)
        place.create_dir(root, recursive=True)
        for batch in batches:
            files = []
            for content in batch.column(1):
                body = content.as_buffer()
                name = f"{hashlib.sha1(body).hexdigest()}.warc.zst"
                with place.open_output_stream(f"{root}/.{name}.part") as out:
                    out.write(body)
                place.move(f"{root}/.{name}.part", f"{root}/{name}")
                files.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), batch.column(0)],
                                             names=["file", "n_records"])

    return pack(pages).mapInArrow(write, "file string, n_records bigint")
