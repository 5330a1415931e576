"""WARC archives as a PySpark Python data source, and pages as WARC records.

``WarcSource`` (format ``warc``) reads and writes folders of WARC 1.1 files,
plain or compressed record by record.

Reading. The driver plans partitions from file sizes: small files share a
partition, a large one has its own. A task parses a record's headers first.
Predicates on header columns (record type, URI, date, ...) are pushed into the
reader and decided on the headers alone; the block of a record they rule out is
skipped: in a compressed file without inflating it, where its gzip member
states its own length (the ``sl`` extra field that the writer puts there), in a
plain file by a seek. Without the ``payload`` column no block is read at all.

Writing. A task writes files of bounded size under names of its own. The commit
puts a manifest beside them, and readers of a folder with manifests see only
the files these list: what a lost or repeated task left behind is never read.

Files are opened through Arrow's file systems, so a folder may be local or on
any store that these know by its scheme.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from .base import only, shared_folder, spill, split_join

HEADER_COLUMNS = {  # column -> the header it is
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
    "record_date": "warc-date", "content_type": "content-type", "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest", "content_length": "content-length",
}
SCHEMA = ("record_id string, record_type string, target_uri string, record_date string, content_type string, "
          "refers_to string, payload_digest string, content_length long, headers map<string,string>, payload binary")
FILE_BYTES = 64 << 20       # a written file is closed beyond this
PARTITION_BYTES = 64 << 20  # small files are read together up to this
BATCH_BYTES = 4 << 20
BATCH_ROWS = 1000
READ_BYTES = 1 << 20
LEVEL = 6
MIN_REVISIT_BYTES = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_DATE = "1970-01-01T00:00:00Z"  # of records whose table has no date: archives come out alike each time


# ------------------------------------------------------------------ writing

def _clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _header_block(first: str, fields: list[tuple[str, str]]) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {_clean(v)}\r\n" for k, v in fields) + "\r\n").encode()


def record_bytes(record: dict) -> bytes:
    """One record. Response and revisit records have an HTTP block, the latter
    without its payload; other records' block is the payload itself."""
    kind, payload = record["record_type"], record.get("payload") or b""
    media = record.get("content_type") or "application/octet-stream"
    if kind in ("response", "revisit"):
        block = _header_block("HTTP/1.1 200 OK", [("Content-Type", media), ("Content-Length", str(len(payload)))])
        block, media = block + (payload if kind == "response" else b""), "application/http; msgtype=response"
    else:
        block = payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record["record_id"]),
              ("WARC-Date", record.get("record_date") or PAGE_DATE)]
    for name, column in (("WARC-Target-URI", "target_uri"), ("WARC-Refers-To", "refers_to"),
                         ("WARC-Payload-Digest", "payload_digest")):
        if record.get(column) is not None:
            fields.append((name, record[column]))
    if kind == "revisit":
        fields.append(("WARC-Profile", REVISIT_PROFILE))
    fields += [(k, v) for k, v in record.get("headers") or [] if v is not None]
    fields += [("Content-Type", media), ("Content-Length", str(len(block)))]
    return _header_block("WARC/1.1", fields) + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    """A gzip member whose ``sl`` extra field holds its own whole length and
    the length of ``data`` (both 0 where they need more than 32 bits)."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    lengths = (24 + len(body) + 8, len(data))
    if max(lengths) >> 32:
        lengths = (0, 0)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, *lengths)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class Written(ds.WriterCommitMessage):
    files: list[str]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.gzip = options.get("compression", "gzip") == "gzip"
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        own = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        files: list[str] = []
        out, size = None, 0
        for batch in iterator:
            for record in batch.to_pylist():
                if out is None or size >= self.file_bytes:
                    if out is not None:
                        out.close()
                    files.append(f"{own}-{len(files):05d}.warc" + (".gz" if self.gzip else ""))
                    out, size = fs.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
                    size += self._put(out, {"record_type": "warcinfo", "record_id": f"<urn:uuid:{uuid.uuid4()}>",
                                            "content_type": "application/warc-fields",
                                            "payload": b"format: WARC File Format 1.1\r\n"})
                size += self._put(out, record)
        if out is not None:
            out.close()
        return Written(files)

    def _put(self, out, record: dict) -> int:
        data = record_bytes(record)
        data = gzip_member(data) if self.gzip else data
        out.write(data)
        return len(data)

    def commit(self, messages) -> None:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        old = _manifests(fs, folder) if self.overwrite else []
        with fs.open_output_stream(f"{folder}/_committed-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())
        for path in old:
            fs.delete_file(path)

    def abort(self, messages) -> None:
        fs, folder = file_system(self.path)
        for m in messages:
            for f in m.files if m else []:
                fs.delete_file(f"{folder}/{f}")


# ------------------------------------------------------------------ reading

class _Plain:
    """A file's bytes, read in windows; skipping is a change of position."""

    def __init__(self, file):
        self.file, self.size, self.pos = file, file.size(), 0
        self.window, self.at = b"", 0

    def peek(self, n: int) -> bytes:
        lo = self.pos - self.at
        if not 0 <= lo <= len(self.window) or (lo + n > len(self.window) and self.at + len(self.window) < self.size):
            self.window, self.at, lo = self.file.read_at(max(n, READ_BYTES), self.pos), self.pos, 0
        return self.window[lo:lo + n]

    def read(self, n: int) -> bytes:
        got = self.peek(n)
        self.pos += len(got)
        return got

    def skip(self, n: int) -> None:
        self.pos += n

    def until(self, mark: bytes) -> bytes:
        """The bytes up to and with ``mark``; all the rest where it is missing."""
        n = 1 << 12
        while True:
            got = self.peek(n)
            end = got.find(mark)
            if end >= 0 or len(got) < n:
                return self.read(end + len(mark) if end >= 0 else len(got))
            n *= 4


class _Inflated:
    """The same of a file of gzip members. A skip that ends where a member ends
    jumps to the next one if the member states its length."""

    def __init__(self, file):
        self.raw = _Plain(file)
        self.inflate, self.held = None, b""
        self.made, self.member = 0, (0, 0, 0)  # bytes given out so far; (start, length, bytes) of the member

    def _more(self) -> bool:
        if self.inflate is None or self.inflate.eof:
            head = self.raw.peek(24)
            if not head:
                return False
            if head[:2] != b"\x1f\x8b":
                raise ValueError(f"no gzip member at byte {self.raw.pos}")
            lengths = (0, 0)
            if len(head) == 24 and head[3] & 4 and head[10:16] == b"\x0c\0sl\x08\0":
                lengths = struct.unpack("<II", head[16:])
            self.member, self.made = (self.raw.pos, *lengths), 0
            self.inflate = zlib.decompressobj(31)
        had = self.inflate.unconsumed_tail or self.raw.read(1 << 16)
        if not had:
            raise ValueError(f"the member at byte {self.member[0]} ends early")
        out = self.inflate.decompress(had, 1 << 16)
        if self.inflate.eof:
            self.raw.pos -= len(self.inflate.unused_data)
        self.held += out
        self.made += len(out)
        return True

    def read(self, n: int) -> bytes:
        parts, missing = [], n
        while missing and (self.held or self._more()):
            parts.append(self.held[:missing])
            self.held = self.held[missing:]
            missing -= len(parts[-1])
        return b"".join(parts)

    def skip(self, n: int) -> None:
        start, length, size = self.member
        if length and self.made - len(self.held) + n == size:
            ends = self.raw.pos
            self.raw.pos = start + length
            if self.raw.pos == self.raw.size or self.raw.peek(2) == b"\x1f\x8b":
                self.inflate, self.held = None, b""
                return
            self.raw.pos = ends  # the field means something else here
        while n and (self.held or self._more()):
            gone = min(n, len(self.held))
            self.held, n = self.held[gone:], n - gone

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (end := self.held.find(mark, max(0, at - len(mark)))) < 0:
            at = len(self.held)
            if not self._more():
                return self.read(len(self.held))
        return self.read(end + len(mark))


def _fields(block: bytes) -> dict[str, str]:
    """Header lines after the first one, names in lower case; a line that
    starts with a blank continues the one before."""
    out: dict[str, str] = {}
    name = None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if name and line[:1] in (" ", "\t"):
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _dechunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = int(body[at:end].split(b";")[0] or b"0", 16) if end >= 0 else 0
        if not size:
            return b"".join(parts)
        parts.append(body[end + 2:end + 2 + size])
        at = end + 2 + size + 2


def _payload(headers: dict[str, str], block: bytes) -> tuple[str | None, bytes]:
    """The payload of a block and its media type: of an HTTP message the body,
    chunks joined and gzip or deflate undone."""
    media = headers.get("content-type")
    if not (media or "").lower().startswith("application/http"):
        return media, block
    head, _, body = block.partition(b"\r\n\r\n")
    http = _fields(head)
    if "chunked" in http.get("transfer-encoding", "").lower():
        body = _dechunked(body)
    coding = http.get("content-encoding", "").lower()
    if body and coding in ("gzip", "x-gzip", "deflate"):
        body = zlib.decompress(body, 47 if coding != "deflate" else (15 if body[0] & 15 == 8 else -15))
    return http.get("content-type"), body


def records(file, gzip: bool, keep, payload: bool) -> Iterator[tuple[dict[str, str], str | None, bytes | None]]:
    """(headers, media type, payload) of the records whose headers ``keep``
    accepts; blocks of others, and all blocks without ``payload``, are skipped."""
    stream = (_Inflated if gzip else _Plain)(file)
    while head := stream.until(b"\r\n\r\n"):
        if not head.strip():
            continue
        if not head.lstrip().startswith(b"WARC/") or not head.endswith(b"\r\n\r\n"):
            raise ValueError(f"no WARC record where one should start: {head[:40]!r}")
        headers = _fields(head.lstrip())
        length = int(headers.get("content-length", 0))
        if not payload or not keep(headers):
            stream.skip(length + 4)
            if not payload and keep(headers):
                yield headers, headers.get("content-type"), None
            continue
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("the last record ends early")
        stream.skip(4)
        yield headers, *_payload(headers, block)


def _column(headers: dict[str, str], name: str):
    value = headers.get(HEADER_COLUMNS[name])
    return int(value) if name == "content_length" and value is not None else value


_COMPARED = {ds.GreaterThan: lambda a, b: a > b, ds.GreaterThanOrEqual: lambda a, b: a >= b,
             ds.LessThan: lambda a, b: a < b, ds.LessThanOrEqual: lambda a, b: a <= b,
             ds.EqualTo: lambda a, b: a == b, ds.In: lambda a, b: a in b,
             ds.StringStartsWith: lambda a, b: a.startswith(b), ds.StringEndsWith: lambda a, b: a.endswith(b),
             ds.StringContains: lambda a, b: b in a}


def _predicate(f):
    """A pushed filter as a function of the headers; None where these do not decide it."""
    negated = isinstance(f, ds.Not)
    child = f.child if negated else f
    column = getattr(child, "attribute", ())
    if len(column) != 1 or column[0] not in HEADER_COLUMNS or column[0] == "content_type":
        return None  # the media type of an HTTP record stands in its block
    name, test = column[0], _COMPARED.get(type(child))
    if test:  # a missing header passes neither a test nor its negation
        return lambda h: (v := _column(h, name)) is not None and test(v, child.value) != negated
    if isinstance(child, (ds.IsNull, ds.IsNotNull)):
        null = isinstance(child, ds.IsNull) != negated
        return lambda h: (_column(h, name) is None) == null
    if isinstance(child, ds.EqualNullSafe):
        return lambda h: (_column(h, name) == child.value) != negated
    return None


def _manifests(fs, folder: str) -> list[str]:
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return [i.path for i in found if i.base_name.startswith("_committed-")]


@dataclass
class Files(ds.InputPartition):
    paths: list[str]


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict, payload: bool):
        self.path, self.payload = options["path"], payload
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.predicates: list = []

    def pushFilters(self, filters):
        for f in filters:
            test = _predicate(f)
            if test is None:
                yield f
            else:
                self.predicates.append(test)

    def partitions(self):
        fs, folder = file_system(self.path)
        info = fs.get_file_info(folder)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if info.type == pafs.FileType.File:
            return [Files([folder])]
        committed = _manifests(fs, folder)
        listed = None
        if committed:
            listed = set()
            for path in committed:
                with fs.open_input_stream(path, compression=None) as f:
                    listed |= set(json.loads(f.read()))
        files = [i for i in fs.get_file_info(pafs.FileSelector(folder)) if i.type == pafs.FileType.File
                 and i.base_name.endswith((".warc", ".warc.gz")) and (listed is None or i.base_name in listed)]
        if listed is not None and len(files) < len(listed):
            raise FileNotFoundError(f"{len(listed) - len(files)} committed files are missing in {self.path}")
        out: list[Files] = []
        room = 0
        for i in sorted(files, key=lambda i: i.path):
            if not out or i.size > room:
                out.append(Files([]))
                room = self.partition_bytes
            out[-1].paths.append(i.path)
            room -= i.size
        return out or [Files([])]

    def read(self, partition: Files):
        fs, _ = file_system(self.path)
        schema = pa.schema([(n, pa.int64() if n == "content_length" else pa.string()) for n in HEADER_COLUMNS]
                           + [("headers", pa.map_(pa.string(), pa.string()))]
                           + ([("payload", pa.binary())] if self.payload else []))
        rows: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        def keep(headers: dict[str, str]) -> bool:
            return all(test(headers) for test in self.predicates)

        for path in partition.paths:
            with fs.open_input_file(path) as file:
                for headers, media, payload in records(file, path.endswith(".gz"), keep, self.payload):
                    row = [media if n == "content_type" else _column(headers, n) for n in HEADER_COLUMNS]
                    row.append(list(headers.items()))
                    if self.payload:
                        row.append(payload)
                        size += len(payload)
                    rows.append(tuple(row))
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()


class WarcSource(ds.DataSource):
    """Options: ``path``; reading ``payload`` (``false``: without that column)
    and ``partitionBytes``; writing ``compression`` (``gzip`` or ``none``) and
    ``fileBytes``. Written rows may lack any column but ``record_id`` and
    ``record_type``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def _payload(self) -> bool:
        return str(self.options.get("payload", "true")).lower() != "false"

    def schema(self) -> str:
        return SCHEMA if self._payload() else SCHEMA.rsplit(",", 1)[0]

    def reader(self, schema) -> WarcReader:
        return WarcReader(self._own(), self._payload())

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self._own(), overwrite)

    def _own(self) -> dict:
        return {k.lower(): v for k, v in self.options.items()}


def read_warc(spark: SparkSession, path: str, payload: bool = True, **options) -> DataFrame:
    """The records of a WARC file or folder. Pushing predicates into a Python
    source is a setting of the session, which this turns on."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(payload=str(payload).lower(), **options).load(path)


def write_warc(rows: DataFrame, path: str, mode: str = "append", **options) -> None:
    """Rows with columns of ``SCHEMA`` as WARC files under ``path``."""
    rows.sparkSession.dataSource.register(WarcSource)
    rows.write.format("warc").mode(mode).options(**options).save(path)


def _record_id(*parts):
    h = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def page_records(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                 min_revisit: int = MIN_REVISIT_BYTES) -> DataFrame:
    """One record per row: of rows whose payloads (UTF-8, null as empty) are
    equal and at least ``min_revisit`` bytes long, those with the smallest id are
    responses and the others revisits of it; shorter ones are responses.

    The id travels in the header ``X-Row-Id``. Rows without an id are responses
    where no equal row has one. Rows that repeat an id and a payload are
    records alike. Extra columns are ignored; no rows give none.
    """
    named = only(pages, key=id_col, uri=uri_col, body=payload_col).select(
        "key", "uri", F.coalesce(F.col("body"), F.lit("")).cast("binary").alias("payload"))
    named = named.withColumn("digest", F.sha2("payload", 256))
    # one narrow row per payload that recurs; the wide rows are shuffled once, and a hot payload's rows can be split
    firsts = (named.where(F.length("payload") >= min_revisit).groupBy("digest")
              .agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    marked = split_join(named, firsts, ["digest"], "left")
    again = F.coalesce(~F.col("key").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    return marked.select(
        _record_id(F.col("key"), F.col("digest")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("uri").alias("target_uri"), F.lit("text/html; charset=utf-8").alias("content_type"),
        F.when(again, _record_id(F.col("first"), F.col("digest"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.create_map(F.lit("X-Row-Id"), F.col("key").cast("string")).alias("headers"),
        F.when(~again, F.col("payload")).alias("payload"))


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """What archives of :func:`page_records` hold, one row per record: ``id``,
    ``uri``, ``record_type``, ``refers_to`` (the id of a revisit's response),
    ``payload_bytes`` and ``payload_digest`` of the full payload, both measured
    on the response's payload as read back. A revisit whose response is missing
    has nulls there."""
    own = F.element_at("headers", "x-row-id").cast("long").alias("id")
    full = spill(read_warc(spark, path).where("record_type = 'response'").select(
        own, F.col("target_uri").alias("uri"), "record_type", F.lit(None).cast("long").alias("refers_to"),
        F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_id"), "responses")
    again = read_warc(spark, path, payload=False).where("record_type = 'revisit'").select(
        own, F.col("target_uri").alias("uri"), "record_type", F.col("refers_to").alias("record_id"))
    named = full.groupBy("record_id").agg(F.min("id").alias("refers_to"), F.min("payload_bytes").alias("payload_bytes"),
                                          F.min("payload_digest").alias("payload_digest"))
    resolved = split_join(again, named, ["record_id"], "left")
    return full.drop("record_id").unionByName(resolved.drop("record_id"))


def archive_and_read(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Pages written as archives under ``path`` (a table of the shared folder
    if not given) and read back by :func:`archived_pages`."""
    spark = pages.sparkSession
    path = path or shared_folder(spark, "warc")
    write_warc(page_records(pages, **columns), path)
    return archived_pages(spark, path)
