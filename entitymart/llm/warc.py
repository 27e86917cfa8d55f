"""WARC archives as a Spark data source, and a crawl archived with repeated payloads stored once.

Every record is one gzip member whose extra field holds the member's lengths, so a reader
inflates the headers, judges them, and steps over a payload that nobody asked for.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from entitymart.llm.common import Scratch

#: Bytes after which a task starts another file, and between places where a file may be cut.
FILE_BYTES, CUT_BYTES = 256 << 20, 16 << 20
#: Bytes of archives that one read task takes, of a file read at once, and of payload in one batch.
PARTITION_BYTES, WINDOW, BATCH_BYTES = 64 << 20, 1 << 20, 8 << 20
#: Bytes of a block read for its HTTP head where the payload is not.
HTTP_HEAD = 16384
#: Shortest payload that a revisit may stand for.
LEAST_PAYLOAD = 100
#: Groups of equal payloads with a larger share of the rows are looked up from a broadcast; there are at most so many.
HOT_GROUPS = 1000
DATE = "1970-01-01T00:00:00Z"

#: Columns of a record, in the order of the source's default schema; fixed names of the format on the right.
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
    "content_length": "content-length",
}
SCHEMA = (
    ", ".join(f"{c} {'long' if c == 'content_length' else 'string'}" for c in HEADERS)
    + ", headers map<string,string>, http_status int, http_length long, payload binary, file string, offset long"
)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and place of a path or address that every executor reaches."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# Records -----------------------------------------------------------------------------------


def head(fields: list[tuple[str, str | None]]) -> bytes:
    """Header lines; a line break in a value is percent-encoded, an absent value leaves its line out."""
    lines = [f"{k}: {v}".replace("\r", "%0D").replace("\n", "%0A") for k, v in fields if v is not None]
    return ("\r\n".join(["WARC/1.1", *lines]) + "\r\n\r\n").encode()


def member(record: bytes) -> bytes:
    """One gzip member; its extra field ``sl`` holds its own length and the record's (0: longer than 32 bits hold)."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    whole = 10 + 2 + 12 + len(body) + 8
    fits = max(whole, len(record)) < 1 << 32
    extra = b"sl" + struct.pack("<HII", 8, whole if fits else 0, len(record) if fits else 0)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class _Window:
    """Bytes of a file by place, read in large stretches."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.held = file, size, 0, b""

    def at(self, place: int, length: int) -> bytes:
        if not (self.start <= place and place + length <= self.start + len(self.held)):
            self.file.seek(place)
            self.start, self.held = place, self.file.read(max(length, WINDOW))
        return self.held[place - self.start : place - self.start + length]


def _fields(raw: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a line that starts with a blank goes on with the one before."""
    out, name = {}, None
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


class BadArchive(ValueError):
    """A place in an archive that holds no whole record."""


def _plain(window: _Window, place: int, wanted, payload: bool):
    """Record of an uncompressed archive: its headers, its block if wanted, and the next place."""
    size, at = 4096, -1
    while at < 0 and size < 1 << 30:
        raw = window.at(place, size)
        at = raw.find(b"\r\n\r\n")
        if len(raw) < size:
            break
        size *= 4
    if at < 0 or not raw.startswith(b"WARC/"):
        raise BadArchive(f"no record at {place}")
    fields = _fields(raw[:at])
    length = int(fields.get("content-length", 0))
    block = window.at(place + at + 4, length if payload else min(length, HTTP_HEAD)) if wanted(fields) else None
    return fields, block, place + at + 4 + length + 4


def _zipped(window: _Window, place: int, wanted, payload: bool):
    """Record of a gzip member. Only its headers are inflated unless it is wanted; a member
    without lengths must be inflated to find its end, though nothing of it is kept."""
    raw = window.at(place, 4096)
    if raw[:3] != b"\x1f\x8b\x08":
        raise BadArchive(f"no gzip member at {place}")
    whole = 0
    if raw[3] & 4:
        extra = raw[12 : 12 + struct.unpack("<H", raw[10:12])[0]]
        while len(extra) >= 4:
            n = struct.unpack("<H", extra[2:4])[0]
            if extra[:2] == b"sl" and n >= 8:
                whole = struct.unpack("<I", extra[4:8])[0]
            extra = extra[4 + n :]
    inflate, at, out, fields, start, need = zlib.decompressobj(31), place, bytearray(), None, 0, 0

    def more() -> bytes:
        nonlocal at
        raw = window.at(at, 4096 if at == place else 16384)
        if not raw:
            raise BadArchive(f"the record at {place} is cut off")
        at += len(raw)
        return inflate.decompress(raw)

    while fields is None or len(out) < need:
        if inflate.eof:
            raise BadArchive(f"no whole record at {place}")
        out += more()
        if fields is None and (end := out.find(b"\r\n\r\n")) >= 0:
            if not out.startswith(b"WARC/"):
                raise BadArchive(f"no record at {place}")
            fields, start = _fields(bytes(out[:end])), end + 4
            take = wanted(fields)
            length = int(fields.get("content-length", 0))
            need = start + (length if payload else min(length, HTTP_HEAD)) if take else start
    block = bytes(out[start:need]) if take else None
    while not whole and not inflate.eof:
        more()
    return fields, block, place + whole if whole else at - len(inflate.unused_data)


def records(path: str, start: int, end: int, wanted=lambda fields: True, payload: bool = True) -> Iterator[tuple[int, dict, bytes]]:
    """(place, headers, block) of the wanted records that start in [start, end) of an archive."""
    store, place = _store(path)
    size = store.get_file_info(place).size
    with store.open_input_file(place) as file:
        window, at = _Window(file, size), start
        step = _zipped if window.at(start, 2) == b"\x1f\x8b" else _plain
        while at < min(end, size):
            fields, block, after = step(window, at, wanted, payload)
            if block is not None:
                yield at, fields, block
            at = after


# Source ------------------------------------------------------------------------------------


@dataclass
class Stretch(ds.InputPartition):
    """Parts of archives that one task reads: (path, first byte, end)."""

    parts: list

    def __init__(self, parts):
        super().__init__(parts)
        self.parts = parts


_TESTS = {
    ds.EqualTo: lambda v, x: v == x,
    ds.In: lambda v, x: v in x,
    ds.GreaterThan: lambda v, x: v > x,
    ds.GreaterThanOrEqual: lambda v, x: v >= x,
    ds.LessThan: lambda v, x: v < x,
    ds.LessThanOrEqual: lambda v, x: v <= x,
    ds.StringStartsWith: lambda v, x: v.startswith(x),
    ds.StringEndsWith: lambda v, x: v.endswith(x),
    ds.StringContains: lambda v, x: x in v,
    ds.IsNotNull: lambda v, x: True,
}


def _value(column: str, fields: dict):
    value = fields.get(HEADERS[column])
    return int(value or 0) if column == "content_length" else value


class WarcReader(ds.DataSourceReader):
    """Plans files, cut where the manifest allows, and reads headers before payloads."""

    def __init__(self, schema: StructType, options: dict):
        self.path, self.schema = options["path"], schema
        self.most = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests = [(HEADERS_FREE + k[7:].lower(), ds.EqualTo, v) for k, v in options.items() if k.lower().startswith("header.")]

    def pushFilters(self, filters):
        """Takes what headers decide; ordering of texts is left to Spark, which compares bytes."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            ordered = type(f) in (ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual)
            if column in HEADERS and type(f) in _TESTS and (not ordered or column == "content_length"):
                self.tests.append((column, type(f), getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, fields: dict) -> bool:
        for column, kind, operand in self.tests:
            value = fields.get(column[len(HEADERS_FREE) :]) if column.startswith(HEADERS_FREE) else _value(column, fields)
            if value is None or not _TESTS[kind](value, operand):
                return False
        return True

    def partitions(self):
        """Cuts of at most about ``partitionBytes``, several small ones to a task, in the order of files."""
        cuts = []
        for path, size, marks in archives(self.path):
            edges = [0]
            for mark in [*marks, size]:
                if mark == size or mark - edges[-1] >= self.most:
                    edges.append(mark)
            cuts += [(path, a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if a < b]
        out, held, load = [], [], 0
        for cut in cuts:
            if held and load + cut[2] - cut[1] > self.most:
                out.append(Stretch(held))
                held, load = [], 0
            held.append(cut)
            load += cut[2] - cut[1]
        return [*out, Stretch(held)] if held or not out else out

    def read(self, partition):
        names, rows, load = self.schema.names, [], 0
        arrow = pa.schema([(n, _ARROW[n]) for n in names])
        payload = "payload" in names
        for path, start, end in partition.parts:
            for at, fields, block in records(path, start, end, self.wanted, payload):
                rows.append(_row(names, path, at, fields, block))
                load += len(block) + 500
                if load >= BATCH_BYTES:
                    yield _batch(rows, arrow)
                    rows, load = [], 0
        if rows:
            yield _batch(rows, arrow)


HEADERS_FREE = "header:"
_ARROW = {c: pa.string() for c in HEADERS} | {
    "content_length": pa.int64(), "headers": pa.map_(pa.string(), pa.string()), "http_status": pa.int32(),
    "http_length": pa.int64(), "payload": pa.binary(), "file": pa.string(), "offset": pa.int64(),
}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], schema.field(n).type) for n in schema.names], schema=schema)


def _row(names: list[str], path: str, at: int, fields: dict, block: bytes) -> dict:
    row = {c: _value(c, fields) for c in HEADERS} | {"headers": list(fields.items()), "file": path, "offset": at, "http_status": None, "http_length": None, "payload": block}
    if (row["content_type"] or "").startswith("application/http"):
        top, gap, body = block.partition(b"\r\n\r\n")
        first, http = top.split(b"\r\n", 1)[0].split(b" "), _fields(top)
        row["payload"] = body if gap else b""
        row["http_status"] = int(first[1]) if len(first) > 1 and first[1].isdigit() else None
        row["http_length"] = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
    if row["record_type"] == "revisit":
        row["payload"] = None
    return {n: row[n] for n in names}


def archives(path: str) -> list[tuple[str, int, list[int]]]:
    """(address, bytes, places to cut) of a folder's archives, or of one archive.

    A folder with manifests holds what they name and nothing else, so files of a task that
    was lost or ran twice do not count.
    """
    store, place = _store(path)
    address = lambda p: path[: len(path) - len(place)] + p if path.endswith(place) else f"{path.partition('://')[0]}://{p}"
    info = store.get_file_info(place)
    if info.type == fs.FileType.File:
        return [(path, info.size, [])]
    found = sorted(store.get_file_info(fs.FileSelector(place, allow_not_found=True)), key=lambda f: f.path)
    manifests = [f for f in found if f.base_name.startswith("_manifest-")]
    out = []
    for f in manifests:
        with store.open_input_stream(f.path) as stream:
            out += [(address(f"{place.rstrip('/')}/{name}"), size, marks) for name, size, marks in json.loads(stream.read())]
    if manifests:
        return out
    return [(address(f.path), f.size, []) for f in found if f.base_name.endswith((".warc", ".warc.gz"))]


@dataclass
class Written(ds.WriterCommitMessage):
    """Files that one task wrote: (name, bytes, places to cut)."""

    files: list = field(default_factory=list)


class WarcWriter(ds.DataSourceArrowWriter):
    """Records to files with names of their own; a manifest written at the end makes them count."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator):
        store, place = _store(self.path)
        store.create_dir(place, recursive=True)
        done, out, name, size, marks = [], None, None, 0, []
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, size, marks = store.open_output_stream(f"{place}/{name}", compression=None), 0, []
                    zipped = member(record(row))
                    if size - (marks[-1] if marks else 0) >= CUT_BYTES:
                        marks.append(size)
                    out.write(zipped)
                    size += len(zipped)
                    if size >= FILE_BYTES:
                        out.close()
                        done.append((name, size, marks))
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written([*done, (name, size, marks)] if out is not None else done)

    def commit(self, messages):
        store, place = _store(self.path)
        store.create_dir(place, recursive=True)
        old = [f.path for f in store.get_file_info(fs.FileSelector(place)) if f.base_name.startswith("_manifest-")] if self.overwrite else []
        manifest = f"{place}/_manifest-{uuid.uuid4().hex}.json"
        with store.open_output_stream(manifest) as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())
        for path in old:
            store.delete_file(path)

    def abort(self, messages):
        store, place = _store(self.path)
        for name, _, _ in [f for m in messages if m for f in m.files]:
            store.delete_file(f"{place}/{name}")


def record(row: dict) -> bytes:
    """A response or revisit record with its HTTP head; a revisit keeps the head and leaves the payload out."""
    payload, revisit = row.get("payload") or b"", row["record_type"] == "revisit"
    length = row.get("http_length")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload) if length is None else length}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", row.get("date") or DATE),
        ("WARC-Target-URI", row.get("target_uri")),
        ("WARC-Payload-Digest", row.get("payload_digest")),
        ("WARC-Refers-To", row.get("refers_to")),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        *(row.get("headers") or []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return head(fields) + block + b"\r\n\r\n"


class WarcSource(ds.DataSource):
    """``spark.read.format("warc")``: a schema with fewer of the columns reads only those.

    Options: ``path`` (one archive or a folder), ``partitionBytes``, and ``header.<name>``,
    the value that a header of that name must have. Ten kinds of filters on the header
    columns are judged before a payload is inflated. Archives may be plain or one gzip
    member a record, also without the lengths that this writer adds. A file that other
    tools wrote is read by one task, since nothing tells where a record starts.
    """

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], overwrite)


def read(spark: SparkSession, path: str, columns: list[str] | None = None, **options: str) -> DataFrame:
    """Records of the archives at ``path``; without ``payload`` among the columns no payload is inflated."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    source = spark.read.format("warc").options(**options)
    if columns:
        kinds = dict(part.split(" ", 1) for part in SCHEMA.split(", "))
        source = source.schema(", ".join(f"{c} {kinds[c]}" for c in columns))
    return source.load(path)


def write(records: DataFrame, path: str, mode: str = "append") -> None:
    """Archives of rows with ``record_type``, ``record_id``, ``payload`` and, where known, the other columns of the source."""
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode(mode).save(path)


# A crawl -----------------------------------------------------------------------------------


def archive(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Writes a record for each page: a response, or a revisit of the response with the same payload.

    The payload is the html in UTF-8; null is empty. Of pages with equal payloads of at
    least ``LEAST_PAYLOAD`` bytes the one with the smallest page_id is the response (null
    ids last; of rows with one id the first read), all others revisit it; shorter payloads
    are all responses. Pages without id or url leave the header out. An empty table writes
    an archive without records. Other columns are not archived.

    Payloads are compared by SHA-256. Only groups of two or more are looked up: those with more
    than a thousandth of the rows, at most a thousand, from a broadcast, so that no task
    gets a group; the rest by a join that Spark plans by size.
    """
    spark, run = pages.sparkSession, uuid.uuid4().hex
    scratch, html = Scratch(spark, "crawl"), F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.keep(rows, "pages")
    place = F.struct(F.col("page_id").isNull().alias("nameless"), "page_id", "row")
    groups = rows.where(F.length("payload") >= LEAST_PAYLOAD).groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    groups = groups.where("n > 1").select("digest", "n", F.col("first.row").alias("first_row"), F.col("first.page_id").alias("first_page"))
    groups, n = scratch.keep(groups, "groups"), rows.count()
    hot, cold = groups.where(F.col("n") * HOT_GROUPS > n), groups.where(F.col("n") * HOT_GROUPS <= n)
    known = rows.join(F.broadcast(hot.select("digest", F.col("first_row").alias("h_row"), F.col("first_page").alias("h_page"))), "digest", "left")
    rest = cold.select("digest", F.col("first_row").alias("c_row"), F.col("first_page").alias("c_page"))
    known = known.where("h_row is not null").withColumn("c_row", F.lit(None).cast("long")).withColumn("c_page", F.lit(None).cast("long")).unionByName(
        known.where("h_row is null").join(rest, "digest", "left")
    )
    first = F.coalesce("h_row", "c_row")
    revisit = first.isNotNull() & (first != F.col("row"))

    def name(row):
        x = F.md5(F.concat_ws(":", F.lit(run), row.cast("string")))
        parts = [F.substring(x, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    marks = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("X-Page-Id").alias("k"), F.col("page_id").cast("string").alias("v")),
        F.struct(F.lit("X-Refers-To-Page-Id").alias("k"), F.when(revisit, F.coalesce("h_page", "c_page")).cast("string").alias("v")),
    ), lambda e: e["v"].isNotNull()))
    write(
        known.select(
            F.when(revisit, "revisit").otherwise("response").alias("record_type"),
            name(F.col("row")).alias("record_id"),
            F.lit(date).alias("date"),
            F.col("url").alias("target_uri"),
            F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
            F.when(revisit, name(first)).alias("refers_to"),
            F.length("payload").cast("long").alias("http_length"),
            marks.alias("headers"),
            F.when(~revisit, F.col("payload")).alias("payload"),
        ),
        path,
    )
    scratch.drop("pages")


def crawl(archived: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, ...) of records that ``archive`` wrote.

    A response's digest and length are taken from the payload read back, a revisit's from
    its headers, which describe the payload that it stands for.
    """
    response = F.col("record_type") == "response"
    stated = F.substring("payload_digest", len("sha256:") + 1, 64)
    digest = F.when(response, F.sha2("payload", 256)).otherwise(stated)
    return archived.where(F.col("record_type").isin("response", "revisit")).select(
        F.col("headers")["x-page-id"].cast("long").alias("page_id"),
        F.when(response, F.length("payload")).otherwise(F.col("http_length")).cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        F.col("headers")["x-refers-to-page-id"].cast("long").alias("refers_to"),
        (digest == stated).alias("digest_agrees"),
    )
