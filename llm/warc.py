"""WARC archives as a Spark data source, written and read in parallel.

``df.write.format("warc")`` writes a file for each task (more beyond ``max_file_bytes``) and
lists the committed files in a manifest; ``spark.read.format("warc")`` plans partitions of
whole files by size.  Filters on ``record_type`` and on text headers are pushed down: a record's headers
are parsed first, and a record that no filter accepts is passed over by its length, its payload
neither copied nor decoded.  ``option("payload", "false")`` skips all payloads.
"""

from __future__ import annotations

import gzip
import io
import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from llm.common import filesystem, new_dir, only

SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary"
)
ARROW = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])
MANIFEST = "_manifest.json"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = {
    "WARC-Record-ID": "record_id", "WARC-Type": "record_type", "WARC-Target-URI": "target_uri",
    "WARC-Refers-To": "refers_to", "WARC-Payload-Digest": "payload_digest",
}
BATCH_BYTES = 8 << 20


def clean(value: str) -> str:
    """A header value on one line: control characters and % are percent-encoded."""
    if value.isprintable() and "%" not in value and value == value.strip():
        return value
    kept = "".join(c if c.isprintable() and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)
    head, tail = len(kept) - len(kept.lstrip()), len(kept.rstrip())
    return "%20" * head + kept[head:tail] + "%20" * (len(kept) - max(tail, head))


def unclean(value: str) -> str:
    if "%" not in value:
        return value
    from urllib.parse import unquote

    return unquote(value)


def record(row: dict) -> bytes:
    """One record: an HTTP response with its payload, or a revisit with the response's head only."""
    revisit = row["record_type"] == "revisit"
    payload = row["payload"]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{clean(row['record_id'])}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{row['payload_digest']}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {clean(row['target_uri'])}")
    if revisit:
        lines += [f"WARC-Refers-To: <{clean(row['refers_to'])}>", f"WARC-Profile: {PROFILE}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


class Skipping:
    """A forward reader over a plain or gzip file that can pass over bytes."""

    def __init__(self, file, packed: bool) -> None:
        self.stream = io.BufferedReader(gzip.GzipFile(fileobj=file), 1 << 20) if packed else io.BufferedReader(_Raw(file), 1 << 20)
        self.packed = packed

    def line(self) -> bytes:
        return self.stream.readline()

    def read(self, n: int) -> bytes:
        return self.stream.read(n)

    def skip(self, n: int) -> None:
        if not self.packed:
            self.stream.seek(n, io.SEEK_CUR)
            return
        while n > 0:
            n -= len(self.stream.read(min(n, 1 << 20))) or n


class _Raw(io.RawIOBase):
    def __init__(self, file) -> None:
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        return self.file.seek(offset, whence)

    def tell(self) -> int:
        return self.file.tell()

    def readinto(self, target) -> int:
        data = self.file.read(len(target))
        target[: len(data)] = data
        return len(data)


def records(file, packed: bool, wanted, with_payload: bool) -> Iterator[tuple]:
    """Records whose headers ``wanted`` accepts, as rows of ``SCHEMA``."""
    stream = Skipping(file, packed)
    while True:
        line = stream.line()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        row, length = dict.fromkeys(HEADERS.values()), 0
        while (line := stream.line().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode().partition(": ")
            if name == "Content-Length":
                length = int(value)
            elif name in HEADERS:
                value = value[1:-1] if value.startswith("<") else value
                row[HEADERS[name]] = value.removeprefix("sha1:") if name == "WARC-Payload-Digest" else unclean(value)
        if not wanted(row):
            stream.skip(length + 4)
            continue
        head, size = 0, None
        while True:
            line = stream.line()
            head += len(line)
            if line.lower().startswith(b"content-length:"):
                size = int(line.split(b":")[1])
            if line in (b"\r\n", b""):
                break
        payload = None
        if with_payload and row["record_type"] != "revisit":
            payload = stream.read(length - head)
            stream.skip(4)
        else:
            stream.skip(length - head + 4)
        yield (row["record_id"], row["record_type"], row["target_uri"], row["refers_to"], size, row["payload_digest"], payload)


@dataclass
class Files(InputPartition):
    paths: list = field(default_factory=list)

    def __init__(self, paths: list) -> None:
        super().__init__(paths)
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.partition_bytes = int(options.get("partition_bytes", 32 << 20))
        self.accept: list[tuple] = []

    def pushFilters(self, filters: list[Filter]):
        """Keep equality, membership and prefix filters on headers; Spark applies the others."""
        own = set(HEADERS.values())
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in own and isinstance(f, EqualTo):
                self.accept.append((name, "in", (f.value,)))
            elif name in own and isinstance(f, In):
                self.accept.append((name, "in", tuple(f.value)))
            elif name in own and isinstance(f, StringStartsWith):
                self.accept.append((name, "prefix", f.value))
            elif name in own and isinstance(f, IsNotNull):
                self.accept.append((name, "known", None))
            else:
                yield f

    def partitions(self) -> list[Files]:
        store, folder = filesystem(self.path)
        try:
            with store.open_input_file(posixpath.join(folder, MANIFEST)) as f:
                sizes = {posixpath.join(folder, name): size for name, size in json.loads(f.read()).items()}
        except FileNotFoundError:
            found = store.get_file_info(pafs.FileSelector(folder))
            sizes = {x.path: x.size for x in found if x.path.endswith((".warc", ".warc.gz"))}
        parts, room = [], 0
        for path in sorted(sizes):
            if room < sizes[path] or not parts:
                parts.append([])
                room = self.partition_bytes
            parts[-1].append(path)
            room -= sizes[path]
        return [Files(p) for p in parts] or [Files([])]

    def _wanted(self, row: dict) -> bool:
        for name, how, value in self.accept:
            have = row[name]
            if have is None or how == "in" and have not in value or how == "prefix" and not have.startswith(value):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as file:
                for row in records(file, path.endswith(".gz"), self._wanted, self.payload):
                    rows.append(row)
                    size += 200 + len(row[-1] or b"")
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


@dataclass
class Written(WriterCommitMessage):
    files: dict


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.packed = options.get("compression", "none") == "gzip"
        self.max_file_bytes = int(options.get("max_file_bytes", 64 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Files carry an attempt's own name; only those that the manifest lists are ever read."""
        store, folder = filesystem(self.path)
        store.create_dir(folder, recursive=True)
        files, out, name, size = {}, None, "", 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc{'.gz' if self.packed else ''}", 0
                    out = store.open_output_stream(posixpath.join(folder, name), compression=None)
                data = record(row)
                data = gzip.compress(data, 6, mtime=0) if self.packed else data
                out.write(data)
                size += len(data)
                if size >= self.max_file_bytes:
                    out.close()
                    files[name], out = size, None
        if out is not None:
            out.close()
            files[name] = size
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = filesystem(self.path)
        store.create_dir(folder, recursive=True)
        listed: dict[str, int] = {}
        try:
            with store.open_input_file(posixpath.join(folder, MANIFEST)) as f:
                listed = json.loads(f.read())
        except FileNotFoundError:
            pass
        for m in messages:
            listed |= m.files if m else {}
        with store.open_output_stream(posixpath.join(folder, MANIFEST)) as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Unlisted files are never read; nothing has to be undone."""


class WarcDataSource(DataSource):
    """``format("warc")``: options ``path``, ``payload``, ``partition_bytes``, ``compression``, ``max_file_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to; write to a new folder instead")
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Rows of ``SCHEMA`` for ``pages(page_id, url, html)``: of equal payloads, the smallest id is the response.

    Equal means an equal SHA-1.  Payloads of fewer than ``min_bytes`` bytes are all responses.  Null html is the
    empty payload; a null ``page_id`` comes after all others (and is a response if its payload has no
    id at all); rows that repeat the responding ``page_id`` with the same payload are responses as well.
    """
    rows = only(pages, page_id="page_id", url="url", html="html")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = rows.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    first = rows.select("page_id", "digest").groupBy(F.col("digest").alias("of")).agg(F.min("page_id").alias("first_id"))
    revisit = (F.col("payload_bytes") >= min_bytes) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("null")))
    joined = rows.join(first, F.col("digest") == F.col("of")).withColumn("revisit", revisit)
    return joined.select(
        name(F.col("page_id")).alias("record_id"),
        F.when(F.col("revisit"), "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(F.col("revisit"), name(F.col("first_id"))).alias("refers_to"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.when(~F.col("revisit"), F.col("payload")).alias("payload"),
    )


def base32(hex_digest: F.Column) -> F.Column:
    """The 32 base32 letters of a 40-digit hex SHA-1, five bits at a time."""
    bits = lambda i: (  # noqa: E731  five hex digits hold four letters
        F.conv(F.substring(hex_digest, 1 + 5 * (i // 4), 5), 16, 10).cast("long").bitwiseAND((1 << 20) - 1)
    )
    letter = lambda i: F.substring(
        F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.shiftright(bits(i), 15 - 5 * (i % 4)).bitwiseAND(31).cast("int") + 1, F.lit(1)
    )
    return F.concat(*[letter(i) for i in range(32)])


def archive(pages: DataFrame, path: str, min_bytes: int = 0, compression: str = "none") -> None:
    """Write a record for each page below ``path``."""
    register(pages.sparkSession)
    rows = with_revisits(pages, min_bytes).withColumn("payload_digest", base32(F.col("payload_digest")))
    rows.write.format("warc").option("compression", compression).mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records below ``path``.

    Spark keeps the filters that were last pushed to a loaded source; the filter that accepts all makes sure that
    each query over these records pushes its own.
    """
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path).filter("record_type IS NOT NULL")


def page_number(record_id: F.Column) -> F.Column:
    """The page id in a record id; null where the page had none."""
    return F.substring_index(record_id, ":", -1).try_cast("long")


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """A row for each page of the archives below ``path``, with size and digest of the payload that was read.

    A revisit has those of the response that it refers to, of equal digest by its own header; both are null where no such
    payload is found, as after damage to the archive.
    """
    read = read_archive(spark, path).filter("record_type = 'response'")
    read = read.select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.sha1("payload")).alias("payload_digest"))
    asked = read_archive(spark, path, payload=False).filter("record_type = 'revisit'").select("record_id", "refers_to", F.col("payload_digest").alias("named"))
    # A page id that the table repeats gives equal records; the pages themselves are all kept.
    known = read.distinct().withColumnRenamed("record_id", "of")
    found = asked.join(known, (F.col("refers_to") == F.col("of")) & (F.col("named") == F.col("payload_digest")), "left")
    columns = lambda kind, refers_to: [
        page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", F.lit(kind).alias("record_type"), page_number(refers_to).alias("refers_to"),
    ]
    return read.select(*columns("response", F.lit(None).cast("string"))).unionByName(found.select(*columns("revisit", F.col("refers_to"))))


def round_trip(pages: DataFrame, min_bytes: int = 0, compression: str = "gzip") -> DataFrame:
    """Write the archives and read their payloads back: a row for each page."""
    spark = pages.sparkSession
    path = new_dir(spark, "warc")
    archive(pages, path, min_bytes, compression)
    return read_back(spark, path)
