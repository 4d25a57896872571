"""WARC archives out of pages: written, normalised, indexed, and read back by offset.

Writers pack the records of a task into whole-file gzip streams, as many crawlers leave them. Such a
stream has no place to start but its beginning. The normaliser inflates it once, in pieces, writes every
record as a gzip member of its own, and a sidecar index beside it (one JSON line per record, with
offset and length). Reading then starts from the indexes as an ordinary table, is dealt
out by bytes instead of files, and opens an archive only where a record lies.

Archives lie in the folder all executors share. A task writes under a name of its own attempt and
renames at the end, so a lost executor leaves nothing that is read, and a repeated task
replaces what it wrote before.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import measured_lookup
from textloom.storage import materialise, new_path

GZIP = 31
PIECE = 1 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VISIBLE = "".join(chr(c) for c in range(33, 127))
INDEX = "file string, offset long, length long, type string, id string, uri string, digest string, refers_to string"
READ = "record_id string, record_type string, uri string, payload_bytes long, payload_digest string, refers_to string"
# A header block that goes on for longer is none.
MAX_HEADER = 1 << 20


@dataclass(frozen=True)
class WarcConfig:
    """Payloads of ``min_revisit`` bytes can be revisited. A monolithic file ends after ``file_bytes`` of records;
    a task that reads by offset gets about ``task_bytes`` of archive."""

    min_revisit: int = 1_000
    file_bytes: int = 64 << 20
    task_bytes: int = 8 << 20
    date: str = "2000-01-01T00:00:00Z"
    level: int = 6


# ---------------------------------------------------------------- records


def record_urn(page_id: str | None, digest: str) -> str:
    """Names a page and its payload, so ids may repeat."""
    return f"<urn:page:{'' if page_id is None else quote(page_id, safe='')}:{digest}>"


def encoded_record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, config: WarcConfig) -> tuple[bytes, bytes, bytes]:
    """Head, body and end of a response record, or of a revisit record without a body."""
    sha1 = hashlib.sha1(payload)
    digest = sha1.hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = payload if refers_to is None else b""
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_urn(page_id, digest),
        "WARC-Date": config.date,
        "WARC-Target-URI": None if url is None else quote(url, safe=VISIBLE),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(sha1.digest()).decode(),
        "WARC-Profile": None if refers_to is None else REVISIT_PROFILE,
        "WARC-Refers-To": refers_to,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(http) + len(body)),
    }
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields.items() if value is not None), "", ""]
    return "\r\n".join(lines).encode() + http, body, b"\r\n\r\n"


def fields_of(header: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a line that starts with a blank goes on from the one before."""
    fields: dict[str, str] = {}
    name = ""
    for line in header.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def hex_digest(labelled: str | None) -> str | None:
    """Lower-case hex of ``sha1:`` and base32 or hex."""
    if not labelled or not labelled.lower().startswith("sha1:"):
        return None
    value = labelled[5:]
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


# ---------------------------------------------------------------- files


@contextmanager
def replacing(path: str):
    """A stream to ``path``, which appears only when all is written."""
    store, name = fs.FileSystem.from_uri(path)
    task = TaskContext.get()
    draft = f"{name}.attempt-{task.taskAttemptId() if task else 0}"
    store.create_dir(name.rpartition("/")[0], recursive=True)
    with store.open_output_stream(draft, compression=None) as out:
        yield out
    if not isinstance(store, fs.LocalFileSystem) and store.get_file_info(name).type != fs.FileType.NotFound:
        store.delete_file(name)
    store.move(draft, name)


class Inflated:
    """The bytes of a gzip file, one member or many, in pieces; what is not needed any more is let go."""

    def __init__(self, source):
        self.source = source
        self.inflater = zlib.decompressobj(GZIP)
        self.held = bytearray()
        self.more = True

    def _fill(self) -> bool:
        while self.more:
            data = self.inflater.unconsumed_tail or self.inflater.unused_data
            if self.inflater.eof:
                data = data.lstrip(b"\0") or self.source.read(PIECE)  # zeros may pad the end of a file
                if not data:
                    self.more = False
                    break
                self.inflater = zlib.decompressobj(GZIP)
            elif not data:
                data = self.source.read(PIECE)
                if not data:
                    raise EOFError("the gzip stream ends early")
            piece = self.inflater.decompress(data, PIECE)
            if piece:
                self.held += piece
                return True
        return False

    def header(self) -> bytes:
        """The next record's header with its empty line; nothing at the end of the file."""
        while not self.held:
            if not self._fill():
                return b""
            del self.held[: len(self.held) - len(self.held.lstrip(b"\r\n"))]
        at = 0
        while (found := self.held.find(b"\r\n\r\n", at)) < 0:
            at = max(0, len(self.held) - 3)
            if at > MAX_HEADER:
                raise ValueError("a record without the end of its header")
            if not self._fill():
                raise EOFError("the archive ends in a header")
        return self.take(found + 4)

    def end_of_record(self) -> None:
        """The empty lines behind a record."""
        while len(self.held) < 4 and self._fill():
            pass
        del self.held[: len(self.held) - len(self.held.lstrip(b"\r\n"))]

    def take(self, n: int) -> bytes:
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._fill():
                raise EOFError("the archive ends in a record")
            piece = self.take(min(n, len(self.held)))
            n -= len(piece)
            yield piece


# ---------------------------------------------------------------- stages


def page_records(pages: DataFrame, config: WarcConfig, id_column: str, url_column: str, html_column: str) -> DataFrame:
    """``(page_id, url, payload, keeper)``; ``keeper`` is the id of the response that a page revisits."""
    rows = pages.select(
        F.col(id_column).alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(html_column).cast("binary"), F.lit(b"")).alias("payload"),
    )
    key = F.when(F.octet_length("payload") >= config.min_revisit, F.unhex(F.sha2("payload", 256)))
    rows = rows.withColumn("key", key)
    copies = rows.filter(F.col("key").isNotNull()).groupBy("key").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("_n"))
    copies = materialise(copies.filter("_n > 1 and largest is not null").select("key", "largest"), "page-copies")
    joined = measured_lookup(rows, copies, "key")
    keeper = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return joined.select(F.col("page_id").cast("string"), "url", "payload", keeper.cast("string").alias("keeper"))


def _written(batches: Iterator[pa.RecordBatch], folder: str, config: WarcConfig) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[tuple[bytes, bytes, bytes]]:
        for batch in batches:
            for page_id, url, payload, keeper in zip(*batch.columns, strict=True):
                payload, keeper = payload.as_py(), keeper.as_py()
                refers_to = None if keeper is None else record_urn(keeper, hashlib.sha1(payload).hexdigest())
                yield encoded_record(page_id.as_py(), url.as_py(), payload, refers_to, config)

    coming = records()
    record = next(coming, None)
    number = 0
    while record:
        path = f"{folder}/crawl-{TaskContext.get().partitionId():06d}-{number:04d}.warc.gz"
        size = count = 0
        with replacing(path) as out:
            deflater = zlib.compressobj(config.level, zlib.DEFLATED, GZIP)
            while record and size < config.file_bytes:
                for part in record:
                    out.write(deflater.compress(part))
                    size += len(part)
                count += 1
                record = next(coming, None)
            out.write(deflater.flush())
            packed = out.tell()
        number += 1
        yield pa.RecordBatch.from_pylist([{"path": path, "records": count, "bytes": packed}])


def write_archives(records: DataFrame, folder: str, config: WarcConfig = WarcConfig()) -> DataFrame:
    """Monolithic archives out of ``records(page_id, url, payload, keeper)``: ``(path, records, bytes)``.
    Each task writes files of its own, so no page moves."""
    written = records.select("page_id", "url", "payload", "keeper").mapInArrow(
        lambda batches: _written(batches, folder, config), "path string, records long, bytes long"
    )
    return materialise(written, "warc-written")


def rewrite(path: str, target: str, config: WarcConfig) -> tuple[int, int]:
    """One archive record by record to ``target`` with its index beside it: records and bytes."""
    store, name = fs.FileSystem.from_uri(path)
    count = 0
    index_path = target.removesuffix(".gz").removesuffix(".warc") + ".cdxj"
    with store.open_input_stream(name, compression=None, buffer_size=PIECE) as source, replacing(target) as out, replacing(index_path) as index:
        inflated = Inflated(source)
        while header := inflated.header():
            if not header.startswith(b"WARC/"):
                raise ValueError(f"{path}: record {count} does not start with a WARC version")
            fields = fields_of(header)
            offset = out.tell()
            deflater = zlib.compressobj(config.level, zlib.DEFLATED, GZIP)
            out.write(deflater.compress(header))
            for piece in inflated.pieces(int(fields["content-length"])):
                out.write(deflater.compress(piece))
            inflated.end_of_record()
            out.write(deflater.compress(b"\r\n\r\n") + deflater.flush())
            line = {
                "file": target, "offset": offset, "length": out.tell() - offset, "type": fields.get("warc-type"), "id": fields.get("warc-record-id"),
                "uri": fields.get("warc-target-uri"), "digest": fields.get("warc-payload-digest"), "refers_to": fields.get("warc-refers-to"),
            }
            index.write(json.dumps(line).encode() + b"\n")
            count += 1
        return count, out.tell()


def _normalised(batches: Iterator[pa.RecordBatch], folder: str, config: WarcConfig) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            target = f"{folder}/{path.rpartition('/')[2]}"
            records, size = rewrite(path, target, config)
            yield pa.RecordBatch.from_pylist([{"path": target, "records": records, "bytes": size}])


def normalise_archives(archives: DataFrame, folder: str, config: WarcConfig = WarcConfig()) -> DataFrame:
    """Rewrite the files of ``archives(path)`` into ``folder``, each record a member, with an index beside each: ``(path,
    records, bytes)``. A gzip stream cannot be entered in the middle, so a file is one task, of bounded memory.
    File names have to differ."""
    files = archives.select("path")
    spread = files.repartitionByRange(max(1, files.count()), "path")
    return materialise(spread.mapInArrow(lambda b: _normalised(b, folder, config), "path string, records long, bytes long"), "warc-normalised")


def record_at(source, offset: int, length: int) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of the member at ``offset``."""
    source.seek(offset)
    data = zlib.decompress(source.read(length), GZIP)
    head = data.index(b"\r\n\r\n") + 4
    fields = fields_of(data[:head])
    block = data[head : head + int(fields["content-length"])]
    if not fields.get("content-type", "").startswith("application/http"):
        return fields, {}, block
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, fields_of(http), payload


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    opened, source = None, None
    names = [part.split()[0] for part in READ.split(", ")] + ["payload"] * with_payload
    for batch in batches:
        rows: list[tuple] = []
        for row in batch.to_pylist():
            if row["file"] != opened:
                if source:
                    source.close()
                store, name = fs.FileSystem.from_uri(row["file"])
                opened, source = row["file"], store.open_input_file(name)
            fields, http, payload = record_at(source, row["offset"], row["length"])
            named = hex_digest(fields.get("warc-payload-digest"))
            revisit = fields.get("warc-type") == "revisit"
            size = int(http.get("content-length", 0)) if revisit else len(payload)
            digest = named if revisit else hashlib.sha1(payload).hexdigest()
            if named and digest != named:
                raise ValueError(f"{row['file']}: the record at {row['offset']} has another payload than its digest says")
            rows.append(
                (fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri"), size, digest, fields.get("warc-refers-to"))
                + (payload,) * with_payload
            )
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
    if source:
        source.close()


def read_archives(spark: SparkSession, folder: str, size: int, config: WarcConfig = WarcConfig(), with_payload: bool = False) -> DataFrame:
    """The records of a folder of normalised archives of ``size`` bytes, found by their indexes. ``payload_digest`` is that of
    the full payload in hex, also for a revisit; a payload that does not fit its digest is an error."""
    index = spark.read.schema(INDEX).json(f"{folder}/*.cdxj").select("file", "offset", "length")
    stretch = F.floor(F.col("offset") / config.task_bytes)
    # Neighbours in a file stay together; dealt by bytes, a long file is many tasks.
    dealt = index.repartition(max(1, -(-size // config.task_bytes)), "file", stretch).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(lambda b: _read(b, with_payload), READ + ", payload binary" * with_payload)


def archive_pages(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    folder: str | None = None,
    config: WarcConfig = WarcConfig(),
) -> DataFrame:
    """Write a record per page, normalise the archives, and read them back by their indexes.

    Returns ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``, a row per
    page; the archives and indexes are left in ``folder``/members. Of pages with
    equal payloads of ``min_revisit`` bytes or more, that of the largest id is a response and
    the others revisit it.

    Defined cases: a null payload is empty; a null or empty url leaves out the target or gives an empty one. A null
    id comes before all others, as a page without an id; payloads that only such pages have are all responses. Rows that
    share the largest id are all responses. Equal rows are records each. Blanks and characters outside ASCII in a
    url are percent-encoded. An empty table writes nothing and gives an empty table. Other columns are not read.
    """
    spark = pages.sparkSession
    kind = pages.schema[id_column].dataType
    folder = folder or new_path(spark, "warc")
    written = write_archives(page_records(pages, config, id_column, url_column, html_column), f"{folder}/monolithic", config)
    members = normalise_archives(written, f"{folder}/members", config)
    found = members.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    if not found[0]:
        empty = spark.createDataFrame([], READ)
        return _as_pages(empty, kind)
    return _as_pages(read_archives(spark, f"{folder}/members", found[1], config), kind)


def _as_pages(records: DataFrame, kind) -> DataFrame:
    def page(urn: str):
        name = F.nullif(F.regexp_extract(urn, "^<urn:page:(.*):[0-9a-f]*>$", 1), F.lit(""))
        return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).cast(kind)

    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )


WARC_SQL = r"""
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
judged AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS largest FROM sized)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN largest IS NOT NULL AND largest IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN largest IS NOT NULL AND largest IS DISTINCT FROM page_id THEN largest END AS refers_to
FROM judged"""
