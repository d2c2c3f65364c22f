"""Deterministic sharded WARC writer, and the reader of what it wrote.

Records are range-sorted by a hash of page id and URL: the key space is cut into equal ranges, one
per shard, whose number follows from all payload bytes. Which record lies in which shard, in which
order, and so every byte of every file, depends on the table alone and not on partitions, tasks or
retries. Headers and digests are made anew for every record; records of equal payload revisit the
first one. A shard's files roll by compressed size.

Files are written under temporary names that carry the task attempt. The rows that a task returns
name its files; only those of the attempt that Spark commits reach the manifest, whose files then get
their final names, and the manifest is written last. A repeated task leaves at most temporary files
that no manifest names. Files are written and read through ``pyarrow.fs``, so the folder may be any
URI that it opens; it must be one that all executors share.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.common import bound_batches, utf8_bytes
from tallymart.workspace import scratch_dir, write_and_read

MIN_REVISIT_BYTES = 100
SHARD_BYTES = 16 << 20  # aimed-at payload of a shard
FILE_BYTES = 4 << 20  # compressed size at which a file is closed
WARC_DATE = "2024-01-01T00:00:00Z"  # the time of capture is not in the table
GZIP_LEVEL = 6
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122's for URLs
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

MANIFEST = ("shard long, number int, file string, temporary string, records long, bytes long, "
            "sha256 string")
RECORD = ("page_id string, url string, payload_bytes long, payload_digest string, "
          "record_type string, refers_to string, file string, offset long, intact boolean")


def payload_digest(html: Column) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 payload; NULL counts as empty."""
    return F.sha2(F.coalesce(html, F.lit("")).cast("binary"), 256)


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _header_value(text: str) -> str:
    """One header line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}|{digest}')}>"


def build_record(page_id: str | None, url: str | None, payload: bytes, digest: str,
                 refers_to: str | None) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    http = HTTP.format(len(payload)).encode()
    block = http if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", WARC_DATE),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _header_value(url)))
    if page_id is not None:
        headers.append(("X-Page-Id", page_id))
    headers.append(("Content-Type", "application/http; msgtype=response"))
    headers.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    headers.append(("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"))
    if refers_to is not None:
        headers.append(("WARC-Profile", PROFILE))
        headers.append(("WARC-Refers-To", record_id(refers_to, digest)))
        headers.append(("X-Refers-To-Page-Id", refers_to))
    headers.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member without time stamp."""
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class ShardFiles:
    """Rolls the files of one shard; every file is written under a temporary name."""

    def __init__(self, folder: str, shard: int, attempt: str, file_bytes: int):
        self.folder, self.shard, self.attempt, self.file_bytes = folder, shard, attempt, file_bytes
        self.system, self.path = _opened(folder)
        self.number, self.sink, self.done = 0, None, []

    def add(self, record: bytes) -> None:
        member = gzip_member(record)
        if self.sink is None:
            name = f"shard-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.entry = {"shard": self.shard, "number": self.number, "file": name,
                          "temporary": f"_temporary/{name}.{self.attempt}", "records": 0, "bytes": 0}
            self.system.create_dir(posixpath.join(self.path, "_temporary"), recursive=True)
            self.sink = self.system.open_output_stream(
                posixpath.join(self.path, self.entry["temporary"]), compression=None)
            self.digest = hashlib.sha256()
        self.sink.write(member)
        self.digest.update(member)
        self.entry["records"] += 1
        self.entry["bytes"] += len(member)
        if self.entry["bytes"] >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.sink is not None:
            self.sink.close()
            self.done.append({**self.entry, "sha256": self.digest.hexdigest()})
            self.sink, self.number = None, self.number + 1


def _described(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("string").alias("page_id"), F.col("page_id").alias("order_id"), "url",
        "html", payload_digest(F.col("html")).alias("digest"),
        utf8_bytes(F.col("html")).alias("payload_bytes"),
    ).withColumn("sort_key", F.xxhash64("page_id", "url"))


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES,
                   file_bytes: int = FILE_BYTES,
                   min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write the records of ``pages`` (page_id, url, html) to ``folder``; the manifest of its files.

    Defined cases: NULL html is an empty payload; a NULL url leaves out its header; a record whose
    page_id is NULL is a response and nothing revisits it; repeated rows of the smallest page_id are
    all responses; an empty table gives no file and an empty manifest; further columns are ignored.
    """
    bound_batches(pages.sparkSession)
    described = _described(pages)
    slim = write_and_read(described.drop("html"), f"{folder.rstrip('/')}-index")
    total = slim.agg(F.sum("payload_bytes")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    first = (
        slim.where((F.col("payload_bytes") >= min_revisit_bytes) & F.col("order_id").isNotNull())
        .groupBy("digest").agg(F.min("order_id").alias("first_id"),
                               F.max("order_id").alias("last_id"))
        .where(F.col("first_id") < F.col("last_id")).drop("last_id")
    )
    # A mark for every revisit travels through the same exchange as the records and sorts just
    # before its record, so payloads are moved once.
    marks = (
        slim.join(first, "digest").where(F.col("order_id") > F.col("first_id"))
        .select("page_id", "url", F.lit(None).cast("string").alias("html"), "digest", "sort_key",
                F.col("first_id").cast("string").alias("refers_to"), F.lit(0).alias("kind"))
        .distinct()
    )
    records = described.select("page_id", "url", "html", "digest", "sort_key",
                               F.lit(None).cast("string").alias("refers_to"), F.lit(1).alias("kind"))
    # The top 32 bits of the key as an unsigned number, scaled to the number of shards.
    top = F.shiftrightunsigned("sort_key", 32).bitwiseXOR(F.lit(1 << 31))
    shard = F.shiftright(top * F.lit(shards), 32)
    order = ["shard", "sort_key", "page_id", "url", "digest", "kind"]
    sorted_rows = (
        records.unionByName(marks).withColumn("shard", shard)
        .repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions(*order)
        .select("shard", "page_id", "url", "html", "digest", "refers_to", "kind")
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        attempt = f"{context.taskAttemptId()}-{uuid.uuid4().hex}"
        files: ShardFiles | None = None
        done: list[dict] = []
        mark: tuple | None = None
        for batch in batches:
            for number, page_id, url, html, digest, refers_to, kind in batch.itertuples(index=False):
                page_id, url = _text(page_id), _text(url)
                if kind == 0:
                    mark = (page_id, url, digest, refers_to)
                    continue
                if files is None or files.shard != number:
                    if files is not None:
                        files.close()
                        done += files.done
                    files = ShardFiles(folder, int(number), attempt, file_bytes)
                revisits = mark is not None and mark[:3] == (page_id, url, digest)
                payload = (_text(html) or "").encode()
                files.add(build_record(page_id, url, payload, digest, mark[3] if revisits else None))
        if files is not None:
            files.close()
            done += files.done
        yield pd.DataFrame(done, columns=[c.split()[0] for c in MANIFEST.split(", ")])

    staged = write_and_read(sorted_rows.mapInPandas(write, MANIFEST), f"{folder.rstrip('/')}-staged")

    def rename(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _opened(folder)
        for batch in batches:
            for temporary, name in zip(batch["temporary"], batch["file"]):
                source, target = posixpath.join(path, temporary), posixpath.join(path, name)
                if system.get_file_info(source).type != fs.FileType.NotFound:
                    system.move(source, target)  # done already if a task is repeated
            yield batch

    manifest = staged.mapInPandas(rename, MANIFEST).drop("temporary")
    return write_and_read(manifest, f"{folder.rstrip('/')}-manifest")


def _text(value) -> str | None:
    return value if isinstance(value, str) else None


def members(stream: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of every gzip member of a stream of chunks."""
    offset = 0
    unpacker, parts, read = zlib.decompressobj(31), [], 0
    for chunk in stream:
        while chunk:
            parts.append(unpacker.decompress(chunk))
            if not unpacker.eof:
                read += len(chunk)
                break
            rest = unpacker.unused_data
            read += len(chunk) - len(rest)
            yield offset, b"".join(parts)
            offset += read
            unpacker, parts, read, chunk = zlib.decompressobj(31), [], 0, rest
    if read:
        raise ValueError("the archive ends within a record")


def parse_record(data: bytes) -> dict:
    """Fields of a record; ``intact`` tells whether length and digests agree with the content."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    length = int(headers["Content-Length"])
    block, tail = rest[:length], rest[length:]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = int(re.search(rb"(?im)^Content-Length: (\d+)", http)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    intact = (lines[0] == "WARC/1.1" and tail == b"\r\n\r\n" and len(block) == length
              and headers["WARC-Block-Digest"] == f"sha256:{hashlib.sha256(block).hexdigest()}")
    if headers["WARC-Type"] == "response":
        digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
        intact &= size == declared and headers["WARC-Payload-Digest"] == f"sha256:{digest}"
    else:
        size = declared
        intact &= not payload
    return {
        "page_id": headers.get("X-Page-Id"), "url": headers.get("WARC-Target-URI"),
        "payload_bytes": size, "payload_digest": digest, "record_type": headers["WARC-Type"],
        "refers_to": headers.get("X-Refers-To-Page-Id"), "intact": bool(intact),
    }


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the files that ``manifest`` names, read from the archives alone.

    page_id and refers_to are text, as in the headers; digests and sizes of responses are taken
    from the payload that was read, those of revisits from their headers.
    """
    columns = [c.split()[0] for c in RECORD.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _opened(folder)
        for batch in batches:
            for name in batch["file"]:
                rows = []
                with system.open_input_stream(posixpath.join(path, name), compression=None) as file:
                    for offset, data in members(iter(lambda: file.read(1 << 20), b"")):
                        rows.append({**parse_record(data), "file": name, "offset": offset})
                        if len(rows) == 1000:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                yield pd.DataFrame(rows, columns=columns)

    files = manifest.select("file").repartition(
        max(1, manifest.sparkSession.sparkContext.defaultParallelism), "file")
    return files.mapInPandas(read, RECORD)


def write_and_verify(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the scratch folder and read the records back.

    Fails if a record's length or digest disagrees with its content.
    """
    folder = scratch_dir(spark, "warc/archive")
    records = read_archives(write_archives(pages, folder), folder)
    kind = pages.schema["page_id"].dataType
    checked = F.when(F.col("intact"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record in "), F.col("file"))))
    return records.select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes",
        checked.cast("string").alias("payload_digest"), "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "file", "offset")
