"""WARC archives: written by the tasks that hold the pages, read back record by record."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import slices, table
from panelkit.storage import new_path, stage

#: A task starts a new archive when the one it writes has grown to this.
ARCHIVE_BYTES = 32 << 20
#: Bytes read from an archive at a time.
CHUNK = 1 << 18
#: Payloads from this size on are stored once; smaller ones always in full.
LEAST_BYTES = 0
#: How header bytes that are no UTF-8 pass through text unchanged.
AS_THEY_ARE = "surrogateescape"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, page: int | None, url: str | None, fields: list[str], block: bytes) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>"]
    if page is not None:
        head.append(f"WARC-X-Page: {page}")
    if url:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += ["WARC-Date: 2000-01-01T00:00:00Z", *fields, f"WARC-Block-Digest: sha1:{base32_digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join([*head, "", ""]).encode(errors=AS_THEY_ARE) + block + b"\r\n\r\n"


def _text(url: bytes | None) -> str | None:
    return None if url is None else url.decode(errors=AS_THEY_ARE)


def response_record(page: int | None, url: str | None, payload: bytes) -> bytes:
    """One gzip member with the payload."""
    fields = [
        "Content-Type: text/html", f"WARC-Payload-Digest: sha1:{base32_digest(payload)}",
        f"WARC-X-Payload-Length: {len(payload)}",
    ]
    return gzip.compress(_record("response", page, url, fields, payload), 6, mtime=0)


def revisit_record(page: int, url: str | None, digest: str, size: int, refers_to: int) -> bytes:
    """One gzip member that names the page whose payload it repeats; `digest` in hexadecimal."""
    bare = base64.b32encode(bytes.fromhex(digest)).decode()
    fields = [
        f"WARC-Payload-Digest: sha1:{bare}", f"WARC-X-Payload-Length: {size}",
        f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>",
    ]
    return gzip.compress(_record("revisit", page, url, fields, b""), 6, mtime=0)


class _Archive:
    """A file written under a name of its own; a task that is run again leaves the first one unread."""

    def __init__(self, folder: str):
        self.fs, path = pa.fs.FileSystem.from_uri(folder)
        self.fs.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.gz"
        self.out, self.bytes, self.records = self.fs.open_output_stream(f"{path}/{self.name}", compression=None), 0, 0

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.bytes += len(member)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.name, self.bytes, self.records


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """A record per row of `pages` (page_id, url, html) in gzip archives below `folder`.

    Of equal payloads of `least_bytes` or more the largest page_id is a response and smaller ones
    revisit it. Null html counts as an empty payload. Rows without page_id, and rows that share the
    largest one, are responses. Payloads and urls are bytes: pages that are no UTF-8 are written as they are.
    Returns (name, bytes, records) of the archives, written once as a
    table: archives of tasks that were lost or run twice are not in it and are never read.

    Only digests are grouped. Each payload becomes a compressed record before anything is
    shuffled, and is joined with the page its digest belongs to; the digest of a third of all pages
    is split by the engine as a skewed join. `folder` must be one that every executor reaches.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    named = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").cast("binary").alias("url"),
        payload.alias("html"), F.sha1(payload).alias("digest"),
    )
    groups = (
        named.filter((F.octet_length("html") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "first")
    )

    def responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True)
            members = [response_record(page, _text(url), html) for page, url, html in rows]
            sizes = pa.compute.binary_length(batch.column("html")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("page_id"), batch.column("url"), sizes, pa.array(members, pa.binary())],
                ["digest", "page_id", "url", "size", "member"],
            )

    records = named.mapInArrow(
        responses, "digest string, page_id long, url binary, size long, member binary"
    ).join(groups, "digest", "left")
    repeats = (F.col("page_id") < F.col("first")) & (F.col("size") >= least_bytes)
    ready = records.select(
        "digest", "page_id", "url", "size", F.when(repeats, F.col("first")).alias("refers_to"),
        F.when(~F.coalesce(repeats, F.lit(False)), F.col("member")).alias("member"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in slices(batches, "member"):
            for row in batch.to_pylist():
                archive = archive or _Archive(folder)
                archive.add(row["member"] or revisit_record(
                    row["page_id"], _text(row["url"]), row["digest"], row["size"], row["refers_to"]
                ))
                if archive.bytes >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        names, sizes, counts = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
            ["name", "bytes", "records"],
        )

    return stage(ready.mapInArrow(write, "name string, bytes long, records long"), "archives")


class _Bytes:
    """Decompressed bytes of an archive in order: a new decompressor at every member's end."""

    def __init__(self, stream):
        self.stream, self.raw, self.zip, self.ready = stream, b"", None, bytearray()
        self.members = 0

    def fill(self) -> bool:
        """Decompress some more; false at the end of the archive."""
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
            if not self.raw:
                if self.zip is not None:
                    raise ValueError("the archive ends inside a gzip member")
                return False
        if self.zip is None:
            self.zip = zlib.decompressobj(wbits=31)
            self.members += 1
        self.ready += self.zip.decompress(self.raw, CHUNK)
        self.raw = self.zip.unconsumed_tail
        if self.zip.eof:
            self.raw, self.zip = self.zip.unused_data + self.raw, None
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with `mark`; None if the archive is at its end."""
        start = 0
        while (at := self.ready.find(mark, start)) < 0:
            start = max(0, len(self.ready) - len(mark) + 1)
            if not self.fill():
                if self.ready:
                    raise ValueError("the archive ends inside a header")
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self.fill():
                raise ValueError("the archive ends inside a block")
        got = bytes(self.ready[:n])
        del self.ready[:n]
        return got


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, in order.

    Blocks are framed by Content-Length; block and payload digests are verified, and a wrong one,
    a wrong frame or an archive that ends early raises ValueError. One record is held at a time.
    """
    source = _Bytes(stream)
    while (head := source.until(b"\r\n\r\n")) is not None:
        first, *lines = head.decode(errors=AS_THEY_ARE).split("\r\n")[:-2]
        if not first.startswith("WARC/1."):
            raise ValueError(f"no record starts with {first[:40]!r}")
        header = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        block = source.take(int(header["content-length"]))
        if source.take(4) != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        whole = f"sha1:{base32_digest(block)}"
        if header.get("warc-block-digest", whole) != whole:
            raise ValueError("a block has another digest than its header says")
        if header["warc-type"] == "response" and header.get("warc-payload-digest", whole) != whole:
            raise ValueError("a payload has another digest than its header says")
        yield header, block


def read_archives(archives: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) per record, and the
    payload with `payloads` (null for revisits). `archives` has the names of files in `folder`; each
    is read by one task from start to end, so its size is bounded by ARCHIVE_BYTES and one record.
    """
    schema = (
        "page_id long, url binary, payload_bytes long, payload_digest string, record_type string,"
        " refers_to long" + ", payload binary" * payloads
    )

    def rows(name: str) -> Iterator[tuple]:
        fs, path = pa.fs.FileSystem.from_uri(folder)
        with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
            for header, block in read_records(stream):
                page, target, url = (header.get(f"warc-{x}") for x in ("x-page", "refers-to", "target-uri"))
                kind = header["warc-type"]
                yield (
                    int(page) if page else None, None if url is None else url.encode(errors=AS_THEY_ARE),
                    int(header["warc-x-payload-length"]),
                    header["warc-payload-digest"].removeprefix("sha1:"), kind,
                    int(target.strip("<>").rpartition(":")[2]) if target else None,
                    *([block if kind == "response" else None] if payloads else []),
                )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in schema.split(", ")]
        held, size = [], 0
        for batch in batches:
            for name in batch["name"]:
                for row in rows(name):
                    held.append(row)
                    size += 1000 + (len(row[-1] or b"") if payloads else 0)
                    if size > 8 << 20:
                        yield _typed(held, columns)
                        held, size = [], 0
        yield _typed(held, columns)

    parts = max(1, min(archives.count(), 100_000))
    return archives.select("name").repartition(parts, "name").mapInPandas(read, schema).withColumn("url", F.col("url").cast("string"))


def _typed(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns, dtype=object)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    return read_archives(write_archives(table(spark, sf_dir, "pages"), folder), folder).drop("url")


def _base32_sql(hexadecimal: str) -> str:
    """SQL for the base32 letters of 40 hexadecimal digits, twenty bits at a time."""
    letter = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr({h}, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))) & 31)::INT, 1)"
    return f"array_to_string(list_transform(range(0, 32), lambda i: {letter.format(h=hexadecimal)}), '')"


WARC_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_base32_sql('hex')} AS payload_digest,
       CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < first THEN first END AS refers_to
FROM g
"""

QUERIES = {"op3_warc": op3_warc}
ORACLES = {"op3_warc": WARC_SQL}
