"""WARC archives of pages: writing with revisit records, and a sequential reader.

Every record is a gzip member of its own.  The reader takes an archive in blocks, inflates it bit by bit, finds record
borders by the content length, checks block and payload digests, and never holds more than one record.

Of records with equal payloads of ``least`` bytes or more, the one with the smallest id is the response; the others are
revisits that point at it and hold the HTTP head alone.  Archives are binary rows of a Parquet table (one archive of about
``ARCHIVE`` payload bytes per row), since only Spark reaches the cluster's store; a row's content is a valid ``.warc.gz`` file.

A null payload is an empty one; a null url leaves the target out; a null id becomes the empty id and comes back as null; rows
with equal id and payload are all responses if theirs is the smallest id.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE = 8 << 20
BLOCK = 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BREAK = b"\r\n"


def page_uri(page_id: object) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object = None) -> bytes:
    """One record as a gzip member; with ``refers_to`` a revisit without the payload."""
    http = BREAK.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload), b"", b""])
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {page_uri(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # Line breaks in a target would end the header.
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {page_uri(refers_to)}", f"WARC-Profile: {PROFILE}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + 2 * BREAK + block + 2 * BREAK) + pack.flush()


def members(blocks: Iterable[bytes]) -> Iterator[Iterator[bytes]]:
    """For every gzip member the pieces it inflates to."""
    source = iter(blocks)
    rest = b""

    def inflate() -> Iterator[bytes]:
        nonlocal rest
        unpack = zlib.decompressobj(31)
        while not unpack.eof:
            data = rest or next(source, None)
            if data is None:
                raise ValueError("archive ends within a member")
            rest = b""
            yield unpack.decompress(data, BLOCK)
            while unpack.unconsumed_tail and not unpack.eof:
                yield unpack.decompress(unpack.unconsumed_tail, BLOCK)
        rest = unpack.unused_data

    while True:
        rest = rest or next(source, b"")
        if not rest:
            return
        pieces = inflate()
        yield pieces
        for _ in pieces:  # what the caller left
            pass


def read_records(blocks: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record in order.  Raises ValueError where framing or a digest is wrong."""
    for pieces in members(blocks):
        data = bytearray()
        for piece in pieces:
            data += piece
            if data.find(b"\r\n\r\n") >= 0:
                break
        end = data.find(b"\r\n\r\n")
        lines = bytes(data[: max(end, 0)]).decode().split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record")
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(head["content-length"])
        block = data[end + 4 :]
        for piece in pieces:
            block += piece
        if len(block) != size + 4 or block[size:] != b"\r\n\r\n":
            raise ValueError("record length is wrong")
        del block[size:]
        if hashlib.sha256(block).hexdigest() != head["warc-block-digest"].removeprefix("sha256:"):
            raise ValueError("block digest is wrong")
        yield head, bytes(block)


def payload_of(head: dict[str, str], block: bytes) -> tuple[int, bytes | None]:
    """(payload length, payload) of a record; a revisit has only the length.  Checks the payload digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    if head["warc-type"] == "revisit":
        return size, None
    if len(payload) != size or hashlib.sha256(payload).hexdigest() != head["warc-payload-digest"].removeprefix("sha256:"):
        raise ValueError("payload digest is wrong")
    return size, payload


def _page_of(uri: str | None) -> str | None:
    return (uri or "").removeprefix("<urn:page:").removesuffix(">") or None


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack: list[bytes] = []
    size = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([len(pack)], pa.int64()), pa.array([b"".join(pack)], pa.binary())], ["records", "content"])

    for rows in batches:
        for page, url, html, digest, refers in zip(*(c.to_pylist() for c in rows.columns)):
            payload = (html or "").encode()
            pack.append(record(page, url, payload, digest, refers))
            size += len(payload) + 512
            if size >= ARCHIVE:
                yield out()
                pack, size = [], 0
    if pack:
        yield out()


def first_of_equal(pages: DataFrame, least: int, key: str, payload: str) -> DataFrame:
    """(page, digest, refers_to) of the rows that repeat a payload of a smaller id.  Only ids and digests are shuffled;
    the smallest ids are found by partial aggregates, and the join back has one row per digest on its other side."""
    body = F.coalesce(F.col(payload), F.lit(""))
    keys = pages.filter(F.octet_length(body) >= least).select(F.col(key).alias("page"), F.sha2(body.cast("binary"), 256).alias("digest"))
    first = keys.groupBy("digest").agg(F.min("page").alias("refers_to"), F.max("page").alias("most")).filter("refers_to < most").drop("most")
    return keys.join(first, "digest").filter("page > refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, least: int = 100, key: str = "page_id", url: str = "url", payload: str = "html") -> None:
    refs = first_of_equal(pages, least, key, payload)
    rows = pages.select(F.col(key).alias("page"), F.col(url).alias("url"), F.col(payload).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256))
    rows.join(refs, ["page", "digest"], "left").select("page", "url", "html", "digest", "refers_to").mapInArrow(
        _archives, "records long, content binary"
    ).write.option("compression", "none").parquet(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for content in rows.column(0):
            raw = memoryview(content.as_buffer())
            out: list[tuple] = []
            for head, block in read_records(raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)):
                size, payload = payload_of(head, block)
                out.append((
                    _page_of(head["warc-record-id"]), head.get("warc-target-uri"), size, head["warc-payload-digest"].removeprefix("sha256:"),
                    head["warc-type"], _page_of(head.get("warc-refers-to")), payload,
                ))
            cols = list(zip(*out)) or [()] * 7
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["page", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])


def read_archives(spark: SparkSession, folder: str, key: str = "page_id", kind: str = "bigint", payloads: bool = True) -> DataFrame:
    """(key, url, payload_bytes, payload_digest, record_type, refers_to[, payload]) of every record."""
    columns = ["page", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = "page string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _read(batches):
            yield out if payloads else out.select(columns)

    rows = spark.read.parquet(folder).select("content").mapInArrow(run, schema + ", payload binary" * payloads)
    return rows.select(F.col("page").cast(kind).alias(key), "url", "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), *["payload"] * payloads)
