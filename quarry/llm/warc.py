"""WARC archives with a Zstandard dictionary.

An archive is a skippable frame that holds the dictionary, then one frame for each record, as the
public WARC/zstd convention has it. The dictionary is built from the first records that the archive
gets, within a fixed number of bytes.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, scratch, ship
from ..sources.stores import open_store

DICT_MAGIC = 0x184D2A5D
SAMPLE_BYTES, SAMPLE_RECORDS, DICT_BYTES = 2 << 20, 400, 64 << 10
_NS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "archive string, records long, bytes long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(url: str) -> str:
    return " ".join(url.split())


def _record(page_id: int | None, url: str | None, html: str | None, refers_to: int | None, first_url: str | None, date: str) -> bytes:
    payload = (html or "").encode("utf-8", "surrogatepass")
    digest = base32_sha1(payload)
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NS, f'{page_id}/{digest}')}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if page_id is not None:
        head.append(("WARC-X-Page", str(page_id)))
    if url is not None:
        head.append(("WARC-Target-URI", _line(url)))
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block += payload
    else:
        head += [("WARC-Profile", _REVISIT), ("WARC-X-Refers-To-Page", str(refers_to)), ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(_NS, f'{refers_to}/{digest}')}>"), ("WARC-Refers-To-Date", date)]
        if first_url is not None:
            head.append(("WARC-Refers-To-Target-URI", _line(first_url)))
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> zstd.ZstdCompressionDict:
    """Trained on the samples; too few or too alike samples serve as a raw dictionary themselves."""
    if len(samples) >= 16:
        try:
            return zstd.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, samples)) // 10)), samples)
        except zstd.ZstdError:
            pass
    return zstd.ZstdCompressionDict(b"".join(samples)[:DICT_BYTES] or b"WARC/1.1", dict_type=zstd.DICT_TYPE_RAWCONTENT)


def write_archive(sink, records: Iterable[bytes], level: int = 3) -> tuple[int, int]:
    """Write records to a binary sink; how many, and their bytes before compression."""
    first: list[bytes] = []
    rest, size = iter(records), 0
    for record in rest:
        first.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES or len(first) >= SAMPLE_RECORDS:
            break
    words = _dictionary([x[: 128 << 10] for x in first])
    body = words.as_bytes()
    sink.write(struct.pack("<II", DICT_MAGIC, len(body)) + body)
    squeeze = zstd.ZstdCompressor(level=level, dict_data=words)
    count = total = 0
    for source in (first, rest):
        for record in source:
            sink.write(squeeze.compress(record))
            count, total = count + 1, total + len(record)
    return count, total


def read_archive(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an archive, streamed."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICT_MAGIC:
        raise ValueError("the archive does not start with a dictionary frame")
    body = source.read(size)
    kind = zstd.DICT_TYPE_FULLDICT if body[:4] == b"\x37\xa4\x30\xec" else zstd.DICT_TYPE_RAWCONTENT
    plain = io.BufferedReader(zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(body, dict_type=kind)).stream_reader(source, read_across_frames=True), 1 << 20)
    while line := plain.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:40]!r}")
        head = {}
        while (line := plain.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[key] = value
        block = plain.read(int(head["Content-Length"]))
        if plain.read(4) != b"\r\n\r\n":
            raise ValueError("the archive is cut short")
        yield head, block


def write_warc(pages: DataFrame, path: str | None = None, *, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Archive a table of pages under path; the manifest (archive, records, bytes) of what counts.

    Of pages with equal payloads of at least min_bytes bytes, the one with the smallest page_id is
    stored, others become revisit records. A null html is an empty payload; a long one is one record. Pages
    without an id are stored as they are; rows that tie with the smallest id are each stored. Empty
    tables make no archives; other columns are ignored. Every task attempt writes a file of its own, and only files named in the manifest
    count, so lost executors leave no half-written archive behind.
    """
    spark = pages.sparkSession
    ship(spark)
    path = path or scratch(spark, "warc")
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("html"), F.when(F.octet_length(body) >= min_bytes, F.sha2(body, 256)).alias("key"))
    first = rows.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("page_id", "url")).alias("first"), F.min("page_id").alias("least"), F.count("*").alias("n"))
    first = first.where("n > 1").select("key", "least", F.when(F.col("first.page_id") == F.col("least"), F.col("first.url")).alias("first_url"))
    rows = rows.join(first, "key", "left").select("page_id", "url", "html", F.when(F.col("page_id") > F.col("least"), F.col("least")).alias("refers_to"), "first_url")

    def write(batches):
        def records():
            for batch in batches:
                for row in zip(*(batch.column(i) for i in range(5)), strict=True):
                    yield _record(*(x.as_py() for x in row), date)

        stream = records()
        head = next(stream, None)
        if head is None:
            return
        where, folder = open_store(path)
        where.create_dir(folder, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.zst"

        def every():
            yield head
            yield from stream

        with where.open_output_stream(f"{folder}/{name}", compression=None) as sink:
            count, total = write_archive(sink, every())
        yield pa.RecordBatch.from_arrays([pa.array([f"{path}/{name}"]), pa.array([count], pa.int64()), pa.array([total], pa.int64())], ["archive", "records", "bytes"])

    return materialise(rows.mapInArrow(write, _MANIFEST), "manifest")


def read_warc(spark: SparkSession, manifest: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """Records of the archives named in a manifest: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to (and payload, null for revisits).

    Size and digest are measured on the payloads that are read; those of revisits are of the stored
    payload with their digest (null size if none of these archives has it). Stored payloads are checked
    against their records' digests; a damaged archive fails the read. Null ids and urls come back
    as nulls, rows that repeat as they are, long payloads whole; an empty manifest gives no rows.
    """
    ship(spark)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def flush(rows):
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(c, t) for c, t in zip(columns, [*types, pa.binary()], strict=True)]
        keep = len(names) + with_payload
        return pa.RecordBatch.from_arrays(arrays[:keep], [*names, "payload"][:keep])

    def read(batches):
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                where, file = open_store(archive)
                rows, size = [], 0
                with where.open_input_stream(file, compression=None) as source:
                    for head, block in read_archive(source):
                        payload = block.partition(b"\r\n\r\n")[2] if head["WARC-Type"] == "response" else None
                        stated = head.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
                        digest = stated if payload is None else base32_sha1(payload)
                        if stated not in (None, digest):
                            raise ValueError(f"{archive}: a payload differs from its digest")
                        number = lambda key, head=head: int(head[key]) if key in head else None
                        rows.append((number("WARC-X-Page"), head.get("WARC-Target-URI"), None if payload is None else len(payload), digest, head["WARC-Type"], number("WARC-X-Refers-To-Page"), payload if with_payload else None))
                        size += len(block) if with_payload else 100
                        if size > 1 << 20:
                            yield flush(rows)
                            rows, size = [], 0
                if rows:
                    yield flush(rows)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = manifest.select("archive").repartition(tasks).mapInArrow(read, schema)
    if not with_payload:
        rows = materialise(rows, "records")
    stored = rows.where("record_type <> 'revisit'")
    sizes = stored.groupBy("payload_digest").agg(F.max("payload_bytes").alias("full"))
    again = rows.where("record_type = 'revisit'").join(sizes, "payload_digest", "left").withColumn("payload_bytes", F.col("full"))
    return stored.unionByName(again.select(*rows.columns))


def _base32(hexadecimal: str) -> str:
    """SQL for the base32 text of 160 bits in hexadecimal: four letters for every five digits."""
    part = lambda i: f"CAST('0x' || substr({hexadecimal}, {5 * i + 1}, 5) AS INTEGER)"
    return " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({part(i)} >> {shift}) & 31) + 1, 1)" for i in range(8) for shift in (15, 10, 5, 0))


#: The rows of op5 for DuckDB.
WARC_SQL = f"""
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS least, sha1(body) AS digest FROM bodies)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, {_base32("digest")} AS payload_digest,
       CASE WHEN page_id > least THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > least THEN least END AS refers_to
FROM firsts
"""
