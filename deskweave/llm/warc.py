"""WARC archives with revisit records.

Headers of all records are shuffled by payload digest; of records with equal payloads the one
with the smallest id keeps its payload, the others become revisit records that refer to it.
Readers join revisit records to their originals.

Archives are written by Spark's text writer, so they go to any storage that Spark reaches and
only committed tasks leave files. Every record is a gzip member of its own. The writer wants a
separator after each value: it is a zero byte, which is also the last byte of a member (the
top byte of its length) and is left out of the value; after records of 16 MiB and more it
stays as padding between members, which gzip readers skip.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_dir, stored

MIN_BYTES = 100  # smaller payloads are always stored
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 10_000
READ_BYTES = 16_384  # handed to the decompressor at once; it copies what is left behind a member
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PARSED = (
    "record_id string, record_type string, uri string, page_id long, refers_to_id string, "
    "payload_bytes long, payload_digest string"
)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def make_record(
    page_id: int | None, uri: str | None, payload: bytes, digest: str,
    original: tuple[int, str | None] | None = None, date: str = DATE,
) -> bytes:
    """One WARC record; with `original` (page_id, uri) a revisit of it, without the payload."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if original else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_one_line(uri)}")
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    block = HTTP % len(payload)
    if original:
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(original[0], digest)}",
            f"WARC-Refers-To-Date: {date}",
        ]
        if original[1] is not None:
            head.append(f"WARC-Refers-To-Target-URI: {_one_line(original[1])}")
    else:
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(uri: str) -> str:
    return uri.replace("\r", "%0D").replace("\n", "%0A")


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of every record of a gzipped archive."""
    view, at = memoryview(content), 0
    while True:
        while at < len(view) and view[at] == 0:
            at += 1
        if at >= len(view):
            return
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            block = view[at : at + READ_BYTES]
            if not block:
                raise ValueError("the archive ends within a record")
            parts.append(member.decompress(block))
            at += len(block) - len(member.unused_data)
        record = b"".join(parts)
        head, _, rest = record.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        yield fields, rest[: int(fields["content-length"])]


def payload_of(pages: Column) -> Column:
    return F.coalesce(pages, F.lit(""))


def revisits(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Which records repeat the payload of another: page_id, digest, original, original_uri.

    `headers` has page_id, uri, digest, bytes. Of records with equal payloads of at least
    `min_bytes` the smallest page_id is the original (null last); rows that repeat its id are
    originals too.
    """
    groups = (
        headers.where(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(
            F.min("page_id").alias("original"),
            F.min_by("uri", "page_id").alias("original_uri"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1 and original is not null")
        .drop("n")
    )
    repeated = headers.join(groups, "digest").where("not (page_id <=> original)")
    return repeated.select("page_id", "digest", "original", "original_uri").distinct()


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = MIN_BYTES, level: int = 6, date: str | None = None,
) -> None:
    """Write `pages` as deduplicated archives below `path`, dated `date` (now).

    A null html is an empty payload, a null url leaves its header out. Repeated rows give
    repeated records. Other columns are ignored. An empty table gives an empty archive.
    """
    payload = payload_of(F.col(f"`{html}`"))
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").alias("uri"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    headers = rows.select("page_id", "uri", "digest", F.octet_length("payload").alias("bytes"))
    again = revisits(headers, min_bytes).withColumnsRenamed({"page_id": "r_id", "digest": "r_digest"})
    same = F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest"))
    marked = rows.join(again, same, "left").select(
        "page_id", "uri", "payload", "digest", "original", "original_uri"
    )

    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = []
            for i in range(batch.num_rows):
                row = [column[i].as_py() for column in batch.columns]
                original = None if row[4] is None else (row[4], row[5])
                body = row[2].encode("utf-8", "surrogatepass")
                record = make_record(row[0], row[1], body, row[3], original, date)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(record) + packer.flush()
                members.append(member[:-1] if member[-1] == 0 else member)
            yield pa.record_batch([pa.array(members, pa.binary())], ["value"])

    (
        marked.mapInArrow(run, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", "\0")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ids, type, uri, and length and SHA-256 of the payload.

    Revisit records carry no payload: their length is null and the digest is the one they
    name.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    names = [part.split()[0] for part in PARSED.split(", ")]

    def row(fields: dict[str, str], block: bytes) -> tuple:
        payload = block.partition(b"\r\n\r\n")[2]
        kept = fields["warc-type"] != "revisit"
        digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
        page = fields.get("page-id")
        return (
            fields["warc-record-id"],
            fields["warc-type"],
            fields.get("warc-target-uri"),
            None if page is None else int(page),
            fields.get("warc-refers-to"),
            len(payload) if kept else None,
            hashlib.sha256(payload).hexdigest() if kept else digest,
        )

    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = [row(*record) for record in parse_archive(content.as_py())]
                if rows:
                    arrays = map(pa.array, zip(*rows, strict=True), types)
                    yield pa.record_batch(list(arrays), names)

    return files.select("content").mapInArrow(run, PARSED)


def resolve(records: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Revisits get length and digest of the original they refer to; if it is not among the
    records, the length is null. `refers_to` is the original's page_id.
    """
    originals = (
        records.where("record_type = 'response'")
        .select(
            F.col("record_id").alias("refers_to_id"),
            F.col("page_id").alias("refers_to"),
            F.col("payload_bytes").alias("original_bytes"),
            F.col("payload_digest").alias("original_digest"),
        )
        .dropDuplicates(["refers_to_id"])
    )
    revisit = F.col("record_type") == "revisit"
    own = records.where(~revisit).withColumn("refers_to", F.lit(None).cast("long"))
    again = (
        records.where(revisit)
        .drop("payload_bytes")
        .join(originals, "refers_to_id", "left")
        .withColumn("payload_digest", F.coalesce("original_digest", "payload_digest"))
        .withColumnRenamed("original_bytes", "payload_bytes")
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return own.select(*columns).unionByName(again.select(*columns))


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write `pages` to archives in the shared folder, read them back and resolve revisits."""
    spark = pages.sparkSession
    path = fresh_dir(spark, "warc")
    write_archives(pages, path, **columns)
    return resolve(stored(read_archives(spark, path), "records"))
