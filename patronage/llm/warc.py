"""WARC archives as a table of record chunks.

A payload is a run of chunk rows ``(record, chunk)``; a long one is streamed
chunk by chunk, with a running SHA-256, and is never put together. In an
archive each chunk is a segment of its record (``WARC-Segment-Number``, type
``continuation`` from the second on), so a segment's block is at most
``CHUNK_BYTES`` and both ways stay within that.

No segment holds the text ``WARC/1.1``: a payload is cut inside of it, an address
has it escaped. Records then begin exactly where ``WARC/1.1 CR LF`` stands, and
Spark's text source reads an archive record by record with that as its line
separator. Archives come from Spark's text writer; they lie where Spark writes.

Of records with equal payloads of ``MIN_REVISIT`` bytes or more the one of the
smallest id is ``response``, the others are ``revisit`` records that refer to it
and hold only the HTTP head with the payload's length. Rows that repeat the
response's id and payload are responses too; so are records whose equals all
lack an id. Null payload counts as empty. An empty table gives an empty archive
and no rows. Only the named columns are read, so others may have any names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.textbatch import bytes_of
from patronage.session import shared_folder, written

CHUNK_BYTES = 64 << 10
MIN_REVISIT = 100

# Fixed values of the archive format.
VERSION = b"WARC/1.1"
RECORD_END = "\r\n\r\n"
SEPARATOR = "WARC/1.1\r\n"

CHUNKS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("first_id", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("chunk_no", T.IntegerType()),
        T.StructField("chunk", T.BinaryType()),
        T.StructField("running_digest", T.StringType()),
        T.StructField("last", T.BooleanType()),
    ]
)


def _cuts(payload: memoryview, size: int) -> Iterator[tuple[int, int]]:
    """Spans of at most ``size`` bytes, cut inside every occurrence of the record mark as well."""
    at, total = 0, len(payload)
    while True:
        end = min(at + size, total)
        mark = bytes(payload[at:end]).find(VERSION)
        if mark >= 0:
            end = at + mark + 1
        yield at, end
        at = end
        if at >= total:
            return


def labelled(pages: DataFrame, page_id: str, url: str, payload: str, min_revisit: int) -> DataFrame:
    """Pages with the digest and length of their payload, and the id of the response they repeat."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.octet_length(body).cast("long").alias("payload_bytes"), F.sha2(body, 256).alias("payload_digest"),
        F.col(payload).alias("payload"),
    )
    firsts = written(
        rows.where(F.col("payload_bytes") >= min_revisit)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"))
        .where("n > 1 AND first_id IS NOT NULL")
        .drop("n"),
        "warc-firsts",
    )
    return rows.join(firsts, ["payload_digest", "payload_bytes"], "left").withColumn(
        "first_id", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    )


def chunked(pages: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of labelled pages; revisits have one chunk without bytes."""
    columns = ["page_id", "url", "first_id", "payload_digest", "payload_bytes"]
    rows = pages.select(*columns, F.when(F.col("first_id").isNull(), F.col("payload")).alias("payload"))
    schema = CHUNKS.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = bytes_of(batch.column(len(columns)))
            flat, owner, number, pieces, digests, last, held = memoryview(data), [], [], [], [], [], 0
            for row, (begin, end) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
                running, payload = hashlib.sha256(), flat[begin:end]
                for no, (a, b) in enumerate(_cuts(payload, size)):
                    running.update(payload[a:b])
                    owner.append(row)
                    number.append(no)
                    pieces.append(bytes(payload[a:b]))
                    digests.append(running.hexdigest())
                    last.append(b == len(payload))
                    held += b - a
                    if held > 4 << 20:
                        yield _rows(batch, owner, number, pieces, digests, last)
                        owner, number, pieces, digests, last, held = [], [], [], [], [], 0
            if owner:
                yield _rows(batch, owner, number, pieces, digests, last)

    def _rows(batch, owner, number, pieces, digests, last) -> pa.RecordBatch:
        kept = batch.select(columns).take(pa.array(owner, pa.int64()))
        made = [
            pa.array(number, pa.int32()), pa.array(pieces, pa.binary()), pa.array(digests, pa.string()),
            pa.array(last, pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays([*kept.columns, *made], names=[f.name for f in schema])

    return rows.mapInArrow(run, CHUNKS)


def _line(name: str, value: Column) -> Column:
    """A header line; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def write_archive(chunks: DataFrame, path: str, date: str) -> None:
    """Write chunk rows as segments of WARC records, one archive file per partition."""
    revisit, first = F.col("first_id").isNotNull(), F.col("chunk_no") == 0
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"),
    )
    block = F.concat(F.when(first, http.cast("binary")).otherwise(F.lit(b"")), F.col("chunk"))
    kind = F.when(revisit, "revisit").when(first, "response").otherwise("continuation")
    many = ~(F.col("last") & first)
    url = F.replace(F.regexp_replace("url", "[\r\n]+", " "), F.lit("WARC/1.1"), F.lit("WARC/1%2E1"))
    rows = chunks.withColumns(
        {
            "record": F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
            "row": F.monotonically_increasing_id() - F.col("chunk_no"),  # the row of the record's first chunk
        }
    )
    record = F.concat(F.lit("<urn:x-page:"), F.col("record"), F.lit(":"), F.col("row").cast("string"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.concat(record, F.lit(":"), F.col("chunk_no").cast("string"), F.lit(">"))),
        _line("WARC-Segment-Origin-ID", F.when(~first, F.concat(record, F.lit(":0>")))),
        _line("WARC-Segment-Number", F.when(many, F.col("chunk_no") + 1)),
        _line("WARC-Segment-Total-Length", F.when(many & F.col("last"), F.col("payload_bytes"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("X-Page-ID", F.col("page_id")),
        _line("X-Refers-To-Page-ID", F.col("first_id")),
        _line("Content-Type", F.when(first, F.lit("application/http; msgtype=response"))),
        _line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
    )
    rows.select(F.concat(head.cast("binary"), block).cast("string").alias("value")).write.option(
        "lineSep", RECORD_END
    ).option("compression", "gzip").text(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments of an archive: the fields below and the ``block`` with its bytes.

    A record whose block is shorter than its header says is an error.
    """
    lines = spark.read.option("lineSep", SEPARATOR).text(path)
    head = F.substring_index("value", RECORD_END, 1)
    rows = lines.where(F.length("value") > 0).select(head.alias("head"), F.col("value").cast("binary").alias("bytes"))

    def field(name: str) -> Column:
        found = F.regexp_extract("head", rf"(?m)^{name}: (.*?)\r?$", 1)
        return F.when(found != "", found)

    size = field("Content-Length").cast("int")
    block = F.substring(F.col("bytes"), F.octet_length("head") + 5, size)
    return rows.select(
        field("WARC-Type").alias("type"),
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("record"),
        (F.coalesce(field("WARC-Segment-Number").cast("int"), F.lit(1)) - 1).alias("chunk_no"),
        field("WARC-Segment-Number").isNotNull().alias("many"),
        field("X-Page-ID").cast("long").alias("page_id"),
        field("X-Refers-To-Page-ID").cast("long").alias("refers_to"),
        field("WARC-Target-URI").alias("url"),
        F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("payload_digest"),
        F.when(F.octet_length(block) == size, block)
        .otherwise(F.raise_error(F.concat(F.lit("cut off: "), F.col("head"))).cast("binary"))
        .alias("block"),
    )


def with_running_digest(chunks: DataFrame) -> DataFrame:
    """``record, payload_bytes, payload_digest`` of records in several chunks.

    A record's chunks meet in one task in their order and are hashed as they
    pass; what is held is one batch of chunks and one hash.
    """
    schema = "record string, payload_bytes long, payload_digest string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, size, running, done = None, 0, None, []
        for batch in batches:
            for name, block in zip(batch.column(0).to_pylist(), batch.column(2)):
                if name != record:
                    if record is not None:
                        done.append((record, size, running.hexdigest()))
                    record, size, running = name, 0, hashlib.sha256()
                part = block.as_buffer()
                running.update(part)
                size += part.size
            if len(done) > 10_000:
                yield _digests(done)
                done = []
        if record is not None:
            done.append((record, size, running.hexdigest()))
        if done:
            yield _digests(done)

    def _digests(done: list) -> pa.RecordBatch:
        names, sizes, values = zip(*done)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.array(sizes), pa.int64()), pa.array(values, pa.string())],
            names=["record", "payload_bytes", "payload_digest"],
        )

    rows = chunks.select("record", "chunk_no", "block")
    rows = rows.repartition("record").sortWithinPartitions("record", "chunk_no")
    return rows.mapInArrow(run, schema)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of an archive, with length and digest of the payload as read.

    A response whose bytes don't have the digest in its header is an error. A
    revisit has the length from its HTTP head and the digest from its header.
    """
    segments = read_segments(spark, path)
    # The HTTP head ends at its first empty line; it is in a record's first segment.
    text = F.col("block").cast("string")
    http = F.substring_index(text, RECORD_END, 1)
    body = F.when(
        F.col("chunk_no") == 0, F.expr("substring(block, octet_length(http) + 5)")
    ).otherwise(F.col("block"))
    said = F.regexp_extract("http", r"(?m)^Content-Length: ([0-9]+)", 1).cast("long")
    rows = segments.withColumn("http", http).withColumn("said", said).withColumn("block", body)
    columns = ["page_id", "url", "refers_to", "type"]
    single = rows.where("NOT many").select(
        *columns,
        F.when(F.col("type") == "revisit", F.col("said")).otherwise(F.octet_length("block")).alias("payload_bytes"),
        F.when(F.col("type") == "revisit", F.col("payload_digest")).otherwise(F.sha2("block", 256)).alias("found"),
        "payload_digest",
    )
    several = rows.where("many")
    heads = several.where("chunk_no = 0").select("record", *columns, F.col("payload_digest").alias("stated"))
    whole = heads.join(with_running_digest(several), "record").select(
        *columns, "payload_bytes", F.col("payload_digest").alias("found"), F.col("stated").alias("payload_digest")
    )
    both = single.unionByName(whole)
    checked = F.when(F.col("found") == F.col("payload_digest"), F.col("found")).otherwise(
        F.raise_error(F.concat(F.lit("digest differs: page "), F.coalesce(F.col("page_id").cast("string"), F.lit("-"))))
    )
    return both.select(
        "page_id", F.col("payload_bytes").cast("long").alias("payload_bytes"), checked.alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to", "url",
    )


def archive_pages(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    chunk_bytes: int = CHUNK_BYTES,
    min_revisit: int = MIN_REVISIT,
    date: str = "2025-01-01T00:00:00Z",
) -> None:
    """Write every page as a WARC record to the folder ``path``."""
    write_archive(chunked(labelled(pages, page_id, url, payload, min_revisit), chunk_bytes), path, date)


def write_and_read(pages: DataFrame, **options) -> DataFrame:
    """Archive all pages in the shared folder and read the records back."""
    path = f"{shared_folder(pages.sparkSession)}/patronage/warc-{uuid.uuid4().hex}"
    archive_pages(pages, path, **options)
    return read_records(pages.sparkSession, path)
