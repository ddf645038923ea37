"""Archives written and read back, next to a plain computation of the same records."""

import gzip
import hashlib
import re
from collections import defaultdict

import pytest

from patronage.llm import warc
from patronage.session import shared_folder

LONG = "<p>" + "äöü line\r\n\r\n" * 9000 + "</p>"
MARKS = "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40 + "tail\r\n\r\n"
ROWS = [
    (5, "http://a/5", "x" * 100), (3, "http://a/3", "x" * 100), (9, "http://a/9", "x" * 99), (8, "u", "x" * 99),
    (1, None, None), (2, "http://a/\r\n2", ""), (7, "http://WARC/1.1", LONG), (11, "u", LONG), (12, "u", MARKS),
    (13, "u", "\r\n\r\n" * 50), (14, "u", "W" * 300 + "WARC/1.1"), (None, "u", "n" * 200), (None, "u", "n" * 200),
    (20, "u", "r" * 120), (20, "u", "r" * 120), (21, "u", "r" * 120), (None, "u", "x" * 100), (22, "u", "😀" * 30_000),
]


def expected(rows):
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        ids = [p for p in groups[html or ""] if p is not None]
        first = min(ids) if ids and len(body) >= 100 and len(groups[html or ""]) > 1 else page
        out.append(
            (page, len(body), hashlib.sha256(body).hexdigest(), "response" if first == page else "revisit",
             None if first == page else first)
        )
    return sorted(out, key=repr)


def found(df):
    return sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("chunk", [1 << 16, 1000, 7])
def test_records_come_back(spark, chunk):
    rows = ROWS if chunk > 7 else [r for r in ROWS if len(r[2] or "") < 2000]
    pages = spark.createDataFrame([(*r, "other") for r in rows], "page_id long, url string, html string, record string")
    assert found(warc.write_and_read(pages.repartition(3), chunk_bytes=chunk)) == expected(rows)


def test_archive_is_warc(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1)
    path = shared_folder(spark) + "/warc-format"
    warc.archive_pages(pages, path + "-" + hashlib.sha256(str(id(pages)).encode()).hexdigest()[:8])
    path = path + "-" + hashlib.sha256(str(id(pages)).encode()).hexdigest()[:8]
    payloads = defaultdict(bytes)
    for file in spark.read.format("binaryFile").load(path).select("content").collect():
        data = gzip.decompress(bytes(file.content))
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            fields = dict(re.findall(rb"(?m)^([\w-]+): (.*?)\r?$", head))
            size = int(fields[b"Content-Length"])
            block, data = rest[:size], rest[size + 4 :]
            assert rest[size : size + 4] == b"\r\n\r\n" and size <= warc.CHUNK_BYTES + 200
            origin = fields.get(b"WARC-Segment-Origin-ID", fields[b"WARC-Record-ID"])
            payloads[origin] += block
    bodies = [p.partition(b"\r\n\r\n")[2] for p in payloads.values()]
    assert LONG.encode() in bodies and MARKS.encode() in bodies and len(bodies) == len(ROWS)


def test_running_digests(spark):
    pages = spark.createDataFrame([(1, "u", LONG)], "page_id long, url string, html string")
    rows = warc.chunked(warc.labelled(pages, "page_id", "url", "html", 100), 5000).orderBy("chunk_no").collect()
    seen = hashlib.sha256()
    for row in rows:
        seen.update(row.chunk)
        assert row.running_digest == seen.hexdigest() and len(row.chunk) <= 5000
    assert [r.last for r in rows] == [False] * (len(rows) - 1) + [True] and rows[-1].running_digest == rows[0].payload_digest


def test_damage_is_an_error(spark):
    path = shared_folder(spark) + f"/warc-damaged-{id(spark)}"
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: {}\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody"
    for i, size in enumerate((23, 50)):
        spark.createDataFrame([(record.format(size),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}-{i}")
        with pytest.raises(Exception, match="digest differs" if i == 0 else "cut off"):
            warc.read_records(spark, f"{path}-{i}").collect()


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write_and_read(pages).count() == 0
