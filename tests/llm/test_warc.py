"""Archives read back as written; framing and segments on their own."""

import gzip
import hashlib
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventide.llm import warc
from eventide.llm.common import shared_folder

BIG = "<p>" + "línea\r\n\r\n<b>x</b>" * 6000
PAGES = [
    (1, "http://a.example/x", "<p>short</p>", "u"),
    (2, "http://a.example/x", "<p>short</p>", "u"),
    (3, None, None, "u"),
    (4, "http://a.example/y y\r\nWARC-Type: evil", "", "u"),
    (5, "http://b.example/", BIG, "u"),
    (7, "http://b.example/2", BIG, "u"),
    (6, "http://b.example/3", BIG, "u"),
    (None, "http://b.example/4", BIG, "u"),
    (7, "http://b.example/2", BIG, "u"),
    (8, "http://c.example/", "é" * 500, "u"),
    (9, "http://c.example/", "é" * 499 + "x", "u"),
    (10, "http://c.example/", "é" * 499 + "x", "u"),
    (11, "http://d.example/", "\r\n\r\n" * 5000, "u"),
    (12, "http://d.example/", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n", "u"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string, payload_digest string").repartition(3)


def test_round_trip(spark, pages):
    want = []
    for i, _, html, _ in PAGES:
        data = (html or "").encode()
        last = max(p for p, _, h, _ in PAGES if (h or "") == (html or "") and p is not None)
        refers = last if len(data) >= 1000 and i != last else None
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", refers, None if refers else data))
    found = warc.archive_and_read(pages, shared_folder(spark, "warc-test")).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload != b"" else b"") for r in found]
    key = lambda r: repr(r)[:300]
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert {r.page_id for r in found if r.target_uri is None} == {3}


def test_long_records_are_segmented(spark, pages):
    lines = warc.records(warc.roles(pages)).where(F.col("value").contains("WARC-Type: continuation"))
    assert lines.count() >= 2 * (len(BIG) // 16384)


def test_segments_of_any_order_and_archive(spark, tmp_path):
    """Parts of one record in several files, out of order, cut at line ends; a wrong total length is an error."""

    def archive(*records):
        return b"".join(head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n" for head, block in records)

    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5;name=1\r\nhello\r\n3\r\n\r\n!\r\n0\r\n\r\n"
    sha = hashlib.sha1(b"hello\r\n!").hexdigest()
    cuts = [0, 17, 60, len(block) - 4, len(block)]
    parts = [block[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    start = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:a>\r\nX-Page-ID: 5\r\nWARC-Payload-Digest: sha1:{sha}\r\nWARC-Segment-Number: 1\r\n"
    more = lambda n, extra="": f"WARC/1.1\r\nWARC-Type: continuation\r\nWARC-Record-ID: <urn:a{n}>\r\nWARC-Segment-Origin-ID: <urn:a>\r\nWARC-Segment-Number: {n}\r\n{extra}"
    total = f"WARC-Segment-Total-Length: {len(block)}\r\n"
    (tmp_path / "a.gz").write_bytes(gzip.compress(archive((more(4, total), parts[3]), (more(2), parts[1]))))
    (tmp_path / "b.gz").write_bytes(gzip.compress(archive((more(3), parts[2]), (start, parts[0]))))
    found = warc.contents(warc.reassemble(warc.read(spark, str(tmp_path)))).collect()
    assert [(r.page_id, bytes(r.payload), r.payload_bytes) for r in found] == [(5, b"hello\r\n!", 8)]
    (tmp_path / "a.gz").write_bytes(gzip.compress(archive((more(4, total), parts[3]))))
    with pytest.raises(Exception, match="incomplete record"):
        warc.contents(warc.reassemble(warc.read(spark, str(tmp_path)))).collect()


def test_parse_any_block():
    rng = random.Random(2)
    blocks = [bytes(rng.choice(b"\r\na") for _ in range(rng.randrange(12))) for _ in range(300)]
    head = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d"
    data = b"".join(head % len(b) + b"\r\n\r\n" + b + b"\r\n\r\n" for b in blocks)
    stretches = data.split(b"\r\n\r\n")
    found = pd.concat(warc.parse([pd.DataFrame({"file": "f", "value": stretches})]))
    assert list(found["block"]) == blocks


def test_empty_table(spark, pages):
    assert warc.archive_and_read(pages.limit(0), shared_folder(spark, "warc-empty")).count() == 0
