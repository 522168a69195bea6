"""WARC archives: writing pages as segmented, chunked records, and putting them together again."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import small_batches

# Fixed values of the format: a record and a header end with an empty line, lines end with CR LF.
END = "\r\n\r\n"
VERSION = "WARC/1.1"
PARSED = (
    "record_id string, warc_type string, page_id long, target_uri string, origin_id string, segment int, total_length long, "
    "length long, payload_digest string, refers_to long, block binary"
)


MOST_PARTS = 256


def _size(text: Column, least: int) -> Column:
    """Characters per part: ``least``, more for a text that would have over MOST_PARTS parts (each part's cut walks the text)."""
    return F.greatest(F.lit(least), F.ceil(F.length(text) / MOST_PARTS).cast("int"))


def chunked(body: Column, least: int = 4096) -> Column:
    """A text in HTTP chunked transfer framing, chunks of at least ``least`` characters (lengths count bytes, in hex)."""
    size = _size(body, least)
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.length(body) - 1) / size).cast("int")), lambda i: F.substring(body, i * size + 1, size))
    framed = F.transform(pieces, lambda p: F.concat(F.lower(F.hex(F.octet_length(p).cast("long"))), F.lit("\r\n"), p, F.lit("\r\n")))
    return F.concat(F.when(F.length(body) > 0, F.array_join(framed, "")).otherwise(F.lit("")), F.lit("0" + END))


def roles(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``pages`` with ``digest``, ``bytes`` and ``refers_to``: the largest id with the same payload, where that's another page.

    Payloads under ``least`` bytes never refer. The largest ids come from digests alone (partial aggregation); the join back is on
    the digest, and a digest that many pages share is split by the join.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    sized = pages.select("page_id", "url", body.alias("html")).withColumn("bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    groups = sized.where(F.col("bytes") >= least).groupBy("digest").agg(F.max("page_id").alias("_last"), F.count("*").alias("_n"))
    last = groups.where("_n > 1").select("digest", "_last")
    return sized.join(last, "digest", "left").withColumn("refers_to", F.when(~F.col("_last").eqNullSafe(F.col("page_id")), F.col("_last"))).drop("_last")


def records(pages: DataFrame, segment: int = 16384) -> DataFrame:
    """One row ``value`` per WARC record of ``roles(pages)``, without the closing empty line.

    A block over ``segment`` characters (more for huge blocks, which have 256 parts at most) is cut: the first part is the record itself with ``WARC-Segment-Number: 1``, the
    others are ``continuation`` records that name it, the last with the total length. A revisit has the HTTP header only.
    """
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise(F.lit(""))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]+", "%20")
    record_id = F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(":"), F.expr("uuid()"), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.when(revisit, F.concat(F.lit("Content-Length: "), F.col("bytes").cast("string"), F.lit(END))).otherwise(F.concat(F.lit("Transfer-Encoding: chunked" + END), chunked(F.col("html")))),
    )
    whole = pages.select("page_id", uri.alias("uri"), "digest", "refers_to", record_id.alias("rid"), http.alias("block"))
    whole = whole.withColumn("total", F.octet_length("block")).withColumn("size", _size(F.col("block"), segment))
    whole = whole.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.length("block") / F.col("size"))).cast("int"))
    cut = whole.select("*", F.explode(F.sequence(F.lit(1), F.col("parts"))).alias("no")).withColumn("part", F.substring(F.col("block"), (F.col("no") - 1) * F.col("size") + 1, F.col("size")))
    first, segmented = F.col("no") == 1, F.col("parts") > 1
    kind = F.when(~first, "continuation").when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")
    own = F.when(first, F.col("rid")).otherwise(F.concat(F.lit("<urn:x-part:"), F.expr("uuid()"), F.lit(">")))
    return cut.select(
        F.concat(
            F.lit(VERSION + "\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", own),
            line("WARC-Date", F.lit("2024-01-01T00:00:00Z")), line("WARC-Target-URI", F.col("uri")), line("X-Page-ID", F.when(first, F.col("page_id"))),
            line("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
            line("WARC-Refers-To", F.when(first & F.col("refers_to").isNotNull(), F.concat(F.lit("<urn:x-page:"), F.col("refers_to").cast("string"), F.lit(">")))),
            line("WARC-Segment-Number", F.when(segmented, F.col("no"))), line("WARC-Segment-Origin-ID", F.when(~first, F.col("rid"))),
            line("WARC-Segment-Total-Length", F.when(segmented & (F.col("no") == F.col("parts")), F.col("total"))),
            F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length("part").cast("string"), F.lit(END), F.col("part"),
        ).alias("value")
    )


def write(pages: DataFrame, folder: str) -> None:
    """Archives of all pages, one gzip file per task, by Spark's text writer: its line end is a record's closing empty line."""
    records(roles(pages)).write.option("lineSep", END).option("compression", "gzip").text(folder)


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}


def _record(head: bytes, block: bytes) -> tuple:
    h = _headers(head)
    number = lambda name: int(h[name]) if name in h else None
    digest = h.get("warc-payload-digest")
    refers = h.get("warc-refers-to")
    return (
        h.get("warc-record-id"), h.get("warc-type"), number("x-page-id"), h.get("warc-target-uri"), h.get("warc-segment-origin-id"),
        number("warc-segment-number"), number("warc-segment-total-length"), number("content-length"), digest.partition(":")[2] if digest else None,
        int(refers.strip("<>").split(":")[2]) if refers else None, block,
    )


def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records from a file's stretches between empty lines, in file order; the header's length says how many make a record."""
    names = [x.split()[0] for x in PARSED.split(", ")]
    head, parts, missing, file = None, [], 0, None
    for batch in batches:
        found = []
        for origin, value in zip(batch["file"], batch["value"], strict=True):
            if origin != file:
                if head is not None:
                    raise ValueError(f"{file}: the last record is cut off")
                file = origin
            if head is None:
                value = value.lstrip(b"\r\n")  # what is left of the last record's end if its block ended with a line end
                if not value:
                    continue
                if not value.startswith(b"WARC/"):
                    raise ValueError(f"{file}: a record starts with {value[:40]!r}")
                head, parts, missing = value, [], int(_headers(value)["content-length"])
                continue
            parts.append(value)
            missing -= len(value)
            if missing < 0:
                raise ValueError(f"{file}: a block is longer than its header says")
            if missing == 2:  # the block's own line end and half of the record's end made up this empty line
                parts.append(b"\r\n")
                missing = 0
            if missing == 0:
                found.append(_record(head, b"".join(parts)))
                head = None
            else:
                parts.append(END.encode())
                missing -= len(END)
        if found:
            yield pd.DataFrame(found, columns=names, dtype=object)
    if head is not None:
        raise ValueError(f"{file}: the last record is cut off")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives below ``folder``; gzip files aren't split, so each is read in order by one task."""
    small_batches(spark)
    lines = spark.read.option("lineSep", END).text(folder).select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("value"))
    return lines.mapInPandas(parse, PARSED)


def dechunk(body: bytes) -> bytes:
    """The payload of chunked transfer framing; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        if len(out[-1]) != size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is cut off")
        at = end + 4 + size


def payload(block: bytes) -> tuple[bytes, int]:
    """An HTTP response's payload and its length; the header alone gives the length where there is no body (a revisit)."""
    head, _, body = block.partition(END.encode())
    h = _headers(head)
    if h.get("transfer-encoding", "").lower() == "chunked":
        body = dechunk(body)
        return body, len(body)
    return body, int(h.get("content-length", len(body)))


def reassemble(found: DataFrame) -> DataFrame:
    """Whole records: a segmented one's parts meet by the record they continue and are joined in the order of their numbers.

    Only parts are shuffled, and a group is one record's. A missing part, a wrong total length or a record without its start
    is an error, not a shorter payload.
    """
    whole = found.where("segment is null")
    parts = found.where("segment is not null").withColumn("_of", F.coalesce("origin_id", "record_id"))
    first = lambda name: F.max(F.when(F.col("segment") == 1, F.col(name))).alias(name)
    joined = parts.groupBy("_of").agg(
        *[first(c) for c in ("record_id", "warc_type", "page_id", "target_uri", "payload_digest", "refers_to")], F.max("total_length").alias("total_length"),
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("_parts"),
    )
    size = F.aggregate("_parts", F.lit(0), lambda n, p: n + F.octet_length(p["block"]))
    in_order = F.transform(F.col("_parts"), lambda p: p["segment"]) == F.sequence(F.lit(1), F.size("_parts"))
    right = in_order & F.col("record_id").isNotNull() & (size == F.col("total_length"))
    # a fold over binary concat copies a growing block again and again; as hex-free strings Spark joins the parts at once
    text = F.array_join(F.transform("_parts", lambda p: p["block"].cast("string")), "").cast("binary")
    checked = F.when(F.coalesce(right, F.lit(False)), text).otherwise(F.raise_error(F.concat(F.lit("incomplete record "), F.col("_of"))).cast("binary"))
    columns = ["record_id", "warc_type", "page_id", "target_uri", "payload_digest", "refers_to"]
    return whole.select(*columns, "block").unionByName(joined.select(*columns, checked.alias("block")))


def contents(found: DataFrame) -> DataFrame:
    """(page_id, target_uri, record_type, payload, payload_bytes, payload_digest, refers_to) per whole record.

    A response's payload is decoded and its digest compared with the header's; a revisit has no payload of its own.
    """

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                body, length = payload(r.block)
                if r.warc_type == "response" and hashlib.sha1(body).hexdigest() != r.payload_digest:
                    raise ValueError(f"{r.record_id}: the payload differs from its digest")
                rows.append((r.page_id, r.target_uri, r.warc_type, body if r.warc_type == "response" else None, length, r.payload_digest, r.refers_to))
            out = pd.DataFrame(rows, columns=["page_id", "target_uri", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"], dtype=object)
            yield out

    return found.mapInPandas(decode, "page_id long, target_uri string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def archive_and_read(pages: DataFrame, folder: str) -> DataFrame:
    """Write all ``pages`` (page_id, url, html) to ``folder`` and read them back through segments and framing.

    Null html is an empty payload, null urls have no target, null page ids no page header; repeated rows have a record
    each. Of equal payloads of 1000 bytes and more the one with the largest page id is a response (repeats of it too). Other
    columns are ignored; an empty table gives no rows.
    """
    write(pages, folder)
    return contents(reassemble(read(pages.sparkSession, folder)))
