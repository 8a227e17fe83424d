"""WARC archives without repeated payloads.

Payload digests are computed next to the data; only (page_id, digest, length)
is shuffled to find, for each digest, the record that keeps its payload. The
others become ``revisit`` records that refer to it. Archives are WARC/1.1,
written by Spark's own file writer (so a lost task is redone and committed
once): every row is one record, the record separator being the two line ends
that the standard puts after each record. Files are compressed as a whole and
so are read by one task each, as a stream: the reader rebuilds the bytes and
cuts records by their Content-Length, whatever a payload contains.

Defined cases: a null or empty html is an empty payload, always a response. Rows
that repeat a page_id are records of their own; if the largest page_id of equal
payloads is repeated, all its rows are responses. A null page_id is less than
any other and is written as ``null``; where all ids of equal payloads are null,
all are responses. Empty tables give archives without records and no rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.scratch import Scratch

CRLF = "\r\n"
MIN_BYTES = 1000
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = "page_id long, record_type string, record_id string, refers_to long, digest string, target_uri string, payload binary"


def originals(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``payload_digest, original``: the record that keeps each payload found
    more than once, from (page_id, payload_digest, payload_bytes)."""
    large = headers.where(F.col("payload_bytes") >= min_bytes)
    return large.groupBy("payload_digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1 and original is not null").drop("n")


def record_text(record_type: Column) -> Column:
    """One WARC record without the separator after it."""
    one = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\x00-\\x20]", "")
    page = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    body = F.when(record_type == RESPONSE, F.col("payload")).otherwise(F.lit(b""))
    head = [
        F.lit(f"WARC/1.1{CRLF}"), one("WARC-Type", record_type), one("WARC-Record-ID", page("page_id")),
        one("WARC-Date", F.col("warc_date")), one("WARC-Target-URI", uri),
        one("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(record_type == REVISIT, F.concat(one("WARC-Refers-To", page("original")), one("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        one("Content-Type", F.lit("text/html; charset=utf-8")), one("Content-Length", F.octet_length(body).cast("string")), F.lit(CRLF),
    ]
    return F.concat(F.concat(*head).cast("binary"), body).cast("string")


def write_archives(pages: DataFrame, path: str, scratch: Scratch, min_bytes: int = MIN_BYTES, warc_date: str = "2024-01-01T00:00:00Z") -> None:
    """Write (page_id, url, html) as deduplicated archives under ``path``."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    digested = pages.select("page_id", "url", payload.alias("payload")).withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    headers = scratch.write(digested.select("page_id", "payload_digest", "payload_bytes"), "headers")
    first = scratch.write(originals(headers, min_bytes), "originals")
    moved = headers.where(F.col("payload_bytes") >= min_bytes).join(first, "payload_digest")
    moved = moved.where("page_id is null or page_id != original").select(F.col("page_id").alias("p"), F.col("payload_digest").alias("d"), "original").distinct()
    moved = scratch.write(moved, "revisits")
    met = digested.join(moved, digested.page_id.eqNullSafe(moved.p) & (digested.payload_digest == moved.d), "left")
    kind = F.when(F.col("original").isNull(), RESPONSE).otherwise(REVISIT)
    record = met.withColumn("warc_date", F.lit(warc_date)).select(record_text(kind).alias("value"))
    record.write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def parse_records(rows: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload of the records in a stream cut at its separators."""
    buffer, separator = bytearray(), (CRLF * 2).encode()
    head: dict[str, str] | None = None
    for row in rows:
        buffer += row + separator
        while True:
            if head is None:
                start = 0
                while buffer[start : start + 2] == b"\r\n":
                    start += 2
                end = buffer.find(separator, start)
                if end < 0:
                    break
                lines = buffer[start:end].decode("utf-8").split(CRLF)
                if lines[0] != "WARC/1.1":
                    raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
                head = dict(x.split(": ", 1) for x in lines[1:])
                del buffer[: end + 4]
            size = int(head["Content-Length"])
            if len(buffer) < size:
                break
            yield head, bytes(buffer[:size])
            del buffer[:size]
            head = None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of archives: one row each, payload as stored."""
    number = lambda uri: None if uri in (None, "<urn:x-page:null>") else int(uri[len("<urn:x-page:") : -1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        names = [x.split()[0] for x in READ.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        packed = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        for head, payload in parse_records(x.as_py() for batch in batches for x in batch.column(0)):
            record = head["WARC-Record-ID"]
            out.append((number(record), head["WARC-Type"], record, number(head.get("WARC-Refers-To")), head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Target-URI"], payload))
            held += len(payload)
            if held > 8_000_000 or len(out) >= 5000:
                yield packed(out)
                out, held = [], 0
        if out:
            yield packed(out)

    rows = spark.read.option("lineSep", CRLF * 2).text(path)
    return rows.select(F.col("value").cast("binary")).mapInArrow(run, READ)


def resolve_revisits(records: DataFrame, scratch: Scratch) -> DataFrame:
    """Every record with the facts of its full payload: those of a revisit come
    from the response that it refers to."""
    facts = records.select("page_id", "record_type", "refers_to", "digest", F.sha1("payload").alias("own"), F.octet_length("payload").cast("long").alias("bytes"))
    facts = scratch.write(facts, "facts")
    revisits = facts.where(F.col("record_type") == REVISIT)
    needed = revisits.select(F.col("refers_to").alias("r"), F.col("digest").alias("d")).distinct()
    responses = facts.where(F.col("record_type") == RESPONSE).select(F.col("page_id").alias("r"), F.col("own").alias("d"), F.col("bytes").alias("full"))
    source = scratch.write(responses.join(needed, ["r", "d"], "left_semi").distinct(), "resolved")
    met = revisits.join(source, (F.col("refers_to") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    resolved = met.select("page_id", F.col("full").alias("payload_bytes"), F.col("d").alias("payload_digest"), "record_type", "refers_to")
    kept = facts.where(F.col("record_type") == RESPONSE).select("page_id", F.col("bytes").alias("payload_bytes"), F.col("own").alias("payload_digest"), "record_type", "refers_to")
    return kept.union(resolved)
