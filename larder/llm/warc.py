"""Web archives: writing WARC records with Spark's text writer, reading them back with reassembled segments.

Writing. A record is one line of a text file whose line separator is the record's end, two line breaks. Payloads are
sent in chunked transfer framing; HTTP messages longer than ``SEGMENT`` bytes are cut into a first record and
continuation records. Chunks end in the middle of every ``WARC/1.1`` of a payload, whatever follows it there (line breaks of
the framing or a record's end could), and an address that ends so has its last dot escaped, so ``VERSION`` stands at the
start of records only.

Reading. Archives are split at ``VERSION``, which can't overlap itself (the line reader would miss a separator that does,
where its buffer ends inside one), so one task need not read a whole archive (compressed ones: one task per
file). The block's length must be the stated one. Continuation records are grouped by the identifier of their origin,
ordered by segment number and checked against the stated total length, then the chunk framing is decoded. Unsegmented
records pass without a shuffle. A record that fails a check stops the job.

Equal payloads: from ``MIN_REVISIT`` bytes on, the record of smallest page identifier (null last, then by address) is the
response and the others are revisits of it, without payload.

Defined results: null html is an empty payload; null addresses and line breaks in them are escaped; rows that repeat an
identifier, address and payload are the same record written several times and come back as often; an empty table gives
an archive without records. Page identifiers are whole numbers: others raise an error before anything runs. A payload passes through one task, a group of equal ones never does.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import map_batches, table, whole_numbers
from larder.session import materialize, scratch_path

END = "\r\n\r\n"
VERSION = "WARC/1.1\r\n"
CHUNK, SEGMENT, MIN_REVISIT = 4096, 32768, 100
DATE = "1970-01-01T00:00:00Z"
HEADERS = {
    "type": "WARC-Type", "record_id": "WARC-Record-ID", "uri": "WARC-Target-URI", "digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To", "segment": "WARC-Segment-Number", "origin": "WARC-Segment-Origin-ID",
    "total": "WARC-Segment-Total-Length", "length": "Content-Length",
}


# --- writing -----------------------------------------------------------------------


def chunked(payload: bytes) -> bytes:
    """Chunked transfer framing. A chunk ends after ``CHUNK`` bytes and inside each version, so no message holds one."""
    cuts = sorted({*range(0, len(payload), CHUNK), *(m.start() + 4 for m in re.finditer(re.escape(VERSION.strip().encode()), payload))})
    parts = []
    for start, stop in zip(cuts, [*cuts[1:], len(payload)]):
        parts += [b"%x\r\n" % (stop - start), payload[start:stop], b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(message: bytes) -> bytes:
    """The body of an HTTP message with chunked framing, decoded. Fails where the framing is broken."""
    at = message.index(b"\r\n\r\n") + 4
    parts = []
    while True:
        stop = message.index(b"\r\n", at)
        size = int(message[at:stop].split(b";")[0], 16)
        at = stop + 2
        if size == 0:
            return b"".join(parts)
        if message[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk doesn't end where its size says")
        parts.append(message[at : at + size])
        at += size + 2


def segments(message: bytes, size: int = SEGMENT) -> list[bytes]:
    """The message cut after every ``size`` bytes."""
    return [message[at : at + size] for at in range(0, len(message), size)]


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    return (VERSION + head + "\r\n").encode() + block


def records(record_id: str, uri: str, digest: str, refers_to: str | None, payload: bytes) -> list[bytes]:
    """The WARC records of one page: a revisit, or a response with its continuations."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    common = [("WARC-Record-ID", record_id), ("WARC-Date", DATE), ("WARC-Target-URI", uri),
              ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [_record([("WARC-Type", "revisit"), *common, ("WARC-Profile", profile), ("WARC-Refers-To", refers_to)], http)]
    blocks = segments(http + chunked(payload))
    if len(blocks) == 1:
        return [_record([("WARC-Type", "response"), *common], blocks[0])]
    found = [_record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", "1")], blocks[0])]
    total = ("WARC-Segment-Total-Length", str(sum(map(len, blocks))))
    for number, block in enumerate(blocks[1:], 2):
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{record_id[:-1]}:{number}>"), ("WARC-Date", DATE),
                  ("WARC-Target-URI", uri), ("WARC-Segment-Origin-ID", record_id), ("WARC-Segment-Number", str(number))]
        found.append(_record([*fields, total] if number == len(blocks) else fields, block))
    return found


def _record_id(page: Column, url: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:larder:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), F.hex(F.xxhash64(url, digest)), F.lit(">"))


def write_pages(pages: DataFrame, path: str, compression: str = "gzip", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Writes one record per page, with continuations, as text files with record ends as line ends."""
    whole_numbers(pages, id_col)
    rows = pages.select(
        F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit("").cast("binary")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    leaders = (
        rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest")
        .agg(F.min(F.struct(F.col("page").isNull().alias("none"), "page", "url")).alias("leader"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "leader")
    )
    # Only digests that occur again are on the right; a frequent one on the left is a skewed join, which AQE splits.
    joined = rows.join(leaders, "digest", "left")
    leads = F.col("leader").isNull() | (F.col("leader.page").eqNullSafe(F.col("page")) & F.col("leader.url").eqNullSafe(F.col("url")))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    # A header's line break would make a version of it.
    uri = F.regexp_replace(uri, r"WARC/1\.1\z", "WARC/1%2E1")
    inputs = joined.select(
        _record_id(F.col("page"), F.col("url"), F.col("digest")).alias("record_id"), uri.alias("uri"), "digest",
        F.when(~leads, _record_id(F.col("leader.page"), F.col("leader.url"), F.col("digest"))).alias("refers_to"),
        F.when(leads, F.col("payload")).alias("payload"),
    )

    def start():
        def step(batch: pa.RecordBatch) -> dict:
            out = []
            for line in batch.to_pylist():
                out += records(line["record_id"], line["uri"], line["digest"], line["refers_to"], line["payload"] or b"")
            return {"record": pa.array(out, pa.binary())}

        return step

    lines = map_batches(inputs, start, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", END).option("compression", compression).text(path)


# --- reading -----------------------------------------------------------------------


def raw_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``: its fields (null where absent) and its block, of checked length."""
    text = spark.read.option("lineSep", VERSION).text(path).where(F.octet_length("value") > 0)
    head = F.substring_index("value", END, 1)
    fields = {name: F.regexp_extract(F.col("head"), rf"(?im)^{label}:[ \t]*([^\r\n]*)", 1) for name, label in HEADERS.items()}
    parsed = text.select(F.col("value").cast("binary").alias("bytes"), head.alias("head")).select(
        "bytes", F.octet_length("head").alias("head_length"), *[F.nullif(value, F.lit("")).alias(name) for name, value in fields.items()])
    numbers = {"segment": "int", "total": "long", "length": "int"}
    parsed = parsed.withColumns({name: F.col(name).cast(kind) for name, kind in numbers.items()})
    rest = F.octet_length("bytes") - F.col("head_length") - len(END)
    whole = rest == F.col("length") + len(END)
    block = F.expr(f"substring(bytes, head_length + {len(END)} + 1, length)")
    broken = F.raise_error(F.concat(F.lit("the block of a record has another length than stated: "), F.coalesce("record_id", F.lit("?"))))
    return parsed.withColumn("block", F.when(whole, block).otherwise(broken)).drop("bytes", "head_length")


def _decoded(blocks: DataFrame) -> DataFrame:
    """Responses with ordered blocks, their total length and how often they were written, to payloads."""

    def start():
        def step(batch: pa.RecordBatch) -> dict:
            payloads = []
            for name, parts, total in zip(*(batch.column(c).to_pylist() for c in ("record_id", "blocks", "total"))):
                message = b"".join(parts)
                if total is not None and total != len(message):
                    raise ValueError(f"{name}: segments have {len(message)} bytes, stated are {total}")
                payloads.append(unchunked(message))
            kept = {c: batch.column(c) for c in ("record_id", "uri", "digest", "copies")}
            return kept | {"payload": pa.array(payloads, pa.binary())}

        return step

    lines = map_batches(blocks, start, "record_id string, uri string, digest string, copies long, payload binary")
    return lines.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copy", "copies")


def read_pages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Responses (record_id, uri, digest, payload) and revisits (record_id, uri, digest, refers_to) of archives."""
    found = raw_records(spark, path)
    single = found.where((F.col("type") == "response") & F.col("segment").isNull()).select(
        "record_id", "uri", "digest", F.lit(1).cast("long").alias("copies"), F.array("block").alias("blocks"), F.lit(None).cast("long").alias("total"))
    # A record that was written several times has several equal segments of each number: one stays, with its count.
    parts = (
        found.where(F.col("segment").isNotNull()).withColumn("record_id", F.coalesce("origin", "record_id"))
        .groupBy("record_id", "segment")
        .agg(F.first("block").alias("block"), F.count("*").alias("copies"), F.max("total").alias("total"),
             F.max(F.when(F.col("origin").isNull(), F.col("uri"))).alias("uri"), F.max("digest").alias("digest"))
    )
    whole = parts.groupBy("record_id").agg(
        F.max("uri").alias("uri"), F.max("digest").alias("digest"), F.min("copies").alias("copies"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        # Without its last segment a record has no total: -1 fails the check.
        F.coalesce(F.max("total"), F.lit(-1).cast("long")).alias("total"))
    whole = whole.select("record_id", "uri", "digest", "copies", F.col("parts.block").alias("blocks"), "total")
    revisits = found.where(F.col("type") == "revisit").select("record_id", "uri", "digest", "refers_to")
    return _decoded(single.unionByName(whole)), revisits


def page_of(record_id: Column) -> Column:
    """The page identifier inside a record identifier; null where it was null."""
    return F.regexp_extract(record_id, r"page:(-?\d+):", 1).try_cast("long")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to; all from the archives read back."""
    path = scratch_path(spark, "warc")
    write_pages(table(spark, folder, "pages"), path)
    responses, revisits = read_pages(spark, path)
    read = responses.select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"), "digest")
    same = F.col("digest") == F.concat(F.lit("sha256:"), "payload_digest")
    read = read.withColumn("payload_digest", F.when(same, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a payload has another digest than stated"))))
    read = materialize(read, "warc_read")
    answered = read.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                           F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    # A leader that was written several times counts once.
    leaders = read.groupBy(F.col("record_id").alias("refers_to")).agg(F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"))
    again = revisits.join(leaders, "refers_to").select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        F.lit("revisit").alias("record_type"), page_of(F.col("refers_to")).alias("refers_to"))
    return answered.unionByName(again)


SQL = """
WITH p AS (
  SELECT page_id, coalesce(strlen(html), 0)::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p
"""

cloudpickle.register_pickle_by_value(sys.modules[__name__])
