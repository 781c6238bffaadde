"""Web archives as a chunked record table.

Writing: a payload longer than ``CHUNK`` bytes becomes one record and its continuation records, as
the WARC format's segments, so a row never holds more than one chunk.  Records are rows of text whose
separator is the record end, so Spark writes and reads the archives by itself, in whatever store the
shared folder is.  Whole records and segmented ones go to two folders.  Payloads that another record
has already are written as revisit records too, with the full payload, so that every payload can be read
back and checked.

Reading: rows are (record id, chunk number, bytes).  Chunks of a record meet in one task in order and
stream through it; a running SHA-256 is carried from chunk to chunk, and the row of the last chunk has
the record's digest and length.

Defined results: null html is an empty payload; an empty payload has the digest of no bytes and is a
response; null page ids are kept; rows that repeat a page id and its payload are the same
record and share its type; an empty table gives an empty archive and result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir

#: Bytes of payload in one record.
CHUNK = 1 << 15
#: Records in one compressed file, which is read by one task.
RECORDS_PER_FILE = 50_000
MIN_REVISIT = 100
#: Parts that a digest's rows are spread over while they meet their response.
SALTS = 16

# The record end and the first line of a record.
END = "\r\n\r\n"
VERSION = "WARC/1.1"


# Fixed value: how a revisit says that its payload is that of another record.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def described(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to."""
    html = F.coalesce("html", F.lit(""))
    raw = html.cast("binary")
    rows = pages.select(
        "page_id", "url", html.alias("html"), F.octet_length(raw).cast("bigint").alias("payload_bytes"),
        F.sha2(raw, 256).alias("payload_digest"),
    )
    big = rows.filter(F.col("payload_bytes") >= MIN_REVISIT)
    first = (
        big.groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("payload_digest", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(first, ["payload_digest", "salt"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; line ends inside a value become spaces."""
    return F.coalesce(
        F.concat(F.lit(f"\r\n{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")), F.lit("")
    )


def records(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(segmented, value): one row per record, its text without the record end.

    No chunk holds a version line, which starts the text that separates records.
    """
    # A payload is cut inside every version line that it holds, then into chunks.
    safe = F.split("html", r"(?<=WA)(?=RC/1[.]1)", -1)
    parts = F.when(F.instr("html", VERSION) > 0, safe).otherwise(F.array("html"))
    cut = F.expr(
        "flatten(transform(transform(parts, p -> cast(p as binary)), p -> transform("
        f"sequence(0, greatest((octet_length(p) - 1) div {chunk}, 0)), "
        f"i -> substring(p, cast(i * {chunk} + 1 as int), {chunk}))))"
    )
    rows = (
        described(pages)
        .withColumns({"parts": parts, "record": F.concat(F.lit("urn:uuid:"), F.expr("uuid()"))})
        .withColumn("chunks", cut)
        .withColumn("segments", F.size("chunks"))
        .select("*", F.posexplode("chunks").alias("at", "chunk"))
        .withColumn("chunk", F.col("chunk").cast("string"))  # the same bytes
    )
    kind = F.when(F.col("at") > 0, "continuation").otherwise(F.col("record_type"))
    many = F.col("segments") > 1
    head = F.concat(
        F.lit(VERSION),
        _header("WARC-Type", kind),
        _header("WARC-Record-ID", F.concat(F.lit("<"), "record", F.when(F.col("at") > 0, F.concat(F.lit("-"), "at")).otherwise(""), F.lit(">"))),
        _header("WARC-Date", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _header("WARC-Profile", F.when(kind == "revisit", REVISIT_PROFILE)),
        _header("WARC-Page-ID", F.when(F.col("at") == 0, F.col("page_id"))),
        _header("WARC-Target-URI", F.when(F.col("at") == 0, F.col("url"))),
        _header("WARC-Refers-To-Page-ID", F.when(F.col("at") == 0, F.col("refers_to"))),
        _header("WARC-Payload-Digest", F.when(F.col("at") == 0, F.concat(F.lit("sha256:"), "payload_digest"))),
        _header("WARC-Segment-Number", F.when(many, F.col("at") + 1)),
        _header("WARC-Segment-Origin-ID", F.when(F.col("at") > 0, F.concat(F.lit("<"), "record", F.lit(">")))),
        _header("WARC-Segment-Total-Length", F.when(many & (F.col("at") == F.col("segments") - 1), F.col("payload_bytes"))),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.octet_length("chunk")),
    )
    return rows.select(many.alias("segmented"), F.concat(head, F.lit(END), "chunk").alias("value"))


def write_archive(pages: DataFrame, path: str, chunk: int = CHUNK) -> None:
    out = records(pages, chunk).write.partitionBy("segmented").option("maxRecordsPerFile", RECORDS_PER_FILE)
    out.option("compression", "gzip").option("lineSep", END).text(path)


def read_archive(spark: SparkSession, path: str, segmented: bool) -> DataFrame:
    """The chunk rows of one folder of an archive: record, chunk_no, headers and the chunk's bytes."""
    try:
        text = spark.read.option("lineSep", END + VERSION).text(f"{path}/segmented={str(segmented).lower()}")
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
        text = spark.createDataFrame([], "value string")
    # The first record of a file still has its version line, the last its record end.
    cut = F.instr("value", END)
    rows = text.filter(cut > 0).withColumn("head", F.substring("value", F.lit(1), cut - 1))
    field = lambda name: F.regexp_extract("head", rf"(?m)^{name}: <?([^\r>]*)>?\r?$", 1)
    rows = rows.select(
        F.col("value").cast("binary").alias("raw"),
        (F.octet_length("head") + len(END) + 1).alias("begin"),
        field("WARC-Type").alias("type"),
        field("WARC-Record-ID").alias("own"),
        field("WARC-Segment-Origin-ID").alias("origin"),
        F.expr(r"try_cast(nullif(regexp_extract(head, '(?m)^WARC-Page-ID: (-?[0-9]+)', 1), '') as bigint)").alias("page_id"),
        F.expr(r"try_cast(nullif(regexp_extract(head, '(?m)^WARC-Refers-To-Page-ID: (-?[0-9]+)', 1), '') as bigint)").alias("refers_to"),
        field("WARC-Payload-Digest").alias("stated"),
        F.coalesce(F.expr("try_cast(nullif(regexp_extract(head, '(?m)^WARC-Segment-Number: ([0-9]+)', 1), '') as int)"), F.lit(1)).alias("number"),
        F.regexp_extract("head", r"(?m)^Content-Length: ([0-9]+)", 1).cast("int").alias("length"),
    )
    return rows.select(
        F.when(F.col("origin") != "", F.col("origin")).otherwise(F.col("own")).alias("record"),
        (F.col("number") - 1).alias("chunk_no"),
        "type", "page_id", "refers_to", "stated",
        F.expr("substring(raw, begin, length)").alias("data"),
    )


DIGESTS = "record string, chunk_no int, type string, page_id bigint, refers_to bigint, stated string, payload_bytes bigint, payload_digest string"  # noqa: E501


def digests(chunks: DataFrame) -> DataFrame:
    """Each chunk row with the length and digest of the record up to its end.

    Needs the chunks of a record in one partition, in order.  One chunk is held at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, total, state, due = None, 0, hashlib.sha256(), 0
        for batch in batches:
            sizes, sums = [], []
            for own, number, data in zip(
                batch.column("record").to_pylist(), batch.column("chunk_no").to_pylist(), batch.column("data"), strict=True
            ):
                if own != record:
                    record, total, state, due = own, 0, hashlib.sha256(), 0
                if number != due:
                    raise ValueError(f"chunk {due} of record {own} is missing")
                piece = data.as_buffer()
                state.update(piece)
                total, due = total + piece.size, due + 1
                sizes.append(total)
                sums.append(state.hexdigest())
            rest = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "data"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(sizes, pa.int64()), pa.array(sums, pa.string())],
                names=[n for n in batch.schema.names if n != "data"] + ["payload_bytes", "payload_digest"],
            )

    return chunks.mapInArrow(run, DIGESTS)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of an archive, with the length and digest of the payload as read."""
    single = read_archive(spark, path, False).select(
        "page_id", "type", "refers_to", "stated",
        F.octet_length("data").cast("bigint").alias("payload_bytes"),
        F.sha2("data", 256).alias("payload_digest"),
    )
    chunks = read_archive(spark, path, True)
    ordered = chunks.repartition("record").sortWithinPartitions("record", "chunk_no")
    last = (
        digests(ordered)
        .groupBy("record")
        .agg(F.max_by(F.struct("payload_bytes", "payload_digest"), "chunk_no").alias("all"),
             F.min_by(F.struct("page_id", "type", "refers_to", "stated"), "chunk_no").alias("first"))
    )
    many = last.select("first.page_id", "first.type", "first.refers_to", "first.stated", "all.payload_bytes", "all.payload_digest")
    return single.unionByName(many)


def round_trip(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Archive every page, read the archive back, and return one row per page from what was read."""
    spark = pages.sparkSession
    path = shared_dir(spark, "archive")
    write_archive(pages, path, chunk)
    read = read_records(spark, path)
    checked = F.when(F.col("stated") == F.concat(F.lit("sha256:"), "payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("?"))))
    )
    return read.select(
        "page_id", "payload_bytes", checked.alias("payload_digest"), F.col("type").alias("record_type"), "refers_to"
    )
