"""A content-addressed WARC archive: payload bytes once, record headers apart.

``blobs`` holds every distinct payload once under its SHA-256 digest. ``headers`` holds the exact
header bytes of every record, response or revisit, with the digest and the length of its
payload. Reading joins the two, checks digest and length of every payload it hands out, and
gives back the records as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stormgrid.session import scratch

WARC_DATE = "2024-01-01T00:00:00Z"
# FIXED VALUES: the digits of conv() to base 32 and those of RFC 4648.
BASE32_CONV, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 160 bits are four groups of ten hex digits, each
    of which is eight base-32 digits."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), BASE32_CONV, BASE32)


def record_id(page_id: Column, url: Column) -> Column:
    """A URN that depends on the page alone, so that writing again gives the same archive."""
    d = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("-")), F.coalesce(url, F.lit("-"))).cast("binary"))
    parts = [F.substring(d, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(is_response: Column) -> Column:
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    # a url is one header line: line breaks in it would end the header
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", "%0A")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(is_response, "response").otherwise("revisit")),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("url"))),
        line("WARC-Target-URI", target),
        line("WARC-Date", F.lit(WARC_DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            ~is_response,
            F.concat(line("WARC-Refers-To", F.col("refers_to_record")), line("WARC-Profile", F.lit(PROFILE))),
        ).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(is_response, F.col("payload_bytes")).otherwise(0).cast("string")),
        F.lit("\r\n"),
    ).cast("binary")


def write_archive(pages: DataFrame, root: str, least_bytes: int = 0) -> None:
    """One record per row of (page_id, url, html); a null html is an empty payload.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with the largest
    page_id is the response and the others are revisits of it; smaller ones are all responses.
    Rows that repeat the largest page_id are one page: each is a response, the payload is kept
    once. A row without a page_id is a response unless its payload has a page with an id.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).select(
        "page_id",
        "url",
        "payload",
        F.sha2("payload", 256).alias("blob"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    narrow = rows.select("page_id", "url", "blob", "payload_bytes")
    # digests that occur more than once; a group of any size is one row after partial sums
    repeated = (
        narrow.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("blob")
        .agg(F.max(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("blob", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    )
    placed = rows.select("page_id", "url", "blob", "payload_bytes", base32_sha1(F.col("payload")).alias("payload_digest"))
    placed = placed.join(repeated, "blob", "left")
    is_response = F.col("first_id").isNull() | F.coalesce(F.col("page_id") == F.col("first_id"), F.lit(False))
    (
        placed.withColumn("refers_to_record", record_id(F.col("first_id"), F.col("first_url")))
        .select(
            "page_id",
            "blob",
            "payload_bytes",
            F.when(is_response, "response").otherwise("revisit").alias("record_type"),
            F.when(~is_response, F.col("first_id")).alias("refers_to"),
            F.when(~is_response, F.col("refers_to_record")).alias("refers_to_record"),
            _header(is_response).alias("header"),
        )
        .write.parquet(f"{root}/headers")
    )
    # equal payloads meet under their digest, and one copy is written
    rows.select("blob", "payload").groupBy("blob").agg(F.first("payload").alias("payload")).write.parquet(f"{root}/blobs")
    spark.catalog.refreshByPath(root)


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """Every record with its payload, verified, and the record's exact bytes.

    A blob whose bytes do not have the digest and length that the header names ends the job.
    """
    headers = spark.read.parquet(f"{root}/headers")
    blobs = spark.read.parquet(f"{root}/blobs")
    joined = headers.join(blobs, "blob", "left")
    sound = (F.sha2("payload", 256) == F.col("blob")) & (F.octet_length("payload") == F.col("payload_bytes"))
    payload = F.when(sound, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged or missing blob "), F.col("blob"))).cast("binary")
    )
    body = F.when(F.col("record_type") == "response", payload).otherwise(F.lit(b""))
    end = F.lit(b"\r\n\r\n")
    return joined.select(
        "page_id",
        "record_type",
        "refers_to",
        "refers_to_record",
        "header",
        payload.alias("payload"),
        F.concat("header", body, end).alias("record"),
    )


def header_value(record: Column, name: str) -> Column:
    """The value of a header line of a record's bytes, or null. Headers hold UTF-8 text; payload bytes
    after the blank line are not looked at."""
    head = F.substring_index(F.decode(record, "ISO-8859-1"), "\r\n\r\n", 1)
    found = F.regexp_extract(head, rf"(?:^|\r\n)\Q{name}\E: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def archive_report(pages: DataFrame, root: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write the pages, read them back, and describe each page's full payload.

    Type, digest and reference are those of the rebuilt records' own bytes. A record that disagrees
    with the stored columns, or with the digest or length of its payload, ends the job.
    """
    root = root or scratch(pages.sparkSession, "warc")
    write_archive(pages, root, least_bytes)
    records = read_archive(pages.sparkSession, root)
    names = {"type": "WARC-Type", "digest": "WARC-Payload-Digest", "refers": "WARC-Refers-To", "length": "Content-Length"}
    read = records.select(
        "page_id",
        "record_type",
        "refers_to",
        "refers_to_record",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.concat(F.lit("sha1:"), base32_sha1(F.col("payload"))).alias("payload_digest"),
        F.octet_length("record").cast("long").alias("record_bytes"),
        F.octet_length("header").cast("long").alias("header_bytes"),
        *[header_value(F.col("record"), name).alias(c) for c, name in names.items()],
    )
    is_response = F.col("type") == "response"
    sound = (
        (F.col("type") == F.col("record_type"))
        & (F.col("digest") == F.col("payload_digest"))
        & F.col("refers").eqNullSafe(F.when(~is_response, F.col("refers_to_record")))
        & (F.col("length").cast("long") == F.when(is_response, F.col("payload_bytes")).otherwise(0))
        & (F.col("record_bytes") == F.col("header_bytes") + F.col("length").cast("long") + 4)
    )
    broken = F.raise_error(F.concat(F.lit("damaged record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("-"))))
    return read.select(
        "page_id",
        "payload_bytes",
        F.substring(F.col("digest"), 6, 32).alias("payload_digest"),
        F.when(F.coalesce(sound, F.lit(False)), F.col("type")).otherwise(broken.cast("string")).alias("record_type"),
        F.when(F.col("refers").isNotNull(), F.col("refers_to")).alias("refers_to"),
    )
