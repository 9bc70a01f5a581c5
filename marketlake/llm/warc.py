"""Content-addressed WARC archive.

An archive is two Parquet tables. ``payloads`` holds each distinct payload once under its SHA-256
with its SHA-1 in base 32. ``headers`` holds the exact header bytes of every record (the WARC
header block and the HTTP header block), and the address of its payload. A record's bytes are its
two header blocks, then its payload if it is a response, then the two closing line ends; joining
the tables by address gives them back, and gives a revisit the payload it stands for.

Among records with equal payloads of at least ``min_revisit_bytes`` bytes the one with the largest
id is the response and the others revisit it; smaller payloads are responses all. The key of a
group is the SHA-256, so that the largest id is found by a combined aggregate and a hot payload
is one row per task. All of it is DataFrame work.

Defined results: a null payload is the empty one; a null id is below all others and is written as
``none``; rows that repeat an id and payload are of one type; a null address leaves out its header;
line breaks in an address are percent-encoded; other columns are ignored; an empty table gives an
empty archive. Reading fails on a payload that no longer has its digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
EOL = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base 32 of the SHA-1; five hexadecimal digits are four of base 32."""
    digest = F.sha1(data)
    groups = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)
    ]
    return F.translate(F.concat(*groups), DIGITS32, BASE32)


def _record_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(EOL)), F.lit(""))


def _header(date: str) -> Column:
    """The WARC header block of a row with id, url, type, refers_to, digest and lengths."""
    revisit = F.col("record_type") == "revisit"
    address = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    length = F.length("http_header") + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", address),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_urn(F.col("refers_to")))),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit(EOL),
    )


def write_archive(
    pages: DataFrame,
    path: str,
    *,
    min_revisit_bytes: int = 0,
    date: str = EPOCH,
    content_type: str = "text/html; charset=utf-8",
) -> None:
    """Write ``pages`` (page_id, url, html) below ``path`` as the tables headers and payloads."""
    spark = pages.sparkSession
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("address", F.unhex(F.sha2("payload", 256)))

    # One pass over the payloads gives what the headers need; later steps read these rows.
    facts = f"{path}/_facts"
    source.select(
        "page_id",
        "url",
        "address",
        F.length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    ).write.parquet(facts)
    rows = spark.read.parquet(facts)
    best = rows.groupBy("address").agg(F.max("page_id").alias("best"))
    original = F.col("page_id").eqNullSafe(F.col("best")) | (
        F.col("payload_bytes") < min_revisit_bytes
    )
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: {content_type}{EOL}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(EOL + EOL),
    )
    typed = (
        rows.join(best, "address")
        .withColumn("record_type", F.when(original, "response").otherwise("revisit"))
        .withColumn("refers_to", F.when(~original, F.col("best")))
        .withColumn("http_header", http)
    )
    typed.select(
        F.encode(_header(date), "UTF-8").alias("warc_header"),
        F.encode("http_header", "UTF-8").alias("http_header"),
        "address",
    ).write.parquet(f"{path}/headers")

    # Rows of one address hold the same bytes, so each task keeps one of them before the shuffle.
    (
        source.groupBy("address")
        .agg(F.first("payload").alias("payload"))
        .select("address", base32_sha1(F.col("payload")).alias("payload_digest"), "payload")
        .write.parquet(f"{path}/payloads")
    )


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads; each is hashed again, and a wrong one fails the read."""
    kept = spark.read.parquet(f"{path}/payloads")
    sound = (F.unhex(F.sha2("payload", 256)) == F.col("address")) & (
        base32_sha1(F.col("payload")) == F.col("payload_digest")
    )
    return kept.select(
        "address",
        F.when(sound, F.col("payload_digest"))
        .otherwise(F.raise_error(F.lit("a stored payload does not have its digest")))
        .alias("payload_digest"),
        F.length("payload").cast("long").alias("payload_bytes"),
        "payload",
    )


def _field(name: str) -> Column:
    text = F.decode("warc_header", "UTF-8")
    found = F.regexp_extract(text, rf"(?:^|\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def _page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, r"urn:x-page:(-?\d+)>", 1).try_cast("long")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Every record's header fields, read out of the exact header bytes."""
    return spark.read.parquet(f"{path}/headers").select(
        _page_of(_field("WARC-Record-ID")).alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"),
        _page_of(_field("WARC-Refers-To")).alias("refers_to"),
        F.regexp_extract(_field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("header_digest"),
        "warc_header",
        "http_header",
        "address",
    )


def read_archive(spark: SparkSession, path: str, *, with_bytes: bool = True) -> DataFrame:
    """The records of an archive: header fields, payload and, if asked for, the record's bytes.

    Fails on a record whose header names another digest than its payload has.
    """
    held = payloads(spark, path)
    if not with_bytes:
        held = held.drop("payload")
    joined = read_headers(spark, path).join(held, "address", "left")
    agrees = F.col("header_digest") == F.col("payload_digest")
    joined = joined.withColumn(
        "payload_digest",
        F.when(agrees, F.col("payload_digest")).otherwise(
            F.raise_error(F.lit("a record and its payload disagree"))
        ),
    )
    if not with_bytes:
        return joined
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.unhex(F.lit("")))
    end = F.encode(F.lit(EOL + EOL), "UTF-8")
    return joined.withColumn("record", F.concat("warc_header", "http_header", body, end))
