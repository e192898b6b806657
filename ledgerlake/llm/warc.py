"""Content-addressed WARC archive.

Writing makes two tables in the shared folder: ``payloads`` holds each distinct
payload once, under its SHA-256, and ``headers`` holds every record's exact
header block with the digest of its payload. Reading joins the two: the
original record is header block, payload and two line ends. A payload is
checked against its name whenever the archive is read. Of records with equal
payloads of ``MIN_REVISIT`` bytes or more, the one with the largest page_id is
a response and the others are revisits of it; a revisit has no block of its
own in the record, and its payload is found by its digest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import shared_folder

MIN_REVISIT = 1000
#: The format's version line, line end and revisit profile.
VERSION = "WARC/1.1"
LINE = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages have no fetch time: one date for all records.
DATE = "1970-01-01T00:00:00Z"


def _record_id(page_id: Column, digest: Column) -> Column:
    """A urn:uuid that is a function of page and payload."""
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)), F.lit(""))


def write(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT) -> None:
    """Archive ``pages`` (page_id, url, html) under ``path``.

    Null html is an empty payload, a null url leaves its line out. Line ends in
    a url are percent-encoded, so that a header stays one line. A null page_id
    is smaller than any other and is written as an absent WARC-Page-Id. Rows
    equal in page_id and payload are records of one kind. Nothing is dropped:
    one header per row.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("sha1", F.sha1("payload")).withColumn("bytes", F.octet_length("payload").cast("long"))
    # A group of equal payloads shrinks to one row before it is shuffled.
    best = rows.select("digest", "page_id").groupBy("digest").agg(F.max("page_id").alias("holder"))
    best.write.parquet(f"{path}/holders")
    best = pages.sparkSession.read.schema(best.schema).parquet(f"{path}/holders").withColumnRenamed("digest", "of")

    # Any copy will do; each task keeps one of a digest before the payloads are shuffled, once.
    rows.select("digest", "sha1", "bytes", "payload").dropDuplicates(["digest"]).write.parquet(f"{path}/payloads")

    named = rows.drop("payload").join(best, rows["digest"] == best["of"])
    revisit = (F.col("bytes") >= min_revisit) & ~F.col("page_id").eqNullSafe(F.col("holder"))
    kind = F.when(revisit, "revisit").otherwise("response")
    lines = [
        F.lit(VERSION + LINE),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("holder"), F.col("digest")))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Page-Id", F.col("page_id").cast("string")),
        _line("WARC-Refers-To-Page-Id", F.when(revisit, F.col("holder")).cast("string")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(LINE),
    ]
    named.select("digest", F.concat(*lines).alias("header")).write.parquet(f"{path}/headers")


def field(name: str) -> Column:
    """The value of a header line; null if the record has none."""
    value = F.regexp_extract("header", rf"\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payloads that are what their name says; others fail the read."""
    rows = spark.read.schema("digest string, sha1 string, bytes long, payload binary").parquet(f"{path}/payloads")
    whole = (F.sha2("payload", 256) == F.col("digest")) & (F.octet_length("payload") == F.col("bytes"))
    return rows.withColumn("digest", F.when(whole, F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("payload is damaged: "), "digest"))))


def _headers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("digest string, header string").parquet(f"{path}/headers")


def _rebuilt(spark: SparkSession, path: str) -> DataFrame:
    """Headers, payloads, and each record as it was (exact bytes)."""
    rows = _headers(spark, path).join(_payloads(spark, path), "digest")
    block = F.when(field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return rows.withColumn("record", F.concat(F.col("header").cast("binary"), block, F.lit((LINE * 2).encode())))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record as it was: page_id, record (exact bytes) and payload (a revisit's is its response's)."""
    return _rebuilt(spark, path).select(field("WARC-Page-Id").cast("long").alias("page_id"), "record", "payload")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, from the archive: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Every record is rebuilt. One whose length or payload is not what its header
    says fails the read.
    """
    rows = _rebuilt(spark, path)
    start, block = F.octet_length(F.col("header").cast("binary")), field("Content-Length").cast("int")
    body = F.when(field("WARC-Type") == "response", F.substring("record", start + 1, block)).otherwise(F.col("payload"))
    rows = rows.withColumn("whole", F.octet_length("record") == start + block + 2 * len(LINE))
    rows = rows.withColumn("sha1", F.sha1(body)).withColumn("payload_bytes", F.octet_length(body).cast("long"))
    whole = F.col("whole") & field("WARC-Payload-Digest").eqNullSafe(F.concat(F.lit("sha1:"), "sha1"))
    digest = F.when(whole, F.col("sha1")).otherwise(F.raise_error(F.concat(F.lit("record is damaged: "), F.coalesce(field("WARC-Record-ID"), F.lit("")))))
    return rows.select(
        field("WARC-Page-Id").cast("long").alias("page_id"), "payload_bytes", digest.alias("payload_digest"),
        field("WARC-Type").alias("record_type"), field("WARC-Refers-To-Page-Id").cast("long").alias("refers_to"),
    )


def archive(pages: DataFrame, path: str | None = None, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write ``pages`` and read the archive's index back (a new folder in the shared one by default).

    Null html is an empty payload, null urls are written as empty; repeated
    rows are records of their own; no pages give no rows.
    """
    spark = pages.sparkSession
    path = path or f"{shared_folder(spark)}/llm/warc-{uuid.uuid4().hex}"
    write(pages, path, min_revisit)
    return read_index(spark, path)
