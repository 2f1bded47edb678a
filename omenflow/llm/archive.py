"""WARC, content-addressed archive.

Each payload's bytes are stored once, under a strong digest (SHA-256) that is checked again whenever the archive is
read; the exact WARC record headers are stored apart, one row a record, and joins put the original records together.

Cases: a null payload counts as empty; empty payloads are records like any others; equal payloads (ties) have the
record with the largest id as their response and the rest as revisits; rows with the same id and payload are equal
records and each is kept; a null id sorts below every other id; a null url gives an empty target header; control
bytes of a url or an id, such as line breaks, are percent-encoded there, so that they can't forge other headers.  An empty
table gives an empty archive.  Columns of the input other than the three named ones are not looked at.
"""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import salted_join, shared_dir, table

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: References to one payload that one task joins: more than that are dealt over salts.
REFS_PER_SALT = 2000


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of some bytes: 160 bits are 4 times 40 bits, each 8 letters."""
    hexed = F.sha1(data)
    parts = []
    for i in range(4):
        bits = F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 10).cast("long")
        parts += [F.substring(F.lit(BASE32), (F.shiftright(bits, 35 - 5 * k).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for k in range(8)]
    return F.concat(*parts)


def one_line(value: Column) -> Column:
    """A header's value: control bytes, which could end its line, are percent-encoded; null is empty."""
    value = F.coalesce(value.cast("string"), F.lit(""))
    safe = reduce(lambda v, k: F.replace(v, F.lit(chr(k)), F.lit(f"%{k:02X}")), [*range(32), 127], value)
    return F.when(value.rlike(r"[\x00-\x1F\x7F]"), safe).otherwise(value)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, date: str | None = None) -> None:
    """Write ``headers`` and ``payloads`` below ``path``.

    ``min_bytes``: payloads of fewer bytes are never revisited; each such record is a response of its own.  ``date``:
    the records' WARC-Date, the time of the call if not given.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    # One pass moves ids and digests, no payloads.
    keys = rows.select("id", "url", F.sha2("payload", 256).alias("sha256"), base32_sha1(F.col("payload")).alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes"))
    keys = keys.withColumn("row", F.monotonically_increasing_id())
    owners = keys.groupBy("sha256").agg(F.max("id").alias("response_id"), F.count("*").alias("refs"))
    joined = salted_join(keys, owners.select("sha256", "response_id", F.ceil(F.col("refs") / REFS_PER_SALT).cast("int").alias("salts"), F.col("refs").alias("_n")), "sha256", how="inner")
    revisit = (F.col("n_bytes") >= min_bytes) & (F.coalesce(F.col("id") != F.col("response_id"), F.col("response_id").isNotNull()))
    length = F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), one_line(F.col("id")), F.lit(">\r\nWARC-Date: "), F.lit(date), F.lit("\r\nWARC-Target-URI: "), one_line(F.col("url")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("sha1"), F.lit("\r\nContent-Type: text/html; charset=utf-8"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), one_line(F.col("response_id")), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"),
    )
    salt = F.pmod(F.xxhash64("row"), F.col("salts")).cast("int")
    headers = joined.select("id", header.cast("binary").alias("header"), "sha256", salt.alias("salt"))
    headers.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/headers")
    # The other moves payloads: of copies one from each task.
    payloads = rows.select(F.sha2("payload", 256).alias("sha256"), "payload").groupBy("sha256").agg(F.count("*").alias("refs"), F.any_value("payload").alias("payload"))
    payloads = payloads.select("sha256", F.ceil(F.col("refs") / REFS_PER_SALT).cast("int").alias("salts"), "payload")
    payloads.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The original records: ``id, header, payload`` (the header's and the payload's exact bytes).

    A payload whose bytes don't have the digest it is stored under raises an error.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    checked = payloads.select("sha256", "salts", F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload damaged: "), F.col("sha256")))).alias("payload"))
    spread = checked.select("sha256", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "payload")
    return headers.join(spread, ["sha256", "salt"]).select("id", "header", "payload")


def field(header: Column, name: str) -> Column:
    """A header field of a record, null if it has none; values have no line breaks."""
    found = F.regexp_extract(F.decode(header, "UTF-8"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def record_bytes(header: Column, payload: Column) -> Column:
    """A whole WARC record as it stands in a file; a revisit has no block."""
    block = F.when(field(header, "WARC-Type") == "revisit", F.lit("").cast("binary")).otherwise(payload)
    return F.concat(header, block, F.lit("\r\n\r\n").cast("binary"))


def records(read: DataFrame) -> DataFrame:
    """What the records that were read, put together again, say.

    A record whose block hasn't the length that its header states raises an error.
    """
    kind = dict(read.dtypes)["id"]
    whole = read.select("id", "payload", record_bytes(F.col("header"), F.col("payload")).alias("record"), F.octet_length("header").alias("begin"))
    header = F.substring("record", F.lit(1), F.col("begin"))
    block = F.octet_length("record") - F.col("begin") - 4
    stated = field(header, "Content-Length").cast("long") == block
    return whole.select(
        F.col("id"), F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"),
        F.when(stated, field(header, "WARC-Type")).otherwise(F.raise_error(F.concat(F.lit("record damaged: "), F.decode(header, "UTF-8")))).alias("record_type"),
        F.regexp_extract(field(header, "WARC-Refers-To"), r"^<urn:page:(.*)>$", 1).cast(kind).alias("refers_to"),
    )


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    write_archive(table(spark, sf_dir, "pages"), path)
    return records(read_archive(spark, path)).withColumnRenamed("id", "page_id")


#: DuckDB has no base32: each five bits are read from the hex digest's number.
OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x FROM p),
e AS (SELECT page_id, payload_bytes, x, max(page_id) OVER (PARTITION BY x) AS top FROM d)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(x, (10 * (i // 8) + 1)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM e
"""
