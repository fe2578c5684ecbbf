"""Content-addressed web archive: payload bytes once by strong digest, record headers apart.

Two Parquet tables in the shared folder: ``payloads`` (sha256, payload) holds each
distinct payload once; ``records`` holds the exact header text of every record, its
type, the page it refers to and the digest.  A record is rebuilt by joining the two.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.session import run_folder

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Date of every record: the archive describes the table, not the moment of writing.
WARC_DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as 32 base-32 characters: five hex digits (20 bits) give four characters."""
    digest = F.sha1(payload)
    parts = []
    for at in range(0, 40, 5):
        number = F.conv(F.substring(digest, at + 1, 5), 16, 10).cast("int")
        parts += [F.substring(F.lit(BASE32), F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*parts)


@dataclass(frozen=True)
class Archive:
    """Where the two tables of an archive lie."""

    payloads: str
    records: str


def header(kind: str) -> Column:
    """The header block of a record, lines ended by CRLF and closed by an empty one."""
    lines = [
        F.lit("WARC/1.1"),
        F.lit(f"WARC-Type: {kind}"),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">")),
        F.lit(f"WARC-Date: {WARC_DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
    ]
    if kind == "revisit":
        lines += [
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")),
            F.lit("Content-Length: 0"),
        ]
    else:
        lines.append(F.concat(F.lit("Content-Length: "), F.col("payload_bytes").cast("string")))
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> Archive:
    """Archive every row of ``page_id, url, html``; null html is the empty payload.

    Of equal payloads of at least ``least_bytes`` bytes the row with the largest
    ``page_id`` is the response, the others revisit it; rows that share this largest
    id (or have no id at all) are all responses.  Smaller payloads are all responses.
    Other columns are not read.
    """
    spark = pages.sparkSession
    archive = Archive(f"{folder}/payloads", f"{folder}/records")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha256", F.sha2("payload", 256))
    heads = rows.select(
        "page_id", "url", "sha256", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"))
    heads.write.parquet(f"{folder}/heads")
    heads = spark.read.schema(heads.schema).parquet(f"{folder}/heads")

    # Equal digests must mean equal lengths and equal second digests; a clash stops the job.
    by_page = heads.groupBy("sha256", "page_id").agg(
        F.count("*").alias("n"), F.min("payload_bytes").alias("short"), F.max("payload_bytes").alias("long"),
        F.min("payload_digest").alias("low"), F.max("payload_digest").alias("high"))
    first = by_page.groupBy("sha256").agg(
        F.max(F.struct("page_id", "n")).alias("top"), F.min("short").alias("short"), F.max("long").alias("long"),
        F.min("low").alias("low"), F.max("high").alias("high")).select("*", F.col("top.page_id").alias("latest"), (F.col("top.n") > 1).alias("shared"))
    clash = (F.col("short") != F.col("long")) | (F.col("low") != F.col("high"))
    first = first.withColumn("latest", F.when(clash, F.raise_error(F.lit("payload digests clash"))).otherwise(F.col("latest")))
    chosen = first.select("sha256", "latest", "shared")

    revisit = (F.col("payload_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("latest"))
    typed = heads.join(chosen.drop("shared"), "sha256").withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("latest")))
    records = typed.select(
        "page_id", "sha256", "record_type", "refers_to",
        F.when(F.col("record_type") == "revisit", header("revisit")).otherwise(header("response")).alias("header"))
    records.write.parquet(archive.records)

    _stored(rows.select("page_id", "sha256", "payload"), chosen).write.parquet(archive.payloads)
    return archive


def _stored(keyed: DataFrame, chosen: DataFrame) -> DataFrame:
    """Each digest with the payload of its chosen row; payloads move once.

    Only the few whose chosen id several rows share (or that have no id) are made single by a second move.
    """
    named = chosen.select(F.col("latest"), F.col("sha256").alias("own"), "shared")
    on = F.col("page_id").eqNullSafe(F.col("latest")) & (F.col("sha256") == F.col("own"))
    found = keyed.join(named, on).select("sha256", "payload", "shared")
    several = found.where("shared").select("sha256", "payload").dropDuplicates(["sha256"])
    return found.where("not shared").select("sha256", "payload").unionByName(several)


def open_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """``sha256, payload``; a stored payload that doesn't have its digest stops the job."""
    stored = spark.read.schema("sha256 string, payload binary").parquet(archive.payloads)
    sound = F.sha2("payload", 256) == F.col("sha256")
    return stored.withColumn("payload", F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload is damaged")).cast("binary")))


RECORDS = "page_id long, sha256 string, record_type string, refers_to long, header string"


def open_records(spark: SparkSession, archive: Archive) -> DataFrame:
    return spark.read.schema(RECORDS).parquet(archive.records)


def rebuild(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record with its full payload and its exact bytes (``record``; a revisit carries no block)."""
    whole = open_records(spark, archive).join(open_payloads(spark, archive), "sha256")
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return whole.withColumn("record", F.concat(F.col("header").cast("binary"), block, F.lit(b"\r\n\r\n")))


def read_back(spark: SparkSession, archive: Archive) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` from the stored bytes and headers.

    Sizes and digests are taken from each stored payload before the join, so payloads don't move.
    """
    sizes = open_payloads(spark, archive).select(
        "sha256", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"))
    kind = F.regexp_extract("header", r"WARC-Type: (\w+)", 1)
    target = F.regexp_extract("header", r"WARC-Refers-To: <urn:page:(-?\d+)>", 1)
    records = open_records(spark, archive).select(
        "page_id", "sha256", kind.alias("record_type"), F.when(target != "", target).cast("long").alias("refers_to"))
    return records.join(sizes, "sha256").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write an archive into the shared folder and read it back."""
    spark = pages.sparkSession
    return read_back(spark, write(pages, run_folder(spark, "warc"), least_bytes))
