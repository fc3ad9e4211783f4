"""A content-addressed web archive: payload bytes once by digest, record headers apart, records rebuilt by a join.

The archive is two tables. `headers` has one row per record: its exact header bytes as text and the SHA-256 of its
payload. `payloads` has each payload once under that digest; every read computes the digest again and fails if the
bytes do not match. A record is the header followed, for a response, by the payload; the payload of a revisit is found
under the same digest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import stage

CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the WARC 1.1 standard


@dataclass
class Archive:
    headers: DataFrame  # page_id, header, payload_key
    payloads: DataFrame  # payload_key, payload


def _header(date: str) -> Column:
    """The header block of a record, from the columns of `_hashed` and its kind."""

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    def urn(page_id: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))

    revisit = F.col("record_type") == "revisit"
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", urn(F.col("page_id"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]+", "%20")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        field("WARC-Refers-To", F.when(revisit, urn(F.col("holder")))),
        field("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        field("Content-Type", F.when(~revisit, F.lit("text/html; charset=utf-8"))),
        field("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
        F.lit(CRLF),
    )


def build_archive(pages: DataFrame, least_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z") -> Archive:
    """Write one record per row of pages (page_id, url, html) into a new archive; a null html is the empty payload.

    Of rows with equal payloads of at least `least_bytes`, the one with the largest page_id is the response and the
    others are revisits of it; equal page_ids there are all responses. Rows without a page_id never hold a group
    that has one. Other columns are not used; an empty table gives an empty archive.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    hashed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    hashed = hashed.withColumns({"payload_key": F.sha2("payload", 256), "n_bytes": F.octet_length("payload")})
    # Only payloads that several rows share are looked up; they are written first, so that the join below has two
    # plain inputs and Spark can split a payload that a third of all rows share.
    shared = hashed.groupBy("payload_key").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("holder")).where("n > 1")
    shared = stage(shared.drop("n"), "warc-shared")
    placed = hashed.join(shared, "payload_key", "left")
    own = F.col("holder").isNull() | F.col("page_id").eqNullSafe(F.col("holder"))
    kind = F.when(own | (F.col("n_bytes") < least_bytes), "response").otherwise("revisit")
    headers = placed.withColumns({"record_type": kind, "sha1": F.sha1("payload")}).select("page_id", _header(date).alias("header"), "payload_key")
    payloads = placed.where(own).select("payload_key", "payload").dropDuplicates(["payload_key"])
    return Archive(stage(headers, "warc-headers"), stage(payloads, "warc-payloads"))


def header_field(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)


def read_archive(archive: Archive) -> DataFrame:
    """Every record again: page_id, url, record_type, refers_to, header, payload, payload_bytes, payload_digest, record.

    `payload` is the full payload also of a revisit, `record` the bytes of the record as a WARC file has them. Length
    and digests come from the stored bytes, before the join, so that a reader that needs no bytes moves none.
    """
    sound = F.sha2("payload", 256) == F.col("payload_key")
    stored = archive.payloads.select(
        "payload_key",
        "payload",
        F.when(sound, F.octet_length("payload")).otherwise(F.raise_error(F.concat(F.lit("payload does not match "), "payload_key"))).cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    page = F.regexp_extract("header", r"\r\nWARC-Record-ID: <urn:page:(-?\d+)>\r\n", 1)
    refers = F.regexp_extract("header", r"\r\nWARC-Refers-To: <urn:page:(-?\d+)>\r\n", 1)
    block = F.when(header_field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    records = archive.headers.select("header", "payload_key").join(stored, "payload_key")
    return records.select(
        F.when(page != "", page.cast("long")).alias("page_id"),
        F.nullif(header_field("WARC-Target-URI"), F.lit("")).alias("url"),
        header_field("WARC-Type").alias("record_type"),
        F.when(refers != "", refers.cast("long")).alias("refers_to"),
        "header",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.concat(F.encode("header", "UTF-8"), block, F.lit(2 * CRLF).cast("binary")).alias("record"),
    )
