"""A content-addressed archive of web records.

Two tables: ``payloads`` holds the bytes of each different payload once, deflated, under its SHA-256; ``records`` holds
the exact header block of each record. Joining them on the digest gives the original records back. Rows are never
gathered by page: one shuffle moves each different payload to its digest, merging equal ones in the map tasks.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caselight.session import shared_dir


@dataclass(frozen=True)
class Archive:
    payloads: str
    records: str


def _crlf(*lines: Column) -> Column:
    return F.concat(*[part for line in lines for part in (line, F.lit("\r\n"))], F.lit("\r\n"))


def record_id(page: Column) -> Column:
    """A urn made of the page id; ``none`` stands for a null id."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> Archive:
    """Write one record per row. Returns the folders of both tables.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest id is a response and the
    others revisit it; records below ``min_bytes`` are all responses. A null payload is empty, a null url is written as
    an empty target, null ids come last. Rows that repeat the id of the response are responses too. Line breaks in a url
    are percent-encoded, so that it stays one header line. Other columns are not read.
    """
    spark = pages.sparkSession
    path = path or shared_dir(spark, "archive")
    out = Archive(f"{path}/payloads", f"{path}/records")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))

    def digest(batches: Iterator[pa.RecordBatch], keep_bytes: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # a few long payloads at a time
                part = batch.slice(at, 256)
                bodies = part.column("payload").to_pylist()
                columns = [part.column("id")]
                if keep_bytes:
                    columns.append(pa.array([zlib.compress(b, 6) for b in bodies], pa.binary()))
                else:
                    columns.append(part.column("url"))
                columns += [
                    pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary()),
                    pa.array([base64.b32encode(hashlib.sha1(b).digest()).decode() for b in bodies], pa.string()),
                    pa.array([len(b) for b in bodies], pa.int64())]
                names = ["id", "packed" if keep_bytes else "url", "strong", "sha1", "n_bytes"]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["id"].dataType.simpleString()
    shared = "strong binary, sha1 string, n_bytes long"
    packed = rows.select("id", "payload").mapInArrow(lambda it: digest(it, True), f"id {kind}, packed binary, {shared}")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id"))
    payloads = packed.groupBy("strong").agg(
        F.first("packed").alias("packed"), F.first("sha1").alias("sha1"), F.first("n_bytes").alias("n_bytes"),
        first.alias("keeper"))
    payloads.select("strong", "packed", "sha1", "n_bytes", F.col("keeper.id").alias("keeper_id")).write.option(
        "compression", "uncompressed").parquet(out.payloads)

    heads = rows.mapInArrow(lambda it: digest(it, False), f"id {kind}, url string, {shared}")
    keepers = spark.read.parquet(out.payloads).select(F.col("strong").alias("k"), "keeper_id")
    joined = heads.join(keepers, heads["strong"] == keepers["k"])
    is_response = (F.col("n_bytes") < min_bytes) | F.col("id").eqNullSafe(F.col("keeper_id"))
    target = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    common = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("id"))),
              F.concat(F.lit("WARC-Target-URI: "), target), F.lit(f"WARC-Date: {date}"),
              F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1"))]
    response = _crlf(*common, F.lit("WARC-Type: response"),
                     F.concat(F.lit("Content-Length: "), F.col("n_bytes").cast("string")))
    revisit = _crlf(*common, F.lit("WARC-Type: revisit"),
                    F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("keeper_id"))), F.lit("Content-Length: 0"))
    joined.select("strong", F.when(is_response, response).otherwise(revisit).alias("header")).write.parquet(out.records)
    return out


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """One row per record: record_key, header, payload, its size and digests computed anew, record_type, refers_key.

    The payload of a revisit is that of the response. A payload whose bytes no longer have their strong digest, or a
    header whose digest or length disagrees with the bytes, fails the read.
    """
    records = spark.read.parquet(archive.records)
    payloads = spark.read.parquet(archive.payloads).select("strong", "packed")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                bodies = [zlib.decompress(b) for b in part.column("packed").to_pylist()]
                if any(hashlib.sha256(b).digest() != s for b, s in zip(bodies, part.column("strong").to_pylist())):
                    raise ValueError("a stored payload does not have its digest")
                sha1 = ["sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode() for b in bodies]
                fields = [dict(line.split(": ", 1) for line in h[:-4].split("\r\n")[1:])
                          for h in part.column("header").to_pylist()]
                for field, body, d in zip(fields, bodies, sha1):
                    length = len(body) if field["WARC-Type"] == "response" else 0
                    if field["WARC-Payload-Digest"] != d or int(field["Content-Length"]) != length:
                        raise ValueError(f"header and payload of {field['WARC-Record-ID']} disagree")
                yield pa.RecordBatch.from_arrays([
                    pa.array([f["WARC-Record-ID"] for f in fields], pa.string()), part.column("header"),
                    pa.array(bodies, pa.binary()), pa.array([len(b) for b in bodies], pa.int64()),
                    pa.array([d[5:] for d in sha1], pa.string()), pa.array([f["WARC-Type"] for f in fields], pa.string()),
                    pa.array([f.get("WARC-Refers-To") for f in fields], pa.string())],
                    ["record_key", "header", "payload", "payload_bytes", "payload_digest", "record_type", "refers_key"])

    return records.join(payloads, "strong").select("strong", "header", "packed").mapInArrow(
        unpack, "record_key string, header string, payload binary, payload_bytes long, payload_digest string, "
                "record_type string, refers_key string")


def page_id_of(key: Column) -> Column:
    """The page id in a record key; null for the key of a null id."""
    return F.regexp_extract(key, "<urn:page:(.*)>", 1).try_cast("long")
