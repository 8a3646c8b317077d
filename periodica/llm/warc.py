"""Content-addressed archive of web records.

``write_archive`` keeps every payload once, under its SHA-256, and the exact header
bytes of every record apart from it. ``read_archive`` joins them again, verifies the
digests and returns the original WARC 1.1 records byte for byte.

Null payloads are empty, a null address has no WARC-Target-URI line, line breaks in
an address are percent-encoded. Rows that repeat an id and a payload are written as
often as they occur. A null id counts as greater than any other when the response of
a payload is chosen. Empty tables give empty archives. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import staged

# The two alphabets of base 32 and the identical-payload profile.
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_EOL = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: 160 bits are eight groups of five hex digits, four letters each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), _DIGITS, _BASE32)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(_EOL))


def _record_name(record_id: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(record_id.cast("string"), F.lit("null")), F.lit(">"))


def write_archive(
    records: DataFrame, folder: str, record_id: str = "page_id", uri: str = "url", payload: str = "html",
    min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write ``payloads`` and ``headers`` below ``folder``.

    Of records with equal payloads of ``min_bytes`` or more, the one with the smallest
    id is a response and the others revisit it; records with smaller payloads are all
    responses. Only the payload itself is shuffled by its digest, once; copies meet in
    a partial aggregate first, so a payload that a third of all records share is no
    hot key there. Headers meet the choice in a join that adaptive execution splits.
    """
    rows = records.select(
        F.col(record_id).alias("record_id"), F.col(uri).cast("string").alias("uri"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    keys = staged(
        rows.select("record_id", "uri", "digest", F.length("payload").cast("long").alias("bytes"),
                    base32_sha1(F.col("payload")).alias("sha1")),
        "warc-keys",
    )
    first = keys.groupBy("digest").agg(
        F.min("record_id").alias("first_id"), F.min(F.struct("bytes", "sha1")).alias("low"),
        F.max(F.struct("bytes", "sha1")).alias("high"),
    )
    # The digest is verified by an independent one: payloads that share it share length and SHA-1.
    first = first.where(
        F.when(F.col("low") == F.col("high"), True).otherwise(F.raise_error(F.lit("payloads differ under one digest")))
    ).select("digest", "first_id")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_EOL}Content-Type: text/html; charset=utf-8{_EOL}"),
        _line("Content-Length", F.col("bytes").cast("string")), F.lit(_EOL),
    )
    revisit = (F.col("bytes") >= min_bytes) & ~F.col("record_id").eqNullSafe(F.col("first_id"))
    block_bytes = F.length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    clean = F.replace(F.replace(F.col("uri"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit(f"WARC/1.1{_EOL}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_name(F.col("record_id"))),
        F.coalesce(_line("WARC-Target-URI", clean), F.lit("")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit(_PROFILE)),
                                 _line("WARC-Refers-To", _record_name(F.col("first_id"))))).otherwise(""),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", block_bytes.cast("string")),
        F.lit(_EOL),
    )
    (
        keys.join(first, "digest")
        .select("record_id", "digest", header.cast("binary").alias("header"), http.cast("binary").alias("http"))
        .write.option("compression", "zstd").parquet(f"{folder}/headers")
    )
    (
        rows.groupBy("digest").agg(F.any_value("payload").alias("payload"))
        .write.option("compression", "zstd").parquet(f"{folder}/payloads")
    )


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive: ``record_id``, ``record`` (the exact bytes), ``header`` text and ``payload``.

    A revisit carries the payload it refers to in ``payload`` and none in ``record``.
    A stored payload that does not match its digest, or is absent, ends the job.
    """
    stored = spark.read.parquet(f"{folder}/payloads").select(
        F.col("digest").alias("stored_digest"),
        F.when(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.col("payload"))
        .otherwise(F.raise_error(F.lit("a stored payload does not match its digest"))).alias("payload"),
    )
    headers = spark.read.parquet(f"{folder}/headers")
    joined = headers.join(stored, F.col("digest") == F.col("stored_digest"), "left")
    payload = F.when(F.col("stored_digest").isNotNull(), F.col("payload")).otherwise(
        F.raise_error(F.lit("a payload is missing from the archive")))
    header = F.col("header").cast("string")
    body = F.when(header.contains(f"{_EOL}WARC-Type: revisit{_EOL}"), F.lit(b"")).otherwise(payload)
    return joined.select(
        "record_id", F.concat("header", "http", body, F.lit(b"\r\n\r\n")).alias("record"),
        header.alias("header"), payload.alias("payload"),
    )


def header_field(header: Column, name: str) -> Column:
    """The value of a header line, null where there is none."""
    return F.nullif(F.regexp_extract(header, f"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))


def record_facts(records: DataFrame) -> DataFrame:
    """What the records say, checked against their bytes: one row per record.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, also for
    revisits; a header with another digest or block length ends the job.
    """
    digest = base32_sha1(F.col("payload"))
    agrees = (header_field(F.col("header"), "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), digest)) & (
        F.length("record") == F.octet_length("header") + header_field(F.col("header"), "Content-Length").cast("int") + 4)
    refers = F.regexp_extract(header_field(F.col("header"), "WARC-Refers-To"), "^<urn:record:(.*)>$", 1)
    return records.select(
        F.col("record_id"), F.length("payload").cast("long").alias("payload_bytes"),
        F.when(agrees, digest).otherwise(F.raise_error(F.lit("a record disagrees with its header")))
        .alias("payload_digest"),
        header_field(F.col("header"), "WARC-Type").alias("record_type"),
        F.nullif(refers, F.lit("null")).cast(records.schema["record_id"].dataType).alias("refers_to"),
    )
