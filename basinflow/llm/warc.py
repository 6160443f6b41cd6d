"""Content-addressed WARC archive.

An archive is two tables in one folder.  ``payloads`` has each distinct payload once, under its
SHA-256, beside the record that holds it.  ``headers`` has the exact header block of each record.
A record's bytes are its header, its payload (none for a revisit) and two line ends, so records
are rebuilt by joining the tables; both digests are checked against the stored bytes.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut

#: The RFC 4648 base32 alphabet and the revisit profile of WARC 1.1.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
#: Groups of pages with equal payloads that are broadcast (about 100 bytes each); beyond it payloads are shuffled.
BROADCAST_GROUPS = 200_000


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 SHA-1 of binary data: each five hex digits of the digest are four letters."""
    digest = F.sha1(data)
    letters = []
    for i in range(8):
        bits = F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def record_id(page_id: Column, number: Column) -> Column:
    """A record's id: the page's, and the number of its row, as page ids can repeat."""
    return F.concat(F.lit("<urn:basinflow:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), number.cast("string"), F.lit(">"))


def header_block(revisit: Column, date: str) -> Column:
    """The header lines of a record, without the empty line that ends them.

    Line ends in a URL would end the line early, so they are percent-encoded.
    """
    url = F.replace(F.replace(F.coalesce(F.col("url"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("number"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        F.when(revisit, F.concat(line("WARC-Refers-To", record_id(F.col("first_id"), F.col("first_number"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        line("X-Payload-Key", F.concat(F.lit("sha256:"), F.col("content_key"))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string")), F.lit(CRLF),
    )


def write_archive(pages: DataFrame, path: str, min_payload: int = 0, date: str | None = None) -> None:
    """Write ``pages(page_id, url, html)`` to an archive in ``path``; ``date`` is that of the records (now, if not given).

    Of the records with equal payloads of at least ``min_payload`` bytes the one with the smallest
    page_id is the response and the others revisit it; smaller payloads are all responses.  A null
    html is an empty payload, a null url an empty target.  Of rows with the same page_id and payload
    one is the response, and the others revisit that id.  Null ids come after all others.  An empty
    table gives an archive without records; other columns are ignored.

    Groups of equal payloads are found by digests alone; payloads go from the scan to the archive.
    """
    spark = pages.sparkSession
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    key = F.sha2(body, 256).alias("content_key")
    # written first: the numbers of the rows are fixed then
    narrow = pages.select("page_id", "url", key, F.octet_length(body).cast("long").alias("payload_bytes"), base32_sha1(body).alias("payload_digest"))
    narrow = cut(narrow.withColumn("number", F.monotonically_increasing_id()), "narrow")
    ids = narrow.groupBy("content_key", "page_id").agg(F.count("*").alias("same"), F.min("number").alias("number"))
    firsts = ids.groupBy("content_key").agg(F.min(F.struct(F.col("page_id").isNull().alias("late"), "page_id", "same", "number")).alias("one"), F.sum("same").alias("n"))
    firsts = cut(firsts.where("n > 1").select("content_key", F.col("one.page_id").alias("first_id"), "one.same", F.col("one.number").alias("first_number")), "firsts")
    revisit = F.col("first_number").isNotNull() & (F.col("number") != F.col("first_number")) & (F.col("payload_bytes") >= min_payload)
    headers = narrow.join(firsts, "content_key", "left").select("page_id", "content_key", header_block(revisit, date).alias("header"))
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")
    groups, repeated = firsts.agg(F.count("*"), F.count(F.when(F.col("same") > 1, 1))).first()
    marked = pages.select("page_id", body.alias("payload"), key).join(F.broadcast(firsts) if groups <= BROADCAST_GROUPS else firsts, "content_key", "left")
    first = F.col("page_id").eqNullSafe(F.col("first_id"))
    stored = marked.where(F.col("first_number").isNull() | first & (F.col("same") == 1)).select("content_key", "payload")
    if repeated:  # rows with the same id and payload: any of them
        stored = stored.unionByName(marked.where(first & (F.col("same") > 1)).select("content_key", "payload").dropDuplicates(["content_key"]))
    stored.withColumn("payload_digest", base32_sha1(F.col("payload"))).write.option("compression", "zstd").parquet(f"{path}/payloads")


def field(name: str) -> Column:
    return F.regexp_extract(F.col("header"), rf"(?:^|\n){name}: ([^\r]*)\r\n", 1)


def stated(head: DataFrame) -> DataFrame:
    """``head(header, ...)`` with what each header states."""
    return head.select(
        "*",
        field("WARC-Type").alias("record_type"), field("WARC-Target-URI").alias("url"),
        field("X-Payload-Length").cast("long").alias("payload_bytes"),
        F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("payload_digest"),
        F.nullif(field("WARC-Refers-To"), F.lit("")).alias("refers"),
    ).withColumn("refers_to", F.regexp_extract("refers", r"page:(-?\d+):\d+>", 1)).withColumn("refers_to", F.expr("try_cast(refers_to AS bigint)")).drop("refers")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive as their headers state them."""
    return stated(spark.read.parquet(f"{path}/headers").select("page_id", "content_key", "header"))


def verified_payloads(spark: SparkSession, path: str) -> DataFrame:
    """content_key and the payload, with both digests computed anew from the stored bytes; a mismatch raises."""
    kept = spark.read.parquet(f"{path}/payloads")
    good = (F.sha2("payload", 256) == F.col("content_key")) & (base32_sha1(F.col("payload")) == F.col("payload_digest"))
    return kept.withColumn("checked_key", F.when(good, F.col("content_key")).otherwise(F.raise_error(F.concat(F.lit("payload does not match its digest: "), F.col("content_key")))))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record with ``record`` (its exact bytes) and ``payload`` (a revisit's is that of its response)."""
    payloads = verified_payloads(spark, path).select(F.col("checked_key").alias("content_key"), "payload")
    empty = F.lit(b"")
    end = F.lit(CRLF.encode())
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(empty)
    return read_headers(spark, path).join(payloads, "content_key").withColumn("record", F.concat(F.col("header").cast("binary"), end, body, end, end))


def archive_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per page what its rebuilt record says, with the length and digest of the payload that is read back from it.

    A response's payload is the part of the record that Content-Length gives; a revisit has none and takes that of
    its response.  A record whose length or payload is not as its header states raises.
    """
    # no header has an empty line inside: line ends in URLs are encoded
    head = F.concat(F.substring_index(F.col("record").cast("string"), CRLF + CRLF, 1), F.lit(CRLF))
    told = stated(read_records(spark, path).select("page_id", "record", F.col("payload").alias("joined"), head.alias("header")))
    size, start = field("Content-Length").cast("int"), F.octet_length("header") + len(CRLF)
    own = F.substring(F.col("record"), start + 1, size)
    back = told.select(
        "page_id", "record_type", "refers_to", F.col("payload_bytes").alias("stated_bytes"), F.col("payload_digest").alias("stated_digest"),
        (F.octet_length("record") == start + size + 2 * len(CRLF)).alias("fits"),
        F.when(F.col("record_type") == "response", own).otherwise(F.col("joined")).alias("payload"),
    )
    back = back.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})
    good = F.col("fits") & (F.col("payload_bytes") == F.col("stated_bytes")) & (F.col("payload_digest") == F.col("stated_digest"))
    wrong = F.raise_error(F.concat(F.lit("record is not as its header states: "), F.coalesce(F.col("page_id").cast("string"), F.lit("no id"))))
    return back.select("page_id", F.when(good, F.col("payload_bytes")).otherwise(wrong).alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
