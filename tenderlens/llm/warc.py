"""Content-addressed WARC archive: payload bytes once per digest, exact record headers apart, joined when read.

An archive folder holds two tables. ``payloads`` (digest, payload) has each payload's bytes once under its SHA-256;
``headers`` (record, header, digest) has the header block of every record byte for byte. ``read_records`` puts them
together again: header, blank line, block, two line ends, as the format demands; ``parse_records`` reads those bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import step

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_uri(record: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), record.cast("string"), F.lit(">"))


def header_block(record: Column, url: Column, sha1: Column, size: Column, refers_to: Column, date: str) -> Column:
    """Header lines up to and with the empty line. NULL fields have no line; line ends in a url are percent-encoded."""
    revisit = refers_to.isNotNull()
    safe = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit(CRLF))

    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_uri(record)),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", safe), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        F.coalesce(line("WARC-Refers-To", record_uri(refers_to)), F.lit("")),
        F.when(revisit, line("WARC-Profile", F.lit(PROFILE))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(size).cast("string")),
        F.lit(CRLF),
    )


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_revisit_bytes: int = 1000,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write one record per row below ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes the largest id is a response and the others
    revisit it; rows that repeat that id are responses, and so is a row with a NULL id, which nothing refers to. NULL
    html is an empty payload. Equality is by digest and full content; two contents under one SHA-256 raise an error.
    """
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("record"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Copies are combined within each map task first, so a payload on a third of the pages is one row per task.
    stored = rows.groupBy("digest", "payload").agg(F.max("record").alias("holder"))
    stored = stored.withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")
    spark = pages.sparkSession
    held = spark.read.schema(stored.schema).parquet(f"{path}/payloads").select("digest", "holder", "sha1", "size")
    clash = held.groupBy("digest").count().where("count > 1").limit(1).collect()
    if clash:
        raise ValueError(f"different payloads have the SHA-256 {clash[0]['digest']}")
    records = rows.select("record", "url", "digest").join(held, "digest")
    refers = F.when((F.col("size") >= min_revisit_bytes) & (F.col("record") != F.col("holder")), F.col("holder"))
    header = header_block(F.coalesce("record", F.lit(-1)), F.col("url"), F.col("sha1"), F.col("size"), refers, date)
    records.select("record", header.alias("header"), "digest").write.option("compression", "zstd").parquet(f"{path}/headers")


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """``record_bytes`` of each record as archived: header, empty line, block, two line ends.

    Only responses meet their payload; a revisit has no block. With ``with_payload`` each row also has its ``payload``, a
    revisit that of the record it refers to.
    """
    headers = spark.read.schema("record long, header string, digest string").parquet(f"{path}/headers")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    revisit = F.col("header").contains(CRLF + "WARC-Type: revisit" + CRLF)
    end = F.lit((CRLF * 2).encode())
    whole = F.concat(F.encode("header", "UTF-8"), F.col("payload"), end).alias("record_bytes")
    bare = F.concat(F.encode("header", "UTF-8"), end).alias("record_bytes")
    full, again = headers.where(~revisit).join(payloads, "digest"), headers.where(revisit)
    if with_payload:
        return full.select(whole, "payload").unionByName(again.join(payloads, "digest").select(bare, "payload"))
    return full.select(whole).unionByName(again.select(bare))


def field(name: str) -> Column:
    """A header field's value, NULL without it."""
    return F.nullif(F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))


def parse_records(records: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Fields and block of each record, from its bytes alone.

    The header ends at the first empty line; the block has ``Content-Length`` bytes and is followed by two line ends. A
    revisit takes ``payload_bytes`` and ``payload_digest`` from the block of the record it refers to. ``payload_digest``
    is the SHA-1 of the block that was read, NULL if the header's differs, the length is wrong, or no such record is there.
    """
    uri = r"<urn:page:(-?[0-9]+)>"
    number = lambda c: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), uri, 1), F.lit("")).cast("long")
    head = F.substring_index(F.col("record_bytes").cast("string"), CRLF * 2, 1)
    start = F.octet_length("header") + len(CRLF)
    cut = records.select("record_bytes", F.concat(head, F.lit(CRLF)).alias("header"))
    cut = cut.withColumn("length", field("Content-Length").try_cast("int"))
    whole = F.octet_length("record_bytes") == start + F.col("length") + 2 * len(CRLF)
    block = F.when(whole, F.substring("record_bytes", start + 1, F.col("length")))
    parsed = cut.select(
        number(field("WARC-Record-ID")).alias(id_col),
        F.octet_length(block).cast("long").alias("payload_bytes"),
        F.sha1(block).alias("found"),
        F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("stated"),
        field("WARC-Type").alias("record_type"),
        number(field("WARC-Refers-To")).alias("refers_to"),
        field("WARC-Target-URI").alias("url"),
        F.octet_length("record_bytes").cast("long").alias("record_length"),
    )
    # Both sides of the join read this: the payloads are not put together a second time.
    parsed = step(parsed, "records")
    held = parsed.where("record_type = 'response'")
    # rows that repeat an id are responses each, with equal payloads if anything refers to them
    target = held.groupBy(F.col(id_col).alias("refers_to")).agg(F.min(F.struct("payload_bytes", "found")).alias("t"))
    again = parsed.where("record_type = 'revisit'").drop("payload_bytes", "found").join(target, "refers_to", "left")
    again = again.select(*[c for c in again.columns if c != "t"], "t.payload_bytes", "t.found")
    out = held.unionByName(again)
    digest = F.when(F.col("found") == F.col("stated"), F.col("found")).alias("payload_digest")
    return out.select(id_col, "payload_bytes", digest, "record_type", "refers_to", "url", "record_length")
