"""Content-addressed WARC archive.

``write_archive`` stores two tables below a folder: ``payloads`` holds the bytes
of every distinct payload once under its SHA-256, ``records`` the exact header
bytes of every record with the digest of its payload. ``read_archive`` joins the
two, checks every payload against its digest and its record's lengths, and gives
the original records back. Payloads are only moved where they are stored or
reconstructed; grouping works on digests and is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.llm.common import fits_broadcast, stage

MIN_REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of WARC 1.1
_EOL = "\r\n"


def _line(name: str, value: Column) -> Column:
    """One header line, absent where the value is null; line breaks inside a value are percent-encoded."""
    safe = F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(_EOL)), F.lit(""))


def _urn(i: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_revisit: int = MIN_REVISIT_BYTES, date: str = DATE) -> None:
    """Write one WARC record per row.

    Payload: ``payload_col`` in UTF-8, null as empty. Of records with equal
    payloads of at least ``min_revisit`` bytes the one with the largest id is a
    response and the others revisit it; smaller ones are all responses. Rows
    repeating the largest id are all responses; null ids sort below all others
    and rows without any id in their group are responses. A null URL has no
    target line. Other columns are ignored; an empty table writes empty tables.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"), payload.alias("_payload"))
    digests = [F.sha2("_payload", 256).alias("_digest"), F.sha1("_payload").alias("_sha1"), F.octet_length("_payload").cast("long").alias("_bytes")]
    narrow = stage(rows.select("_id", "_url", *digests), "warc-rows")
    groups = (narrow.groupBy("_digest").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
              .where("_n > 1"))
    groups = stage(groups, "warc-groups")
    few = fits_broadcast(groups, 96)
    shared = F.broadcast(groups) if few else groups
    records = narrow.join(shared, "_digest", "left")
    revisit = (F.col("_n") > 1) & (F.col("_bytes") >= min_revisit) & F.col("_keep").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_keep"))
    revisit = F.coalesce(revisit, F.lit(False))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_EOL}Content-Type: text/html; charset=utf-8{_EOL}Content-Length: "),
                    F.col("_bytes").cast("string"), F.lit(_EOL + _EOL))
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("_bytes"))
    header = F.concat(
        F.lit(f"WARC/1.1{_EOL}"), _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _urn(F.col("_id"))), _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("_url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_sha1"))),
        _line("WARC-Refers-To", F.when(revisit, _urn(F.col("_keep")))), _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("Content-Type", F.lit("application/http; msgtype=response")), _line("Content-Length", block.cast("string")), F.lit(_EOL), http)
    records.select(header.cast("binary").alias("header"), F.col("_digest").alias("digest"), F.col("_bytes").alias("payload_bytes")) \
        .write.parquet(f"{folder}/records")
    # One row of each payload carries its bytes into the store: the row with the largest id.
    stored = rows.select("_id", "_payload", F.sha2("_payload", 256).alias("_digest")).join(shared, "_digest", "left")
    stored = stored.where("_n is null or _id <=> _keep")
    tied = stored.where("_n > 1").dropDuplicates(["_digest"])
    stored.where("_n is null").unionByName(tied).select(F.col("_digest").alias("digest"), F.col("_payload").alias("payload")) \
        .write.parquet(f"{folder}/payloads")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Records rebuilt by joining headers with payloads.

    Columns: ``header`` (exact bytes through the HTTP head), ``payload`` (for
    revisits the payload they refer to), ``record`` (the record's own bytes),
    ``page_id, record_type, target_uri, payload_digest, refers_to`` as parsed
    from the header. Fails where a payload is missing, does not hash to its
    digest, or has another length than its record says.
    """
    records = spark.read.schema("header binary, digest string, payload_bytes long").parquet(f"{folder}/records")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{folder}/payloads")
    verified = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not hash to its digest "), F.col("digest"))).cast("binary"))
    joined = records.join(payloads.select("digest", verified.alias("payload")), "digest", "left")
    text = F.col("header").cast("string")
    field = lambda name: F.nullif(F.regexp_extract(text, rf"(?md)^{name}: ([^\r\n]*)", 1), F.lit(""))
    page = lambda name: F.regexp_extract(text, rf"(?md)^{name}: <urn:page:(-?\d+)>", 1).try_cast("long")
    whole = F.when(F.octet_length("payload") == F.col("payload_bytes"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload missing or of another length: "), F.col("digest"))).cast("binary"))
    kind = field("WARC-Type")
    return joined.withColumn("payload", whole).select(
        "header", "payload", F.when(kind == "revisit", F.col("header")).otherwise(F.concat("header", "payload")).alias("record"),
        page("WARC-Record-ID").alias("page_id"), kind.alias("record_type"), field("WARC-Target-URI").alias("target_uri"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"), page("WARC-Refers-To").alias("refers_to"))
