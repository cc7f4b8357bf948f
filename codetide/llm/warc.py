"""Content-addressed web archive.

An archive is a folder of two tables. ``payloads`` holds the bytes of every distinct payload once, under their SHA-256.
``headers`` holds the exact header block of every record. Reading joins the two, rebuilds the records byte for byte and
checks lengths and both digests against the bytes.

Of the records with equal payloads of at least ``LEAST_REVISIT`` bytes that with the largest page_id is the response
and the others are revisits of it; smaller ones are all responses. A revisit record has no block of its own; reading it gives the
payload it refers to.

Defined cases: a null payload is an empty one; a null page_id counts as smaller than any other; rows with the same
page_id and payload are one record each, of one type; a null url leaves the header line out; other columns are ignored; no rows
give an archive without records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetide.llm.common import materialise
from codetide.session import scratch_path

LEAST_REVISIT = 1000
#: The lines of a record by the archive format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def payload_digests(pages: DataFrame) -> DataFrame:
    """page_id, url, both digests and length of every page; the payloads stay behind."""
    return pages.select(
        "page_id", "url",
        F.sha2(_payload(), 256).alias("sha256"), F.sha1(_payload()).alias("sha1"),
        F.octet_length(_payload()).cast("long").alias("payload_bytes"),
    )


def record_types(digests: DataFrame) -> DataFrame:
    """Adds record_type and refers_to. Groups are combined before they are shuffled."""
    large = F.col("payload_bytes") >= LEAST_REVISIT
    groups = digests.where(large).groupBy("sha256").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("copies"))
    shared = groups.where("copies > 1").select("sha256", "keeper")
    typed = digests.join(shared, "sha256", "left")
    revisit = F.col("keeper").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("keeper")))
    return typed.select(
        *digests.columns,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keeper")).alias("refers_to"),
    )


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def header_block() -> Column:
    """Header lines of a record with the empty line that ends them. Only responses have a block."""
    revisit = F.col("record_type") == "revisit"
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", "")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2))


def write_archive(pages: DataFrame, path: str) -> None:
    """Write the two tables under ``path``.

    Which rows carry a payload that another row stores, too, is decided on the digests. Only the list of those rows meets
    the payloads; Spark broadcasts it while it is under its size limit and shuffles beyond.
    """
    digests = materialise(payload_digests(pages), "digests")
    records = materialise(record_types(digests), "records")
    records.select("page_id", "sha256", header_block().alias("header")).write.parquet(f"{path}/headers")

    # A payload is stored from the rows of its largest page_id.
    holders = digests.groupBy("sha256").agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("rows"))
    shared = holders.where("rows > 1").select("sha256", "holder")
    skipped = materialise(
        digests.join(shared, "sha256")
        .groupBy("page_id", "sha256").agg(F.count(F.lit(1)).alias("rows"), F.max("holder").alias("holder"))
        .select("page_id", "sha256", (F.col("page_id").eqNullSafe(F.col("holder"))).alias("holds"), (F.col("rows") > 1).alias("repeated"))
        .where("not holds or repeated"),
        "skipped",
    )
    stored = pages.select("page_id", F.sha2(_payload(), 256).alias("sha256"), _payload().alias("payload"))
    ids = skipped.select(F.col("page_id").alias("skip_id"), F.col("sha256").alias("skip_sha256"))
    same = F.col("page_id").eqNullSafe(F.col("skip_id")) & (F.col("sha256") == F.col("skip_sha256"))
    once = stored.join(ids, same, "left_anti").select("sha256", "payload")
    repeated = ids.join(skipped.where("holds"), (F.col("page_id").eqNullSafe(F.col("skip_id"))) & (F.col("sha256") == F.col("skip_sha256")), "left_semi")
    if not repeated.isEmpty():
        again = stored.join(repeated, same, "left_semi").groupBy("sha256").agg(F.min("payload").alias("payload"))
        once = once.unionByName(again)
    once.write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, header, payload, record: the bytes as they stand in an archive file. Bytes unlike their digest raise, as does a header without its payload."""
    held = spark.read.parquet(f"{path}/payloads")
    intact = F.sha2("payload", 256) == F.col("sha256")
    held = held.withColumn("payload", F.when(intact, F.col("payload")).otherwise(F.raise_error(F.lit("payload unlike its digest"))))
    headers = spark.read.parquet(f"{path}/headers")
    missing = F.raise_error(F.concat(F.lit("no payload for "), F.col("sha256"))).cast("binary")
    joined = headers.join(held, "sha256", "left").withColumn("payload", F.when(F.col("payload").isNull(), missing).otherwise(F.col("payload")))
    revisit = F.col("header").contains(f"{CRLF}WARC-Type: revisit{CRLF}")
    block = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    record = F.concat(F.col("header").cast("binary"), block, F.lit(CRLF * 2).cast("binary"))
    return joined.select("page_id", "header", "payload", record.alias("record"))


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)


def parsed_records(records: DataFrame) -> DataFrame:
    """What header and rebuilt payload say; a record whose header contradicts its payload raises."""
    digest, length = F.sha1("payload"), F.octet_length("payload").cast("long")
    agrees = (_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), digest)) & (_field("X-Payload-Length").cast("long") == length)
    return records.select(
        "page_id",
        F.when(agrees, length).otherwise(F.raise_error(F.lit("header unlike its payload")).cast("long")).alias("payload_bytes"),
        digest.alias("payload_digest"),
        _field("WARC-Type").alias("record_type"),
        F.expr("try_cast(nullif(regexp_extract(header, '\\\\r\\\\nWARC-Refers-To: <urn:page:(-?[0-9]+)>', 1), '') as bigint)").alias("refers_to"),
    )


def archive_query(pages: DataFrame) -> DataFrame:
    """Write the archive of all pages, read it back and report every record."""
    path = scratch_path(pages.sparkSession, "archive")
    write_archive(pages, path)
    return parsed_records(read_archive(pages.sparkSession, path))
