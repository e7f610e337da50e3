"""WARC archives: writing pages as records, and reading records back by boundary-chain verification.

Writing: each page is one record. Of the pages with equal payloads of at least ``min_bytes`` the one with the largest
page_id carries the payload; the others are revisits that name it. Spark's text writer makes the archives, so a lost
task is written again and only whole files count.

Reading: Spark's text reader cuts the archives at the magic line wherever a split begins, so a piece may be a record
or the rest of a payload that holds the magic. Every piece that parses as a record is a candidate, an edge from its offset to the
offset its lengths point at. Pointer jumping from offset 0 of each file keeps the candidates that the chain of
records reaches; all others are payload. A record's payload is hashed in the task that read it. Only a payload that holds
the magic spans several pieces: these are fetched and joined again. Only thin rows are shuffled.

Defined cases: null html is an empty payload; a null url has no target line; line breaks in a url are escaped; rows that
share the largest page_id of a payload are all responses, and so are all where every page_id is null; repeated rows are
records of their own; an empty table gives no records; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.session import scratch_path, small_side, store

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
RECORDS_PER_FILE = 1000
LEAST_BYTES = 1000


def with_referred(pages: DataFrame, min_bytes: int) -> DataFrame:
    """page_id, url, html, digest, bytes, and the page that carries the payload where another one does."""
    html = F.coalesce(F.col("html"), F.lit(""))
    known = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
                         F.octet_length(html).cast("long").alias("bytes"))
    carriers = store(known.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(
        F.count("*").alias("pages"), F.max("page_id").alias("carrier")).where("pages > 1 and carrier is not null").drop("pages"), "warc")
    return known.join(small_side(carriers), ["digest", "bytes"], "left").withColumn(
        "carrier", F.when(F.col("page_id").eqNullSafe(F.col("carrier")), None).otherwise(F.col("carrier")))


def record(min_bytes: int) -> Column:
    """A whole record but for its last line feed, which the text writer adds."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    optional = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    revisit = F.col("carrier").isNotNull()
    page = lambda key: F.concat(F.lit("<urn:page:"), key.cast("string"), F.lit(">"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        optional("WARC-Record-ID", page(F.col("page_id"))), optional("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("bytes").cast("string")), optional("WARC-Refers-To", page(F.col("carrier"))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"), F.when(revisit, F.lit("")).otherwise(F.col("html")), F.lit("\r\n\r"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = LEAST_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    with_referred(pages, min_bytes).select(record(min_bytes).alias("value")).write.option(
        "maxRecordsPerFile", records_per_file).text(folder)


def pieces_of(spark: SparkSession, folder: str) -> DataFrame:
    """What lies between magic lines, with its place: file, split, and order inside the split.

    The same session cuts the same files the same way each time, so a place names the same piece in a second scan.
    """
    return spark.read.option("lineSep", MAGIC).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value")


def field(name: str) -> Column:
    found = F.regexp_extract(F.col("header"), rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def parsed(pieces: DataFrame) -> DataFrame:
    """Thin rows: place, length, and the fields, payload digest and end of what would be a record at this piece."""
    header = F.when(F.instr(F.col("value"), END) > 0, F.substring_index(F.col("value"), END, 1))
    rows = pieces.withColumn("header", header).withColumn("body_at", F.octet_length("header") + len(END)).withColumn(
        "body", F.regexp_extract(field("Content-Length"), r"^\d{1,18}$", 0).try_cast("long")).withColumn(
        "span", F.octet_length("value").cast("long"))
    whole = F.col("body_at") + F.col("body") + len(END) <= F.col("span")
    payload = F.substring(F.col("value").cast("binary"), F.col("body_at") + 1, F.col("body").cast("int"))
    identity = lambda name: F.regexp_extract(field(name), r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return rows.select(
        "file", "block", "row", "span", "body_at", "body", whole.alias("whole"), F.when(whole, F.sha1(payload)).alias("digest"),
        field("WARC-Type").alias("record_type"), identity("WARC-Record-ID").alias("page_id"),
        identity("WARC-Refers-To").alias("refers_to"), F.regexp_extract(field("WARC-Payload-Digest"), r"^sha1:(\w+)$", 1).alias("said_digest"),
        field("WARC-Payload-Length").try_cast("long").alias("said_bytes"))


def candidates(rows: DataFrame) -> DataFrame:
    """``rows`` with each piece's offset in its file (that of the magic before it) and the offset its record would end at."""
    before = Window.partitionBy("file").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("span") + len(MAGIC)).over(before), F.lit(0)) - len(MAGIC)
    ends = F.col("offset") + len(MAGIC) + F.col("body_at") + F.col("body") + len(END)
    return rows.withColumn("offset", offset).withColumn("successor", ends)


def reached(nodes: DataFrame) -> DataFrame:
    """(file, offset) of the candidates on the chain from offset 0, by pointer jumping.

    After round k the set holds what 2^k steps reach and a jump spans 2^k steps. No chain is longer than its file has
    candidates, which bounds the rounds by their logarithm.
    """
    jumps = nodes.where("successor is not null and offset >= 0").select("file", "offset", "successor")
    longest = jumps.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    found = jumps.where("offset = 0").select("file", "offset")
    for _ in range(math.ceil(math.log2(longest + 1)) if longest else 0):
        steps = jumps.join(found, ["file", "offset"], "left_semi").select("file", F.col("successor").alias("offset"))
        known = jumps.select("file", "offset").join(steps, ["file", "offset"], "left_semi")
        found = store(found.union(known).distinct(), "warc")
        ahead = jumps.select("file", F.col("offset").alias("successor"), F.col("successor").alias("further"))
        jumps = store(jumps.join(ahead, ["file", "successor"], "left").select("file", "offset", F.coalesce(
            "further", "successor").alias("successor"), F.col("further").isNotNull().alias("goes_on")), "warc").drop("goes_on")
    return found


def joined_payloads(spark: SparkSession, folder: str, rows: DataFrame, records: DataFrame) -> DataFrame:
    """(file, offset, digest) of the records whose payload spans several pieces."""
    marked = rows.select("file", "block", "row", "offset").join(
        records.select("file", "offset", F.lit(True).alias("starts"), "whole", "body_at", "body"), ["file", "offset"], "left")
    owner = F.last(F.when(F.col("starts"), F.struct("offset", "whole", "body_at", "body")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("offset"))
    wanted = store(marked.withColumn("owner", owner).where("not owner.whole").select("file", "block", "row", "offset", "owner"), "warc")
    fetched = pieces_of(spark, folder).join(small_side(wanted), ["file", "block", "row"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "value"))), lambda p: p["value"]), MAGIC)
    payload = F.substring(F.col("text").cast("binary"), F.col("owner.body_at") + 1, F.col("owner.body").cast("int"))
    return fetched.groupBy("file", "owner").agg(text.alias("text")).select(
        "file", F.col("owner.offset").alias("offset"), F.sha1(payload).alias("joined"))


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each record; a revisit has the lengths and digest of the payload it refers to."""
    if spark.read.text(folder).isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    rows = store(candidates(parsed(pieces_of(spark, folder))), "warc")
    records = store(rows.join(reached(rows), ["file", "offset"], "left_semi"), "warc")
    digest = F.col("digest")
    if not records.where("not whole").isEmpty():
        records = records.join(joined_payloads(spark, folder, rows, records), ["file", "offset"], "left")
        digest = F.coalesce("digest", "joined")
    revisit = F.col("record_type") == "revisit"
    return records.select(
        "page_id", F.when(revisit, F.col("said_bytes")).otherwise(F.col("body")).alias("payload_bytes"),
        F.when(revisit, F.col("said_digest")).otherwise(digest).alias("payload_digest"), "record_type", "refers_to")


def round_trip(pages: DataFrame, min_bytes: int = LEAST_BYTES, records_per_file: int = RECORDS_PER_FILE) -> DataFrame:
    folder = scratch_path(pages.sparkSession, "archives")
    write_archives(pages.select(F.col("page_id").cast("long"), "url", "html"), folder, min_bytes, records_per_file)
    return read_archives(pages.sparkSession, folder)


SQL = """
WITH known AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
carried AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS carrier FROM known)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < carrier THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < carrier THEN carrier END AS refers_to
FROM carried
"""
