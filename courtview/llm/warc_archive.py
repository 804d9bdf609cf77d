"""A content-addressed WARC archive: payload bytes once by digest, exact record headers apart, records rebuilt by joins.

``write_archive`` turns each page into a WARC/1.1 record and keeps it as two Parquet tables: ``headers`` (one row for
each record: the exact bytes before the payload, and the payload's SHA-256) and ``payloads`` (each distinct payload
once). Of records with equal payloads of at least ``least`` bytes the one with the largest page_id is a response
and the others are revisits that refer to it; smaller ones are all responses. ``read_archive`` joins the two: a payload
is checked against its digest once, before the join (a mismatch fails the job), and every record gets its header, its
whole payload and its exact WARC bytes. ``export_warc`` writes plain WARC files.

Payloads are found to be equal by SHA-256, verified at writing by a second digest and the length, and at reading
by hashing the stored bytes again. Bytes of payloads cross one exchange at writing (after one row for each digest and
task) and one at reading. A digest that more than a share of all records hold is salted, on both sides of every join:
no task gets all copies, and the payload is repeated once for each salt (at most ``2 * SHARES`` rows in all).

Defined results: a null html is an empty payload; rows of equal page_id are records of their own (of equal largest ids
one is the response); a null page_id is smaller than any other and gets no Page-ID field; a null url is ``urn:unknown``;
control characters, spaces and bytes outside ASCII in urls are percent-encoded; empty tables give empty archives; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtview.llm.common import scratch_path, scratch_scope, write_scratch
from courtview.session import delete_at_exit

LEAST = 1000
SHARES = 200
MIN_SHARE = 1000
_EOL = "\r\n"


def _line(name: str, value: Column) -> Column:
    """One header line; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_EOL)), F.lit(""))


def _safe_url(url: Column) -> Column:
    bad = r"[^\x21-\x7E]"
    plain = F.coalesce(url, F.lit("urn:unknown"))
    each = F.transform(F.split(plain, ""), lambda c: F.when(c.rlike(bad), F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")).otherwise(c))
    return F.when(plain.rlike(bad), F.concat_ws("", each)).otherwise(plain)


def _record_id(page_id: Column, record: Column) -> Column:
    """A version-8 UUID made of the page and record numbers: the same in every run over the same files."""
    h = F.sha2(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("-")), record.cast("string")), 256)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def _facts(pages: DataFrame) -> DataFrame:
    """One narrow row for each record: numbers, url, digests and length of its payload."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")).select(
        "page_id", "url", F.unhex(F.sha2("payload", 256)).alias("digest"), F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("record"))


def _grouped(facts: DataFrame) -> DataFrame:
    """Payloads that several records hold: how many, in how many salts, and the last record by page_id (null first)."""
    total = facts.count()
    share = max(total // SHARES, MIN_SHARE)
    last = F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "record")).alias("last")
    same = (F.min("sha1") == F.max("sha1")) & (F.min("n_bytes") == F.max("n_bytes"))
    groups = facts.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), last, same.alias("same")).where("n > 1")
    verified = F.when(F.col("same"), F.col("n")).otherwise(F.raise_error(F.lit("payloads of one SHA-256 differ in SHA-1 or length")).cast("long"))
    return groups.select("digest", F.ceil(verified / F.lit(share)).cast("int").alias("salts"), F.col("last.page_id").alias("last_page"), F.col("last.record").alias("last_record"))


def write_archive(pages: DataFrame, path: str, least: int = LEAST, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write the records of ``pages`` (page_id, url, html) below ``path`` as ``headers`` and ``payloads``.

    ``date`` is the WARC-Date of all records: the pages carry no time of their own.
    """
    spark = pages.sparkSession
    with scratch_scope(spark):
        facts, _ = write_scratch(_facts(pages), "warc-facts")
        groups, _ = write_scratch(_grouped(facts), "warc-groups")
        hot = F.broadcast(groups.where("salts > 1"))  # at most SHARES rows
        cold = groups.where("salts = 1")
        shared = facts.join(hot, "digest").unionByName(facts.join(hot, "digest", "left_anti").join(cold, "digest", "left"))
        revisit = (F.col("n_bytes") >= least) & F.coalesce(F.col("last_record") != F.col("record"), F.lit(False))
        http = F.concat(F.lit(f"HTTP/1.1 200 OK{_EOL}Content-Type: text/html; charset=UTF-8{_EOL}"), _line("Content-Length", F.col("n_bytes").cast("string")), F.lit(_EOL))
        length = F.octet_length("http") + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("n_bytes"))
        only = lambda c: F.when(F.col("revisit"), c)
        header = F.concat(
            F.lit(f"WARC/1.1{_EOL}"), _line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
            _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("record"))), _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", _safe_url(F.col("url"))),
            _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))), _line("Page-ID", F.col("page_id").cast("string")),
            _line("WARC-Profile", only(F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            _line("WARC-Refers-To", only(_record_id(F.col("last_page"), F.col("last_record")))), _line("Refers-To-Page-ID", only(F.col("last_page").cast("string"))),
            F.lit(f"Content-Type: application/http; msgtype=response{_EOL}"), _line("Content-Length", length.cast("string")), F.lit(_EOL), F.col("http"))
        salt = F.pmod(F.xxhash64("record"), F.coalesce("salts", F.lit(1)).cast("long")).cast("int")
        headers = shared.withColumn("revisit", revisit).withColumn("http", http).select("record", "digest", salt.alias("salt"), F.encode(header, "UTF-8").alias("header"))
        headers.write.mode("errorifexists").parquet(f"{path}/headers")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    bodies = pages.select(payload.alias("payload")).select(F.unhex(F.sha2("payload", 256)).alias("digest"), "payload")
    bodies.groupBy("digest").agg(F.first("payload").alias("payload")).write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """record, header, payload, warc of every record: its bytes before the payload, the whole payload, its exact WARC bytes."""
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    true = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    checked = payloads.withColumn("payload", F.when(true, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload does not have its digest")).cast("binary")))
    hot = headers.where("salt > 0").groupBy("digest").agg(F.max("salt").alias("last_salt"))  # at most SHARES rows
    salted = checked.join(F.broadcast(hot), "digest", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("last_salt", F.lit(0))))).drop("last_salt")
    kind = F.regexp_extract(F.col("header").cast("string"), "\r\nWARC-Type: (\\w+)\r\n", 1)
    end = F.lit(f"{_EOL}{_EOL}").cast("binary")
    warc = F.when(kind == "revisit", F.concat("header", end)).otherwise(F.concat("header", "payload", end))
    return headers.join(salted, ["digest", "salt"]).select("record", "header", "payload", warc.alias("warc"))


def described(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records read back: digests of the payload itself, the rest from the header."""
    text = F.col("header").cast("string")
    field = lambda name: F.regexp_extract(text, f"\r\n{name}: ([^\r]*)\r\n", 1)
    number = lambda name: F.nullif(field(name), F.lit("")).cast("long")
    digest = F.sha1("payload")
    agreed = F.when(F.concat(F.lit("sha1:"), digest) == field("WARC-Payload-Digest"), digest).otherwise(F.raise_error(F.lit("a record's payload does not have the digest of its header")))
    return records.select(number("Page-ID").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), agreed.alias("payload_digest"),
                          field("WARC-Type").alias("record_type"), number("Refers-To-Page-ID").alias("refers_to"))


def export_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Write the records as plain WARC files: the text sink writes bytes as they are, and CR LF CR LF ends each record."""
    body = F.expr("substring(warc, 1, octet_length(warc) - 4)").cast("string")
    records.select(body.alias("value")).write.mode("errorifexists").option("lineSep", f"{_EOL}{_EOL}").option("compression", compression).text(path)


def archived_pages(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write an archive of ``pages`` into the shared folder (it lasts as long as the application), read it back and describe its records."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc-archive")
    write_archive(pages, path, least)
    delete_at_exit(spark, path)
    return described(read_archive(spark, path))
