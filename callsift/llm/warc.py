"""WARC archives with one copy of each payload: revisit records for the rest, written and read by Spark's text source."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.session import settle

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def digest(payload: Column) -> Column:
    """Upper-case base32 SHA-1: five hexadecimal digits make four letters."""
    hexed, letters = F.sha1(payload), []
    for group in range(8):
        value = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substr(F.lit(ALPHABET), F.shiftright(value, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def record_id(key: Column, payload_digest: Column) -> Column:
    """A URN of key and payload digest, so that a retried task writes the same record and repeated keys do not mix payloads."""
    h = F.md5(F.concat_ws("|", F.lit("record:"), F.coalesce(key.cast("string"), F.lit("")), payload_digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def resolve_revisits(pages: DataFrame, key: str, payload: str, least: int = 0, url: str | None = None) -> DataFrame:
    """Adds payload (binary), payload_bytes, payload_digest, refers_to (the smallest key with the same payload), refers_to_url.

    Only headers (key, digest, URL) are grouped; the written table has a row for each digest that occurs more than once.
    The join meets it by digest: two plain exchanges, so AQE can split a digest that many pages share. Null payloads count
    as empty; payloads under `least` bytes and null keys are never revisits; rows that repeat the smallest key are all
    responses; of several URLs of that key the smallest is named. Other columns pass through, those named like results are
    replaced; an empty table gives none.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.withColumn("payload", body).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": digest(F.col("payload"))}
    )
    first, found = free_name(rows, "first"), free_name(rows, "found")
    place = F.struct(F.col(f"`{key}`").alias("key"), (F.col(f"`{url}`") if url else F.lit(None)).cast("string").alias("url"))
    shared = (
        rows.where(F.col("payload_bytes") >= least)
        .groupBy(F.col("payload_digest").alias(found))
        .agg(F.min(F.when(F.col(f"`{key}`").isNotNull(), place)).alias(first), F.count("*").alias("n"))
        .where("n > 1")
        .select(found, first)
    )
    later = (F.col("payload_bytes") >= least) & (F.col(first)["key"] < F.col(f"`{key}`"))
    joined = rows.join(settle(shared, "digests"), F.col("payload_digest") == F.col(found), "left")
    named = {"refers_to": F.when(later, F.col(first)["key"]), "refers_to_url": F.when(later, F.col(first)["url"])}
    return joined.withColumns(named).drop(first, found)


def target_uri(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20]", "%20")


def headers(*fields: tuple[str, Column | str]) -> Column:
    """The head of a record; fields without a value are left out."""
    lines = [F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value) for name, value in fields]
    return F.concat(F.lit(VERSION), F.concat_ws("\r\n", *lines), F.lit(END))


def write_archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, date: str | None = None) -> None:
    """Write text payloads as WARC records under `path`, payloads that came before as revisits, after a warcinfo record.

    Headers are made anew: the date of this writing (or `date`), ids by key and payload, lengths of what is stored, and for
    a revisit the id, address and date of its original. A payload that holds the byte sequence between two records is
    stored as base64 and says so in its header, so that records can be told apart without reading a file from its start.
    Rows that repeat a key keep their own payload; null keys have none in the archive; other columns are left out; an
    empty table gives an archive of a warcinfo record alone.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    named = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{payload}`").alias("body"))
    rows = resolve_revisits(named, "key", "body", least, "url")
    clash = F.contains(F.concat(F.lit(END), F.col("payload").cast("string")), F.lit(END + VERSION))
    text = F.when(clash, F.base64("payload")).otherwise(F.col("payload").cast("string"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(text).cast("string"),
        F.when(clash, "\r\nContent-Transfer-Encoding: base64").otherwise(""),
        F.lit(END),
    )
    again = F.col("refers_to").isNotNull()
    block = F.when(again, http).otherwise(F.concat(http, text))
    head = headers(
        ("WARC-Type", F.when(again, "revisit").otherwise("response")),
        ("WARC-Record-ID", record_id(F.col("key"), F.col("payload_digest"))),
        ("WARC-Date", date),
        ("WARC-Target-URI", target_uri(F.col("url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        ("WARC-Profile", F.when(again, PROFILE)),
        ("WARC-Refers-To", F.when(again, record_id(F.col("refers_to"), F.col("payload_digest")))),
        ("WARC-Refers-To-Target-URI", F.when(again, target_uri(F.col("refers_to_url")))),
        ("WARC-Refers-To-Date", F.when(again, date)),
        ("Source-Key", F.col("key").cast("string")),
        ("Refers-To-Key", F.col("refers_to").cast("string")),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", F.octet_length(block).cast("string")),
    )
    about = "software: callsift\r\nformat: WARC File Format 1.1\r\n"
    info_head = headers(
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(F.lit(f"warcinfo:{path}:{date}"), F.lit(""))), ("WARC-Date", date),
        ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(about))),
    )
    info = pages.sparkSession.range(1, numPartitions=1).select(F.concat(info_head, F.lit(about)).alias("value"))
    info.unionByName(rows.select(F.concat(head, block).alias("value"))).write.option("lineSep", END).text(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit: record_type, record_id, refers_to_id, url, refers_to_url, date, payload_digest, key, refers_to, payload (null: revisit)."""
    raw = spark.read.option("lineSep", END + VERSION).text(path)
    record = F.regexp_replace("value", "^WARC/1[.]1\r\n", "")
    parts = raw.select(record.alias("record")).where("record <> ''").withColumn("head", F.substring_index("record", END, 1))

    def field(name: str, column: str = "head") -> Column:
        found = F.regexp_extract(column, rf"(?:^|\n){name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    start = F.length("head") + len(END) + 1
    kept = parts.where(F.regexp_extract("head", r"(?:^|\n)WARC-Type: ([^\r\n]*)", 1).isin("response", "revisit"))
    block = kept.withColumn("block", F.substr("record", start)).withColumn("http", F.substring_index("block", END, 1))
    body = F.substr("block", F.length("http") + len(END) + 1)
    size = field("Content-Length").cast("long") - F.octet_length("http") - len(END)
    cut = F.substr(body.cast("binary"), F.lit(1), size.cast("int"))
    plain = F.when(field("Content-Transfer-Encoding", "http") == "base64", F.unbase64(cut.cast("string"))).otherwise(cut)
    return block.select(
        field("WARC-Type").alias("record_type"),
        field("WARC-Record-ID").alias("record_id"),
        field("WARC-Refers-To").alias("refers_to_id"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-Refers-To-Target-URI").alias("refers_to_url"),
        field("WARC-Date").alias("date"),
        F.substr(field("WARC-Payload-Digest"), F.lit(6)).alias("payload_digest"),
        field("Source-Key").alias("key"),
        field("Refers-To-Key").alias("refers_to"),
        F.when(field("WARC-Type") == "response", plain).alias("payload"),
    )


def read_resolved(spark: SparkSession, path: str) -> DataFrame:
    """Every record with the size and digest of its payload: a response's own, a revisit's from its original (null: missing).

    The archive is parsed once, into a written table of headers. A payload whose digest is not the one in its header, or a
    revisit whose original has another digest, raises an error.
    """
    own = digest(F.col("payload"))
    wrong = lambda what: F.raise_error(F.concat(F.lit(what), F.col("record_id")))
    checked = F.when(F.col("payload").isNull() | (own == F.col("payload_digest")), F.col("payload_digest")).otherwise(wrong("payload differs from its digest: "))
    small = read_archive(spark, path).select(
        "record_type", "record_id", "refers_to_id", "url", "key", "refers_to", checked.alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    rows = settle(small, "records")
    named = ["record_type", "record_id", "url", "key", "refers_to"]
    responses = rows.where("record_type = 'response'").select(*named, "payload_bytes", "payload_digest")
    originals = responses.select(F.col("record_id").alias("refers_to_id"), F.col("payload_bytes").alias("size"), F.col("payload_digest").alias("original")).dropDuplicates(["refers_to_id"])
    revisits = rows.where("record_type = 'revisit'").join(settle(originals, "originals"), "refers_to_id", "left")
    same = F.when(F.col("original").isNull() | (F.col("original") == F.col("payload_digest")), F.col("original")).otherwise(wrong("original has another payload: "))
    return responses.unionByName(revisits.select(*named, F.col("size").alias("payload_bytes"), same.alias("payload_digest")))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """record_type, record_id, url, key, payload: every record with its whole payload, a revisit's from its original (null: missing).

    Payloads of originals that no revisit names are not shuffled.
    """
    records = read_archive(spark, path)
    named = ["record_type", "record_id", "url", "key"]
    revisits = settle(records.where("record_type = 'revisit'").select(*named, "refers_to_id"), "revisits")
    wanted = revisits.select(F.col("refers_to_id").alias("record_id")).distinct()
    responses = records.where("record_type = 'response'").select(*named, "payload")
    originals = settle(responses.join(wanted, "record_id", "left_semi").select(F.col("record_id").alias("refers_to_id"), "payload").dropDuplicates(["refers_to_id"]), "originals")
    return responses.unionByName(revisits.join(originals, "refers_to_id", "left").select(*named, "payload"))
