"""A content-addressed WARC archive.

Payload bytes are stored once under their SHA-256; every record's exact header
is stored apart with that digest. Records are rebuilt by joining the two, and
each payload is hashed again when it is read.

Nulls: a null page is an empty payload, a null address an empty one. Rows that
repeat a page id and payload count as one page captured twice: each gets a
record of the same type. Rows without page_id are never the first of a payload
that a row with an id has too; among themselves they count as one page. Without
pages both tables are empty; columns other than page_id, url and html are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import store, table

CRLF = "\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: RFC 4648 digits, and those of Spark's conv in base 32.
BASE32, CONV32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_of_hex(hexed):
    """Base32 of a hexadecimal string whose length is a multiple of 5: each five digits are four of base 32."""
    chunks = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*chunks), CONV32, BASE32)


def write_archive(pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> tuple[DataFrame, DataFrame]:
    """(payloads: digest, payload), (headers: page_id, digest, header). date: when the pages were captured, as the table does not tell.

    Of pages with equal payloads of at least min_bytes, the one with the largest
    id is the response and the others are revisits; smaller ones are responses.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    made = pages.select(F.col("page_id").cast("long"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    digests = store(made.select("page_id", "url", F.unhex(F.sha2("payload", 256)).alias("digest"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("bytes")), "digests")
    tops = digests.groupBy("digest").agg(F.max("page_id").alias("top"))
    typed = digests.join(tops, "digest").withColumn("first", F.col("page_id").eqNullSafe(F.col("top")))
    response = F.col("first") | (F.col("bytes") < min_bytes)
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(response, "response").otherwise("revisit"),
        F.lit(f"{CRLF}WARC-Record-ID: "), name(F.col("page_id")), F.lit(f"{CRLF}WARC-Date: {date}"),
        F.when(response, F.lit("")).otherwise(F.concat(F.lit(f"{CRLF}WARC-Profile: {REVISIT}{CRLF}WARC-Refers-To: "), name(F.col("top")))),
        F.lit(f"{CRLF}WARC-Target-URI: "), F.regexp_replace("url", "[\r\n]", ""),
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), base32_of_hex(F.col("sha1")),
        F.lit(f"{CRLF}WARC-Block-Digest: sha256:"), F.lower(F.hex("digest")),
        F.lit(f"{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF + CRLF),
    )
    headers = store(typed.select("page_id", "digest", F.encode(header, "UTF-8").alias("header")), "headers")
    # Pages that are not the first of their payload; a table of ids, which Catalyst broadcasts only if its stored size allows.
    others = store(typed.filter(~F.col("first")).select(F.col("page_id").alias("o_page"), F.col("digest").alias("o_digest")), "others")
    bodies = made.select("page_id", F.unhex(F.sha2("payload", 256)).alias("digest"), "payload")
    once = bodies.join(others, F.col("page_id").eqNullSafe(F.col("o_page")) & (F.col("digest") == F.col("o_digest")), "left_anti").select("digest", "payload")
    if digests.groupBy("page_id", "digest").count().filter("count > 1").limit(1).count():  # the same page twice: its payload is still stored once
        once = once.dropDuplicates(["digest"])
    return store(once, "payloads"), headers


def read_records(payloads: DataFrame, headers: DataFrame) -> DataFrame:
    """page_id and the record as it would stand in a WARC file. A payload that does not hash to its name is an error."""
    same = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    sound = payloads.select("digest", F.when(same, F.col("payload")).otherwise(F.raise_error(F.lit("payload does not match its digest")).cast("binary")).alias("payload"))
    return headers.join(sound, "digest").select("page_id", F.concat("header", "payload", F.encode(F.lit(CRLF + CRLF), "UTF-8")).alias("record"))


def parse_records(records: DataFrame) -> DataFrame:
    """Fields and payload of WARC records. As a string a record is its own bytes; what follows the header is neither decoded nor copied."""
    text = F.col("record").cast("string")
    head = records.select("page_id", "record", F.substring_index(text, CRLF + CRLF, 1).alias("head"))
    field = lambda n: F.regexp_extract("head", f"\r\n{n}: ([^\r\n]*)", 1)
    n = field("Content-Length").cast("int")
    body = head.select("page_id", field("WARC-Type").alias("record_type"), field("WARC-Refers-To").alias("refers"), field("WARC-Target-URI").alias("url"), n.alias("n"), F.substring("record", F.octet_length("head") + 5, n).alias("payload"))
    return body


def op8_content_addressed_warc(spark, sf_dir):
    """Round trip of all pages through an archive; the digests are of the payloads read back."""
    payloads, headers = write_archive(table(spark, sf_dir, "pages"))
    back = parse_records(read_records(payloads, headers))
    refers = F.regexp_extract("refers", "<urn:page:(-?[0-9]+)>", 1)
    return back.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_of_hex(F.sha1("payload")).alias("payload_digest"),
        "record_type", F.when(refers != "", refers.cast("long")).alias("refers_to"),
    )


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(s, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM t
"""
