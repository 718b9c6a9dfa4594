"""WARC derivatives: metadata and plain-text conversion records of responses.

``responses`` describes crawled pages as response records: the HTTP message
(status line, headers, page) is the record's block, the page its payload, and
both have a digest. ``derive`` makes two records of each response: a metadata
record (title, language, links, sizes, digests of the source) and a conversion
record with the page's text. Both refer to the response by its identifier, carry
its target, date and headers, and have identifiers and digests of their own.
Identifiers depend on the kind of record, page id, target and content alone, so
a repeated task or run gives the same records. ``write`` writes records as gzip files.

A null page counts as empty and a null target as the empty text; both still give
records. Pages that repeat give records with the same identifier, as they are
the same capture. An empty table gives no records. Extra columns are ignored.
A comment, script, style, noscript or title that nothing closes lasts to the end of
the page, and a tag without an end is text. All is done by DataFrame functions;
each step is linear in the page, also where it is full of tags that do not close.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.llm.common import let

# The entities that are turned back into signs. "&amp;" must be last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}
CRLF = "\r\n"
# Patterns that mean the same to both engines: no back-references, blanks spelled out.
_B = r"[\x20\x09-\x0D]"
# Each begins with one sign that is tested alone, and ends at the end of the page or at the next tag if
# nothing closes it, so that no opener is read twice, whatever the page holds.
HIDDEN = r"(?is)<(?:!--.*?(?:-->|\z)|" + "|".join(
    rf"{t}\b.*?(?:</{t}{_B}*>|\z)" for t in ("script", "style", "noscript", "title")) + ")"
BLOCK = (rf"(?i)<(?:br{_B}*/?>|/?(?:p|div|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|blockquote|pre)"
         r"\b[^<>]*>)")
TAG = r"<[^<>]*>"
GAPS = ((r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+", " "), (r"\x20?\n[\x20\n]*", "\n"))
TITLE = rf"(?is)<title\b[^<>]*>(.*?)(?:</title{_B}*>|\z)"
LANGUAGE = r"(?i)<html\b[^<>]*?\blang=[\x22\x27]?([A-Za-z-]+)"
LINK = r"(?i)<a\b[^<>]*?\bhref="
DATE = "2024-01-01T00:00:00Z"


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def named(sha: Column) -> Column:
    return F.concat(F.lit("sha256:"), sha)


def record_id(kind: Column, page: Column, target: Column, sha: Column) -> Column:
    """A name-based URN in the form of a UUID; ``sha`` is the digest of the content."""
    def urn(name: Column) -> Column:
        parts = [F.substring(name, at, size) for at, size in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), parts[0], F.lit("-"), parts[1], F.lit("-3"), parts[2], F.lit("-8"), parts[3],
                        F.lit("-"), parts[4], F.lit(">"))
    return let(F.md5(F.concat_ws("|", kind, page, target, sha).cast("binary")), urn)


def plain_text(html: Column) -> Column:
    """The text of a page: scripts, styles, comments and tags go, blocks end lines,
    entities become signs, and runs of blanks one blank."""
    text = F.regexp_replace(html, HIDDEN, " ")
    text = F.regexp_replace(text, BLOCK, "\n")
    text = F.regexp_replace(text, TAG, "")
    for entity, sign in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(sign))
    for gap, sign in GAPS:
        text = F.regexp_replace(text, gap, sign)
    return F.btrim(text, F.lit(" \n"))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """page_id, target, date, headers, block, payload and digests of each page's response record."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    rows = pages.select("page_id", url.alias("target"), html.alias("payload"))
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                       F.octet_length("payload").cast("string"), F.lit(CRLF))
    rows = rows.withColumn("headers", headers)
    block = F.concat(F.col("headers"), F.lit(CRLF), F.col("payload"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return rows.select("page_id", "target", F.lit(date).alias("date"), "headers", "payload",
                       # Both names of the content come from one pass over it.
                       let(sha256(F.col("payload")), lambda sha: F.struct(
                           record_id(F.lit("response"), page, F.col("target"), sha).alias("record_id"),
                           named(sha).alias("payload_digest"))).alias("_names"),
                       named(sha256(block)).alias("block_digest")).select(
        "page_id", "target", "date", "headers", "payload", "_names.*", "block_digest")


def derive(source: DataFrame) -> DataFrame:
    """Two records per response: page_id, record_type, record_id, refers_to, target,
    date, source_headers, source_digest, content_type, content, content_length, block_digest."""
    html = F.col("payload")
    title = F.regexp_extract(html, TITLE, 1)
    language = F.regexp_extract(html, LANGUAGE, 1)
    links = F.size(F.regexp_extract_all(html, F.lit(LINK), F.lit(0)))
    text = plain_text(html)
    described = source.withColumn("_text", text)
    fields = F.concat(
        F.lit("title: "), F.regexp_replace(title, f"{_B}+", " "), F.lit(f"{CRLF}language: "), language,
        F.lit(f"{CRLF}links: "), links.cast("string"), F.lit(f"{CRLF}payload-length: "), F.octet_length("payload").cast("string"),
        F.lit(f"{CRLF}text-length: "), F.octet_length("_text").cast("string"), F.lit(CRLF))
    made = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("content")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                 F.col("_text").alias("content")))
    both = described.select("page_id", F.col("record_id").alias("refers_to"), "target", "date", F.col("headers").alias("source_headers"),
                            F.col("payload_digest").alias("source_digest"), F.inline(made))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    names = let(sha256(F.col("content")), lambda sha: F.struct(
        record_id(F.col("record_type"), page, F.col("refers_to"), sha).alias("record_id"), named(sha).alias("block_digest")))
    return both.withColumn("_names", names).select(
        "page_id", "record_type", "_names.record_id", "refers_to", "target", "date", "source_headers",
        "source_digest", "content_type", "content", F.octet_length("content").cast("long").alias("content_length"),
        "_names.block_digest")


def build(pages: DataFrame, date: str = DATE) -> DataFrame:
    return derive(responses(pages, date))


def as_text(records: DataFrame) -> DataFrame:
    """One column: each record with its header lines, as it stands in a file.

    The source's status line and headers go into header fields of their own, with
    line ends folded, so that a record can be traced without the response."""
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.col("record_type"), F.lit(f"{CRLF}WARC-Record-ID: "), F.col("record_id"),
        F.lit(f"{CRLF}WARC-Refers-To: "), F.col("refers_to"), F.lit(f"{CRLF}WARC-Target-URI: "),
        F.regexp_replace("target", r"[\r\n]+", "%0A"), F.lit(f"{CRLF}WARC-Date: "), F.col("date"),
        F.lit(f"{CRLF}X-Source-Headers: "), F.regexp_replace(F.btrim(F.col("source_headers"), F.lit(CRLF)), "\r\n", "; "),
        F.lit(f"{CRLF}X-Source-Payload-Digest: "), F.col("source_digest"), F.lit(f"{CRLF}WARC-Block-Digest: "), F.col("block_digest"),
        F.lit(f"{CRLF}Content-Type: "), F.col("content_type"), F.lit(f"{CRLF}Content-Length: "),
        F.col("content_length").cast("string"), F.lit(CRLF + CRLF))
    return records.select(F.concat(header, F.col("content")).alias("value"))


def write(records: DataFrame, folder: str) -> None:
    """Write records to gzip files; a record ends in two line ends, as the text writer's separator."""
    as_text(records).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(folder)
