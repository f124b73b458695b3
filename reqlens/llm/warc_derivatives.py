"""WARC derivatives: linked metadata and plain-text conversion records from responses.

For every response record the builder makes two more:

* ``conversion``: the plain text of an HTML payload (scripts, styles, comments and
  tags dropped, blocks on lines of their own, character references decoded);
* ``metadata``: title, language and counts as ``application/warc-fields``, with the
  source's headers.

Both carry the response's target and date, ``WARC-Refers-To`` its record id,
``WARC-Refers-To-Target-URI`` and ``-Date``, a block digest, and the payload
digest of their source; the metadata record repeats the source's HTTP
headers.  Record ids are derived from the response's id, so a rerun writes the
same ones.  All of it is row by row, with no shuffle: DataFrame functions, and HTML's own rules for
character references (all named ones, decimal and hexadecimal numbers, also without their semicolon
where HTML allows it) in a Pandas function.

Defined cases: a NULL payload is an empty one (its digest is that of no
bytes); a NULL record id or target is left out of the headers; records that share
an id each have their derivatives, with the same ids; a payload without
markup is its own text; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reqlens.llm.common import load

CRLF = "\r\n"
VERSION = "WARC/1.1"
#: The date of records whose source has none.
NO_DATE = "1970-01-01T00:00:00Z"

# Markup whose content isn't text (left open, the first two hide all that follows), and tags that end a line.
RAW_TEXT = ("script", "style")
HIDDEN = ("noscript", "template", "head")
BREAKING = "br|p|div|li|ul|ol|tr|table|section|article|header|footer|nav|aside|main|h[1-6]|blockquote|pre|dt|dd|dl|hr|form|figure"


@F.pandas_udf(StringType())
def decoded(text: pd.Series) -> pd.Series:
    """Character references as HTML reads them; a no-break space becomes a space."""
    return text.map(lambda t: html.unescape(t).replace("\xa0", " ") if t and "&" in t else t)


def _spaced(text: Column, *characters: str) -> Column:
    """A text with a space for each of the characters."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def _stripped(text: Column) -> Column:
    """A text without spaces and line ends around it, nor before a separator of Unicode that ends it."""
    separated = F.endswith(text, F.lit("\u0085")) | F.endswith(text, F.lit("\u2028")) | F.endswith(text, F.lit("\u2029"))
    return F.when(separated, F.regexp_replace(text, "^[ \n]+|[ \n]+$", "")).otherwise(F.trim(text, F.lit(" \n")))


def _without(text: Column, *tags: str) -> Column:
    """A text without elements of the tags, those of the first before the others."""
    for tag in tags:
        text = F.regexp_replace(text, f"(?is)<{tag}(\\s[^>]*)?>.*?</{tag}\\s*>", " ")
    return text


def _bare(payload: Column) -> Column:
    """An HTML payload without markup, one line per block."""
    text = F.coalesce(payload, F.lit(""))
    text = F.regexp_replace(text, r"(?s)<!--.*?(?:-->|\z)", " ")
    text = F.regexp_replace(text, rf"(?is)<({'|'.join(RAW_TEXT)})(?:\s[^>]*)?>.*?(?:</\1\s*>|\z)", " ")
    *rare, usual = HIDDEN
    some = F.rlike(text, F.lit(f"(?i)<(?:{'|'.join(rare)})"))  # a search costs far less than passes that find nothing
    text = _without(F.when(some, _without(text, *rare)).otherwise(text), usual)
    text = _spaced(text, "\n", "\r")  # runs of spaces are drawn together later
    text = F.regexp_replace(text, f"(?i)</?({BREAKING})(\\s[^>]*)?/?>", "\n")
    return F.regexp_replace(text, "<[!/?A-Za-z][^>]*>", "")


def plain_text(payload: Column) -> Column:
    """Text of an HTML payload: one line per block, single spaces.

    Patterns begin with a fixed character and match only what changes: one that matches each space costs several times as much.
    """
    text = _spaced(decoded(_bare(payload)), "\t", "\r", "\f")
    text = F.replace(F.regexp_replace(text, "  +", " "), F.lit(" \n"), F.lit("\n"))
    return _stripped(F.regexp_replace(text, "\n[ \n]+", "\n"))


def _first(payload: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(payload, F.lit("")), pattern, 1), F.lit(""))


def record_id(*parts: Column) -> Column:
    """A `urn:uuid` derived from the parts by md5 (laid out as a name-based UUID)."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.concat(
        F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-3"), F.substring(h, 14, 3), F.lit("-8"),
        F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"),
    )


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha1:"), F.sha1(F.coalesce(block, F.lit("")).cast("binary")))


def _lines(**fields: Column) -> Column:
    """`Name: value` lines of the fields that aren't NULL (underscores in names are hyphens), line breaks in values dropped."""
    lines = [
        F.concat(F.lit(name.replace("_", "-") + ": "), F.regexp_replace(value.cast("string"), "[\\r\\n]+", " "), F.lit(CRLF))
        for name, value in fields.items()
    ]
    return F.concat_ws("", *lines)


def responses_of_pages(pages: DataFrame) -> DataFrame:
    """Response records (record_id, target_uri, date, http_headers, payload) of a page table (page_id, url, html)."""
    length = F.octet_length(F.coalesce(pages["html"].cast("string"), F.lit(""))).cast("string")
    return pages.select(
        F.when(pages["page_id"].isNotNull(), record_id(F.lit("response"), pages["page_id"].cast("string"), F.coalesce(pages["url"], F.lit("")))).alias("record_id"),
        pages["url"].cast("string").alias("target_uri"),
        F.lit(NO_DATE).alias("date"),
        F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), length, F.lit(CRLF)).alias("http_headers"),
        pages["html"].cast("string").alias("payload"),
        pages["page_id"].alias("source_id"),
    )


def derivatives(responses: DataFrame, *carry: str) -> DataFrame:
    """record_type, record_id, refers_to, target_uri, payload_digest, block_digest, content_length, headers, block.

    Two rows per response record (record_id, target_uri, date, http_headers, payload); ``carry`` names columns to keep.
    """
    r = responses.select(
        *carry, "record_id", "target_uri", F.coalesce("date", F.lit(NO_DATE)).alias("date"), "http_headers",
        digest(F.col("payload")).alias("payload_digest"),
        F.octet_length(F.coalesce("payload", F.lit(""))).cast("long").alias("payload_length"),
        plain_text(F.col("payload")).alias("text"),
        decoded(_first(F.col("payload"), "(?is)<title[^>]*>\\s*(.*?)\\s*</title")).alias("title"),
        _first(F.col("payload"), "(?i)<html[^>]*\\slang=[\"']?([A-Za-z-]+)").alias("language"),
        F.size(F.regexp_extract_all(F.coalesce("payload", F.lit("")), F.lit("(?i)<a\\s[^>]*href="), F.lit(0))).cast("long").alias("links"),
    )
    status = F.nullif(F.regexp_extract(F.coalesce("http_headers", F.lit("")), "^HTTP/[0-9.]+ ([0-9]{3})", 1), F.lit(""))
    kind = F.nullif(F.regexp_extract(F.coalesce("http_headers", F.lit("")), "(?i)(?:^|\n)content-type:[ \t]*([^;\r\n]+)", 1), F.lit(""))
    facts = F.concat(
        _lines(
            title=F.col("title"), language=F.col("language"), outlinks=F.col("links"), http_status=status, content_type=kind,
            source_payload_length=F.col("payload_length"), text_characters=F.length("text"),
        ),
        # the source's own header lines, each under one name
        F.regexp_replace(F.coalesce("http_headers", F.lit("")), "(?m)^(?=[^\r\n])", "source-header: "),
    )
    both = F.array(
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")),
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), facts.alias("block")),
    )
    rows = r.select(*carry, F.col("record_id").alias("refers_to"), "target_uri", "date", "payload_digest", F.explode(both).alias("d"))
    rows = rows.select(*carry, "refers_to", "target_uri", "date", "payload_digest", "d.*")
    rows = rows.withColumns(
        {
            "record_id": record_id(F.col("record_type"), F.coalesce("refers_to", F.lit("")), F.coalesce("target_uri", F.lit(""))),
            "block_digest": digest(F.col("block")),
            "content_length": F.octet_length("block").cast("long"),
        }
    )
    headers = F.concat(
        F.lit(VERSION + CRLF),
        _lines(
            WARC_Type=F.col("record_type"), WARC_Record_ID=F.col("record_id"), WARC_Date=F.col("date"), WARC_Target_URI=F.col("target_uri"),
            WARC_Refers_To=F.col("refers_to"), WARC_Refers_To_Target_URI=F.col("target_uri"), WARC_Refers_To_Date=F.col("date"),
            WARC_Block_Digest=F.col("block_digest"), WARC_Source_Payload_Digest=F.col("payload_digest"),
            Content_Type=F.col("content_type"), Content_Length=F.col("content_length"),
        ),
    )
    return rows.select(
        *carry, "record_type", "record_id", "refers_to", "target_uri", "payload_digest", "block_digest", "content_length",
        headers.alias("headers"), "block",
    )


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records (headers, block) as WARC files, one per partition.

    A record is its headers, an empty line, the block and two line ends; the text
    sink adds the last character of those.
    """
    text = F.concat("headers", F.lit(CRLF), "block", F.lit(CRLF + "\r"))
    records.select(text.alias("value")).write.option("lineSep", "\n").option("compression", compression).text(path)


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = derivatives(responses_of_pages(load(spark, sf_dir, "pages")), "source_id")
    return done.withColumnRenamed("source_id", "page_id")
