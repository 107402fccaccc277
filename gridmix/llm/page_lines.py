"""Line dedup of raw web pages: the lines of a page, the host of its URL.

A page's lines are its visible text: comments, scripts and styles go, tags of
block elements end a line, other tags vanish, the five named entities and the
blank one are read, runs of line ends are one. The host is the URL's, in lower
case, without user and port. ``line_dedup.clean`` drops the lines that too many
pages of a host share.

Edge cases: a null page stays null and has no lines, but counts as a page of its
host; a null URL is a host of its own, one without a host the host ''; repeated
rows count as pages each.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.llm import line_dedup

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
BLOCK = (r"(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
         r"h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)"
         r"\b[^>]*>")
TAG = r"</?[A-Za-z!][^>]*>"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def visible(html: Column) -> Column:
    c = F.regexp_replace(html, HIDDEN, "")
    c = F.regexp_replace(F.regexp_replace(c, BLOCK, "\n"), TAG, "")
    for entity, plain in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return F.trim(F.regexp_replace(c, r"\n+", "\n"), F.lit("\n"))


def clean(pages: DataFrame) -> DataFrame:
    """page_id, host, text without boilerplate lines, n_lines, n_dropped."""
    return line_dedup.clean(pages.select("page_id", host(F.col("url")).alias("host"),
                                         visible(F.col("html")).alias("text")), host="host")


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_visible() -> str:
    c = f"regexp_replace(html, {_sql_text(HIDDEN)}, '', 'g')"
    c = f"regexp_replace(regexp_replace({c}, {_sql_text(BLOCK)}, chr(10), 'g'), {_sql_text(TAG)}, '', 'g')"
    for entity, plain in ENTITIES:
        c = f"replace({c}, {_sql_text(entity)}, {_sql_text(plain)})"
    return f"trim(regexp_replace({c}, '\\n+', chr(10), 'g'), chr(10))"


# the documents' statement, over the visible text of pages
SQL = (line_dedup.SQL
       .replace("SELECT doc_id, source, text, row_number() OVER () AS k FROM documents",
                f"SELECT page_id, CASE WHEN url IS NOT NULL THEN lower(regexp_extract(url, {_sql_text(HOST)}, 1)) END"
                f" AS source, {_sql_visible()} AS text, row_number() OVER () AS k FROM pages")
       .replace("WITH pages AS", "WITH visible AS").replace("FROM pages))", "FROM visible))")
       .replace("FROM pages GROUP BY", "FROM visible GROUP BY").replace("FROM pages p", "FROM visible p")
       .replace("SELECT p.doc_id, p.source,", "SELECT p.page_id, p.source AS host,"))
