"""Web page to text document."""

from __future__ import annotations

from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, functions as F

# Patterns over page markup, and the entities decoded (the ampersand last).
ARTICLE = r"(?is)<article[^>]*>(.*?)(?:</article>|\z)"
BODY = r"(?is)<body[^>]*>(.*?)(?:</body>|\z)"
HEAD = r"(?is)<head(?:\s[^>]*)?>.*?(?:</head>|(?=<body))"
HIDDEN = [
    r"(?is)<!--.*?(?:-->|\z)",
    r"(?is)<script[^>]*>.*?(?:</script>|\z)",
    r"(?is)<style[^>]*>.*?(?:</style>|\z)",
    r"(?is)<nav[^>]*>.*?</nav>",
    r"(?is)<header[^>]*>.*?</header>",
    r"(?is)<aside[^>]*>.*?</aside>",
    r"(?is)<footer[^>]*>.*?</footer>",
    r"(?is)<h1[^>]*>.*?</h1>",
]
BLOCK = r"(?i)</?(?:p|br|div|li|ul|ol|tr|table|h[1-6]|section|blockquote|pre)(?:\s[^>]*)?/?>"
TAG = r"(?s)<[^>]*>"
# Named references: those of HTML 4, the ampersand last.
ENTITIES = {f"&{name};": chr(code) for name, code in sorted(name2codepoint.items()) if name not in ("amp", "nbsp")}
ENTITIES |= {"&nbsp;": " ", "&apos;": "'", "&amp;": "&"}
REFERENCE = r"&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
LANG = r"(?i)<html[^>]*\slang=[\"']?([a-z]+)"
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)"


def _character(code: Column) -> Column:
    """The character of a decimal or ``x`` hexadecimal number, empty if there is none."""
    number = F.when(F.lower(F.substring(code, 1, 1)) == "x", F.conv(F.substring(code, 2, 6), 16, 10)).otherwise(code).cast("int")
    valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise("")


def _decoded(text: Column) -> Column:
    """Character references decoded: numeric ones by their number, named ones by table, the ampersand last.

    Each kind that occurs in the text is replaced once; a text without an ampersand is left as it is.
    """
    numbers = F.array_distinct(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)))
    plain = F.aggregate(numbers, text, lambda t, n: F.replace(t, F.concat(F.lit("&#"), n, F.lit(";")), _character(n)))
    names = F.array_distinct(F.regexp_extract_all(plain, F.lit("&[a-zA-Z][a-zA-Z0-9]*;"), F.lit(0)))
    table = F.map_from_arrays(F.lit(list(ENTITIES)), F.lit(list(ENTITIES.values())))
    known = F.filter(names, lambda n: F.map_contains_key(table, n) & (n != "&amp;"))
    named = F.aggregate(known, plain, lambda t, n: F.replace(t, n, F.element_at(table, n)))
    return F.when(F.contains(text, F.lit("&")), F.replace(named, F.lit("&amp;"), F.lit("&"))).otherwise(text)


def _main_text(html: str) -> Column:
    """All articles, else the body, else all markup but the head."""
    article = F.array_join(F.regexp_extract_all(html, F.lit(ARTICLE), F.lit(1)), "\n")
    body = F.regexp_extract(html, BODY, 1)
    main = F.when(article != "", article).when(body != "", body).otherwise(F.regexp_replace(html, HEAD, " "))
    shown = reduce(lambda c, p: F.regexp_replace(c, p, " "), HIDDEN, main)
    plain = F.regexp_replace(F.regexp_replace(shown, BLOCK, "\n"), TAG, "")
    spaced = F.regexp_replace(_decoded(plain), r"[ \t\r]+", " ")
    return F.regexp_replace(F.regexp_replace(spaced, r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")


def extract_text(pages: DataFrame) -> DataFrame:
    """Main text of each page: the article, or the body without its furniture."""
    return pages.select("page_id", "url", _main_text("html").alias("text"))


def page_meta(pages: DataFrame) -> DataFrame:
    """Title, declared language and host; ``und`` where no language is declared."""
    lang = F.lower(F.regexp_extract("html", LANG, 1))
    return pages.select(
        "page_id",
        F.trim(_decoded(F.regexp_extract("html", TITLE, 1))).alias("title"),
        F.when(lang == "", "und").otherwise(lang).alias("lang"),
        F.lower(F.regexp_extract("url", HOST, 1)).alias("host"),
    )


def documents(pages: DataFrame, keep: tuple = ()) -> DataFrame:
    """Pages as documents in one narrow pass; the host is the source. Columns ``keep`` of the pages go along."""
    lang = F.lower(F.regexp_extract("html", LANG, 1))
    return pages.select(
        F.col("page_id").alias("doc_id"),
        _main_text("html").alias("text"),
        F.when(lang == "", "und").otherwise(lang).alias("lang"),
        F.lower(F.regexp_extract("url", HOST, 1)).alias("source"),
        *keep,
    ).withColumn("n_chars", F.length("text").cast("long"))
