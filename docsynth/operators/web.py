"""Crawled pages: article text, links, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsynth.functions.binding import let

# Named entities besides the ampersand.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0"}


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/?#:]+)", 1)


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'<a [^>]*href="([^"]*)"'), F.lit(1))


def image_urls(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'<img [^>]*src="([^"]*)"'), F.lit(1))


def strip_markup(html: Column) -> Column:
    """Text of a fragment: script and style bodies go with their tags, other tags leave a space."""
    bare = F.regexp_replace(html, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"\s+", " "))


def unescape(text: Column) -> Column:
    """Named entities of markup and numeric ones of every plane; ``&amp;`` last, so that nothing is decoded twice.

    A number that names no character (0, a surrogate, or beyond the last plane) stays as it is written.
    """

    def decoded(acc: Column, one: Column) -> Column:
        body = F.regexp_extract(one, "([0-9A-Fa-f]+);", 1)
        code = F.when(one.rlike("[xX]"), F.conv(body, 16, 10)).otherwise(body)
        return let(code.cast("bigint"), lambda n: F.when((n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF), F.replace(acc, one, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))).otherwise(acc))

    def numbers(t: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(t, F.lit("&#(?:[0-9]{1,10}|[xX][0-9A-Fa-f]{1,8});"), F.lit(0)))
        return F.when(F.contains(t, F.lit("&#")), F.aggregate(found, t, decoded)).otherwise(t)

    for name, sign in ENTITIES.items():
        text = F.replace(text, F.lit(f"&{name};"), F.lit(sign))
    return F.replace(let(text, numbers), F.lit("&amp;"), F.lit("&"))


def paragraphs(html: Column) -> Column:
    """Texts of the paragraphs, one a line; a paragraph ends where its end tag or the next one stands."""
    parts = F.split(html, r"<[pP](?:\s[^>]*)?>")
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    texts = F.transform(rest, lambda p: unescape(strip_markup(F.split(p, "</[pP]>")[0])))
    return F.array_join(F.filter(texts, lambda x: x != ""), "\n")


def article_text(html: Column) -> Column:
    """Paragraphs of the article element; where it has none, all its text, and without an article that of the body."""
    body = F.regexp_extract(html, r"(?s)<body[^>]*>(.*)</body>", 1)
    found = lambda text, rest: let(text, lambda x: F.when(x != "", x).otherwise(rest))
    whole = unescape(strip_markup(body))
    article = F.regexp_extract(html, r"(?s)<article[^>]*>(.*)</article>", 1)
    return let(article, lambda a: found(paragraphs(a), found(unescape(strip_markup(a)), whole)))


def allowed(link: Column, pattern: str) -> Column:
    return link.rlike(pattern)
