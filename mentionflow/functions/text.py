"""Text rules shared by the sources: trimming, fallbacks, social links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode-aware trimming removes at both ends.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Addresses of the social platform, and the length of a title used as an id.
SOCIAL_HOST = "https://x.com"
SOCIAL_STATUS_URL = "https://x.com/i/web/status/"
TITLE_KEY_LENGTH = 60


def trimmed(col: Column) -> Column:
    """Drop white space at both ends, Unicode kinds included (plain `trim` only drops spaces)."""
    return F.btrim(col, F.lit(WHITESPACE))


def or_else(col: Column, fallback: Column) -> Column:
    """`col`, or `fallback` where `col` is null or empty."""
    return F.coalesce(F.nullif(col, F.lit("")), fallback)


def title_key(title: Column) -> Column:
    """The start of a title, counted in code points, for items without a link."""
    return F.substring(title, 1, TITLE_KEY_LENGTH)


def keyword_list(raw: Column) -> Column:
    """Split a comma list: trim each part, drop the blank ones, keep the order."""
    return F.filter(F.transform(F.split(raw, ","), trimmed), lambda part: part != "")


def joined_text(parts: Column) -> Column:
    """Join text nodes with one space, each trimmed, blank ones left out."""
    return F.array_join(F.filter(F.transform(parts, trimmed), lambda part: part != ""), " ")


def social_url(post_id: Column) -> Column:
    return F.concat(F.lit(SOCIAL_STATUS_URL), post_id)


def status_id(href: Column) -> Column:
    """The digits after the only `/status/` of a link; empty when there is none."""
    pieces = F.split(href, "/status/")
    digits = F.regexp_extract(F.element_at(pieces, -1), r"(?s)^/*([0-9]+)(?:[/?].*)?$", 1)
    return F.when(F.size(pieces) == 2, digits).otherwise(F.lit(""))


def first_matching(items: Column, test: Callable[[Column], Column]) -> Column:
    """The first array element that passes; null when none does."""
    return F.try_element_at(F.filter(items, test), F.lit(1))


def status_link(hrefs: Column) -> Column:
    return first_matching(hrefs, lambda href: status_id(href) != "")


def author_handle(hrefs: Column) -> Column:
    """Handle from the first link that is a single path segment; empty when there is none."""
    link = first_matching(hrefs, lambda href: href.rlike(r"(?s)\A/[^/]+\z"))
    return F.coalesce(F.substring(link, 2, 2147483647), F.lit(""))


def on_social_host(href: Column) -> Column:
    """Put the platform's host before a root-relative link; other links stay as they are."""
    return F.when(href.startswith("/"), F.concat(F.lit(SOCIAL_HOST), href)).otherwise(href)


def record_id(source: Column, post_id: Column) -> Column:
    """Id of a stored post. It follows from the key, so a retried task writes the same value."""
    return F.sha2(F.concat_ws("\u0001", source, post_id), 256)
