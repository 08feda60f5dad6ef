"""Addresses: page URLs, base URLs, link targets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.constants import BASE_URL_PATTERN, BASE_URLS, WIKI_MARKER
from corpusmill.functions.common import by_key
from corpusmill.functions.text import unescape

_ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
_HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"


def base_url(lang: Column) -> Column:
    head, tail = BASE_URL_PATTERN.split("{lang}")
    cases = {code: F.lit(url) for code, url in BASE_URLS.items()}
    return by_key(lang, cases, F.concat(F.lit(head), lang, F.lit(tail)))


def source_url(lang: Column, title: Column) -> Column:
    return F.concat(base_url(lang), F.lit(WIKI_MARKER), F.replace(title, F.lit(" "), F.lit("_")))


def percent_decode(text: Column) -> Column:
    """Decode %XX and leave ``+`` alone; text with broken escapes stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def after_marker(path: Column, marker: str = WIKI_MARKER) -> Column:
    """Part after the last marker, or all of it when there is no marker."""
    return F.substring_index(path, marker, -1)


def url_path(url: Column) -> Column:
    """Path part, cut out textually so that unusual characters do not turn the result into null."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    rest = F.regexp_replace(rest, r"^//[^/?#]*", "")
    return F.regexp_replace(rest, r"(?s)[?#].*$", "")


def url_host(url: Column) -> Column:
    """Lower-case host name without user and port."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def parse_page_url(url: Column, marker: str = WIKI_MARKER) -> Column:
    """Struct (title, lang) of a page address; underscores stay."""
    return F.struct(
        percent_decode(after_marker(url_path(url), marker)).alias("title"),
        F.substring_index(url_host(url), ".", 1).alias("lang"),
    )


def link_title(url: Column, marker: str = WIKI_MARKER) -> Column:
    """Page title a link points to, or null when its path lacks the marker."""
    path = url_path(url)
    title = F.replace(percent_decode(after_marker(path, marker)), F.lit("_"), F.lit(" "))
    return F.when(F.contains(path, F.lit(marker)), title)


def absolute_url(href: Column, base: Column) -> Column:
    """Resolve ``href`` against a base that is a bare scheme and host."""
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.substring_index(base, ":", 1), F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(base, href))
        .when(href.rlike("^[?#]"), F.concat(base, href))
        .otherwise(F.concat(base, F.lit("/"), F.regexp_replace(href, r"^(\.{1,2}/)+", "")))
    )


def anchors(html: Column) -> Column:
    """href values of all anchors in page order, repeats included."""
    visible = F.regexp_replace(html, _HIDDEN, "")
    tags = F.regexp_extract_all(visible, F.lit(_ANCHOR), F.lit(0))
    return F.transform(
        tags,
        lambda t: F.concat(*[F.regexp_extract(t, _ANCHOR, g) for g in (1, 2, 3)]),
    )


def extract_links(html: Column, base: Column, marker: str = WIKI_MARKER) -> Column:
    """Absolute link targets whose href contains the marker."""
    decoded = unescape(F.array_join(anchors(html), "\n"))
    hrefs = F.filter(F.split(decoded, "\n"), lambda h: F.contains(h, F.lit(marker)))
    return F.transform(hrefs, lambda h: absolute_url(h, base))
