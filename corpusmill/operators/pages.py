"""Derived columns and tables of raw pages."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.constants import CONTENT_ID, WIKI_MARKER
from corpusmill.functions import page_html as H
from corpusmill.functions.common import SLICE_ROWS
from corpusmill.functions.links import extract_links, link_title
from corpusmill.operators.categories import category_page_title

_PARTS = {
    "main_content": ("string", pa.string()),
    "links": ("array<string>", pa.list_(pa.string())),
    "infobox": ("map<string,string>", pa.map_(pa.string(), pa.string())),
    "tables": ("array<array<array<string>>>", pa.list_(pa.list_(pa.list_(pa.string())))),
    "images": (
        "array<struct<image_url:string,caption:string>>",
        pa.list_(pa.struct([("image_url", pa.string()), ("caption", pa.string())])),
    ),
}


def parse_pages(
    pages: DataFrame,
    parts: tuple[str, ...] = tuple(_PARTS),
    base: str = "",
    marker: str = WIKI_MARKER,
    content_id: str = CONTENT_ID,
) -> DataFrame:
    """Add the wanted ``parts`` to a table with an ``html`` column, parsing every page once.

    ``base`` is the address links are resolved against, unless the table has a ``base_url`` column.
    """
    has_base = "base_url" in pages.columns
    extract = {
        "main_content": lambda page, text, at: H.main_content(page, text, content_id),
        "links": lambda page, text, at: H.links(page, at, marker),
        "infobox": lambda page, text, at: list(H.infobox(page).items()),
        "tables": lambda page, text, at: H.tables(page),
        "images": lambda page, text, at: H.images(page),
    }

    def run(batches):
        # A few pages at a time: what is found takes several times the bytes of a batch.
        for batch in (b.slice(i, SLICE_ROWS) for b in batches for i in range(0, b.num_rows, SLICE_ROWS)):
            texts = batch.column("html").to_pylist()
            bases = batch.column("base_url").to_pylist() if has_base else [base] * len(texts)
            found: dict[str, list] = {name: [] for name in parts}
            for text, at in zip(texts, bases):
                page = H.parse(text or "")
                for name in parts:
                    found[name].append(extract[name](page, text, at))
            new = [pa.array(found[name], type=_PARTS[name][1]) for name in parts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *new], names=[*batch.schema.names, *parts]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields]
    fields += [f"`{name}` {_PARTS[name][0]}" for name in parts]
    return pages.mapInArrow(run, ", ".join(fields))


def page_infoboxes(pages: DataFrame) -> DataFrame:
    """(title, language, infobox) of pages (title, language, html) that have one."""
    return (
        parse_pages(pages.select("title", "language", "html"), ("infobox",))
        .filter(F.size("infobox") > 0)
        .select("title", "language", "infobox")
    )


def page_tables(pages: DataFrame) -> DataFrame:
    """(title, language, tables) of pages (title, language, html) that have tables."""
    return (
        parse_pages(pages.select("title", "language", "html"), ("tables",))
        .filter(F.size("tables") > 0)
        .select("title", "language", "tables")
    )


def table_cells(tables: DataFrame, *keys: str) -> DataFrame:
    """Long form of a ``tables`` column: keys, table_no, row_no, col_no, cell."""
    return (
        tables.select(*keys, F.posexplode("tables").alias("table_no", "t"))
        .select(*keys, "table_no", F.posexplode("t").alias("row_no", "r"))
        .select(*keys, "table_no", "row_no", F.posexplode("r").alias("col_no", "cell"))
    )


def strip_tables(html: Column) -> Column:
    """Drop tables without nested tables, repeated once for one level of nesting."""
    plain = r"(?is)<table\b[^>]*>(?:(?!<table\b).)*?</table\s*>"
    return F.regexp_replace(F.regexp_replace(html, plain, ""), plain, "")


def content_element(html: Column, tag: str = "article") -> Column:
    """Outermost span of a content element, tables dropped, as one regex; the page itself when absent.

    For page layouts whose content element occurs once. Pages that mark content by a nested ``div`` id go
    through :func:`parse_pages`.
    """
    bare = strip_tables(html)
    found = F.regexp_extract(bare, rf"(?is)<{tag}\b[^>]*>.*</{tag}\s*>", 0)
    return F.when(found == "", html).otherwise(found)


def link_rows(pages: DataFrame, key: str, base: Column, marker: str = WIKI_MARKER) -> DataFrame:
    """(src, pos, url, dst) of all marked links, extracted with JVM regexes only."""
    listed = pages.select(F.col(key).alias("src"), F.posexplode(extract_links(F.col("html"), base, marker)))
    return listed.select("src", F.col("pos"), F.col("col").alias("url"), link_title(F.col("col"), marker).alias("dst"))


def category_page_links(pages: DataFrame, names: DataFrame, base: Column) -> DataFrame:
    """Links on the category pages of ``names`` (name, lang), from pages (title, lang, html)."""
    wanted = names.select(category_page_title(F.col("name"), F.col("lang")).alias("title"), "lang").distinct()
    return link_rows(pages.join(wanted, ["title", "lang"], "left_semi"), "title", base)
