"""Page tables to links, content, infoboxes, tables, images."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import pages, query, table
from corpusmill.functions.links import parse_page_url
from corpusmill.operators import pages as P
from corpusmill.operators.ordering import image_manifest


@query(
    "page_url_parts",
    r"""SELECT page_id, split_part(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/', -1) AS title,
      split_part(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1), '.', 1) AS lang FROM pages""",
)
def url_parts(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", parse_page_url(F.col("url"), "/").alias("p"))
    return rows.select("page_id", "p.title", "p.lang")


_LINKS = r"""hrefs AS (SELECT page_id, unnest(h) AS href, generate_subscripts(h, 1) - 1 AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1) AS h FROM pages))"""


@query(
    "extract_links",
    rf"""WITH {_LINKS} SELECT page_id, pos, 'https://en.example.org' || href AS url FROM hrefs WHERE contains(href, '/')""",
)
def extract_links(spark, sf):
    rows = P.link_rows(pages(spark, sf), "page_id", F.lit("https://en.example.org"), "/")
    return rows.select(F.col("src").alias("page_id"), "pos", "url")


@query(
    "extract_links_parsed",
    rf"""WITH {_LINKS} SELECT page_id, pos, 'https://en.example.org' || href AS url FROM hrefs WHERE contains(href, '/')""",
)
def extract_links_parsed(spark, sf):
    parsed = P.parse_pages(pages(spark, sf).select("page_id", "html"), ("links",), "https://en.example.org", "/")
    return parsed.select("page_id", F.posexplode("links").alias("pos", "url"))


@query(
    "content_element",
    r"""SELECT page_id, regexp_extract(html, '(?s)<article>.*</article>', 0) AS content FROM pages""",
)
def content_element(spark, sf):
    added = F.replace("html", F.lit("<article>"), F.lit("<article><table class='x'><tr><td>gone</td></tr></table>"))
    return pages(spark, sf).select("page_id", P.content_element(added).alias("content"))


def marked_pages(spark, sf):
    """Pages with a content element, an infobox, a data table and images built from their own fields."""
    key = F.col("page_id").cast("string")
    block = F.concat(
        F.lit("<div id='mw-content-text'><p>body "), key, F.lit("</p><table class='infobox vcard'><tr><th>Key</th><td> "), key,
        F.lit("</td></tr><tr><th>Url<td>"), F.replace("url", F.lit("&"), F.lit("&amp;")),
        F.lit("</td></tr></table><table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>"), key,
        F.lit("</td></tr></table><div class='thumb left'><img src='//img/"), key,
        F.lit(".png'/><div class='thumbcaption'>Cap "), key, F.lit("</div></div><figure><img src='f.png'></figure></div>"),
    )
    return pages(spark, sf).select(
        F.concat(F.lit("page "), key).alias("title"), F.lit("en").alias("language"),
        F.replace("html", F.lit("<article>"), F.concat(block, F.lit("<article>"))).alias("html"),
    )


@query(
    "main_content",
    """SELECT 'page ' || page_id AS title, '<div id="mw-content-text"><p>body ' || page_id || '</p><div class="thumb left">'
      || '<img src="//img/' || page_id || '.png"/><div class="thumbcaption">Cap ' || page_id
      || '</div></div><figure><img src="f.png"/></figure></div>' AS content FROM pages""",
)
def main_content(spark, sf):
    return P.parse_pages(marked_pages(spark, sf), ("main_content",)).select("title", F.col("main_content").alias("content"))


@query(
    "page_infoboxes",
    """SELECT 'page ' || page_id AS title, 'en' AS language, 'Key' AS key, page_id::VARCHAR AS value FROM pages
    UNION ALL SELECT 'page ' || page_id, 'en', 'Url' || url, url FROM pages""",
)
def infoboxes(spark, sf):
    found = P.page_infoboxes(marked_pages(spark, sf))
    return found.select("title", "language", F.explode("infobox").alias("key", "value"))


@query(
    "page_tables",
    """SELECT 'page ' || page_id AS title, table_no, row_no, col_no,
      CASE cell WHEN 'key' THEN page_id::VARCHAR WHEN 'url' THEN url WHEN 'Urlurl' THEN 'Url' || url ELSE cell END AS cell
    FROM pages, (VALUES (0, 0, 0, 'Key'), (0, 0, 1, 'key'), (0, 1, 0, 'Urlurl'), (0, 1, 1, 'url'), (1, 0, 0, 'A'), (1, 0, 1, 'B'),
      (1, 1, 0, '1'), (1, 1, 1, 'key')) v(table_no, row_no, col_no, cell)""",
)
def tables(spark, sf):
    return P.table_cells(P.page_tables(marked_pages(spark, sf)), "title")


@query(
    "page_images",
    """SELECT 'page ' || page_id AS title, 0 AS pos, 'https://img/' || page_id || '.png' AS image_url, 'Cap ' || page_id AS caption FROM pages
    UNION ALL SELECT 'page ' || page_id, 1, 'f.png', '' FROM pages""",
)
def images(spark, sf):
    parsed = P.parse_pages(marked_pages(spark, sf), ("images",)).select("title", F.posexplode("images").alias("pos", "i"))
    return parsed.select("title", "pos", "i.image_url", "i.caption")


@query(
    "image_manifest",
    """WITH n AS (SELECT *, row_number() OVER (ORDER BY page_id) - 1 AS k FROM pages)
    SELECT page_id AS seq, lpad(k::VARCHAR, 5, '0') || CASE page_id % 3 WHEN 0 THEN '.png' ELSE '.jpg' END AS file_name,
      CASE WHEN page_id % 2 = 0 THEN 'cap ' || page_id ELSE url END AS caption,
      'http://img.example.org/a.b/' || page_id || CASE page_id % 3 WHEN 0 THEN '.png' ELSE '' END AS image_url
    FROM n WHERE NOT contains(url, '?')""",
)
def manifest(spark, sf):
    key = F.col("page_id")
    address = F.concat(F.lit("http://img.example.org/a.b/"), key, F.when(key % 3 == 0, ".png").otherwise(""))
    records = table(spark, sf, "pages").select(
        key.alias("seq"),
        F.when(~F.contains(F.col("url"), F.lit("?")), address).alias("image_url"),
        F.when(key % 2 == 0, F.concat(F.lit("cap "), key)).otherwise("").alias("caption"),
        F.col("url").alias("title"),
    )
    return image_manifest(records)


@query(
    "category_page_links",
    rf"""WITH {_LINKS} SELECT CASE WHEN page_id % 2 = 0 THEN 'Category:' ELSE 'Categoria:' END || page_id AS src, pos,
      'https://en.example.org/wiki' || href AS url, replace(substr(href, 2), '_', ' ') AS dst FROM hrefs""",
)
def category_links(spark, sf):
    portuguese = F.col("page_id") % 2 == 1
    prefix, lang = F.when(portuguese, "Categoria:").otherwise("Category:"), F.when(portuguese, "pt").otherwise("en")
    listed = pages(spark, sf).select(
        F.concat(prefix, "page_id").alias("title"), lang.alias("lang"),
        F.replace("html", F.lit('href="/'), F.lit('href="/wiki/')).alias("html"),
    )
    names = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("name"), lang.alias("lang"))
    return P.category_page_links(listed, names, F.lit("https://en.example.org"))
