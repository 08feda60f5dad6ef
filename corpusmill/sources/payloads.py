"""Landed API payloads to rows. Each function takes a DataFrame, so files, tables and streams all work.

A ``limit`` keeps what a request of that size would have brought; without one all landed entries are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.constants import IMAGE_URL_PREFIX, NS_MAIN
from corpusmill.functions.text import advanced_clean_text, clean_text
from corpusmill.operators.ordering import top_n
from corpusmill.schema import RELATED_PAYLOAD_DDL, REVISION_PAYLOAD_DDL


def _first(items: Column | str, limit: int | None) -> Column:
    items = F.col(items) if isinstance(items, str) else items
    return items if limit is None else F.slice(items, 1, limit)


def qa_items(payloads: DataFrame, limit: int | None = None) -> DataFrame:
    """Items of all payloads, or the best-voted ``limit`` per (lang, category)."""
    items = payloads.select("lang", "category", F.explode("items").alias("i")).select("lang", "category", "i.*")
    if limit is None:
        return items
    return top_n(items, ["lang", "category"], [F.desc_nulls_last("score"), "link"], limit).drop("rank")


def parse_qa_items(items: DataFrame) -> DataFrame:
    lang = F.coalesce("lang", F.lit("en"))
    body = clean_text(F.coalesce("body", F.lit("")))
    return items.select(
        F.coalesce("title", F.lit("")).alias("title"),
        lang.alias("language"),
        F.coalesce("category", F.lit("")).alias("category"),
        F.coalesce("score", F.lit(0)).cast("bigint").alias("score"),
        F.coalesce("link", F.lit("")).alias("link"),
        advanced_clean_text(body, lang).alias("content"),
    )


def entity_items(payloads: DataFrame, limit: int | None = None) -> DataFrame:
    """Search hits (lang, category, id, label, description), all or the first ``limit`` per payload."""
    hits = payloads.filter(F.col("search").isNotNull()).select(
        "lang", "category", F.explode(_first("search", limit)).alias("s")
    )
    return hits.select("lang", "category", "s.id", "s.label", "s.description")


def entity_details(payloads: DataFrame) -> DataFrame:
    """(id, entity) from the ``entities`` maps; one row per id."""
    rows = payloads.filter(F.col("entities").isNotNull()).select(F.explode("entities").alias("id", "entity"))
    return rows.withColumn("_h", F.xxhash64("id", F.to_json("entity"))).groupBy("id").agg(
        F.max_by("entity", "_h").alias("entity")
    )


def parse_entity_items(items: DataFrame, details: DataFrame) -> DataFrame:
    """Label and description in the item's language, else those of the hit; image address of the first claim."""
    lang = F.coalesce("lang", F.lit("en"))
    joined = items.filter(F.coalesce("id", F.lit("")) != "").join(details, "id", "left")
    labels, descriptions = F.col("entity.labels"), F.col("entity.descriptions")
    claim = F.get(F.try_element_at(F.col("entity.claims"), F.lit("P18")), F.lit(0))
    image = claim["mainsnak"]["datavalue"]["value"]
    return joined.select(
        F.coalesce(F.try_element_at(labels, lang)["value"], F.col("label"), F.lit("")).alias("title"),
        lang.alias("language"),
        F.coalesce("category", F.lit("")).alias("category"),
        F.coalesce(F.try_element_at(descriptions, lang)["value"], F.col("description"), F.lit("")).alias("description"),
        F.col("id").alias("wikidata_id"),
        F.when(image != "", F.concat(F.lit(IMAGE_URL_PREFIX), image)).alias("image_url"),
    )


def revisions(payloads: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """(key, revisions) from JSON text in ``payload``: all or the first ``limit`` entries per page."""
    pages = F.map_values(F.from_json("payload", REVISION_PAYLOAD_DDL)["query"]["pages"])
    flat = F.flatten(F.transform(F.filter(pages, lambda p: p["revisions"].isNotNull()),
                                 lambda p: _first(p["revisions"], limit)))
    empty = F.array().cast("array<struct<timestamp:string,user:string>>")
    return payloads.select(key, F.coalesce(flat, empty).alias("revisions"))


def related_pages(payloads: DataFrame, limit: int | None = None) -> DataFrame:
    """(lang, title) of main-namespace links from JSON text in ``payload``, of all or the first ``limit`` links per page."""
    pages = F.map_values(F.from_json("payload", RELATED_PAYLOAD_DDL)["query"]["pages"])
    links = payloads.select("lang", F.explode(pages).alias("p")).select(
        "lang", F.explode(_first("p.links", limit)).alias("l")
    )
    return links.filter(F.col("l.ns") == NS_MAIN).select(F.col("l.title").alias("title"), "lang")
