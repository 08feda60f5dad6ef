"""Named sources: how to scan raw items for a work grid, and how to turn items into records."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.pages import page_infoboxes, page_tables
from corpusmill.sources import payloads as P

Scan = Callable[[SparkSession, DataFrame], DataFrame]
Parse = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Source:
    """``scan(spark, grid)`` gives raw items of the wanted (lang, category) rows, ``parse(items)`` records."""

    scan: Scan
    parse: Parse


_sources: dict[str, Source] = {}


def register_source(name: str, scan: Scan, parse: Parse) -> Source:
    _sources[name] = Source(scan, parse)
    return _sources[name]


def load_source(name: str) -> Source:
    """A registered source, else the ``SOURCE`` of the module called ``name``."""
    if name not in _sources:
        _sources[name] = importlib.import_module(name).SOURCE
    return _sources[name]


def _wanted(table: DataFrame, grid: DataFrame) -> DataFrame:
    return table.join(grid.select("lang", "category").distinct(), ["lang", "category"], "left_semi")


def register_payload_sources(
    qa: DataFrame | None = None, entities: DataFrame | None = None, pages: DataFrame | None = None
) -> None:
    """The stock sources over landed data.

    ``qa`` and ``entities`` are payload tables; ``pages`` has title, language, category and html.
    """
    if qa is not None:
        register_source("qa", lambda spark, grid: P.qa_items(_wanted(qa, grid)), P.parse_qa_items)
    if entities is not None:
        details = P.entity_details(entities)
        register_source(
            "entities",
            lambda spark, grid: P.entity_items(_wanted(entities, grid)),
            lambda items: P.parse_entity_items(items, details),
        )
    if pages is not None:
        def scan(spark: SparkSession, grid: DataFrame) -> DataFrame:
            wanted = grid.select(F.col("lang").alias("language"), "category").distinct()
            return pages.join(wanted, ["language", "category"], "left_semi")

        register_source("infobox", scan, page_infoboxes)
        register_source("tables", scan, page_tables)


def union_sources(spark: SparkSession, names: list[str], grid: DataFrame) -> DataFrame:
    """Records of all sources, missing columns as null; nothing is deduplicated."""
    out = None
    for name in names:
        source = load_source(name)
        rows = source.parse(source.scan(spark, grid))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
