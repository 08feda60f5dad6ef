"""Category names, weights and work grids. The canonical list is a fixed constant, so no join is needed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.constants import (
    CATEGORY_ALIASES,
    CATEGORY_PREFIXES,
    CATEGORY_WEIGHTS,
    DEFAULT_WEIGHT,
    LANGUAGES,
)
from corpusmill.functions.common import by_key, let
from corpusmill.functions.text import fold_accents, fold_text


def normalize_category(name: Column) -> Column:
    """Canonical name, ignoring accents and case, else the alias target, else null."""
    cases = {fold_text(c).lower(): F.lit(c) for c in CATEGORY_WEIGHTS}
    for alias, canonical in CATEGORY_ALIASES.items():
        cases.setdefault(alias, F.lit(canonical))
    return let(F.lower(fold_accents(name)), lambda key: by_key(key, cases, F.lit(None).cast("string")))


def category_weight(name: Column) -> Column:
    return by_key(name, {c: F.lit(w) for c, w in CATEGORY_WEIGHTS.items()}, F.lit(DEFAULT_WEIGHT))


def closest_category(
    name: Column, candidates: Sequence[str] = tuple(CATEGORY_WEIGHTS), max_distance: int | None = None
) -> Column:
    """Candidate with the smallest edit distance on folded names (ties by name), null beyond the cut-off."""

    def best(key: Column) -> Column:
        options = F.array(
            *[
                F.struct(F.levenshtein(key, F.lit(fold_text(c).lower())).alias("d"), F.lit(c).alias("name"))
                for c in candidates
            ]
        )
        return F.array_min(options)

    nearest = let(F.lower(fold_accents(name)), best)
    if max_distance is None:
        return nearest["name"]
    return F.when(nearest["d"] <= max_distance, nearest["name"])


def resolve_categories(names: DataFrame, known: DataFrame, max_distance: int | None = None) -> DataFrame:
    """(name, resolved): exact names stay; the others take the closest canonical name, or null."""
    names = names.select("name").distinct()
    marked = names.join(known.select("name").distinct().withColumn("known", F.lit(True)), "name", "left")
    return marked.select(
        "name",
        F.when(F.col("known"), F.col("name"))
        .otherwise(closest_category(F.col("name"), max_distance=max_distance))
        .alias("resolved"),
    )


def strip_category_prefix(title: Column) -> Column:
    for prefix in CATEGORY_PREFIXES:
        title = F.replace(title, F.lit(prefix), F.lit(""))
    return title


def category_page_title(name: Column, lang: Column) -> Column:
    english, portuguese = CATEGORY_PREFIXES
    return F.when(lang == "pt", F.concat(F.lit(portuguese), name)).otherwise(F.concat(F.lit(english), name))


def work_grid(
    jobs: DataFrame, languages: Sequence[str] = tuple(LANGUAGES), categories: Sequence[str] = tuple(CATEGORY_WEIGHTS)
) -> DataFrame:
    """One row per language and category of each job, in job columns otherwise; a null list means all.

    Two nested explodes inside the row: no cross join.
    """
    lang = F.coalesce("lang", F.array(*[F.lit(x) for x in languages]))
    category = F.coalesce("category", F.array(*[F.lit(x) for x in categories]))
    rest = [c for c in jobs.columns if c not in ("lang", "category")]
    grid = jobs.select(*rest, F.explode(lang).alias("lang"), category.alias("categories")).select(
        *rest, "lang", F.explode("categories").alias("category")
    )
    named = F.coalesce(normalize_category(F.col("category")), F.col("category"))
    return grid.withColumn("category", named).withColumn("weight", category_weight(F.col("category")))
