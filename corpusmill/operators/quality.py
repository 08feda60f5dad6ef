"""Record filters and validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.constants import MIN_TEXT_LENGTH, NS_CATEGORY, NS_MAIN
from corpusmill.functions.common import all_finite, is_empty_array, is_empty_text
from corpusmill.functions.text import clean_text
from corpusmill.operators.entities import find_entities
from corpusmill.session import materialize

RECORD_VIEW = ["id", "title", "language", "category", "topic", "subtopic", "summary", "created_at"]


def long_enough(content: Column, minimum: int = MIN_TEXT_LENGTH) -> Column:
    return F.length(content) >= minimum


def filter_records(
    records: DataFrame,
    langs: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Rows matching every given condition; bounds are inclusive and a bare date means midnight.

    Plain comparisons on stored columns, so they reach the file scan.
    """
    if langs:
        records = records.filter(F.col("language").isin(list(langs)))
    if categories:
        records = records.filter(F.col("category").isin(list(categories)))
    if start:
        records = records.filter(F.col("created_at") >= F.lit(start).cast("timestamp"))
    if end:
        records = records.filter(F.col("created_at") <= F.lit(end).cast("timestamp"))
    return records


def record_view(records: DataFrame) -> DataFrame:
    return records.select(*RECORD_VIEW)


def enrich_records(records: DataFrame, gazetteer: DataFrame | None = None, seq: str = "seq") -> DataFrame:
    """Add ``clean_content`` and, with a gazetteer, the ``entities`` found in it."""
    out = records.withColumn("clean_content", clean_text(F.col("content")))
    if gazetteer is None:
        return out
    # Written once, as the texts are read for the lookup and again for the result.
    out = materialize(out, "cleaned")
    found = find_entities(out.select(F.col(seq).alias("seq"), F.col("clean_content").alias("content")), gazetteer)
    lists = found.groupBy("seq").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("pos", "text", "type"))),
            lambda e: F.struct(e["text"].alias("text"), e["type"].alias("type")),
        ).alias("entities")
    )
    joined = out.drop("entities").join(lists.withColumnRenamed("seq", seq), seq, "left")
    empty = F.array().cast("array<struct<text:string,type:string>>")
    return joined.withColumn("entities", F.coalesce("entities", empty))


def semantically_valid() -> Column:
    """Content, summary, questions and answers present, embeddings finite."""
    return (
        ~is_empty_text(F.col("content"))
        & ~is_empty_text(F.col("summary"))
        & ~is_empty_array(F.col("questions"))
        & ~is_empty_array(F.col("answers"))
        & all_finite(F.col("content_embedding"))
        & all_finite(F.col("summary_embedding"))
    )


def validate_semantics(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) rows."""
    marked = records.withColumn("ok", semantically_valid())
    return marked.filter("ok").drop("ok"), marked.filter("not ok").drop("ok")


def save_reasons(minimum: int = MIN_TEXT_LENGTH) -> Column:
    """Names of the save rules a record breaks, in rule order; ``relations`` may be empty but not missing."""
    rules = [
        ("content_embedding", ~all_finite(F.col("content_embedding"))),
        ("summary_embedding", ~all_finite(F.col("summary_embedding"))),
        ("questions", is_empty_array(F.col("questions"))),
        ("answers", is_empty_array(F.col("answers"))),
        ("relations", F.col("relations").isNull()),
        ("summary", F.length(F.coalesce("summary", F.lit(""))) < minimum),
    ]
    return F.array_compact(F.array(*[F.when(broken, name) for name, broken in rules]))


def validate_for_save(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) rows; the rejected ones carry ``reasons``."""
    marked = records.withColumn("reasons", save_reasons())
    return marked.filter(F.size("reasons") == 0).drop("reasons"), marked.filter(F.size("reasons") > 0)


def main_pages(members: DataFrame) -> DataFrame:
    return members.filter(F.col("ns") == NS_MAIN)


def category_pages(members: DataFrame) -> DataFrame:
    return members.filter(F.col("ns") == NS_CATEGORY)
