"""Whole flows: record building, the quality pass, training conversions, source runs."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.constants import EMBEDDING_THRESHOLD, RECORD_SOURCE, SIMHASH_DISTANCE
from corpusmill.functions.keywords import extract_keywords
from corpusmill.functions.links import source_url
from corpusmill.functions.questions import generate_answers, generate_questions
from corpusmill.functions.relations import extract_relations
from corpusmill.functions.text import advanced_clean_text, clean_text
from corpusmill.functions.topics import classify_topic
from corpusmill.operators.dedup import deduplicate_by_hash, deduplicate_by_simhash
from corpusmill.operators.fill import complete_missing_fields
from corpusmill.operators.ordering import final_sort
from corpusmill.operators.quality import long_enough, validate_for_save, validate_semantics
from corpusmill.operators.similarity import deduplicate_by_embedding
from corpusmill.operators.stats import progress, removal_accounting
from corpusmill.operators.summaries import summarize
from corpusmill.operators.vectors import cluster_vectors, embed_texts
from corpusmill.session import materialize, unstage
from corpusmill.sinks.writers import KEEP_NULLS, embedding_export, qa_pairs, triples, write_dataset
from corpusmill.sources.registry import union_sources
from corpusmill.sources.tables import read_records


def clean_pages(pages: DataFrame, stop_words: dict[str, Iterable[str]] | None = None, drop_short: bool = True) -> DataFrame:
    """Replace ``text`` by cleaned ``content`` and drop pages that are too short, unless told to keep them.

    The length test comes before any costly derivation. It is an explode of a list of one or no text: a
    plain filter would be pushed below the column and evaluate the cleaning chain once more.
    """
    content = advanced_clean_text(clean_text(F.col("text")), F.col("lang"), stop_words)
    if not drop_short:
        return pages.select(*[c for c in pages.columns if c != "text"], content.alias("content"))
    kept = F.filter(F.array(content), lambda c: long_enough(c))
    return pages.select(*[c for c in pages.columns if c != "text"], F.explode(kept).alias("content"))


def derive_records(pages: DataFrame, stop_words: dict[str, Iterable[str]]) -> DataFrame:
    """Record columns that depend on one row only, from seq, title, lang, category, content and summary."""
    title, lang, content = F.col("title"), F.col("lang"), F.col("content")
    entities = F.col("entities") if "entities" in pages.columns else None
    return (
        pages.withColumn("keywords", extract_keywords(content, lang, stop_words))
        .withColumn("_topic", classify_topic(title, content))
        .select(
            "seq",
            F.md5(F.concat(title, F.lit("_"), lang)).alias("id"),
            "title",
            lang.alias("language"),
            "category",
            F.col("_topic.topic").alias("topic"),
            F.col("_topic.subtopic").alias("subtopic"),
            "keywords",
            "content",
            "summary",
            generate_questions(title, lang, F.col("keywords"), entities).alias("questions"),
            generate_answers(content, F.col("summary")).alias("answers"),
            extract_relations(content).alias("relations"),
            (F.col("created_at") if "created_at" in pages.columns else F.current_timestamp()).alias("created_at"),
            F.struct(
                F.length(content).alias("length"),
                F.lit(RECORD_SOURCE).alias("source"),
                source_url(lang, title).alias("source_url"),
            ).alias("metadata"),
            *[c for c in ("entities", "images", "wikidata_id", "image_url") if c in pages.columns],
        )
    )


def build_records(
    pages: DataFrame,
    stop_words: dict[str, Iterable[str]],
    remove_stop_words: bool = False,
    idf: np.ndarray | None = None,
) -> DataFrame:
    """Page texts (seq, title, text, lang, category) to records with summaries and embeddings.

    Cleaned texts and derived records are staged as tables, because term statistics and the embedding
    models read them before the rows themselves are needed.
    """
    cleaned = materialize(clean_pages(pages, stop_words if remove_stop_words else None), "cleaned")
    records = materialize(derive_records(summarize(cleaned, idf=idf), stop_words), "derived")
    unstage(cleaned)
    records = embed_texts(records)
    return embed_texts(records, content="summary", output="summary_embedding")


@dataclass(frozen=True)
class QualityResult:
    records: DataFrame
    rejected: DataFrame
    progress: DataFrame
    accounting: DataFrame


def quality_pass(
    records: DataFrame,
    extra: DataFrame | None = None,
    threshold: float = EMBEDDING_THRESHOLD,
    distance: int = SIMHASH_DISTANCE,
) -> QualityResult:
    """Key hash, embeddings, fill, semantic validation, snapshot, simhash, save validation, sort.

    The snapshot is taken before simhash and save validation, so their removals do not show in it.
    Records are staged as a table where several later steps read them; once the valid ones are, the first table is deleted.
    """
    records = materialize(records, "records")
    unique, same_key = deduplicate_by_hash(records)
    distinct, similar = deduplicate_by_embedding(unique, threshold)
    filled = distinct if extra is None else complete_missing_fields(distinct, extra)
    valid, invalid = validate_semantics(filled)
    valid = materialize(valid, "valid")
    counts = removal_accounting({"hash": same_key, "embedding": similar, "semantics": invalid})
    counts = materialize(counts, "counts")
    removed = counts.filter("stage <> 'semantics'").agg(F.sum("removed")).scalar()
    bad = counts.filter("stage = 'semantics'").agg(F.sum("removed")).scalar()
    unstage(records)
    snapshot = progress(valid, removed, bad)
    apart, near = deduplicate_by_simhash(valid, distance)
    saved, rejected = validate_for_save(apart)
    accounting = counts.unionByName(removal_accounting({"simhash": near, "save": rejected}))
    return QualityResult(final_sort(saved), rejected, snapshot, accounting)


def cluster_records(records: DataFrame) -> DataFrame:
    return cluster_vectors(records)


def training_bundle(spark: SparkSession, path: str, lines: bool = False) -> dict[str, str]:
    """Write ``_pairs``, ``_embeddings`` and ``_triples`` next to the dataset at ``path``."""
    # Only what the three tables take is kept beside the file; texts of pages are in it once, as answers.
    wanted = ["id", "title", "keywords", "content_embedding"]
    spoken = lambda name: F.transform(name, lambda x: F.struct(x["text"].alias("text"))).alias(name)
    records = read_records(spark, path, lines).select(*wanted, spoken("questions"), spoken("answers")).persist()
    base = path.rstrip("/")
    head, dot, tail = base.rpartition(".")
    if dot and "/" not in tail:
        base = head
    out = {
        "pairs": qa_pairs(records).select("question", "answer"),
        "embeddings": embedding_export(records),
        "triples": triples(records),
    }
    targets = {name: f"{base}_{name}" for name in out}
    for name, df in out.items():
        df.write.mode("overwrite").options(**KEEP_NULLS).json(targets[name])
    records.unpersist()
    return targets


def run_source(spark: SparkSession, name: str, grid: DataFrame, path: str, fmt: str = "all") -> DataFrame:
    """Scan, parse and write one source's rows; rows are written as they are, without save validation."""
    rows = union_sources(spark, [name], grid)
    write_dataset(rows, path, fmt)
    return rows
