"""A training-data pipeline of five stages, each one operator of ``corpusmill.llm`` over all rows the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import decontaminate, secret_scan, sketch_join, trie_bpe, weak_quality
from corpusmill.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality and toxicity scorer accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return weak_quality.drop_rejected(docs, weak_quality.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return sketch_join.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; of the others, only benchmark passages of at least a window (13 words) are cut out.

    Shorter items count as hits, but stay in documents that are not contaminated, also where they are covered whole.
    """
    # Columns of the caller that have the names of the operator's results come back unchanged.
    aside = {c: f"__{c}" for c in ("n_words", "hit_ranges", "hit_items") if c in docs.columns}
    cut = decontaminate.drop_contaminated(docs.withColumnsRenamed(aside), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _recounted(cut.withColumnsRenamed({b: a for a, b in aside.items()}), docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets masked in the texts; all documents stay."""
    return _recounted(secret_scan.redact_secrets(docs), docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts."""
    encoded = trie_bpe.encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


def _recounted(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with ``n_chars``, where there is one, of the changed text."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("BPE encoding", bpe),
]

# The trained scorer, the automaton and the token ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
