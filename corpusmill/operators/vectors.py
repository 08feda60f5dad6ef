"""Embedding columns, and clusters with Spark ML."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.constants import CLUSTER_K, CLUSTER_SEED
from corpusmill.functions.common import all_finite
from corpusmill.operators.terms import term_vectors


def embed_texts(docs: DataFrame, content: str = "content", output: str = "content_embedding", key: str = "seq") -> DataFrame:
    """Keep an embedding column that exists; otherwise add sparse unit tf-idf vectors over the whole vocabulary.

    ``output`` holds the weights and ``<output>_terms`` their terms, in ascending order; ``key`` must be unique. Texts without
    a term that tells them from others have empty arrays.
    """
    if output in docs.columns:
        return docs
    found = term_vectors(docs, content, key, staged=True).withColumnsRenamed({"weights": output, "terms": f"{output}_terms"})
    return docs.drop(f"{output}_terms").join(found, key, "left").withColumns({
        output: F.coalesce(output, F.array().cast("array<float>")), f"{output}_terms": F.coalesce(f"{output}_terms", F.array().cast("array<string>"))
    })


def cluster_vectors(
    records: DataFrame, embedding: str = "content_embedding", k: int = CLUSTER_K, seed: int = CLUSTER_SEED
) -> DataFrame:
    """Add ``cluster``: k-means on unit vectors; all 0 when there are fewer usable rows than clusters.

    Rows with a missing, all-zero or non-finite vector are not fitted; beside a fitted model their cluster is null.
    """
    good = F.coalesce(F.exists(embedding, lambda x: x != 0) & all_finite(F.col(embedding)), F.lit(False))
    usable = records.filter(good)
    if usable.limit(k).count() < k:
        return records.withColumn("cluster", F.lit(0))
    norm = Normalizer(inputCol="_raw", outputCol="_unit")
    train = norm.transform(usable.select(array_to_vector(F.col(embedding)).alias("_raw")))
    model = KMeans(k=k, seed=seed, featuresCol="_unit", predictionCol="cluster").fit(train)
    scored = model.transform(norm.transform(usable.withColumn("_raw", array_to_vector(F.col(embedding))))).drop("_raw", "_unit")
    return scored.unionByName(records.filter(~good).withColumn("cluster", F.lit(None).cast("int")))
