"""Progress, counters, rates and relation graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def progress(records: DataFrame, duplicates_removed: Column | None = None, invalid: Column | None = None) -> DataFrame:
    """One row: pages, sorted distinct clusters, topics and languages, and the two removal counts."""

    def distinct(name: str) -> Column:
        if name not in records.columns:
            return F.array().cast("array<string>")
        value = F.col(name)
        return F.sort_array(F.collect_set(value if name == "cluster" else F.when(value != "", value)))

    zero = F.lit(0).cast("bigint")
    return records.agg(
        F.count(F.lit(1)).alias("pages_processed"),
        distinct("cluster").alias("clusters"),
        distinct("topic").alias("topics"),
        distinct("language").alias("languages"),
    ).select(
        "*",
        (duplicates_removed if duplicates_removed is not None else zero).alias("duplicates_removed"),
        (invalid if invalid is not None else zero).alias("invalid_records"),
    )


def hit_rate(lookups: DataFrame, hit: Column, miss: Column, *keys: str) -> DataFrame:
    """hits, misses and hits / (hits + misses), 0 without lookups."""
    hits = F.coalesce(F.sum(F.when(hit, 1)), F.lit(0)).cast("bigint")
    misses = F.coalesce(F.sum(F.when(miss, 1)), F.lit(0)).cast("bigint")
    counts = lookups.groupBy(*keys).agg(hits.alias("hits"), misses.alias("misses"))
    rate = F.coalesce(F.try_divide("hits", F.col("hits") + F.col("misses")), F.lit(0.0))
    return counts.withColumn("hit_rate", rate.cast("double"))


def counters(events: DataFrame, key: str, value: str) -> DataFrame:
    """Total count, sum and mean duration per outcome; the mean is 0 when nothing was measured."""
    return events.groupBy(key).agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("seconds"),
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean_seconds"),
    )


def relation_graph(relations: DataFrame, order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): distinct names, and one edge per (subject, object) with the last relation."""
    nodes = relations.select(F.explode(F.array("subject", "object")).alias("id")).distinct()
    edges = relations.groupBy(F.col("subject").alias("src"), F.col("object").alias("dst")).agg(
        F.max_by("relation", order).alias("relation")
    )
    return nodes, edges


def removal_accounting(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, removed) for each stage's rejected rows; an empty stage counts 0."""
    parts = [
        rejected.agg(F.count(F.lit(1)).alias("removed")).select(F.lit(name).alias("stage"), "removed")
        for name, rejected in stages.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
