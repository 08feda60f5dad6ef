"""Order-dependent operators: top-n, caps, final sort, manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.session import materialize


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows per key. Spark applies the bound before the shuffle as well, so hot keys shrink first."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)


def final_sort(records: DataFrame, seq: str = "seq") -> DataFrame:
    """By language, then topic, ties in input order. The range exchange samples all three columns, so one
    frequent (language, topic) is still split over many tasks."""
    return records.orderBy("language", "topic", seq)


def numbered(df: DataFrame, seq: str, name: str, keys: Sequence[str] = (), bucket_bits: int = 16) -> DataFrame:
    """Add the zero-based position by ``seq`` (per ``keys``) without sorting a whole group in one task.

    Buckets are ranges of ``seq`` values, so each holds at most 2^bucket_bits rows of a group. Only the bucket
    counts of a group pass through one window: its rows / 65536 for a dense ``seq``.
    """
    marked = df.withColumn("_bucket", F.shiftright(seq, bucket_bits))
    place = [*keys, "_bucket"]
    sizes = marked.groupBy(*place).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(W.partitionBy(*keys).orderBy("_bucket")) - F.col("_rows")
    starts = sizes.select(*place, before.alias("_start"))
    local = F.row_number().over(W.partitionBy(*place).orderBy(seq)) - 1
    return (
        marked.withColumn("_local", local)
        .join(starts, place)
        .withColumn(name, (F.col("_start") + F.col("_local")).cast("bigint"))
        .drop("_bucket", "_start", "_local")
    )


def numbered_by_range(df: DataFrame, seq: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """The same positions for a sparse ``seq``, such as a hash, whose buckets by value would hold a row each.

    Rows are range-partitioned by keys and ``seq``, so a hot group is dealt over many partitions, and written once with
    the number of their partition. What passes through one window is a row per partition (and group), not per bucket.
    """
    dealt = df.repartitionByRange(*keys, seq).withColumn("_part", F.spark_partition_id())
    marked = materialize(dealt, "numbered")
    place = [*keys, "_part"]
    sizes = marked.groupBy(*place).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(W.partitionBy(*keys).orderBy("_part")) - F.col("_rows")
    starts = sizes.select(*[F.col(k).alias(f"_{i}_key") for i, k in enumerate(keys)], F.col("_part").alias("_at"), before.alias("_start"))
    same = F.col("_part") == F.col("_at")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_{i}_key"))
    local = F.row_number().over(W.partitionBy(*place).orderBy(seq)) - 1
    placed = marked.withColumn("_local", local).join(starts, same)
    return placed.select(*df.columns, (F.col("_start") + F.col("_local")).cast("bigint").alias(name))


def image_manifest(records: DataFrame, seq: str = "seq") -> DataFrame:
    """(seq, file_name, caption, image_url) of records with an image; the number is the input position."""
    suffix = F.regexp_extract("image_url", r"[^/.](\.[^/.]+)/*$", 1)
    caption = F.coalesce(F.when(F.col("caption") != "", F.col("caption")), F.col("title"), F.lit(""))
    position = F.col("position").cast("string")
    padded = F.when(F.length(position) >= 5, position).otherwise(F.lpad(position, 5, "0"))
    return (
        numbered_by_range(records.select(seq, "image_url", "caption", "title"), seq, "position")
        .filter(F.coalesce(F.col("image_url"), F.lit("")) != "")
        .select(
            seq,
            F.concat(padded, F.when(suffix == "", ".jpg").otherwise(suffix)).alias("file_name"),
            caption.alias("caption"),
            "image_url",
        )
    )
