"""Session helpers: shared folder, lineage cuts, partition spread."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, else one below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Loops use this to cut lineage: the result survives lost executors, later plans start from files, and
    Spark knows the size, so join strategies stay size-checked.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with _shuffles_end(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


@contextmanager
def _shuffles_end(spark: SparkSession):
    """Jobs in this block delete their shuffle files when they end, as the table written by them takes their place."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def unstage(*tables: DataFrame) -> None:
    """Delete tables written by :func:`materialize` that no later plan reads."""
    for table in tables:
        spark = table.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(table._staged)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def bucketed(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` written once to the shared folder as a table bucketed and sorted by ``keys``.

    Joins on ``keys`` then leave this side where it lies. The rows are dealt by them before they are written, one file a bucket.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = new_path(spark, name)
    table = f"{name}_{path.rsplit('-', 1)[-1]}"
    dealt = df.repartition(n, *keys)
    dealt.write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return spark.table(table)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition by ``keys`` only when the input has fewer partitions than there are task slots.

    Inputs of real size already have many splits and pass through unchanged.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots, *keys)
