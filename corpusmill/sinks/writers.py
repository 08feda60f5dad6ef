"""Dataset writers. All write directories of part files in parallel; any Hadoop path works, object stores too."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.common import explode_positions
from corpusmill.functions.questions import zip_shorter
from corpusmill.functions.text import clean_text
from corpusmill.session import materialize

DATASET_FORMATS = ["json", "jsonl", "csv", "parquet"]
KEEP_NULLS = {"ignoreNullFields": "false"}


def write_dataset(df: DataFrame, path: str, fmt: str = "all", mode: str = "error") -> list[str]:
    """Write ``df`` below ``path`` in one format or in all of them; returns the written paths.

    ``qa`` writes question/answer pairs, ``text`` the text corpus. Null fields are written as nulls. ``mode``
    is that of Spark's writers: existing data is an error unless told otherwise. For several formats the rows are
    computed once. Errors are raised, never swallowed.
    """
    formats = DATASET_FORMATS if fmt == "all" else [fmt]
    if len(formats) > 1:
        df = materialize(df, "dataset")
    writers = {
        "json": lambda p: df.write.mode(mode).options(**KEEP_NULLS).json(p),
        "jsonl": lambda p: df.write.mode(mode).options(**KEEP_NULLS).json(p),
        "csv": lambda p: write_csv(df, p, mode),
        "parquet": lambda p: df.write.mode(mode).parquet(p),
        "qa": lambda p: qa_pairs(df).write.mode(mode).options(**KEEP_NULLS).json(p),
        "text": lambda p: write_text_corpus(df, p, mode),
    }
    unknown = [f for f in formats if f not in writers]
    if unknown:
        raise ValueError(f"unknown format: {unknown[0]}")
    targets = [f"{path.rstrip('/')}/{f}" for f in formats]
    for name, target in zip(formats, targets):
        writers[name](target)
    return targets


def sorted_for_write(records: DataFrame, seq: str = "seq") -> DataFrame:
    """Range partitions in final order, each sorted: files read in name order give the full order."""
    order = ["language", "topic", seq]
    return records.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)


def csv_view(df: DataFrame) -> DataFrame:
    """Nested cells as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[F.to_json(f.name, KEEP_NULLS).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields]
    )


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    csv_view(df).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def qa_pairs(records: DataFrame, *keys: str) -> DataFrame:
    """(question, answer) by position, up to the shorter list of each record."""
    pairs = zip_shorter(
        F.transform("questions", lambda q: q["text"]),
        F.transform("answers", lambda a: a["text"]),
        "question",
        "answer",
    )
    return explode_positions(records, pairs, *keys, value="p").select(*keys, "pos", "p.question", "p.answer")


def embedding_export(records: DataFrame) -> DataFrame:
    return records.select("id", F.col("content_embedding").alias("embedding"))


def triples(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("title").alias("subject"), F.lit("related_to").alias("relation"), F.explode("keywords").alias("object")
    )


def corpus_name() -> Column:
    return F.coalesce(F.when(F.col("id") != "", F.col("id")), F.col("title"), F.lit("record"))


def text_corpus(records: DataFrame) -> DataFrame:
    """(name, text): cleaned text named by id, else title."""
    return records.select(corpus_name().alias("name"), clean_text(F.coalesce("content", F.lit(""))).alias("text"))


def write_text_corpus(records: DataFrame, path: str, mode: str = "error", layout: str = "table") -> None:
    """A two-column parquet table, or with ``layout`` "text" one directory of plain text per record."""
    if layout not in ("table", "text"):
        raise ValueError(f"unknown layout: {layout}")
    corpus = text_corpus(records)
    if layout == "text":
        corpus.write.mode(mode).partitionBy("name").text(path)
    else:
        corpus.write.mode(mode).parquet(path)


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON text column ``data`` per record."""
    return df.select(F.to_json(F.struct("*"), KEEP_NULLS).alias("data"))


def write_json_rows(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append JSON rows to a relational table."""
    json_rows(df).write.jdbc(url, table, mode="append", properties=properties or {})


def blob_rows(records: DataFrame) -> DataFrame:
    """(key, data): id and metadata as JSON, keyed by content so that a repeated task writes the same key."""
    data = F.to_json(F.struct("id", "metadata"), KEEP_NULLS)
    return records.select(F.md5(data).alias("key"), data.alias("data"))


def append_blobs(records: DataFrame, path: str) -> None:
    blob_rows(records).write.mode("append").parquet(path)


_POINTER = "current.txt"


def write_progress(snapshot: DataFrame, path: str) -> None:
    """Replace the snapshot at ``path``; it is one row.

    The row goes to a new version folder, and then a pointer file that names it is renamed over the old one, in one step of the file
    system. A write that fails, or a reader in between, leaves or finds the snapshot before it. The version before the current
    one stays for readers that have just opened it; older ones are removed.
    """
    spark = snapshot.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    snapshot.coalesce(1).write.options(**KEEP_NULLS).json(f"{path}/{version}")
    before = current_version(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = hadoop.Path(path).getFileSystem(conf)
    fresh, pointer = hadoop.Path(f"{path}/_{version}.txt"), hadoop.Path(f"{path}/{_POINTER}")
    out = files.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    over = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(files.makeQualified(fresh).toUri(), conf).rename(files.makeQualified(fresh), files.makeQualified(pointer), over)
    for status in files.listStatus(hadoop.Path(path)):
        name = status.getPath().getName()
        if name.startswith("version-") and name not in (version, before):
            files.delete(status.getPath(), True)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version folder that the pointer of ``path`` names; None before the first snapshot."""
    rows = spark.read.text(f"{path}/{_POINTER}").head(1) if _exists(spark, f"{path}/{_POINTER}") else []
    return rows[0][0] if rows else None


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of its own making."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def read_progress(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The current snapshot of :func:`write_progress`."""
    version = current_version(spark, path)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{path}/{version}")


def export_pages(pages: DataFrame, path: str, fmt: str = "json") -> list[str]:
    """Raw (url, html) rows as json, csv or parquet."""
    return write_dataset(pages.select("url", "html"), path, fmt)
