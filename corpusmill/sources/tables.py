"""File scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.constants import WIKI_MARKER
from corpusmill.functions.links import parse_page_url
from corpusmill.schema import ANSWER, JOB_DDL, MEMBERSHIP_DDL, QUESTION, RECORD_DDL


# Questions and answers as they may stand in files: structs or plain strings.
RAW_RECORD_DDL = RECORD_DDL.replace(f"array<{QUESTION}>", "array<string>").replace(f"array<{ANSWER}>", "array<string>")


def read_records(spark: SparkSession, path: str, lines: bool = False, missing_ok: bool = False) -> DataFrame:
    """Records from JSON: one array per file, or one record per line. Large sets should use lines or parquet,
    which can be split. A missing path gives an empty table when ``missing_ok``.

    Questions and answers given as plain strings become structs with only ``text``.
    """
    try:
        raw = spark.read.option("multiLine", not lines).schema(RAW_RECORD_DDL).json(path)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], RECORD_DDL)
        raise
    return record_lists(raw)


def record_lists(raw: DataFrame) -> DataFrame:
    """Questions and answers of raw records as structs."""
    return raw.withColumns(
        {
            "questions": F.transform("questions", lambda q: _struct_or_text(q, QUESTION)),
            "answers": F.transform("answers", lambda a: _struct_or_text(a, ANSWER)),
        }
    )


def _struct_or_text(item: Column, ddl: str) -> Column:
    plain = F.from_json(F.to_json(F.struct(item.alias("text"))), ddl)
    # Malformed JSON parses to nulls only; such an item is plain text that happens to start with a brace.
    parsed = F.when(F.startswith(item, F.lit("{")) & F.get_json_object(item, "$").isNotNull(), F.from_json(item, ddl))
    return F.coalesce(parsed, plain)


def read_url_list(spark: SparkSession, path: str, marker: str = WIKI_MARKER) -> DataFrame:
    """(url, title, lang) of the non-blank lines; the title follows the last marker."""
    urls = spark.read.text(path).select(F.trim("value").alias("url")).filter("url <> ''")
    return urls.withColumn("page", parse_page_url(F.col("url"), marker)).select("url", "page.title", "page.lang")


def read_membership(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MEMBERSHIP_DDL).json(path)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOB_DDL).json(path)
