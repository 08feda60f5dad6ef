"""Registration and the standard bindings of driver tables to records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import spread

ARROW_ROWS = 512

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            # Rows hold whole texts and pages: a batch of the default 10,000 rows takes hundreds of MB in a Python worker.
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts, spread over all task slots when the input is a single small file."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id")


def records_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat(F.lit("doc "), F.col("doc_id"))
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("seq"),
        title.alias("title"),
        F.col("lang").alias("language"),
        F.col("source").alias("category"),
        F.col("text").alias("content"),
        F.md5(F.concat(title, F.lit("_"), F.col("lang"))).alias("id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("created_at"),
    )


RECORDS_SQL = """records_base AS (
  SELECT doc_id AS seq, concat('doc ', doc_id) AS title, lang AS language, source AS category, text AS content,
         md5(concat('doc ', doc_id, '_', lang)) AS id,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id::INTEGER) AS created_at
  FROM documents)"""

# Short stop word lists of the checks.
STOP_WORDS = {
    "en": ["the", "of", "and", "a", "to", "in", "is"],
    "fr": ["de", "la", "le", "les", "et", "des", "en"],
    "de": ["der", "die", "und", "in", "den", "von", "zu"],
    "es": ["de", "la", "que", "el", "en", "y", "los"],
}


def lit(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def stop_sql(lang: str, word: str) -> str:
    cases = [f"({lang} = {lit(code)} AND {word} IN ({', '.join(map(lit, entries))}))" for code, entries in STOP_WORDS.items()]
    return "(" + " OR ".join(cases) + ")"


def clean_sql(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


def fold_sql(text: str) -> str:
    return f"strip_accents(replace({text}, 'ß', 'ss'))"


def record_text_sql(text: str, lang: str) -> str:
    """Record cleaning on plain text without any markup."""
    flat = clean_sql(text)
    return f"CASE WHEN {lang} IN ('en', 'de') THEN {fold_sql(flat)} ELSE {flat} END"


def topic_sql(text: str) -> tuple[str, str]:
    """CASE expressions for topic and subtopic over a lower-cased text expression."""
    from corpusmill.constants import DEFAULT_SUBTOPIC, DEFAULT_TOPIC, TOPIC_RULES

    def any_of(entries: list[str]) -> str:
        return "(" + " OR ".join(f"contains({text}, {lit(e)})" for e in entries) + ")"

    topic, sub = "CASE", "CASE"
    for name, keywords, subtopics in TOPIC_RULES:
        topic += f" WHEN {any_of(keywords)} THEN {lit(name)}"
        inner = "CASE" + "".join(f" WHEN {any_of(words)} THEN {lit(s)}" for s, words in subtopics)
        sub += f" WHEN {any_of(keywords)} THEN {inner} ELSE {lit(DEFAULT_SUBTOPIC)} END"
    return f"{topic} ELSE {lit(DEFAULT_TOPIC)} END", f"{sub} ELSE {lit(DEFAULT_SUBTOPIC)} END"


def translate_sql(question: str, lang: str) -> str:
    from corpusmill.constants import QUESTION_PHRASES

    out = "CASE"
    for code, phrases in QUESTION_PHRASES.items():
        expr = question
        for a, b in phrases:
            expr = f"replace({expr}, {lit(a)}, {lit(b)})"
        out += f" WHEN {lang} = {lit(code)} THEN {expr}"
    return f"{out} ELSE {question} END"
