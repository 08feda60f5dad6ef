"""Record construction, filters, validation, categories."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    RECORDS_SQL,
    STOP_WORDS,
    clean_sql,
    lit,
    query,
    record_text_sql,
    records_base,
    table,
    topic_sql,
)
from corpusmill.constants import BASE_URLS, CATEGORY_ALIASES, CATEGORY_WEIGHTS, DEFAULT_WEIGHT
from corpusmill.functions.links import base_url, source_url
from corpusmill.functions.text import fold_text
from corpusmill.functions.topics import classify_topic
from corpusmill.operators import categories as C
from corpusmill.operators import quality as Q
from corpusmill.operators.fill import attach_metadata
from corpusmill.plans.records import clean_pages, derive_records


def page_texts(spark, sf):
    """Records as page tasks with raw text."""
    base = records_base(spark, sf)
    return base.select(
        "seq", "title", F.col("content").alias("text"), F.col("language").alias("lang"), "category", "created_at"
    )


_CLEAN = f"cleaned AS (SELECT seq, title, language, category, id, {record_text_sql('content', 'language')} AS content FROM records_base)"
_TOPIC, _SUBTOPIC = topic_sql("lower(title || chr(10) || content)")
_BASE_URL = f"CASE language WHEN 'en' THEN {lit(BASE_URLS['en'])} WHEN 'pt' THEN {lit(BASE_URLS['pt'])} ELSE 'https://' || language || '.wikipedia.org' END"


@query(
    "build_record_scalars",
    f"""WITH {RECORDS_SQL}, {_CLEAN}
    SELECT seq, id, title, language, category, {_TOPIC} AS topic, {_SUBTOPIC} AS subtopic,
      length(content) AS length, 'wikipedia' AS source,
      {_BASE_URL} || '/wiki/' || replace(title, ' ', '_') AS source_url, 2 + 1 AS n_answers, content
    FROM cleaned WHERE length(content) >= 150""",
)
def build_record_scalars(spark, sf):
    cleaned = clean_pages(page_texts(spark, sf)).withColumn("summary", F.substring("content", 1, 150))
    records = derive_records(cleaned, STOP_WORDS)
    return records.select(
        "seq", "id", "title", "language", "category", "topic", "subtopic", "metadata.length", "metadata.source",
        "metadata.source_url", F.size("answers").alias("n_answers"), "content",
    )


@query(
    "minimum_length",
    f"WITH {RECORDS_SQL}, {_CLEAN} SELECT seq, length(content) AS n FROM cleaned WHERE length(content) >= 150",
)
def minimum_length(spark, sf):
    return clean_pages(page_texts(spark, sf)).select("seq", F.length("content").alias("n"))


_FILTER = """language IN ('en', 'fr') AND category IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src5')
  AND created_at >= TIMESTAMP '2024-01-01 01:00:00' AND created_at <= TIMESTAMP '2024-01-02 00:00:00'"""


def _filtered(spark, sf):
    return Q.filter_records(
        records_base(spark, sf), ["en", "fr"], [f"src{i}" for i in range(6)], "2024-01-01T01:00:00", "2024-01-02"
    )


@query(
    "filter_records",
    f"""WITH {RECORDS_SQL} SELECT seq, language, category, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
    FROM records_base WHERE {_FILTER}""",
)
def filter_records(spark, sf):
    return _filtered(spark, sf).select(
        "seq", "language", "category", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at")
    )


@query(
    "record_view",
    f"""WITH {RECORDS_SQL} SELECT id, title, language, category, {_TOPIC} AS topic, {_SUBTOPIC} AS subtopic,
      substr(content, 1, 40) AS summary, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
    FROM records_base WHERE {_FILTER}""",
)
def record_view(spark, sf):
    records = _filtered(spark, sf).withColumn("t", classify_topic(F.col("title"), F.col("content"))).select(
        "*", "t.topic", "t.subtopic", F.substring("content", 1, 40).alias("summary")
    )
    return Q.record_view(records).withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    "enrich_records",
    f"""WITH {RECORDS_SQL} SELECT seq, {clean_sql("content || ' World seen in ' || category")} AS clean_content,
      category || ':SOURCE' AS entities FROM records_base""",
)
def enrich_records(spark, sf):
    base = records_base(spark, sf)
    gazetteer = base.select(F.col("category").alias("name"), F.lit("SOURCE").alias("type")).distinct()
    marked = base.withColumn(
        "content", F.concat(F.lit("<p>"), "content", F.lit("</p> [[Link|World]]<sup>1</sup> seen in "), "category")
    )
    return Q.enrich_records(marked, gazetteer).select(
        "seq", "clean_content",
        F.array_join(F.transform("entities", lambda e: F.concat(e["text"], F.lit(":"), e["type"])), ",").alias("entities"),
    )


_CHECKED = f"""{RECORDS_SQL}, checked AS (
  SELECT r.seq, r.content, CASE WHEN length(content) < 300 THEN '' ELSE substr(content, 1, 200) END AS summary,
    category <> 'src3' AS has_questions, category <> 'src4' AS has_answers, category <> 'src5' AS has_relations,
    coalesce(e.label, -1) AS label
  FROM records_base r LEFT JOIN embeddings e ON e.vec_id = r.seq)"""


def checked_records(spark, sf):
    """Records in which each validation rule is broken by some rows."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("seq"), "embedding", "label")
    broken = F.transform(
        "embedding",
        lambda x: F.when(F.col("label") == 2, F.lit(float("nan"))).when(F.col("label") == 4, F.lit(float("inf"))).otherwise(x),
    )
    text = F.col("content")
    question = "array<struct<text:string,type:string,difficulty:string>>"
    answer = "array<struct<text:string,type:string,length:string>>"
    relation = "array<struct<subject:string,relation:string,object:string>>"
    one_question = F.array(F.struct(F.lit("q").alias("text"), F.lit("t").alias("type"), F.lit("d").alias("difficulty")))
    one_answer = F.array(F.struct(F.lit("a").alias("text"), F.lit("t").alias("type"), F.lit("l").alias("length")))
    return (
        records_base(spark, sf)
        .join(vectors, "seq", "left")
        .withColumn("content_embedding", broken.cast("array<float>"))
        .withColumn("summary_embedding", F.col("embedding"))
        .withColumn("summary", F.when(F.length(text) < 300, "").otherwise(F.substring(text, 1, 200)))
        .withColumn("questions", F.when(F.col("category") == "src3", F.array().cast(question)).otherwise(one_question))
        .withColumn("answers", F.when(F.col("category") != "src4", one_answer).cast(answer))
        .withColumn("relations", F.when(F.col("category") != "src5", F.array().cast(relation)))
        .drop("embedding", "label")
    )


@query(
    "validate_semantics",
    f"""WITH {_CHECKED} SELECT seq, content <> '' AND summary <> '' AND has_questions AND has_answers
      AND label NOT IN (2, 4) AS valid FROM checked""",
)
def validate_semantics(spark, sf):
    valid, rejected = Q.validate_semantics(checked_records(spark, sf))
    return valid.select("seq", F.lit(True).alias("valid")).unionByName(rejected.select("seq", F.lit(False).alias("valid")))


@query(
    "validate_for_save",
    f"""WITH {_CHECKED} SELECT seq, concat_ws(',', CASE WHEN label IN (2, 4) THEN 'content_embedding' END,
      CASE WHEN NOT has_questions THEN 'questions' END, CASE WHEN NOT has_answers THEN 'answers' END,
      CASE WHEN NOT has_relations THEN 'relations' END, CASE WHEN length(summary) < 150 THEN 'summary' END) AS reasons
    FROM checked""",
)
def validate_for_save(spark, sf):
    valid, rejected = Q.validate_for_save(checked_records(spark, sf))
    return valid.select("seq", F.lit("").alias("reasons")).unionByName(
        rejected.select("seq", F.array_join("reasons", ",").alias("reasons"))
    )


@query(
    "base_and_source_url",
    f"""WITH {RECORDS_SQL} SELECT seq, {_BASE_URL} AS base, {_BASE_URL} || '/wiki/' || replace(title, ' ', '_') AS page
    FROM records_base""",
)
def base_and_source_url(spark, sf):
    return records_base(spark, sf).select(
        "seq", base_url(F.col("language")).alias("base"), source_url(F.col("language"), F.col("title")).alias("page")
    )


_NAMES = [*CATEGORY_WEIGHTS, *CATEGORY_ALIASES, "Unknown", "Blockchains"]
_NAMES_SQL = "[" + ", ".join(map(lit, _NAMES)) + "]"
_NAMED = f"""named AS (SELECT doc_id AS seq,
  CASE doc_id % 3 WHEN 0 THEN upper(name) WHEN 1 THEN strip_accents(name) ELSE name END AS name
  FROM (SELECT doc_id, {_NAMES_SQL}[doc_id % {len(_NAMES)} + 1] AS name FROM documents))"""
_CANON = "canon AS (SELECT unnest([" + ", ".join(map(lit, CATEGORY_WEIGHTS)) + "]) AS canonical, unnest([" + ", ".join(
    f"{w}::DOUBLE" for w in CATEGORY_WEIGHTS.values()
) + "]) AS weight)"


def category_names(spark, sf):
    """Spelling variants of category names, one per document."""
    names = F.array(*[F.lit(n) for n in _NAMES])
    name = F.element_at(names, (F.col("doc_id") % len(_NAMES) + 1).cast("int"))
    plain = F.element_at(F.array(*[F.lit(fold_text(n)) for n in _NAMES]), (F.col("doc_id") % len(_NAMES) + 1).cast("int"))
    variant = F.when(F.col("doc_id") % 3 == 0, F.upper(name)).when(F.col("doc_id") % 3 == 1, plain).otherwise(name)
    return table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), variant.alias("name"))


@query(
    "normalize_category",
    f"""WITH {_NAMED}, {_CANON} SELECT seq, name, coalesce(canonical, CASE WHEN lower(strip_accents(name)) = 'programacao'
      THEN 'Programação' END, name) AS category
    FROM named LEFT JOIN canon ON lower(strip_accents(name)) = lower(strip_accents(canonical))""",
)
def normalize_category(spark, sf):
    return category_names(spark, sf).select(
        "seq", "name", F.coalesce(C.normalize_category(F.col("name")), F.col("name")).alias("category")
    )


@query(
    "category_weight",
    f"""WITH {_NAMED}, {_CANON} SELECT seq, coalesce(weight, {DEFAULT_WEIGHT}::DOUBLE) AS weight
    FROM named LEFT JOIN canon ON name = canonical""",
)
def category_weight(spark, sf):
    return category_names(spark, sf).select("seq", C.category_weight(F.col("name")).alias("weight"))


@query(
    "closest_category",
    f"""WITH {_NAMED}, {_CANON}, typo AS (SELECT seq, name || chr((97 + seq % 20)::INTEGER) AS name FROM named),
    ranked AS (SELECT name, canonical, levenshtein(lower(strip_accents(name)), lower(strip_accents(canonical))) AS d
      FROM (SELECT DISTINCT name FROM typo), canon),
    best AS (SELECT name, canonical, d FROM ranked QUALIFY row_number() OVER (PARTITION BY name ORDER BY d, canonical) = 1)
    SELECT name, CASE WHEN d <= 3 THEN canonical END AS resolved FROM best
    WHERE name NOT IN (SELECT canonical FROM canon)
    UNION ALL SELECT DISTINCT name, name FROM typo WHERE name IN (SELECT canonical FROM canon)""",
)
def closest_category(spark, sf):
    typos = category_names(spark, sf).select(
        F.concat("name", F.chr((F.lit(97) + F.col("seq") % 20).cast("int"))).alias("name")
    )
    known = spark.createDataFrame([(c,) for c in CATEGORY_WEIGHTS], "name string")
    return C.resolve_categories(typos, known, max_distance=3)


@query(
    "attach_metadata",
    f"""WITH {RECORDS_SQL} SELECT seq, CASE WHEN doc_id IS NOT NULL THEN 'Q' || doc_id END AS wikidata_id,
      CASE WHEN quality = 1 THEN 'img' || doc_id END AS image_url
    FROM records_base LEFT JOIN labels ON seq = doc_id""",
)
def attach(spark, sf):
    extra = table(spark, sf, "labels").select(
        F.col("doc_id").alias("seq"),
        F.concat(F.lit("Q"), "doc_id").alias("wikidata_id"),
        F.when(F.col("quality") == 1, F.concat(F.lit("img"), "doc_id")).alias("image_url"),
    )
    return attach_metadata(records_base(spark, sf), extra, "seq").select("seq", "wikidata_id", "image_url")
