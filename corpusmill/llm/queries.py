"""The queries of this subpackage, their tables bound to the operators with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_line_frequency")
def line_frequency(spark, sf_dir):
    from corpusmill.llm.line_frequency import quality_verdicts

    return quality_verdicts(table(spark, sf_dir, "documents"))


@query("op2_pii")
def pii(spark, sf_dir):
    from corpusmill.llm.pii import pii_digests

    return pii_digests(table(spark, sf_dir, "documents"))


@query("op3_secrets")
def secrets(spark, sf_dir):
    from corpusmill.llm.secret_scan import KINDS, find_secrets

    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["base"])
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


@query("op4_ngram_jaccard")
def ngram_jaccard(spark, sf_dir):
    from corpusmill.llm.sketch_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_chat_format")
def chat_format(spark, sf_dir):
    from corpusmill.llm.chat_format import conversation_digests, format_conversations

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    hard = spark.range(2).select(
        F.lit(-7).cast(turns.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return conversation_digests(format_conversations(turns.union(hard)))


@query("op6_licenses")
def licenses(spark, sf_dir):
    from corpusmill.llm.license_scan import document_licenses

    return document_licenses(table(spark, sf_dir, "documents"))


@query("op7_bpe")
def bpe(spark, sf_dir):
    from corpusmill.llm.trie_bpe import token_digests

    return token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_html_layout")
def html_layout(spark, sf_dir):
    from corpusmill.llm.html_layout import render_pages

    return render_pages(table(spark, sf_dir, "pages"))


@query("op9_decontamination")
def decontamination(spark, sf_dir):
    from corpusmill.llm.decontaminate import find_contamination, is_contaminated, n_hit

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
    ).withColumn("contaminated", is_contaminated(F.col("n_hit"), F.col("n_words")))


@query("op10_quality")
def quality(spark, sf_dir):
    from corpusmill.llm.weak_quality import score_documents, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels"))).drop("text")


@query("op11_hard_negatives")
def hard_negatives(spark, sf_dir):
    from corpusmill.llm.hard_negatives import mine_hard_negatives

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", label), F.col("id") % 50 == 0)


ORACLES["op11_hard_negatives"] = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 3
"""


@query("op12_phrases")
def phrases(spark, sf_dir):
    from corpusmill.llm.phrases import mine_collocations

    return mine_collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_phrases"] = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT doc_id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT doc_id, lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM lists, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size
), counts AS (
  SELECT lang, size, phrase, count(*) AS a, min(doc_id) AS first_doc FROM grams GROUP BY ALL HAVING count(*) >= 30
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2
), cuts AS (
  SELECT *, unnest(range(1, size)) AS k FROM candidates
), scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.first_doc, c.k, x.a AS l, y.a AS r,
         CAST((2000000 * c.a::HUGEINT) // (x.a + y.a)::HUGEINT AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), parts AS (
  SELECT lang, a, unnest(flatten(list_transform(range(2, size), lambda s: list_transform(range(1, size - s + 2), lambda p: array_to_string(w[p:p + s - 1], ' '))))) AS phrase
  FROM candidates WHERE size >= 3
), covered AS (
  SELECT lang, phrase, max(a) AS most FROM parts GROUP BY ALL
), ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
  FROM weakest w LEFT JOIN covered c ON c.lang = w.lang AND c.phrase = w.phrase WHERE c.most IS NULL OR 100 * c.most < 80 * a
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score, r.first_doc FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""


@query("op13_toxicity")
def toxicity(spark, sf_dir):
    from corpusmill.llm.toxicity import score_documents, train

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "voters")
