"""Duplicate removal and its pair lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import RECORDS_SQL, query, records_base, table
from catalog.records import checked_records
from corpusmill.constants import HASH_PREFIX
from corpusmill.operators import dedup as D
from corpusmill.operators import similarity as S
from corpusmill.operators.stats import removal_accounting


def anonymous(spark, sf):
    """Records without id and title, so that the key is the language and the text."""
    return records_base(spark, sf).withColumn("id", F.lit(None).cast("string")).withColumn("title", F.lit(""))


_KEY = "md5('_' || language || content)"


@query("hash_key", f"WITH {RECORDS_SQL} SELECT seq, md5(id || content) AS key FROM records_base")
def hash_key(spark, sf):
    key = D.hash_key(F.col("id"), F.col("title"), F.col("language"), F.col("content"))
    return records_base(spark, sf).select("seq", key.alias("key"))


@query("hash_key_prefix", f"WITH {RECORDS_SQL} SELECT seq, md5(id || substr(content, 1, 50)) AS key FROM records_base")
def hash_key_prefix(spark, sf):
    key = D.hash_key(F.col("id"), F.col("title"), F.col("language"), F.col("content"), HASH_PREFIX)
    return records_base(spark, sf).select("seq", key.alias("key"))


@query("deduplicate_by_hash", f"WITH {RECORDS_SQL} SELECT min(seq) AS seq FROM records_base GROUP BY {_KEY}")
def by_hash(spark, sf):
    return D.deduplicate_by_hash(anonymous(spark, sf))[0].select("seq")


@query(
    "deduplicate_by_hash_prefix",
    f"WITH {RECORDS_SQL} SELECT min(seq) AS seq FROM records_base GROUP BY md5('_' || language || substr(content, 1, 50))",
)
def by_hash_prefix(spark, sf):
    return D.deduplicate_by_hash(anonymous(spark, sf), prefix=HASH_PREFIX)[0].select("seq")


@query("first_occurrence", f"WITH {RECORDS_SQL} SELECT min(seq) AS seq FROM records_base GROUP BY language, length(content)")
def first_occurrence(spark, sf):
    return D.first_per_key(records_base(spark, sf), F.concat_ws("|", "language", F.length("content")))


_VECTOR_PAIRS = """pairs AS (SELECT a.vec_id AS lo, b.vec_id AS hi,
    list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS cosine
  FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= {threshold})"""

# First-come removal in SQL: visit rows in order and carry the list of removed ones.
_GREEDY = """later AS (SELECT lo, list(hi) AS his, row_number() OVER (ORDER BY lo) AS n FROM pairs GROUP BY lo),
  walk AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS gone
    UNION ALL SELECT l.n, CASE WHEN list_contains(w.gone, l.lo) THEN w.gone ELSE list_concat(w.gone, l.his) END
    FROM walk w JOIN later l ON l.n = w.n + 1),
  removed AS (SELECT DISTINCT unnest(gone) AS seq FROM (SELECT gone FROM walk ORDER BY n DESC LIMIT 1))"""


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("seq"), "embedding")


@query(
    "cosine_pairs",
    f"WITH {_VECTOR_PAIRS.format(threshold=0.45)} SELECT lo, hi, round(cosine, 5) AS cosine FROM pairs",
)
def cosine_pairs(spark, sf):
    return S.cosine_pairs(vectors(spark, sf), 0.45).withColumn("cosine", F.round("cosine", 5))


@query(
    "deduplicate_by_embedding",
    f"WITH RECURSIVE {_VECTOR_PAIRS.format(threshold=0.95)}, {_GREEDY} SELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT seq FROM removed)",
)
def by_embedding(spark, sf):
    rows = table(spark, sf, "embeddings")
    return S.deduplicate_by_embedding(rows, seq="vec_id", embedding="embedding")[0].select("vec_id")


@query(
    "deduplicate_by_embedding_loose",
    f"WITH RECURSIVE {_VECTOR_PAIRS.format(threshold=0.4)}, {_GREEDY} SELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT seq FROM removed)",
)
def by_embedding_loose(spark, sf):
    rows = table(spark, sf, "embeddings")
    return S.deduplicate_by_embedding(rows, 0.4, seq="vec_id", embedding="embedding")[0].select("vec_id")


_BITS = ", ".join(
    f"sum(((instr('0123456789abcdef', substr(h, {32 - b // 4}, 1)) - 1) >> {b % 4}) & 1) AS v{b}" for b in range(64)
)
_SUM = " + ".join(f"CASE WHEN 2 * v{b} > n THEN {1 << b}::HUGEINT ELSE 0 END" for b in range(64))
_PRINTS = f"""letters AS (SELECT doc_id, unnest(c) AS c1, generate_subscripts(c, 1) AS i
    FROM (SELECT doc_id, string_split(array_to_string(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'), ''), '') AS c FROM documents)),
  grams AS (SELECT doc_id, c1 || lead(c1, 1) OVER w || lead(c1, 2) OVER w || lead(c1, 3) OVER w AS g
    FROM letters WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
  short AS (SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'), '') AS g FROM documents),
  votes AS (SELECT doc_id, count(*) AS n, {_BITS} FROM (SELECT doc_id, md5(g) AS h FROM grams WHERE g IS NOT NULL
    UNION ALL SELECT doc_id, md5(g) FROM short WHERE length(g) < 4) GROUP BY doc_id),
  sums AS (SELECT doc_id, {_SUM} AS u FROM votes),
  prints AS (SELECT doc_id, (CASE WHEN u >= {1 << 63}::HUGEINT THEN u - {1 << 64}::HUGEINT ELSE u END)::BIGINT AS fingerprint FROM sums)"""
_HAMMING = """pairs AS (SELECT a.doc_id AS lo, b.doc_id AS hi, bit_count(xor(a.fingerprint, b.fingerprint)) AS distance
  FROM prints a JOIN prints b ON a.doc_id < b.doc_id WHERE bit_count(xor(a.fingerprint, b.fingerprint)) <= 3)"""


@query("simhash_fingerprints", f"WITH {_PRINTS} SELECT doc_id, fingerprint FROM prints")
def fingerprints(spark, sf):
    docs = records_base(spark, sf).select(F.col("seq").alias("doc_id"), "content")
    return D.simhash_fingerprints(docs, "doc_id")


@query(
    "hamming_pairs",
    f"""WITH {_PRINTS}, firsts AS (SELECT min(doc_id) AS doc_id, fingerprint FROM prints GROUP BY fingerprint)
    SELECT a.doc_id AS lo, b.doc_id AS hi FROM firsts a JOIN firsts b ON a.doc_id < b.doc_id
    WHERE bit_count(xor(a.fingerprint, b.fingerprint)) <= 3""",
)
def hamming_pairs(spark, sf):
    prints = D.simhash_fingerprints(records_base(spark, sf))
    firsts = prints.groupBy("fingerprint").agg(F.min("seq").alias("seq"))
    return D.hamming_pairs(firsts.select("seq", "fingerprint"))


@query(
    "deduplicate_by_simhash",
    f"WITH RECURSIVE {_PRINTS}, {_HAMMING}, {_GREEDY} SELECT doc_id AS seq FROM documents WHERE doc_id NOT IN (SELECT seq FROM removed)",
)
def by_simhash(spark, sf):
    return D.deduplicate_by_simhash(records_base(spark, sf))[0].select("seq")


@query(
    "removal_accounting",
    f"""WITH {RECORDS_SQL}, keyed AS (SELECT seq, content, category, row_number() OVER (PARTITION BY {_KEY} ORDER BY seq) AS rn FROM records_base),
    labelled AS (SELECT k.*, coalesce(e.label, -1) AS label FROM keyed k LEFT JOIN embeddings e ON e.vec_id = k.seq)
    SELECT 'hash' AS stage, count(*) FILTER (rn > 1) AS removed FROM labelled
    UNION ALL SELECT 'semantics', count(*) FILTER (rn = 1 AND NOT (content <> '' AND length(content) >= 300
      AND category NOT IN ('src3', 'src4') AND label NOT IN (2, 4))) FROM labelled""",
)
def accounting(spark, sf):
    from corpusmill.operators.quality import validate_semantics

    records = checked_records(spark, sf).withColumn("id", F.lit("")).withColumn("title", F.lit(""))
    unique, same = D.deduplicate_by_hash(records)
    return removal_accounting({"hash": same, "semantics": validate_semantics(unique)[1]})
