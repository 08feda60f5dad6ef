"""Keywords, summaries, embeddings, clusters, questions and answers, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    RECORDS_SQL,
    STOP_WORDS,
    lit,
    query,
    records_base,
    stop_sql,
    table,
    translate_sql,
)
from corpusmill.constants import (
    DEFINITION_QUESTION,
    ENTITY_QUESTION,
    KEYWORD_QUESTIONS,
    MAX_ENTITY_QUESTIONS,
    MAX_KEYWORD_QUESTIONS,
    MAX_PARAGRAPHS,
    MAX_TEXT_LENGTH,
)
from corpusmill.functions.common import explode_positions
from corpusmill.functions.keywords import extract_keywords
from corpusmill.functions.questions import generate_answers, generate_questions, zip_shorter
from corpusmill.operators.ordering import numbered
from corpusmill.operators.summaries import summarize
from corpusmill.operators.terms import sparse_cosine_pairs, term_vectors
from corpusmill.operators.vectors import cluster_vectors, embed_texts
from corpusmill.sinks import writers as W


def _phrases_sql(max_words: int) -> str:
    parts = ["SELECT seq, language, i * 4 + 1 AS pos, w AS phrase FROM nxt WHERE NOT s0"]
    if max_words > 1:
        parts.append("SELECT seq, language, i * 4 + 2, w || ' ' || w1 FROM nxt WHERE NOT s0 AND w1 IS NOT NULL AND NOT s1")
        parts.append(
            "SELECT seq, language, i * 4 + 3, w || ' ' || w1 || ' ' || w2 FROM nxt WHERE NOT s0 AND w2 IS NOT NULL AND NOT s2"
        )
    return f"""toks AS (SELECT seq, language, unnest(t) AS w, generate_subscripts(t, 1) AS i
        FROM (SELECT seq, language, regexp_extract_all(lower(content), '[\\p{{L}}\\p{{N}}]+') AS t FROM records_base)),
      marked AS (SELECT *, {stop_sql("language", "w")} AS s0 FROM toks),
      nxt AS (SELECT *, lead(w, 1) OVER x AS w1, lead(w, 2) OVER x AS w2, lead(s0, 1) OVER x AS s1, lead(s0, 2) OVER x AS s2
        FROM marked WINDOW x AS (PARTITION BY seq ORDER BY i)),
      phrases AS ({" UNION ALL ".join(parts)}),
      counted AS (SELECT seq, phrase, count(*) AS n, min(pos) AS first FROM phrases GROUP BY seq, phrase)
    SELECT seq, phrase, row_number() OVER (PARTITION BY seq ORDER BY n DESC, first) - 1 AS rank FROM counted
    QUALIFY row_number() OVER (PARTITION BY seq ORDER BY n DESC, first) <= 10"""


def _keywords(spark, sf, max_words):
    found = extract_keywords(F.col("content"), F.col("language"), STOP_WORDS, max_words=max_words)
    return explode_positions(records_base(spark, sf), found, "seq", pos="rank", value="phrase")


@query("extract_keywords", f"WITH {RECORDS_SQL}, {_phrases_sql(3)}")
def keywords(spark, sf):
    return _keywords(spark, sf, 3)


@query("extract_keywords_single_words", f"WITH {RECORDS_SQL}, {_phrases_sql(1)}")
def keywords_single(spark, sf):
    return _keywords(spark, sf, 1)


@query(
    "summarize",
    r"""WITH toks AS (SELECT doc_id, substr(md5(unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))), 1, 4) AS b FROM documents),
    idf AS (SELECT b, ln(((SELECT count(*) FROM documents) + 1) / (count(DISTINCT doc_id) + 1)) AS w FROM toks GROUP BY b),
    lists AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[.!?]+'),
      lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '') AS s FROM documents),
    sents AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos FROM lists),
    words AS (SELECT doc_id, pos, substr(md5(unnest(regexp_extract_all(lower(sentence), '[\p{L}\p{N}]+'))), 1, 4) AS b FROM sents),
    scores AS (SELECT doc_id, pos, round(avg(w), 9) AS score FROM words JOIN idf USING (b) GROUP BY doc_id, pos),
    best AS (SELECT s.doc_id, s.pos, sentence FROM sents s LEFT JOIN scores c ON c.doc_id = s.doc_id AND c.pos = s.pos
      QUALIFY row_number() OVER (PARTITION BY s.doc_id ORDER BY coalesce(score, 0) DESC, s.pos) <= 3),
    joined AS (SELECT doc_id, string_agg(sentence, ' ' ORDER BY pos) AS summary FROM best GROUP BY doc_id)
    SELECT d.doc_id AS seq, coalesce(summary, substr(text, 1, 150)) AS summary FROM documents d LEFT JOIN joined USING (doc_id)""",
)
def summaries(spark, sf):
    return summarize(records_base(spark, sf).select("seq", "content")).select("seq", "summary")


# Unit tf-idf weights of every document and term that not all documents have.
_TERMS = r"""tf AS (SELECT doc_id AS seq, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents) GROUP BY ALL),
    weighed AS (SELECT seq, term, tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) AS w FROM tf JOIN (SELECT term, count(*) AS df FROM tf GROUP BY term) USING (term)),
    unit AS (SELECT seq, term, (w / sqrt(sum(w * w) OVER (PARTITION BY seq)))::FLOAT AS w FROM weighed WHERE w > 0)"""


@query(
    "embed_texts",
    f"""WITH {_TERMS} SELECT d.doc_id AS seq, coalesce(n, 0) AS size, coalesce(total, 0) AS total, terms FROM documents d LEFT JOIN
    (SELECT seq, count(*) AS n, round(sum(w::DOUBLE), 3) AS total, md5(string_agg(term, ' ' ORDER BY term)) AS terms FROM unit GROUP BY seq) t ON t.seq = d.doc_id""",
)
def embeddings(spark, sf):
    rows = embed_texts(records_base(spark, sf).select("seq", "content"))
    weights, terms = F.col("content_embedding"), F.col("content_embedding_terms")
    total = F.round(F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w.cast("double")), 3)
    listed = F.when(F.size(terms) > 0, F.md5(F.array_join(terms, " ").cast("binary")))
    return rows.select("seq", F.size(weights).cast("long").alias("size"), total.alias("total"), listed.alias("terms"))


@query(
    "sparse_cosine_pairs",
    f"""WITH {_TERMS} SELECT a.seq AS lo, b.seq AS hi, round(sum(a.w::DOUBLE * b.w::DOUBLE), 4) AS cosine FROM unit a JOIN unit b ON a.term = b.term AND a.seq < b.seq
    GROUP BY a.seq, b.seq HAVING sum(a.w::DOUBLE * b.w::DOUBLE) >= 0.9""",
)
def term_pairs(spark, sf):
    found = term_vectors(records_base(spark, sf).select("seq", "content"))
    return sparse_cosine_pairs(found, 0.9).withColumn("cosine", F.round("cosine", 4))


@query("embedding_column_kept", "SELECT vec_id, len(embedding) AS size FROM embeddings")
def embedding_kept(spark, sf):
    rows = table(spark, sf, "embeddings").withColumnRenamed("embedding", "content_embedding")
    return embed_texts(rows).select("vec_id", F.size("content_embedding").alias("size"))


@query("cluster_vectors")
def clusters(spark, sf):
    return cluster_vectors(table(spark, sf, "embeddings"), "embedding").select("vec_id", "cluster")


def with_questions(spark, sf, question_bounds=None, answer_bounds=None):
    """Records with the first distinct words as keywords and two entities, a suitable and another one."""
    words = F.col("words")
    entity = lambda i, kind: F.struct(F.get(words, F.lit(i)).alias("text"), F.lit(kind).alias("type"))
    entities = F.filter(F.array(entity(0, "PERSON"), entity(1, "DATE")), lambda e: e["text"].isNotNull())
    base = records_base(spark, sf).withColumn("words", F.split("content", r"\s+"))
    base = base.withColumn("keywords", F.slice(words, 1, 7)).withColumn("summary", F.substring("content", 1, 60))
    return base.withColumn(
        "questions", generate_questions(F.col("title"), F.col("language"), F.col("keywords"), entities, **(question_bounds or {}))
    ).withColumn("answers", generate_answers(F.col("content"), F.col("summary"), **(answer_bounds or {})))


def with_capped_questions(spark, sf):
    """The same with the first keywords, entities, characters and lines only."""
    return with_questions(
        spark, sf, {"max_keywords": MAX_KEYWORD_QUESTIONS, "max_entities": MAX_ENTITY_QUESTIONS},
        {"max_length": MAX_TEXT_LENGTH, "max_paragraphs": MAX_PARAGRAPHS},
    )


def _question_rows() -> str:
    def text(template: str) -> str:
        out = lit(template)
        for name in ("keyword", "title", "entity"):
            out = out.replace("{" + name + "}", "' || " + name + " || '")
        return out

    def row(spec, pos: str, source: str) -> str:
        kind, difficulty, template = spec
        return (
            f"SELECT seq, language, {pos} AS pos, {text(template)} AS question, {lit(kind)} AS type, "
            f"{lit(difficulty)} AS difficulty FROM {source}"
        )

    parts = [row(DEFINITION_QUESTION, "0", "w")]
    parts += [row(spec, f"(k - 1) * 3 + {j + 1}", "kws") for j, spec in enumerate(KEYWORD_QUESTIONS)]
    parts.append(row(ENTITY_QUESTION, "1 + 3 * least(len(words), 5)", "ents"))
    return " UNION ALL ".join(parts)


_QUESTIONS = rf"""w AS (SELECT *, string_split_regex(content, '\s+') AS words FROM records_base),
  kws AS (SELECT *, words[k] AS keyword FROM (SELECT *, unnest(generate_series(1, least(len(words), 5))) AS k FROM w)),
  ents AS (SELECT *, words[1] AS entity FROM w),
  raw AS ({_question_rows()}),
  questions AS (SELECT seq, pos, {translate_sql("question", "language")} AS question, type, difficulty FROM raw)"""
_ANSWERS = r"""answers AS (
  SELECT seq, 0 AS pos, substr(content, 1, 60) AS answer, 'summary' AS type, 'short' AS length FROM records_base
  UNION ALL SELECT seq, 1, substr(content, 1, 10000), 'detailed', 'long' FROM records_base
  UNION ALL SELECT seq, 1 + i, lines[i], 'paragraph', 'medium' FROM (SELECT *, unnest(generate_series(1, least(len(lines), 3))) AS i
    FROM (SELECT seq, list_filter(string_split(content, chr(10)), lambda p: trim(p) <> '') AS lines FROM records_base)))"""


# The forms without bounds: all seven keywords, the whole text, all lines.
_WHOLE_QUESTIONS = _QUESTIONS.replace("least(len(words), 5)", "least(len(words), 7)")
_WHOLE_ANSWERS = _ANSWERS.replace("substr(content, 1, 10000)", "content").replace("least(len(lines), 3)", "len(lines)")


def _question_texts(records):
    rows = explode_positions(records, F.col("questions"), "seq", value="q")
    return rows.select("seq", "pos", F.col("q.text").alias("question"), "q.type", "q.difficulty")


def _answer_texts(records):
    rows = explode_positions(records, F.col("answers"), "seq", value="a")
    return rows.select("seq", "pos", F.col("a.text").alias("answer"), "a.type", "a.length")


def _pairs_sql(questions: str, answers: str) -> str:
    return f"""WITH {RECORDS_SQL}, {questions}, {answers} SELECT q.seq, q.pos, question, answer
    FROM questions q JOIN answers a ON a.seq = q.seq AND a.pos = q.pos"""


@query("generate_questions_whole", f"WITH {RECORDS_SQL}, {_WHOLE_QUESTIONS} SELECT * FROM questions")
@query("generate_questions", f"WITH {RECORDS_SQL}, {_WHOLE_QUESTIONS} SELECT * FROM questions")
def questions(spark, sf):
    return _question_texts(with_questions(spark, sf))


@query("generate_answers_whole", f"WITH {RECORDS_SQL}, {_WHOLE_ANSWERS} SELECT * FROM answers")
@query("generate_answers", f"WITH {RECORDS_SQL}, {_WHOLE_ANSWERS} SELECT * FROM answers")
def answers(spark, sf):
    return _answer_texts(with_questions(spark, sf))


@query("qa_pairs_whole", _pairs_sql(_WHOLE_QUESTIONS, _WHOLE_ANSWERS))
@query("qa_pairs", _pairs_sql(_WHOLE_QUESTIONS, _WHOLE_ANSWERS))
def qa_pairs(spark, sf):
    return W.qa_pairs(with_questions(spark, sf), "seq")


@query("generate_questions_capped", f"WITH {RECORDS_SQL}, {_QUESTIONS} SELECT * FROM questions")
def questions_capped(spark, sf):
    return _question_texts(with_capped_questions(spark, sf))


@query("generate_answers_capped", f"WITH {RECORDS_SQL}, {_ANSWERS} SELECT * FROM answers")
def answers_capped(spark, sf):
    return _answer_texts(with_capped_questions(spark, sf))


@query("qa_pairs_capped", _pairs_sql(_QUESTIONS, _ANSWERS))
def qa_pairs_capped(spark, sf):
    return W.qa_pairs(with_capped_questions(spark, sf), "seq")


@query(
    "conversation_pairs",
    """WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS pos FROM conversations)
    SELECT u.conv_id, u.pos, u.text AS question, a.text AS answer FROM t u JOIN t a ON a.conv_id = u.conv_id AND a.pos = u.pos
    WHERE u.role = 'user' AND a.role = 'assistant'""",
)
def conversation_pairs(spark, sf):
    # Turns are numbered in buckets and joined, so that a very long conversation is split over tasks.
    turns = numbered(table(spark, sf, "conversations"), "turn", "pos", ["conv_id", "role"])
    users = turns.filter("role = 'user'").select("conv_id", "pos", F.col("text").alias("question"))
    replies = turns.filter("role = 'assistant'").select("conv_id", "pos", F.col("text").alias("answer"))
    return users.join(replies, ["conv_id", "pos"])


@query(
    "conversation_zip",
    """WITH t AS (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS reply, role,
        lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM conversations)
    SELECT conv_id, turn, text AS question, reply AS answer FROM t WHERE role = 'user' AND next_role = 'assistant'""",
)
def conversation_zip(spark, sf):
    turns = numbered(table(spark, sf, "conversations"), "turn", "pos", ["conv_id"])
    users = turns.filter("role = 'user'").select("conv_id", "turn", (F.col("pos") + 1).alias("pos"), F.array("text").alias("q"))
    replies = turns.filter("role = 'assistant'").select("conv_id", "pos", F.array("text").alias("a"))
    pairs = zip_shorter(F.col("q"), F.col("a"), "question", "answer")
    zipped = users.join(replies, ["conv_id", "pos"]).select("conv_id", "turn", F.explode(pairs).alias("p"))
    return zipped.select("conv_id", "turn", "p.question", "p.answer")


@query("embedding_export", "SELECT md5('vec ' || vec_id) AS id, round(list_sum(embedding::DOUBLE[]), 4) AS total FROM embeddings")
def embedding_export(spark, sf):
    records = table(spark, sf, "embeddings").select(
        F.md5(F.concat(F.lit("vec "), "vec_id")).alias("id"), F.col("embedding").alias("content_embedding")
    )
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return W.embedding_export(records).select("id", F.round(total, 4).alias("total"))


@query(
    "keyword_triples",
    f"WITH {RECORDS_SQL}, p AS ({_phrases_sql(1).replace('toks AS', 'WITH toks AS', 1)}) "
    "SELECT title AS subject, 'related_to' AS relation, phrase AS object FROM p JOIN records_base USING (seq)",
)
def keyword_triples(spark, sf):
    found = extract_keywords(F.col("content"), F.col("language"), STOP_WORDS, max_words=1)
    return W.triples(records_base(spark, sf).withColumn("keywords", found))
