"""Summaries by latent ranks and by exact document frequencies."""

from __future__ import annotations

from catalog.base import query, records_base
from corpusmill.operators.sentence_ranks import summarize_exact, summarize_latent

_SENTENCES = r"""lists AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[.!?]+'),
      lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '') AS s FROM documents),
    sents AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos FROM lists),
    words AS (SELECT doc_id, pos, unnest(regexp_extract_all(lower(sentence), '[\p{L}\p{N}]+')) AS word FROM sents)"""

_CHOSEN = """best AS (SELECT s.doc_id, s.pos, sentence FROM sents s LEFT JOIN scores c ON c.doc_id = s.doc_id AND c.pos = s.pos
      QUALIFY row_number() OVER (PARTITION BY s.doc_id ORDER BY score DESC NULLS LAST, s.pos) <= 3),
    joined AS (SELECT doc_id, string_agg(sentence, ' ' ORDER BY pos) AS summary FROM best GROUP BY doc_id)
    SELECT d.doc_id AS seq, coalesce(summary, substr(text, 1, 150)) AS summary FROM documents d LEFT JOIN joined USING (doc_id)"""


@query(
    "summarize_latent",
    f"""WITH {_SENTENCES},
    counted AS (SELECT doc_id, pos, word, count(*) AS c FROM words GROUP BY ALL),
    sums AS (SELECT doc_id, pos, sum(c)::DOUBLE AS n, max(c)::DOUBLE AS m, sum(c * c)::DOUBLE AS q FROM counted GROUP BY ALL),
    scores AS (SELECT doc_id, pos, (4 * n * m + 3 * q) / (m * m) AS score FROM sums), {_CHOSEN}""",
)
def latent(spark, sf):
    return summarize_latent(records_base(spark, sf).select("seq", "content")).select("seq", "summary")


@query(
    "summarize_exact",
    f"""WITH {_SENTENCES},
    idf AS (SELECT word, ln(((SELECT count(*) FROM documents) + 1) / (count(DISTINCT doc_id) + 1)) AS w FROM words GROUP BY word),
    scores AS (SELECT doc_id, pos, round(avg(w), 9) AS score FROM words JOIN idf USING (word) GROUP BY doc_id, pos), {_CHOSEN}""",
)
def exact(spark, sf):
    return summarize_exact(records_base(spark, sf).select("seq", "content")).select("seq", "summary")
