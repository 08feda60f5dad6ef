"""Queries over the driver tables, one or more per operator, each with its SQL where SQL can say it."""

from catalog import corpus, duplicates, html_jobs, joins, open_fields, ranks, records, sinks_sources, stats_sets, streams, text  # noqa: F401
from catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

# Columns that are 32-bit in Spark and 64-bit in the SQL as written.
_INTEGERS = {
    "rank": ["extract_keywords", "extract_keywords_single_words", "top_n_per_group"],
    "pos": [
        "generate_questions", "generate_answers", "qa_pairs",
        "generate_questions_whole", "generate_answers_whole", "qa_pairs_whole",
        "generate_questions_capped", "generate_answers_capped", "qa_pairs_capped", "extract_links", "extract_links_parsed",
        "category_page_links", "revision_history", "positional_zip", "split_sentences",
    ],
    "length": ["build_record_scalars", "stream_records"],
    "n": ["minimum_length", "clean_text"],
    "size": ["embedding_column_kept"],
    "kept": ["positional_caps"],
}
for _column, _names in _INTEGERS.items():
    for _name in _names:
        ORACLES[_name] = f"SELECT * REPLACE ({_column}::INTEGER AS {_column}) FROM ({ORACLES[_name]})"
