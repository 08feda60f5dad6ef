"""Topic rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.constants import DEFAULT_SUBTOPIC, DEFAULT_TOPIC, TOPIC_RULES
from corpusmill.functions.common import let


def _any_word(text: Column, entries: list[str]) -> Column:
    hit = F.lit(False)
    for entry in entries:
        hit = hit | F.contains(text, F.lit(entry))
    return hit


def classify_topic(title: Column, content: Column) -> Column:
    """Struct (topic, subtopic): first rule with a keyword anywhere in title or content."""

    def rules(text: Column) -> Column:
        out = None
        for topic, keywords, subtopics in TOPIC_RULES:
            sub = None
            for name, entries in subtopics:
                hit = _any_word(text, entries)
                sub = F.when(hit, name) if sub is None else sub.when(hit, name)
            value = F.struct(
                F.lit(topic).alias("topic"), sub.otherwise(DEFAULT_SUBTOPIC).alias("subtopic")
            )
            hit = _any_word(text, keywords)
            out = F.when(hit, value) if out is None else out.when(hit, value)
        default = F.struct(F.lit(DEFAULT_TOPIC).alias("topic"), F.lit(DEFAULT_SUBTOPIC).alias("subtopic"))
        return out.otherwise(default)

    # The separator occurs in no keyword, so no match can span title and content.
    haystack = F.concat(
        F.lower(F.coalesce(title, F.lit(""))), F.lit("\n"), F.lower(F.coalesce(content, F.lit("")))
    )
    return let(haystack, rules)
